"""Town-level operators: neighbours, recent weeks, risk bands, silence, use of the laboratory, confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import CONFIDENCE_CUTS, CONFIDENCE_LEVELS, average_rank_share, bins, clip, haversine_km, ratio

WEEK = ["epi_year", "epi_week"]
#: Bounds of valid coordinates, and the size of a grid cell in degrees.
LATITUDE, LONGITUDE, CELL = (-18.5, -7.0), (-62.5, -50.0), 1.2


def valid_coordinates(master: DataFrame) -> DataFrame:
    """One row for each town inside the box; of several the least coordinates stay."""
    inside = master.where(F.col("latitude").between(*LATITUDE) & F.col("longitude").between(*LONGITUDE))
    return inside.groupBy("municipio").agg(F.min(F.struct("latitude", "longitude")).alias("_p")).select("municipio", "_p.latitude", "_p.longitude")


def neighbours(points: DataFrame, k: int = 6, max_km: float = 120.0) -> DataFrame:
    """The k nearest towns within ``max_km``. Towns meet by grid cell, never all with all:
    each is dealt to its own cell and looks for others in the cells around it."""
    reach_lat = int(max_km / 111.0 / CELL) + 1
    narrowest = 0.85  # cosine of the widest latitude that is used, with room to spare
    reach_lon = int(max_km / (111.0 * narrowest) / CELL) + 1
    cell = points.select("municipio", "latitude", "longitude", F.floor(F.col("latitude") / CELL).alias("cy"), F.floor(F.col("longitude") / CELL).alias("cx"))
    around = cell.select("municipio", "latitude", "longitude", F.explode(F.sequence(F.col("cy") - reach_lat, F.col("cy") + reach_lat)).alias("cy"), "cx")
    around = around.select("municipio", "latitude", "longitude", "cy", F.explode(F.sequence(F.col("cx") - reach_lon, F.col("cx") + reach_lon)).alias("cx"))
    other = cell.select(F.col("municipio").alias("vizinho"), F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), "cy", "cx")
    pairs = around.join(other, ["cy", "cx"]).where("municipio != vizinho")
    near = pairs.select("municipio", "vizinho", haversine_km(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon")).alias("dist_km")).where(F.col("dist_km") <= max_km)
    w = Window.partitionBy("municipio").orderBy("dist_km", "vizinho")
    return near.withColumn("rank_vizinho", F.row_number().over(w).cast("long")).where(F.col("rank_vizinho") <= k)


def around(edges: DataFrame, values: DataFrame, value: str, alert: str) -> DataFrame:
    """How many neighbours are alert, and the median of their value; unknown neighbours count as 0."""
    joined = edges.select("municipio", "vizinho").join(values.select(F.col("municipio").alias("vizinho"), value, alert), "vizinho", "left")
    return joined.groupBy("municipio").agg(F.sum(F.coalesce(F.col(alert).cast("int"), F.lit(0))).cast("long").alias("vizinhos_em_alerta"), F.median(F.coalesce(F.col(value), F.lit(0)).cast("double")).alias("mediana_vizinhos"), F.count(F.lit(1)).alias("n_vizinhos"))


def last_weeks(panel: DataFrame, n: int = 8, skip: int = 0) -> DataFrame:
    """The last ``n`` observed weeks but the last ``skip``: a table of n rows, whatever the panel's size."""
    weeks = panel.dropna(subset=WEEK).select(*WEEK).distinct().orderBy(F.desc("epi_year"), F.desc("epi_week")).limit(n + skip)
    if not skip:
        return weeks
    return weeks.withColumn("_r", F.row_number().over(Window.orderBy(F.desc("epi_year"), F.desc("epi_week")))).where(F.col("_r") > skip).drop("_r")


def recent(panel: DataFrame, n: int = 8, skip: int = 0) -> DataFrame:
    return panel.join(F.broadcast(last_weeks(panel, n, skip)), WEEK, "left_semi")


def town_target(panel: DataFrame) -> DataFrame:
    """O111, O115: town and target over the last eight weeks: use of the laboratory, silence, low use."""
    level = F.create_map(*[F.lit(x) for i, n in enumerate(["habitual", "atencao", "alerta", "alto_alerta"]) for x in (n, i)])
    sums = recent(panel).groupBy("municipio", "target").agg(
        F.count(F.lit(1)).alias("semanas"), F.sum("tests").alias("tests"), F.sum("positives").alias("positives"), F.sum("notificacoes").alias("notificacoes"), F.max("populacao").alias("populacao"),
        F.avg("risco_composto").alias("risco_medio"), F.max("risco_composto").alias("risco_max"), F.max(F.element_at(level, F.col("nivel_risco"))).cast("long").alias("nivel_max"),
    )
    silent = (F.col("tests") == 0) & (F.col("notificacoes") > 0)
    low = (F.col("notificacoes") >= 3) & (F.col("tests") < F.greatest(F.lit(1.0), F.col("notificacoes") * 0.2))
    rate = F.when(F.col("notificacoes") > 0, F.col("tests") / F.col("notificacoes")).when(F.col("tests") > 0, F.lit(None).cast("double")).otherwise(0.0)
    out = sums.select("*", rate.alias("taxa_utilizacao"), silent.alias("silencio_laboratorial"), low.alias("baixo_uso"), ratio(F.col("tests"), F.col("notificacoes"), 100.0).alias("exames_por_100_notificacoes"), ratio(F.col("tests"), F.col("populacao"), 1e5).alias("exames_por_100k"))
    use = F.when(F.col("silencio_laboratorial"), "silencio").when(F.col("baixo_uso"), "baixo").when(F.coalesce("taxa_utilizacao", F.lit(0.0)) >= 1, "adequado_ou_alto").otherwise("intermediario")
    return out.withColumn("classificacao_uso", use)


BANDS = ["Baixo", "Moderado", "Alto", "Crítico"]


def _band(value: Column, cuts: tuple[float, float, float]) -> Column:
    return F.when(value >= cuts[2], 3).when(value >= cuts[1], 2).when(value >= cuts[0], 1).otherwise(0)


def territorial_risk(by_target: DataFrame) -> DataFrame:
    """O112: a town's score, its band by quantiles of all towns, by fixed cuts and by percentile. The quantiles are one row."""
    towns = by_target.groupBy("municipio").agg(
        F.countDistinct("target").alias("alvos_monitorados"), F.sum("tests").alias("tests_8sem"), F.sum("positives").alias("positives_8sem"), F.sum("notificacoes").alias("notificacoes_8sem"),
        F.avg("risco_medio").alias("risco_medio"), F.max("risco_max").alias("risco_max"), F.count_if(F.col("nivel_max") >= 2).alias("alvos_alerta"),
    )
    score = clip(F.coalesce("risco_max", F.lit(0.0)), 0, 10) * 0.55 + clip(F.coalesce("risco_medio", F.lit(0.0)), 0, 10) * 0.25 + F.coalesce(ratio(F.col("alvos_alerta"), F.col("alvos_monitorados")), F.lit(0.0)) * 0.20
    scored = towns.withColumn("score_risco_territorial", score)
    cuts = scored.agg(*[F.percentile("score_risco_territorial", q).alias(f"_q{round(100 * q)}") for q in (0.5, 0.75, 0.9)])
    q50, q75 = F.col("_q50"), F.greatest(F.col("_q75"), F.col("_q50") + 1e-6)
    q90, s = F.greatest(F.col("_q90"), F.col("_q75") + 1e-6), F.col("score_risco_territorial")
    share = average_rank_share(s, [F.lit(1)]) * 100.0
    placed = scored.join(F.broadcast(cuts), F.lit(True)).select("*", F.when(s <= q50, "habitual").when(s <= q75, "atencao").when(s <= q90, "alerta").otherwise("alto_alerta").alias("faixa_risco"), share.alias("_pct"))
    fixed, relative = _band(F.coalesce("risco_max", F.lit(0.0)), (1, 2, 3)), _band(F.col("_pct"), (50, 75, 90))
    name = lambda c: F.element_at(F.array(*[F.lit(b) for b in BANDS]), c + 1)
    criterion = F.when(fixed > relative, "absoluto").when(relative > fixed, "percentil").otherwise("ambos")
    return placed.select(*scored.columns, "faixa_risco", name(fixed).alias("banda_absoluta"), F.round("_pct", 1).alias("percentil_estadual"), name(relative).alias("banda_percentil"), name(F.greatest(fixed, relative)).alias("banda_risco"), criterion.alias("criterio_banda"))


def silence(universe: DataFrame, panel: DataFrame) -> DataFrame:
    """O113: every town of ``universe`` (municipio, populacao, indice_vulnerabilidade), with what it sent lately and before, its class and score."""
    sums = lambda df, tag: df.groupBy("municipio").agg(F.sum("tests").alias(f"tests_{tag}"), F.sum("notificacoes").alias(f"notif_{tag}"))
    joined = universe.join(sums(recent(panel), "recent"), "municipio", "left").join(sums(panel, "hist"), "municipio", "left").fillna(0)
    none, past, noted = F.col("tests_recent") <= 0, F.col("tests_hist") > 0, F.col("notif_recent") > 0
    pop, vulnerable = F.col("populacao"), F.col("indice_vulnerabilidade")
    kind = (
        F.when(none & (noted | (past & (pop >= 5000) & (vulnerable >= 0.5))), "silencio_critico").when(none & ((pop >= 10000) | (past & (pop >= 3000))), "silencio_provavel")
        .when(none & (pop >= 3000), "silencio_moderado").when((F.col("notif_recent") >= 3) & (F.col("tests_recent") < F.greatest(F.lit(1.0), F.col("notif_recent") * 0.2)), "baixo_uso").otherwise("")
    )
    point = lambda c, x: c.cast("int") * x
    score = point(none, 2.0) + point(~past & none, 0.5) + point(noted, 2.0) + point(pop >= 10000, 1.0) + point(pop >= 5000, 0.5) + point(vulnerable >= 0.5, 1.0) + point(vulnerable >= 1.0, 0.5)
    return joined.select("*", kind.alias("classificacao_silencio"), score.alias("score_silencio"))


def silence_near_alerts(silent: DataFrame, rolled: DataFrame) -> DataFrame:
    """O114: a silent town with an alert neighbour gains 1.5 points and becomes critical."""
    joined = silent.join(rolled.select("municipio", "vizinhos_em_alerta"), "municipio", "left").fillna({"vizinhos_em_alerta": 0})
    up = (F.col("vizinhos_em_alerta") > 0) & F.col("classificacao_silencio").isin("silencio_moderado", "silencio_provavel", "baixo_uso")
    near = (F.col("vizinhos_em_alerta") > 0) & (F.col("classificacao_silencio") != "")
    return joined.select(*[c for c in silent.columns if c not in ("classificacao_silencio", "score_silencio")], "vizinhos_em_alerta",
        (F.col("score_silencio") + F.when(near, 1.5).otherwise(0.0)).alias("score_silencio"), F.when(up, "silencio_critico").otherwise(F.col("classificacao_silencio")).alias("classificacao_silencio"), near.alias("silencio_com_vizinho_alerta"))


#: What a town's data say, in this order; the first that holds.
READINGS = [
    "notificações sem exames: a captação pode ter parado", "notificações que não se ligam a nenhum alvo: rever o mapeamento", "dados em poucas semanas: ler com cautela", "boa cobertura recente", "cobertura intermediária: acompanhar",
]


def confidence(panel: DataFrame, notified: DataFrame) -> DataFrame:
    """How far a town's data of the last eight weeks can be trusted: weeks with data, exams, no gap between notifications and exams,
    notifications that meet a target; its band and one of five readings (``READINGS``)."""
    seen = recent(panel).groupBy("municipio").agg(F.sum("tests").alias("exames"), F.sum("positives").alias("positivos"), F.countDistinct(*WEEK).alias("semanas_com_dado"), F.sum("notificacoes").alias("notif_join"))
    noted = notified.join(F.broadcast(last_weeks(panel)), WEEK, "left_semi").groupBy("municipio").agg(F.sum("notificacoes").alias("notif_sinan"))
    both = seen.join(noted, "municipio", "full").fillna(0)
    gap, weak = (F.col("notif_sinan") > 0) & (F.col("exames") <= 0), (F.col("notif_sinan") > 0) & (F.col("notif_join") <= 0)
    score = F.least(F.col("semanas_com_dado") / 8.0, F.lit(1.0)) * 0.35 + (F.col("exames") > 0).cast("int") * 0.25 + (~gap).cast("int") * 0.20 + (~weak).cast("int") * 0.20
    scored = both.select("*", F.round(score, 3).alias("confianca_dado"), gap.alias("gap_sinan_sem_exame"), weak.alias("join_sinan_fraco"))
    reading = F.when(F.col("gap_sinan_sem_exame"), READINGS[0]).when(F.col("join_sinan_fraco"), READINGS[1]).when(F.col("confianca_dado") < 0.35, READINGS[2]).when(F.col("confianca_dado") >= 0.8, READINGS[3]).otherwise(READINGS[4])
    return scored.withColumn("faixa_confianca", bins(F.col("confianca_dado"), CONFIDENCE_CUTS, CONFIDENCE_LEVELS)).withColumn("interpretacao", reading)


def integration(exams: DataFrame, notified: DataFrame, other: DataFrame, deaths: DataFrame, capacity: DataFrame) -> DataFrame:
    """Towns side by side: exams, the larger of two notification sources, deaths, capacity."""
    a = notified.groupBy("municipio").agg(F.sum("notificacoes").alias("n1")).join(other.groupBy("municipio").agg(F.sum("notificacoes").alias("n2")), "municipio", "full")
    joined = exams.groupBy("municipio").agg(F.countDistinct("record_id").alias("exames")).join(a, "municipio", "full").join(deaths.groupBy("municipio").agg(F.sum("obitos").alias("obitos")), "municipio", "left").join(capacity, "municipio", "left")
    n = F.greatest(F.coalesce("n1", F.lit(0)), F.coalesce("n2", F.lit(0)))
    return joined.select("municipio", F.coalesce("exames", F.lit(0)).alias("exames"), n.alias("notificacoes"), F.coalesce("obitos", F.lit(0)).alias("obitos"), "cnes_leitos_total", ratio(F.col("exames"), n).alias("exames_por_notificacao"), ((n > 0) & (F.coalesce("exames", F.lit(0)) == 0)).alias("lacuna"))


def executive_summary(panel: DataFrame, n: int = 8) -> DataFrame:
    """One row: the latest year and the highest week of the last ``n`` observed weeks, their exams, positives, towns and targets."""
    sums = recent(panel, n).agg(
        F.max("epi_year").alias("epi_year_max"), F.max("epi_week").alias("epi_week_max"), F.sum("tests").cast("double").alias("exames_8sem"), F.sum("positives").cast("double").alias("positivos_8sem"), F.countDistinct("municipio").alias("municipios"), F.countDistinct("target").alias("agravos"))
    return sums.withColumn("positividade_8sem", ratio(F.col("positivos_8sem"), F.col("exames_8sem")))


def ordered(towns: DataFrame, order: list[Column]) -> DataFrame:
    """O103: ``towns`` with the place of each in a mixed order. The window is over a dimension: one row for each town."""
    return towns.withColumn("ordem", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order)).cast("long"))
