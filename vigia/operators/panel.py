"""The integrated panel: joins of the weekly table with context, composite risk, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import RISK_CUTS, RISK_LEVELS, average_rank_share, bins, clip, with_robust_z
from ..functions import weeks
from ..functions.text import norm_town, normalize_prop
from .aggregates import SERIES, with_rates


def integrate(weekly: DataFrame, notified: DataFrame, deaths: DataFrame, population: DataFrame, master: DataFrame, capacity: DataFrame, disease: Column) -> DataFrame:
    """The panel with notifications and deaths through the bridge key, population of the year, and town context.

    Facts are grouped before they are joined; rows without a match keep their cell with nulls.
    The week's notifications of a town, whatever the disease, come from the same grouped table.
    """
    keys = ["epi_year", "epi_week", "municipio", "agravo"]
    base = weekly.withColumn("agravo", disease)
    town_week = notified.groupBy("epi_year", "epi_week", "municipio").agg(F.sum("notificacoes").alias("notificacoes_mun_semana"))
    joined = base.join(notified.select(*keys, "notificacoes"), keys, "left").join(deaths.select(*keys, F.col("obitos")), keys, "left").join(town_week, keys[:3], "left")
    joined = joined.join(population.withColumnRenamed("ano", "epi_year"), ["municipio", "epi_year"], "left")
    return with_rates(joined.join(master, "municipio", "left").join(capacity, "municipio", "left"))


def vulnerability(master: DataFrame) -> DataFrame:
    """Mean of the robust z of development (inverse), inequality, poverty and working people (inverse rank).

    The window is over a dimension: one row for each town."""
    ranked = master.select("*", (1 - average_rank_share(F.col("pea_2010"), [F.lit(1)])).alias("pea_inv"), (1 - F.col("idh")).alias("idh_inv"), F.lit(1).alias("_all"))
    z = with_robust_z(ranked, {"idh_inv": "idh_inv_z", "gini": "gini_z", "extrema_pobreza_pct": "extrema_pobreza_pct_z", "pea_inv": "pea_inv_z"}, ["_all"])
    parts = ["idh_inv_z", "gini_z", "extrema_pobreza_pct_z", "pea_inv_z"]
    return z.drop("_all").withColumn("indice_vulnerabilidade", sum((F.col(p) for p in parts[1:]), F.col(parts[0])) / 4.0)


Z = {"tests": "z_tests", "positividade": "z_pos", "incidencia_100k": "z_inc", "notificacoes_100k": "z_notif", "mortalidade_100k": "z_mort"}


def scored(panel: DataFrame) -> DataFrame:
    """O91, O109: robust z of five measures in each series, held in [0, 5], and the composite risk with its level."""
    zed = with_robust_z(panel, Z, SERIES)
    held = [clip(F.coalesce(F.col(z), F.lit(0.0)), 0, 5).alias(z) for z in Z.values()]
    kept = zed.select(*panel.columns, *held)
    vulnerable = clip(F.coalesce("indice_vulnerabilidade", F.lit(0.0)), 0, 5)
    risk = clip(F.col("z_tests") * 0.25 + F.col("z_pos") * 0.20 + F.col("z_inc") * 0.20 + F.col("z_notif") * 0.15 + F.col("z_mort") * 0.10 + vulnerable * 0.10, 0, 10)
    return kept.withColumn("risco_composto", risk).withColumn("nivel_risco", bins(F.col("risco_composto"), RISK_CUTS, RISK_LEVELS))


def risk_v1(panel: DataFrame) -> DataFrame:
    """O108: the earlier weights, z not held from above; capacity (inverse beds) and weather severity count too."""
    z = with_robust_z(panel, Z, SERIES)
    plus = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0))
    short = 1 / (1 + F.coalesce(F.col("cnes_leitos_total"), F.lit(0)))
    risk = plus("z_tests") * 0.20 + plus("z_pos") * 0.20 + plus("z_inc") * 0.15 + plus("z_notif") * 0.10 + plus("z_mort") * 0.15 + plus("indice_vulnerabilidade") * 0.10 + short * 0.05 + F.coalesce(F.col("severidade_max"), F.lit(0)) * 0.05
    return z.withColumn("risco_v1", risk).withColumn("nivel_v1", bins(F.col("risco_v1"), RISK_CUTS, RISK_LEVELS))


def gate(rows: DataFrame, year: Column, worst: float = 0.5) -> DataFrame:
    """A source of which more than ``worst`` has an impossible year is dropped whole. The share is one row, and is joined as such."""
    fine = F.coalesce(year.between(1990, 2100), F.lit(False))
    share = rows.agg(F.avg((~fine).cast("double")).alias("_bad"))
    return rows.join(F.broadcast(share), F.lit(True)).where(fine & (F.col("_bad") <= worst)).drop("_bad")


def early_alerts(weekly: DataFrame, least: int = 5) -> DataFrame:
    """Each week of a series against the same week of earlier years and the eight weeks seen before it.

    Counts and positivity have thresholds of mean + 2 deviations; what passes one gives an alert and adds to the score.
    ``weekly`` has target, municipio, epi_year, epi_week, tests, positividade (may be null).
    """
    same = Window.partitionBy(*SERIES, "epi_week").orderBy("epi_year").rowsBetween(Window.unboundedPreceding, -1)
    eight = Window.partitionBy(*SERIES).orderBy("epi_year", "epi_week").rowsBetween(-8, -1)
    upto = Window.partitionBy(*SERIES).orderBy("epi_year", "epi_week").rowsBetween(Window.unboundedPreceding, -1)

    def pair(c: str, w, name: str) -> list[Column]:
        v = F.col(c).cast("double")
        return [F.avg(v).over(w).alias(f"{name}_mean"), F.when(F.count(v).over(w) > 1, F.stddev_samp(v).over(w)).otherwise(0.0).alias(f"{name}_std")]

    seen = weekly.select("*", *pair("tests", same, "st"), *pair("tests", eight, "rt"), *pair("positividade", same, "sp"))
    # the k-th known positivity of a series stands with seven before it; a row looks at the last known one before it (0: none)
    numbered = seen.withColumn("_nth", F.count("positividade").over(upto))
    nth = Window.partitionBy(*SERIES).orderBy("_place").rowsBetween(-7, 0)
    known = numbered.where("positividade is not null").select(*SERIES, (F.col("_nth") + 1).alias("_place"), "positividade")
    recent = known.select(*SERIES, F.col("_place").alias("_nth"), *pair("positividade", nth, "rp"))
    filled = numbered.join(recent, [*SERIES, "_nth"], "left").fillna(0.0, ["rp_std"])
    volume = F.greatest(F.col("st_mean") + 2 * F.col("st_std"), F.col("rt_mean") + 2 * F.col("rt_std"))
    positive = F.greatest(F.col("sp_mean") + 2 * F.col("sp_std"), F.col("rp_mean") + 2 * F.col("rp_std"))
    out = filled.withColumn("volume_threshold", volume).withColumn("positivity_threshold", positive)
    out = out.withColumn("volume_alert", F.col("tests") >= F.greatest(F.lit(float(least)), F.coalesce("volume_threshold", F.lit(float(least)))))
    out = out.withColumn("positivity_alert", F.coalesce((F.col("positividade") >= F.col("positivity_threshold")) & (F.col("tests") >= least), F.lit(False)))
    by_volume = F.when(F.col("volume_threshold") > 0, F.col("volume_threshold")).otherwise(F.greatest(F.lit(1.0), F.coalesce("st_mean", "rt_mean", F.lit(1.0))))
    by_positive = F.when(F.col("positivity_threshold") > 0, F.col("positivity_threshold")).otherwise(F.greatest(F.lit(0.01), F.coalesce("sp_mean", "rp_mean", F.lit(0.01))))
    score = F.when(F.col("volume_alert"), F.col("tests") / by_volume).otherwise(0.0) + F.when(F.col("positivity_alert"), F.col("positividade") / by_positive).otherwise(0.0)
    level = F.when(F.col("alert_score") >= 3, "alto").when(F.col("alert_score") >= 2, "moderado").when(F.col("alert_score") > 0, "baixo").otherwise("sem_sinal")
    keep = [*SERIES, "epi_year", "epi_week", "tests", "positividade", "volume_threshold", "positivity_threshold", "volume_alert", "positivity_alert", "alert_score"]
    return out.withColumn("alert_score", score).select(*keep).withColumn("alert_level", level)


def alerts_in_context(alerts: DataFrame, panel: DataFrame) -> DataFrame:
    """O110: alerts with the risk of their cell."""
    return alerts.join(panel.select(*SERIES, "epi_year", "epi_week", "risco_composto", "nivel_risco"), [*SERIES, "epi_year", "epi_week"], "left")


#: Names under which the columns of a panel come; the first that is there counts.
WEEKLY_NAMES = {
    "target": ["target", "alvo", "agravo", "agravo_alvo", "doenca"], "municipio": ["municipio", "Município", "Municipio", "municipio_residencia", "mun"], "epi_year": ["epi_year", "ano", "year", "ano_epidemiologico"],
    "epi_week": ["epi_week", "semana", "week", "semana_epidemiologica"], "tests": ["tests", "testes", "solicitacoes", "solicitacoes_lab", "n_testes", "exames"], "positives": ["positives", "positivos", "detectados", "reagentes", "n_positivos"],
    "negatives": ["negatives", "negativos", "n_negativos"], "notificacoes": ["notificacoes", "notificacoes_sinan", "casos_sinan", "casos"], "obitos": ["obitos_sim", "obitos", "deaths", "mortes"], "populacao": ["populacao", "pop", "population"],
    "positividade": ["positividade", "positivity", "positividade_media", "taxa_positividade", "pos_rate"], "incidencia_100k": ["incidencia_100k", "incidencia", "incidencia_media_100k"], "mortalidade_100k": ["mortalidade_100k", "mortalidade"],
    "risco_composto": ["risco_composto", "indice_risco_integrado", "risco_integrado", "risk_score"],
}
ANNUAL_NAMES = {
    "target": ["target", "alvo", "agravo"], "ano": ["ano", "year", "epi_year"], "testes": ["testes", "tests", "solicitacoes"], "positivos": ["positivos", "positives"], "notificacoes": ["notificacoes", "notificacoes_sinan"], "obitos": ["obitos", "obitos_sim"],
    "positividade_media": ["positividade_media", "positividade", "positivity"], "incidencia_100k": ["incidencia_100k", "incidencia_media_100k"], "risco_max": ["risco_max", "risco_composto", "indice_risco_integrado"],
}


def _named(df: DataFrame, names: dict[str, list[str]]) -> dict[str, Column | None]:
    """The column that each name stands for, as it is; None where the table has none."""
    return {name: next((F.col(f"`{c}`") for c in others if c in df.columns), None) for name, others in names.items()}


def _number(c: Column | None, otherwise: float | None = None) -> Column:
    return F.lit(otherwise).cast("double") if c is None else c.cast("string").try_cast("double")


def _global_z(df: DataFrame, columns: list[str]) -> DataFrame:
    """``_z_<column>``: O91 over the whole table. Medians, deviations and means are rows of one aggregate each, so no window holds the table."""
    first = df.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("med", F.median), ("avg", F.avg), ("sd", F.stddev_pop))])
    centred = df.join(F.broadcast(first), F.lit(True))
    spread = centred.agg(*[F.median(F.abs(F.col(c) - F.col(f"_med_{c}"))).alias(f"_mad_{c}") for c in columns])
    out = []
    for c in columns:
        plain = F.when(F.col(f"_sd_{c}") > 1e-12, (F.col(c) - F.col(f"_avg_{c}")) / F.col(f"_sd_{c}")).otherwise(0.0)
        out.append(F.when(F.col(f"_mad_{c}") > 0, 0.6745 * (F.col(c) - F.col(f"_med_{c}")) / F.col(f"_mad_{c}")).otherwise(plain).alias(f"_z_{c}"))
    return centred.join(F.broadcast(spread), F.lit(True)).select(*df.columns, *out)


def harmonise(panel: DataFrame) -> DataFrame:
    """O146: a weekly panel under any of its names (``WEEKLY_NAMES``) with canonical ones: numbers, towns, what can be derived where it is missing
    (positivity, incidence of notifications, mortality, and for the risk the mean of three robust z-scores), the week's label and Monday."""
    c = _named(panel, WEEKLY_NAMES)
    zero = {n: _number(c[n], 0.0) for n in ("tests", "positives", "notificacoes", "obitos")}
    out = panel.select(
        (c["target"].cast("string") if c["target"] is not None else F.lit("outros")).alias("target"), (norm_town(c["municipio"]) if c["municipio"] is not None else F.lit("IGNORADO")).alias("municipio"),
        *[_number(c[n]).cast("long").alias(n) for n in ("epi_year", "epi_week")], *[v.alias(n) for n, v in zero.items()], *[_number(c[n]).alias(n) for n in ("negatives", "populacao", "positividade", "incidencia_100k", "mortalidade_100k", "risco_composto")])
    per = lambda n: F.when(F.col("populacao") > 0, F.col(n) / F.col("populacao") * 1e5)
    derived = {
        "positividade": normalize_prop(F.col("positividade")) if c["positividade"] is not None else F.when(F.col("tests") != 0, F.col("positives") / F.col("tests")),
        "incidencia_100k": F.col("incidencia_100k") if c["incidencia_100k"] is not None else per("notificacoes"), "mortalidade_100k": F.col("mortalidade_100k") if c["mortalidade_100k"] is not None else per("obitos"),
    }
    out = out.withColumns(derived)
    if c["risco_composto"] is None:
        middle = out.agg(F.median("positividade").alias("_m"))
        filled = out.join(F.broadcast(middle), F.lit(True)).withColumns({"_t": F.coalesce("tests", F.lit(0.0)), "_p": F.coalesce("positividade", "_m"), "_n": F.coalesce("notificacoes", F.lit(0.0))}).drop("_m")
        z = _global_z(filled, ["_t", "_p", "_n"])
        out = z.withColumn("risco_composto", sum((F.coalesce(f"_z_{x}", F.lit(0.0)) for x in ("_t", "_p", "_n")), F.lit(0.0)) / 3).select(*out.columns)
    return out.select("*", weeks.week_label(F.col("epi_year"), F.col("epi_week")).alias("periodo"), weeks.monday(F.col("epi_year"), F.col("epi_week")).alias("periodo_data"))


def harmonise_annual(panel: DataFrame) -> DataFrame:
    """O146: a yearly table under any of its names (``ANNUAL_NAMES``): counts that are missing are 0, positivity is derived, other rates stay unknown."""
    c = _named(panel, ANNUAL_NAMES)
    counts = {n: _number(c[n], 0.0) for n in ("testes", "positivos", "notificacoes", "obitos")}
    share = normalize_prop(_number(c["positividade_media"])) if c["positividade_media"] is not None else F.when(counts["testes"] != 0, counts["positivos"] / counts["testes"])
    return panel.select(
        (c["target"].cast("string") if c["target"] is not None else F.lit("outros")).alias("target"), _number(c["ano"]).cast("long").alias("ano"), *[v.alias(n) for n, v in counts.items()], share.alias("positividade_media"),
        _number(c["incidencia_100k"]).alias("incidencia_100k"), _number(c["risco_max"]).alias("risco_max"))
