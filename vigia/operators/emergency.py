"""Emergency indicators: network pressure, service crisis, sudden silence, divergence, priority, confirmation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import PRESSURE_CUTS, PRESSURE_LEVELS, average_rank_share, bins, clip
from ..functions.rules import CRISIS_ACTION, PROTOCOLS, SILENCE_ACTION
from ..functions.weeks import ordinal
from .period import with_protocol
from .territory import WEEK, last_weeks


def pressure(network: DataFrame) -> DataFrame:
    """O98, O117: 100 * (0.30 volume + 0.30 backlog + 0.25 turnaround + 0.15 rejection), each scaled to [0, 1]; the 95th percentile of volume is one row."""
    top = network.agg(F.greatest(F.percentile("exames", 0.95), F.lit(1.0)).alias("_p95"))
    volume = clip(F.col("exames") / F.col("_p95"), 0, 1)
    backlog = clip(F.col("backlog_estimado") / F.greatest(F.col("exames"), F.lit(1)), 0, 1)
    slow = clip(F.coalesce("tat_p90_dias", F.lit(14.0)) / 14.0, 0, 2) / 2.0
    rejected = clip(F.coalesce("pct_rejeitado", F.lit(0.0)) / 0.05, 0, 2) / 2.0
    joined = network.join(F.broadcast(top), F.lit(True)).withColumn("indice_pressao_rede", F.round(clip(100.0 * (0.30 * volume + 0.30 * backlog + 0.25 * slow + 0.15 * rejected), 0, 100), 2)).drop("_p95")
    return joined.withColumn("faixa_pressao", bins(F.col("indice_pressao_rede"), PRESSURE_CUTS, PRESSURE_LEVELS))


def service_crisis(network: DataFrame) -> DataFrame:
    """O118: the worst quarter of release within 48 hours, or of the 90th percentile of turnaround; without the first, release within 7 days stands in."""
    cuts = network.agg(F.percentile("pct_liberado_48h", 0.25).alias("_q48"), F.percentile("pct_liberado_7d", 0.25).alias("_q7"), F.percentile("tat_p90_dias", 0.75).alias("_p75"))
    slow = F.when(F.col("_q48").isNotNull(), F.col("pct_liberado_48h") <= F.col("_q48")).otherwise(F.col("pct_liberado_7d") <= F.col("_q7"))
    crisis = F.coalesce(slow, F.lit(False)) | F.coalesce(F.col("tat_p90_dias") >= F.col("_p75"), F.lit(False))
    return network.join(F.broadcast(cuts), F.lit(True)).withColumn("sla_crise", crisis).drop("_q48", "_q7", "_p75")


def sudden_silence(panel: DataFrame, edges: DataFrame) -> DataFrame:
    """O101: the last week against the median cell of the eight before, and against the neighbours' last week."""
    now = panel.join(F.broadcast(last_weeks(panel, 1)), WEEK, "left_semi").groupBy("municipio").agg(F.sum("tests").alias("exames_ultima_se"))
    base = panel.join(F.broadcast(last_weeks(panel, 8, skip=1)), WEEK, "left_semi").groupBy("municipio").agg(F.median("tests").alias("exames_mediana_8se"), F.avg("tests").alias("exames_media_8se"))
    out = base.join(now, "municipio", "full").fillna(0)
    med, last = F.col("exames_mediana_8se"), F.col("exames_ultima_se")
    absolute, drop = (med >= 3) & (last <= 0), (med >= 5) & (last <= 0.25 * med)
    out = out.select("*", F.when(med > 0, F.round(last / med, 3)).alias("razao_exames_vs_hist"), (absolute | drop).alias("silencio_gal_alerta"), F.when(absolute, "queda_absoluta").when(drop, "queda_abrupta").otherwise("estavel").alias("tipo_silencio_gal"))
    near = edges.join(out.select(F.col("municipio").alias("vizinho"), last.alias("_v")), "vizinho", "left").groupBy("municipio").agg(F.median(F.coalesce("_v", F.lit(0))).alias("exames_mediana_vizinhos"))
    joined = out.join(near, "municipio", "left").fillna({"exames_mediana_vizinhos": 0.0})
    return joined.withColumn("silencio_gal_vs_vizinhos", F.col("silencio_gal_alerta") & (F.col("exames_mediana_vizinhos") >= 5) & (last < 0.5 * F.col("exames_mediana_vizinhos")))


def divergence(quality: DataFrame, panel: DataFrame) -> DataFrame:
    """O57, O119: towns that notify without exams over the window, then those that differ in the last week only; one row a town."""
    first = quality.where(F.col("gap_sinan_sem_exame") | ((F.col("notif_sinan") > 0) & (F.col("exames") <= 0))).select("municipio", F.col("exames").cast("double").alias("exames_janela"), F.col("notif_sinan").cast("double").alias("notificacoes_janela"), F.lit("sinan_sem_exame").alias("tipo_divergencia"))
    week = panel.join(F.broadcast(last_weeks(panel, 1)), WEEK, "left_semi").groupBy("municipio").agg(F.sum("tests").cast("double").alias("exames_janela"), F.sum("notificacoes").cast("double").alias("notificacoes_janela"))
    odd = week.where(((F.col("notificacoes_janela") >= 3) & (F.col("exames_janela") <= 0)) | ((F.col("exames_janela") >= 20) & (F.col("notificacoes_janela") <= 0)))
    kind = F.when((F.col("notificacoes_janela") > 0) & (F.col("exames_janela") <= 0), "notif_sem_exame_semana").otherwise("exame_sem_notif_semana")
    return first.unionByName(odd.join(first, "municipio", "left_anti").withColumn("tipo_divergencia", kind))


def priority(card: DataFrame) -> DataFrame:
    """O120: the order in which a town's signals count. ``card`` has sla_crise, faixa_pressao, silencio_gal_alerta, silencio_gal_vs_vizinhos, divergente."""
    on = lambda c: F.coalesce(F.col(c), F.lit(False))
    pressed = F.coalesce(F.col("faixa_pressao").isin("alta", "critica"), F.lit(False))
    level = (
        F.when(on("sla_crise") & (F.coalesce("faixa_pressao", F.lit("")) == "critica"), "CRÍTICO").when(on("sla_crise") | on("silencio_gal_vs_vizinhos"), "ALTO")
        .when(on("silencio_gal_alerta") | on("divergente"), "ALTO").when(pressed, "MODERADO").otherwise("MONITORAMENTO"))
    signal = F.when(on("sla_crise"), "risco").when(on("silencio_gal_alerta"), "silencio").when(on("divergente"), "utilizacao").when(pressed, "risco").otherwise("padrao")
    return card.select("*", level.alias("prioridade"), signal.alias("sinal"))


def escalated(card: DataFrame, predicted: DataFrame) -> DataFrame:
    """O120: priorities after the prediction (municipio, pressao_predita_acima_limiar): a town that is only watched becomes moderate, and a moderate
    one under high pressure becomes high."""
    one = predicted.groupBy("municipio").agg(F.max("pressao_predita_acima_limiar").alias("pressao_predita_acima_limiar"))
    joined = card.join(one, "municipio", "left").fillna(False, ["pressao_predita_acima_limiar"])
    first = F.when(F.col("pressao_predita_acima_limiar") & (F.col("prioridade") == "MONITORAMENTO"), "MODERADO").otherwise(F.col("prioridade"))
    up = F.col("pressao_predita_acima_limiar") & (first == "MODERADO") & F.coalesce(F.col("faixa_pressao").isin("alta", "critica"), F.lit(False))
    return joined.withColumn("prioridade", F.when(up, "ALTO").otherwise(first))


def protocolled(card: DataFrame, table=PROTOCOLS) -> DataFrame:
    """O116, O120: the card with its protocol: a crisis of service calls for that of an emergency, with its own action, list and deadline and those
    responsible for a risk; a sudden silence then has its own action, and who and by when of a silence."""
    rows = with_protocol(card, crisis=F.col("sla_crise"), table=table)
    of = {p[0]: p for p in table}
    crisis, silent = F.coalesce("sla_crise", F.lit(False)), F.coalesce("silencio_gal_alerta", F.lit(False))

    def either(column: str, in_crisis: str, in_silence: str | None) -> Column:
        told = F.when(crisis, in_crisis).otherwise(F.col(column))
        return told if in_silence is None else F.when(silent, in_silence).otherwise(told)

    return rows.withColumns({
        "acao_sugerida": either("acao_sugerida", CRISIS_ACTION[0], SILENCE_ACTION), "responsavel": either("responsavel", of["risco"][1], of["silencio"][1]),
        "prazo_acao": either("prazo_acao", "24–48h", of["silencio"][2]), "checklist_operacional": either("checklist_operacional", CRISIS_ACTION[1], None)})


def family_crisis(families: DataFrame) -> DataFrame:
    """O118: families in the worst quarter of release within 48 hours, or of the 90th percentile of turnaround. Where no family has the first, a
    half stands in for its quartile; where none has the second, 90 days. The cuts are one row."""
    cuts = families.agg(F.coalesce(F.percentile("pct_liberado_48h", 0.25), F.lit(0.5)).alias("_q48"), F.coalesce(F.percentile("tat_p90_dias", 0.75), F.lit(90.0)).alias("_p75"))
    crisis = F.coalesce(F.col("pct_liberado_48h") <= F.col("_q48"), F.lit(False)) | (F.coalesce("tat_p90_dias", F.lit(0.0)) >= F.col("_p75"))
    return families.join(F.broadcast(cuts), F.lit(True)).withColumn("sla_crise", crisis).drop("_q48", "_p75")


def retrospective(panel: DataFrame, n_weeks: int = 12, history: int = 8) -> DataFrame:
    """O102: for each of the ``n_weeks`` observed weeks before the last (which has no weeks after it) and each town seen in it, its volume against the
    median of the ``history`` observed weeks before.

    Every cell is sent to the reference weeks that look back on it, so there is no range join."""
    volume = panel.groupBy("municipio", *WEEK).agg(F.sum("tests").alias("tests"), F.sum("notificacoes").alias("notificacoes"))
    weeks = last_weeks(panel, n_weeks + history + 1).withColumn("idx", F.row_number().over(Window.orderBy(*WEEK)).cast("long"))
    placed = volume.join(F.broadcast(weeks), WEEK)
    last = weeks.agg(F.max("idx").alias("_last"))
    back = placed.select("municipio", "tests", F.explode(F.sequence(F.col("idx") + 1, F.col("idx") + history)).alias("idx")).groupBy("municipio", "idx").agg(F.median("tests").alias("mediana_8"))
    seen = placed.join(F.broadcast(last), F.lit(True)).where(F.col("idx").between(F.col("_last") - n_weeks, F.col("_last") - 1)).drop("_last")
    return seen.join(back, ["municipio", "idx"], "left").fillna(0.0, ["mediana_8"]).drop("idx")


def retro_flags(retro: DataFrame, network: DataFrame) -> DataFrame:
    """O96, O121: types of alert of each (week, town): silence, divergence, pressure (the week's top quarter by volume, or a network under pressure) and
    service crisis. ``network`` has municipio, indice_pressao_rede, sla_crise: one row a town."""
    placed = retro.withColumn("_pct", average_rank_share(F.col("tests"), WEEK)).join(network.select("municipio", "indice_pressao_rede", "sla_crise"), "municipio", "left")
    med, tests = F.col("mediana_8"), F.col("tests")
    pressed = (F.col("_pct") >= 0.75) | F.coalesce(F.col("indice_pressao_rede") >= 55, F.lit(False))
    types = F.array_compact(F.array(
        F.when(((med >= 5) & (tests <= 0.25 * med)) | ((med >= 3) & (tests <= 0)), "silencio_gal"), F.when((F.col("notificacoes") >= 3) & (tests <= 0), "divergencia"),
        F.when(pressed, "pressao_alta"), F.when(F.coalesce("sla_crise", F.lit(False)), "sla_crise"),
    ))
    return placed.select("municipio", *WEEK, "tests", "mediana_8", F.explode(types).alias("tipo_alerta"))


def confirmed(flags: DataFrame, panel: DataFrame, horizon: int = 2) -> DataFrame:
    """O60, O121: each alert that has a week after it, with what the next weeks brought. Outcomes are sent back to the weeks that await them: an equal join."""
    volume = panel.groupBy("municipio", *WEEK).agg(F.sum("tests").alias("_t"), F.sum("notificacoes").alias("_n"))
    at = ordinal(F.col("epi_year"), F.col("epi_week"))
    awaited = volume.select("municipio", "_t", "_n", F.explode(F.sequence(at - horizon, at - 1)).alias("_at")).groupBy("municipio", "_at").agg(F.sum("_t").alias("exames_futuro"), F.max("_t").alias("_most"), F.sum("_n").alias("_noted"), F.count(F.lit(1)).alias("_weeks"))
    joined = flags.withColumn("_at", at).join(awaited, ["municipio", "_at"])
    future, tests, kind = F.col("exames_futuro"), F.col("tests"), F.col("tipo_alerta")
    came = (
        F.when(kind == "silencio_gal", (future <= 0.5 * F.greatest(F.col("mediana_8"), F.lit(1.0)) * F.col("_weeks")) | (F.col("_most") <= 0)).when(kind == "divergencia", (F.col("_noted") >= 2) & (future < 0.5 * F.col("_noted")))
        .when(kind == "pressao_alta", F.col("_most") >= F.greatest(F.lit(5.0), 0.75 * tests)).otherwise(future >= F.greatest(F.lit(3.0), 0.5 * tests)))
    return joined.select("municipio", *WEEK, "tipo_alerta", "tests", "exames_futuro", came.alias("confirmado"))


def confirmation_rates(alerts: DataFrame) -> DataFrame:
    """O121, O128: overall and by type, from one rollup; alerts without an outcome yet count as open."""
    rates = alerts.rollup("tipo_alerta").agg(F.count(F.lit(1)).alias("alertas"), F.count("confirmado").alias("resolvidos"), F.count_if(F.col("confirmado")).alias("confirmados"))
    return rates.select(F.coalesce("tipo_alerta", F.lit("todos")).alias("tipo_alerta"), "alertas", "resolvidos", "confirmados", F.when(F.col("resolvidos") > 0, F.col("confirmados") / F.col("resolvidos")).alias("taxa_confirmacao"))


def summary(card: DataFrame) -> DataFrame:
    """One row: towns, medians, flags, and a sentence."""
    one = card.agg(
        F.count(F.lit(1)).alias("n_municipios"), F.median("tat_mediano_dias").alias("tat_mediano"), F.median("indice_pressao_rede").alias("pressao_mediana"), F.count_if("sla_crise").alias("n_sla_crise"),
        F.count_if(F.col("faixa_pressao").isin("alta", "critica")).alias("n_pressao_alta"), F.count_if(F.coalesce("silencio_gal_alerta", F.lit(False))).alias("n_silencio"), F.count_if(F.coalesce("divergente", F.lit(False))).alias("n_divergentes"))
    return one.withColumn("resumo", F.format_string("%d em crise de SLA, %d com pressão alta, %d em silêncio, %d divergentes, de %d", "n_sla_crise", "n_pressao_alta", "n_silencio", "n_divergentes", "n_municipios"))
