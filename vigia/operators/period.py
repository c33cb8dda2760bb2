"""A period against its baseline, scenarios, projection, messages and the operational queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import ratio
from ..functions.rules import PROTOCOLS, protocol_key, protocol_map
from ..functions.weeks import monday, ordinal


def against_baseline(panel: DataFrame, year: int, first: int, last: int, mode: str = "previous", keys: tuple[str, ...] = ("municipio", "target")) -> DataFrame:
    """O82, O122: sums of the weeks ``first`` to ``last`` of ``year`` beside those of a baseline, in one pass over the panel.

    ``mode``: 'previous' (as many weeks just before), 'last_year' (the same weeks a year earlier) or
    'history' (the same weeks of all earlier years, per year). A baseline of 0 has no percentage.
    """
    at, n = ordinal(F.col("epi_year"), F.col("epi_week")), last - first + 1
    now = (F.col("epi_year") == year) & F.col("epi_week").between(first, last)
    start = year * 53 + first
    before = {
        "previous": at.between(start - n, start - 1),
        "last_year": (F.col("epi_year") == year - 1) & F.col("epi_week").between(first, last),
        "history": (F.col("epi_year") < year) & F.col("epi_week").between(first, last),
    }[mode]
    years = F.countDistinct(F.when(before, F.col("epi_year"))) if mode == "history" else F.lit(1)
    total = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0))
    sums = panel.where(now | before).groupBy(*keys).agg(
        total("tests", now).alias("tests"), total("positives", now).alias("positives"), total("notificacoes", now).alias("notificacoes"), F.max(F.when(now, F.col("risco_composto"))).alias("risco_max"),
        total("tests", before).alias("_t"), total("positives", before).alias("_p"), years.alias("_y"))
    per_year = F.greatest(F.col("_y"), F.lit(1))
    base = sums.withColumn("tests_base", F.col("_t") / per_year).withColumn("positives_base", F.col("_p") / per_year)
    p, pb = ratio(F.col("positives"), F.col("tests")), ratio(F.col("positives_base"), F.col("tests_base"))
    return base.select(
        *keys, "tests", "positives", "notificacoes", "risco_max", "tests_base", "positives_base", p.alias("positividade"), pb.alias("positividade_base"), (F.col("tests") - F.col("tests_base")).alias("delta_abs"),
        F.when(F.col("tests_base") > 0, (F.col("tests") - F.col("tests_base")) / F.col("tests_base") * 100.0).alias("delta_pct"), ((p - pb) * 100.0).alias("delta_pp"),
    )


def analysis(panel: DataFrame, year: int, first: int, last: int, mode: str = "previous", years: tuple[int, int] | None = None, keys: tuple[str, ...] = ("municipio", "target"), by_year: bool = False) -> DataFrame:
    """O122: the weeks ``first`` to ``last`` of ``year`` against a baseline, with deltas, a z against history, and flags.

    ``mode``: 'previous' (as many weeks just before, of the same year), 'last_year' (the same weeks a year earlier) or 'history'
    (the same weeks of ``years``, first and last, but the year itself). Groups with no row in either have none here.
    History is one sum for each group, so that it has no deviation and the z is 0; with ``by_year`` the deviation is that of the years.
    One pass: sums by year under conditions, added up.
    """
    keys = list(keys)
    years = years or (year - 5, year - 1)
    weeks = F.col("epi_week").between(first, last)
    hist = F.col("epi_year").between(*years) & (F.col("epi_year") != year) & weeks
    start = max(1, first - (last - first + 1))
    spans = {
        "periodo": (F.col("epi_year") == year) & weeks,
        "base": {"previous": (F.col("epi_year") == year) & F.col("epi_week").between(start, first - 1), "last_year": (F.col("epi_year") == year - 1) & weeks, "history": hist}[mode],
        "hist": hist,
    }
    counts = {"tests": "tests", "positives": "positivos", "notificacoes": "notificacoes", "obitos": "obitos"}
    yearly = panel.groupBy(*keys, "epi_year").agg(
        F.max("populacao").alias("populacao"), *[F.countDistinct(F.when(on, F.col("epi_week"))).alias(f"semanas_{tag}") for tag, on in spans.items()],
        *[F.max(F.when(on, F.col("risco_composto"))).alias(f"risco_{tag}") for tag, on in spans.items() if tag != "hist"], *[F.sum(F.when(on, F.col(c)).otherwise(0)).alias(f"{n}_{tag}") for tag, on in spans.items() for c, n in counts.items()])
    a_year = F.when(F.col("semanas_hist") > 0, F.col("tests_hist") / F.col("semanas_hist"))
    sums = yearly.groupBy(*keys).agg(
        F.max("populacao").alias("populacao"), F.max("risco_periodo").alias("risco_periodo"), F.max("risco_base").alias("risco_base"), *[F.sum(f"semanas_{tag}").alias(f"semanas_{tag}") for tag in spans],
        *[F.sum(f"{n}_{tag}").alias(f"{n}_{tag}") for tag in spans for n in counts.values()], F.stddev_samp(a_year).alias("_dp"), F.avg(a_year).alias("_media"))
    rate = lambda x, y, scale=1.0: ratio(F.col(x), F.col(y), scale)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    out = sums.where("semanas_periodo > 0 or semanas_base > 0").select(
        *keys, "populacao", "risco_periodo", "risco_base", *[f"{n}_{tag}" for tag in ("periodo", "base") for n in ("semanas", *counts.values())], rate("positivos_periodo", "tests_periodo").alias("positividade_periodo"), rate("positivos_base", "tests_base").alias("positividade_base"),
        rate("tests_periodo", "semanas_periodo").alias("media_semanal_tests_periodo"), rate("notificacoes_periodo", "populacao", 1e5).alias("incidencia_periodo_100k"), rate("tests_periodo", "populacao", 1e5).alias("solicitacoes_periodo_100k"),
        (F.col("_media") if by_year else rate("tests_hist", "semanas_hist")).alias("hist_media_semanal_tests"), (F.col("_dp") if by_year else F.lit(None).cast("double")).alias("hist_dp_semanal_tests"), rate("positivos_hist", "tests_hist").alias("hist_positividade_media"))
    out = out.select(
        "*", (F.col("tests_periodo") - F.col("tests_base")).alias("delta_tests_abs"), (F.col("positivos_periodo") - F.col("positivos_base")).alias("delta_positivos_abs"), (F.col("notificacoes_periodo") - F.col("notificacoes_base")).alias("delta_notificacoes_abs"),
        (zero("positividade_periodo") - zero("positividade_base")).alias("delta_positividade_pp"), ((F.col("notificacoes_periodo") > 0) & (F.col("tests_periodo") == 0)).alias("silencio_laboratorial"),
        ((F.col("notificacoes_periodo") >= 3) & (F.col("tests_periodo") < F.greatest(F.lit(1.0), F.col("notificacoes_periodo") * 0.2))).alias("baixo_uso_lacen"))
    z = F.when(F.col("hist_dp_semanal_tests") > 0, (F.col("media_semanal_tests_periodo") - F.col("hist_media_semanal_tests")) / F.col("hist_dp_semanal_tests"))
    return out.select("*", rate("delta_tests_abs", "tests_base").alias("delta_tests_pct"), rate("delta_notificacoes_abs", "notificacoes_base").alias("delta_notificacoes_pct"), F.coalesce(z, F.lit(0.0)).alias("z_solicitacoes_vs_historico"))


#: Scenarios, in the order in which they are looked for.
SCENARIOS = [
    "Silêncio laboratorial com notificação SINAN",
    "Baixa utilização do LACEN diante de notificações",
    "Aumento simultâneo de positividade e solicitações",
    "Aumento relevante de positividade",
    "Aumento relevante de solicitações",
    "Aumento de notificações SINAN",
    "Atividade laboratorial no período",
    "Sem sinal laboratorial no período",
]
#: Priorities and their scores.
PRIORITIES = {"MONITORAMENTO": 1, "MODERADO": 2, "ALTO": 3, "CRÍTICO": 4}


def scenario(rows: DataFrame) -> DataFrame:
    """O123: the scenario, priority and score of each row of ``analysis``. A missing percentage passes no cut."""
    tests, notified, z = F.col("tests_periodo"), F.col("notificacoes_periodo"), F.col("z_solicitacoes_vs_historico")
    more = lambda x: F.coalesce(F.col("delta_tests_pct") >= x, F.lit(False))
    warmer = lambda x: F.col("delta_positividade_pp") >= x
    silent, low = F.col("silencio_laboratorial"), F.col("baixo_uso_lacen")
    rules = [silent, low, (tests > 0) & warmer(0.15) & (more(0.30) | (z >= 1.5)), (tests > 0) & warmer(0.15), more(0.50), (notified > 0) & (F.col("delta_notificacoes_abs") > 0), tests > 0]
    name = F.when(rules[0], SCENARIOS[0])
    for rule, text in zip(rules[1:], SCENARIOS[1:], strict=False):
        name = name.when(rule, text)
    urgent = ((F.col("obitos_periodo") >= 1) & (warmer(0.10) | (z >= 1.5))) | (F.coalesce(F.col("positividade_periodo") >= 0.30, F.lit(False)) & (warmer(0.15) | (z >= 2.0) | more(0.50)))
    level = F.when(silent, "ALTO").when(urgent, "CRÍTICO").when(warmer(0.10) | (z >= 1.5) | more(0.30) | low, "ALTO").when(warmer(0.05) | (z >= 1.0) | more(0.15) | (notified > 0), "MODERADO").otherwise("MONITORAMENTO")
    score = F.create_map(*[F.lit(x) for pair in PRIORITIES.items() for x in pair])
    named = rows.select("*", name.otherwise(SCENARIOS[-1]).alias("cenario_operacional"), level.alias("prioridade"))
    return named.withColumn("prioridade_score", F.element_at(score, F.col("prioridade")))


def projected(rows: DataFrame, year: int, first: int, last: int, days: int = 14) -> DataFrame:
    """O124: the weekly mean and half its trend carried on for ``days``, positivity by half its change, and the dates these are for."""
    n = float(max(1, last - first + 1))
    mean, trend = F.col("tests_periodo") / n, F.col("delta_tests_abs") / n
    volume = F.round(F.greatest(F.lit(0.0), (mean + F.greatest(trend, -mean) * 0.5) * (days / 7.0)), 1)
    share = F.least(F.greatest(F.coalesce("positividade_periodo", "positividade_base", F.lit(0.0)) + F.col("delta_positividade_pp") / 2.0, F.lit(0.0)), F.lit(1.0))
    begin = F.date_add(monday(F.lit(year), F.lit(last)), 7)
    window = F.concat_ws(" a ", F.date_format(begin, "dd/MM/yyyy"), F.date_format(F.date_add(begin, days - 1), "dd/MM/yyyy"))
    out = rows.select("*", volume.alias("projecao_solicitacoes"), share.alias("positividade_projetada"))
    return out.select("*", F.round(F.col("projecao_solicitacoes") * F.col("positividade_projetada"), 1).alias("projecao_positivos"), window.alias("janela_alerta"), F.lit(days).alias("horizonte_alerta_dias"))


#: What a manager is asked to do, by scenario or priority, and by which channel.
ACTIONS = {
    "silencio": "Acionar vigilância municipal para checar fluxo de coleta/envio ao LACEN e conciliar casos SINAN sem exame.",
    "baixo": "Orientar ampliação/regularização do envio de amostras e revisão do fluxo assistencial-laboratorial.",
    "CRÍTICO": "Acionar gestor municipal e regional no mesmo dia; verificar coleta, estoque, investigação, assistência e comunicação de risco.",
    "ALTO": "Emitir alerta técnico ao município e regional; solicitar verificação local e plano de resposta em 24-48h.",
    "MODERADO": "Manter monitoramento ativo e solicitar checagem de dados se o padrão persistir.",
}
CHANNELS = {"CRÍTICO": "WhatsApp + e-mail + ligação", "ALTO": "WhatsApp + e-mail", "MODERADO": "E-mail/boletim de monitoramento"}


def messages(rows: DataFrame, contacts: DataFrame | None = None) -> DataFrame:
    """O41, O63, O125: what a manager is told of rows of ``projected`` that are to be acted on; of a town's contacts the first in order stands."""
    urgent = rows.where(F.col("prioridade").isin(*CHANNELS))
    if contacts is not None:
        urgent = urgent.join(contacts.groupBy("municipio").agg(F.min("gestor").alias("gestor")), "municipio", "left")
    else:
        urgent = urgent.withColumn("gestor", F.lit(None).cast("string"))
    level = F.col("prioridade")
    by = lambda d: F.element_at(F.create_map(*[F.lit(x) for pair in d.items() for x in pair]), level)
    action = F.when(F.col("cenario_operacional") == SCENARIOS[0], ACTIONS["silencio"]).when(F.col("cenario_operacional") == SCENARIOS[1], ACTIONS["baixo"]).otherwise(by({k: ACTIONS[k] for k in CHANNELS}))
    whole = lambda c: F.col(c).cast("long").cast("string")
    said = F.concat(
        F.lit("Alerta operacional ("), level, F.lit("): "), F.col("municipio"), F.lit(", "), F.col("target"), F.lit(". Cenário: "), F.col("cenario_operacional"), F.lit(". Solicitações: "), whole("tests_periodo"), F.lit("; positivos: "), whole("positivos_periodo"),
        F.lit("; variação de solicitações: "), whole("delta_tests_abs"), F.lit("; notificações: "), whole("notificacoes_periodo"), F.lit(". Janela: "), F.col("janela_alerta"), F.lit(". Ação sugerida: "), action)
    subject = F.concat(F.lit("["), level, F.lit("] Alerta: "), F.col("target"), F.lit(" em "), F.col("municipio"))
    return urgent.select("municipio", "target", "prioridade", "prioridade_score", "gestor", subject.alias("assunto"), said.alias("mensagem"), action.alias("acao_sugerida"), by(CHANNELS).alias("canal_sugerido"), F.lit("pendente_validacao_tecnica").alias("status_envio"))


def queue(signals: list[DataFrame], top: int = 20, each: int = 15) -> DataFrame:
    """O104, O126: the best of each signal list (municipio, target, sinal, score), one row a town and target, the first ``top`` with their protocols."""
    best = None
    for s in signals:
        part = s.select("municipio", "target", "sinal", "score").orderBy(F.desc("score"), "municipio", "target").limit(each)
        best = part if best is None else best.unionByName(part)
    w = Window.partitionBy("municipio", "target").orderBy(F.desc("score"), "sinal")
    first = best.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r").orderBy(F.desc("score"), "municipio", "target").limit(top)
    return with_protocol(first)


_QUEUE = ["municipio", "target", "sinal", "motivo", "prioridade", "score"]


def action_queue(alerts: DataFrame, risk: DataFrame, silent: DataFrame, top: int = 20, towns: int = 10) -> DataFrame:
    """O126: what is to be done first: urgent rows of ``scenario``, towns by territorial risk and silent towns, the best of each, by priority and score;
    of equal (town, signal, target) the first stays. Lists of ``top`` and ``towns`` rows are what the operator is for."""
    rank = F.element_at(F.create_map(*[F.lit(x) for pair in PRIORITIES.items() for x in pair]), F.col("prioridade"))
    near = F.coalesce("silencio_com_vizinho_alerta", F.lit(False)) if "silencio_com_vizinho_alerta" in silent.columns else F.lit(False)
    band, kind = F.col("faixa_risco"), F.col("classificacao_silencio")
    said = F.concat(kind, F.lit(" | exames recentes="), F.col("tests_recent").cast("long"), F.lit(" | notif="), F.col("notif_recent").cast("long"))
    if "vizinhos_em_alerta" in silent.columns:
        said = F.when(near, F.concat(said, F.lit(" | vizinhos em alerta="), F.col("vizinhos_em_alerta").cast("long"))).otherwise(said)
    shape = lambda rows, target, sign, why, level, score, first: rows.select("municipio", target.alias("target"), F.lit(sign).alias("sinal"), why.alias("motivo"), level.alias("prioridade"), F.col(score).cast("double").alias("score"), first.alias("_first"))
    lists = [
        (shape(alerts.where(F.col("prioridade").isin("CRÍTICO", "ALTO")), F.col("target"), "alerta_laboratorial", F.coalesce("cenario_operacional", F.concat(F.lit("Prioridade "), "prioridade")), F.col("prioridade"), "prioridade_score", F.lit(False)), top),
        (shape(risk.where(band.isin("atencao", "alerta", "alto_alerta")), F.lit(""), "risco_territorial", F.format_string("Faixa %s | score %.2f", band, F.coalesce("score_risco_territorial", F.lit(0.0))), F.when(band == "atencao", "MODERADO").otherwise("ALTO"), "score_risco_territorial", F.lit(False)), min(towns, top)),
        (shape(silent.where(kind.isin("silencio_critico", "silencio_provavel")), F.lit(""), "silencio_laboratorial", said, F.when((kind == "silencio_critico") | near, "CRÍTICO").otherwise("ALTO"), "score_silencio", near), min(towns, top)),
    ]
    best = None
    for rows, n in lists:
        part = rows.orderBy(F.desc("_first"), F.desc("score"), "municipio", "target").limit(n).select(*_QUEUE)
        best = part if best is None else best.unionByName(part)
    order = [F.desc(rank), F.desc("score"), F.col("municipio"), F.col("target"), F.col("sinal")]
    w = Window.partitionBy("municipio", "sinal", "target").orderBy(*order)
    return with_protocol(best.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r").orderBy(*order).limit(top))


def reinforced(queue: DataFrame, risk: DataFrame | None = None, silence: DataFrame | None = None, pressure: DataFrame | None = None, threshold: float = 0.55, pressure_threshold: float = 0.40) -> DataFrame:
    """O126: rows of ``action_queue`` held against predictions (municipio, prob; ``risk`` may have ``banda_risco``): an urgent row whose town's highest
    probability passes ``threshold`` is a hybrid alert and critical, as is a high one in the highest band; pressure lifts what is only watched.

    Silence signals look at ``silence``, the others at ``risk``; a town without a prediction is left as it is."""
    rows = queue
    for name, side in (("_risk", risk), ("_silence", silence), ("prob_pressao_predita", pressure)):
        if side is None:
            rows = rows.withColumn(name, F.lit(None).cast("double"))
        else:
            rows = rows.join(side.groupBy("municipio").agg(F.max("prob").alias(name)), "municipio", "left")
    if risk is not None and "banda_risco" in risk.columns:
        rows = rows.join(risk.groupBy("municipio").agg(F.max_by("banda_risco", F.struct("prob", "banda_risco")).alias("_band")), "municipio", "left")
    else:
        rows = rows.withColumn("_band", F.lit(""))
    rows = rows.withColumn("prob_ml", F.when(F.col("sinal").contains("silencio"), F.col("_silence")).otherwise(F.col("_risk")))
    sure = lambda c, cut: F.coalesce(F.col(c) >= cut, F.lit(False))
    rows = rows.withColumn("alerta_hibrido", F.col("prioridade").isin("CRÍTICO", "ALTO") & sure("prob_ml", threshold))
    high, told = sure("prob_pressao_predita", pressure_threshold), lambda text, c: F.concat(F.lit(text), F.round(c, 2).cast("string"), F.lit(")"))
    lifted = F.when((F.col("prioridade") == "ALTO") & (F.col("alerta_hibrido") | F.coalesce(F.col("_band") == "Crítico", F.lit(False))), "CRÍTICO").when(high & (F.col("prioridade") == "MONITORAMENTO"), "MODERADO").otherwise(F.col("prioridade"))
    why = F.concat(
        F.coalesce("motivo", F.lit("")), F.when(F.col("alerta_hibrido"), told(" | ML confirma (prob=", "prob_ml")).otherwise(""), F.when(high, told(" | Pressão predita (prob=", "prob_pressao_predita")).otherwise(""))
    return rows.withColumns({"motivo": why, "prioridade": lifted}).drop("_risk", "_silence", "_band")


#: Fields of a protocol, in the order of its table.
PROTOCOL_FIELDS = ((1, "responsavel"), (2, "prazo_acao"), (3, "acao_sugerida"), (4, "checklist_operacional"))


def with_protocol(rows: DataFrame, band: Column | None = None, use: Column | None = None, crisis: Column | None = None, table=PROTOCOLS) -> DataFrame:
    """O116: who is to act, by when, how, and what to tick off, by the protocols of ``table``."""
    target = F.col("target") if "target" in rows.columns else F.lit("")
    key = protocol_key(F.col("sinal"), band if band is not None else F.lit(""), use if use is not None else F.lit(""), target, crisis)
    keyed = rows.withColumn("protocolo", key)
    return keyed.select("*", *[F.element_at(protocol_map(k, table), F.col("protocolo")).alias(n) for k, n in PROTOCOL_FIELDS])


def distributions(rows: DataFrame) -> DataFrame:
    """How many rows and towns each scenario and priority has, in one pass."""
    sets = rows.groupingSets([["cenario_operacional"], ["prioridade"]], "cenario_operacional", "prioridade").agg(F.count(F.lit(1)).alias("linhas"), F.countDistinct("municipio").alias("municipios"), F.sum("tests_periodo").alias("tests"))
    return sets.select(F.when(F.col("cenario_operacional").isNotNull(), "cenario").otherwise("prioridade").alias("dimensao"), F.coalesce("cenario_operacional", "prioridade").alias("valor"), "linhas", "municipios", "tests")
