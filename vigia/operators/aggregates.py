"""Weekly, annual, demographic and network aggregates. Each is one grouping; Spark adds up partial sums before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text, weeks
from ..functions.measures import poisson, ratio, wilson
from ..functions.rules import arbovirus_evidence
from .normalise import arboviral, distinct_evidence

SERIES = ["target", "municipio"]
CELL = ["target", "municipio", "epi_year", "epi_week"]


def positivity(exams: DataFrame, keys: list[str]) -> DataFrame:
    """Tests, positives, negatives and their share over interpretable rows, by ``keys``."""
    counted = exams.groupBy(*keys).agg(F.countDistinct("record_id").alias("tests"), F.count_if(F.col("outcome") == "positive").alias("positives"), F.count_if(F.col("outcome") == "negative").alias("negatives"))
    counted = counted.withColumn("positives", F.least("positives", "tests"))
    return counted.withColumn("positividade", ratio(F.col("positives"), F.col("tests")))


def weekly(exams: DataFrame) -> DataFrame:
    """The panel of (target, town, week)."""
    return positivity(exams, CELL).drop("positividade")


def with_rates(panel: DataFrame) -> DataFrame:
    """Counts held in bounds, rates for 100,000 and intervals. Needs tests, positives, notificacoes, obitos, populacao."""
    zero = lambda c: F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(0)).alias(c)
    counts = ["tests", "positives", "negatives", "notificacoes", "obitos"]
    held = panel.select(*[zero(c) if c in counts else F.col(c) for c in panel.columns]).withColumn("positives", F.least("positives", "tests"))
    ci, inc, mort = wilson(F.col("positives"), F.col("tests")), poisson(F.col("positives"), F.col("populacao")), poisson(F.col("obitos"), F.col("populacao"))
    by_population = {"solicitacoes_100k": "tests", "incidencia_100k": "positives", "notificacoes_100k": "notificacoes", "mortalidade_100k": "obitos"}
    return held.select(
        "*", ratio(F.col("positives"), F.col("tests")).alias("positividade"), *[ratio(F.col(c), F.col("populacao"), 1e5).alias(n) for n, c in by_population.items()],
        ratio(F.col("obitos"), F.col("notificacoes")).alias("letalidade_proxy"), ci[0].alias("positivity_ci_low"), ci[1].alias("positivity_ci_high"),
        inc[0].alias("incidencia_ci_low"), inc[1].alias("incidencia_ci_high"), mort[0].alias("mortalidade_ci_low"), mort[1].alias("mortalidade_ci_high"),
    )


def notified(rows: DataFrame, name: str = "notificacoes") -> DataFrame:
    """Counts and closed counts (``encerrado``) by week, town and disease; rows without a key are left out."""
    keys = ["epi_year", "epi_week", "municipio", "agravo"]
    return rows.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name), F.count_if("encerrado").alias("encerrados"))


PERSON = ["ano", "target", "municipio", "sexo", "faixa_etaria", "raca_cor", "escolaridade"]


def by_person(rows: DataFrame, name: str = "notificacoes") -> DataFrame:
    """Counts by year, target, town, sex, age group, race and schooling, raw as they come (``event_date``, ``agravo_texto``, ``idade``); null keys
    are keys of their own. Rows without a town or a date are left out."""
    named = rows.where(F.col("municipio").isNotNull() & F.col("event_date").isNotNull())
    target = F.when(F.trim(F.coalesce("agravo_texto", F.lit(""))) != "", rules.target_of_text(F.col("agravo_texto"))).otherwise("nao_classificado")
    keys = named.select(
        F.year("event_date").cast("long").alias("ano"), target.alias("target"), "municipio", text.sex(F.col("sexo")).alias("sexo"), text.age_group(F.col("idade")).alias("faixa_etaria"), text.race(F.col("raca_cor")).alias("raca_cor"), text.schooling(F.col("escolaridade")).alias("escolaridade"))
    return keys.groupBy(*PERSON).agg(F.count(F.lit(1)).alias(name))


def with_fallback_date(rows: DataFrame, date: str = "event_date", year: str = "ano", worst: float = 0.5) -> DataFrame:
    """A source of which more than ``worst`` has no date takes the first of July of its year for all rows; rows without a date, or outside 1990 to
    2100, are left out. The share is one row, and is joined as such."""
    share = rows.agg((F.avg(F.col(date).isNull().cast("double")) > worst).alias("_lacking"))
    middle = F.when(F.col(year).between(1, 9999), F.make_date(F.col(year).cast("int"), F.lit(7), F.lit(1)))
    dated = rows.join(F.broadcast(share), F.lit(True)).withColumn(date, F.when(F.col("_lacking"), middle).otherwise(F.col(date))).drop("_lacking")
    return dated.where(F.year(date).between(1990, 2100))


#: What makes a bed an intensive one, equipment critical and a team one of family health (texts without accents, upper case).
INTENSIVE, CRITICAL, FAMILY_HEALTH = "UTI|INTENSIVA", "VENTIL|RESPIR|RX|RAIO X|TOMOG|PCR|ULTRASSOM|DESFIB|MONITOR", "SAUDE DA FAMILIA|ESF"


def capacity(facilities: DataFrame, beds: DataFrame, equipment: DataFrame, teams: DataFrame) -> DataFrame:
    """Facilities, beds (all, public, intensive), equipment (all, in use, critical) and teams (all, family health) of a town, from four
    sources of their own, each summed before they are joined.

    ``beds``: municipio, tipo, existentes, sus; ``equipment``: municipio, tipo, existentes, uso; ``teams``: municipio, tipo, quantidade."""
    some = lambda c, pattern: F.sum(F.when(F.upper("tipo").rlike(pattern), F.col(c)).otherwise(0))
    parts = [
        facilities.groupBy("municipio").agg(F.count(F.lit(1)).alias("cnes_estabelecimentos")),
        beds.groupBy("municipio").agg(F.sum("existentes").alias("cnes_leitos_total"), F.sum("sus").alias("cnes_leitos_sus"), some("existentes", INTENSIVE).alias("cnes_leitos_uti")),
        equipment.groupBy("municipio").agg(F.sum("existentes").alias("cnes_equipamentos_total"), F.sum("uso").alias("cnes_equipamentos_uso"), some("existentes", CRITICAL).alias("cnes_equipamentos_criticos")),
        teams.groupBy("municipio").agg(F.sum("quantidade").alias("cnes_equipes_total"), some("quantidade", FAMILY_HEALTH).alias("cnes_equipes_esf")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.join(part, "municipio", "full")
    return out


def climate(readings: DataFrame, keys: list[str], means: dict[str, str], event: str = "event_id", severity: str = "severidade") -> DataFrame:
    """Means (column to name), distinct events and worst severity by ``keys`` and week."""
    return readings.groupBy(*keys, "epi_year", "epi_week").agg(*[F.avg(c).alias(n) for c, n in means.items()], F.countDistinct(event).alias("n_eventos"), F.max(severity).alias("severidade_max"))


def _share(c: str, days: float):
    """Share of the known times that are at most so many days; null if none is known."""
    return F.avg(F.when(F.col(c).isNotNull(), (F.col(c) <= days).cast("double")))


def turnaround(exams: DataFrame) -> DataFrame:
    """Days from collection to release, in the laboratory (from receipt to release; both null outside 0 to 365) and on the way
    (collection to receipt; null outside 0 to 120). Where the first are not known, those in the laboratory stand for them."""
    days = lambda end, start, most: F.when(F.datediff(end, start).between(0, most), F.datediff(end, start).cast("double"))
    lab = days("event_date", "dt_recebimento", 365)
    return exams.withColumns({"tat_dias": F.coalesce(days("event_date", "dt_coleta", 365), lab), "tat_lab_dias": lab, "logistica_dias": days("dt_recebimento", "dt_coleta", 120)})


def network(exams: DataFrame, keys: list[str]) -> DataFrame:
    """Service levels by ``keys`` over the output of ``turnaround``. What is released in two days is told by laboratory days
    where a group has any; an exam counts as rejected if ``rejeitado`` is true."""
    return exams.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("exames"), F.median("tat_dias").alias("tat_mediano_dias"), F.percentile("tat_dias", 0.9).alias("tat_p90_dias"), F.median("tat_lab_dias").alias("tat_lab_mediano_dias"), F.median("logistica_dias").alias("logistica_mediana_dias"),
        F.coalesce(_share("tat_lab_dias", 2), _share("tat_dias", 2)).alias("pct_liberado_48h"), _share("tat_dias", 2).alias("pct_liberado_48h_coleta"), _share("tat_dias", 7).alias("pct_liberado_7d"), _share("tat_dias", 14).alias("pct_liberado_14d"),
        F.avg(F.coalesce("rejeitado", F.lit(False)).cast("double")).alias("pct_rejeitado"), F.count_if(F.col("status") == "pendente").alias("backlog_estimado"),
        F.avg((F.col("outcome") == "inconclusive").cast("double")).alias("pct_inconclusivo"), F.avg((F.col("status") == "liberado").cast("double")).alias("pct_liberado"),
    )


def network_by_family(exams: DataFrame, least: int = 20) -> DataFrame:
    """O80, O106: one table of service levels by family, and by town and family with enough exams, from grouping sets."""
    sets = exams.groupingSets([["regional"], ["municipio", "regional"]], "municipio", "regional").agg(
        F.count(F.lit(1)).alias("exames"), F.countDistinct("municipio").alias("n_municipios"), F.median("tat_dias").alias("tat_mediano_dias"),
        _share("tat_dias", 7).alias("pct_liberado_7d"), F.count_if(F.col("status") == "pendente").alias("backlog_estimado"), F.grouping("municipio").alias("_all"),
    )
    level = F.when(F.col("_all") == 1, "familia").otherwise("municipio_familia")
    return sets.where((F.col("_all") == 1) | (F.col("exames") >= least)).select(level.alias("granularidade"), F.coalesce("municipio", F.lit("ESTADO")).alias("municipio"), "regional", "exames", "n_municipios", "tat_mediano_dias", "pct_liberado_7d", "backlog_estimado")


def network_summary(by_town: DataFrame) -> DataFrame:
    """Medians over towns, and sums."""
    return by_town.agg(F.count(F.lit(1)).alias("n_municipios"), F.sum("exames").alias("exames_total"), F.median("tat_mediano_dias").alias("tat_mediano_estadual"), F.median("tat_p90_dias").alias("tat_p90_estadual"), F.median("pct_liberado_7d").alias("pct_liberado_7d_mediano"), F.sum("backlog_estimado").alias("backlog_total"))


def statewide(panel: DataFrame) -> DataFrame:
    """All towns of a (target, week), and all weeks of a year, in one pass of grouping sets; rates come from the sums."""
    sums = panel.groupingSets([["target", "epi_year", "epi_week"], ["target", "epi_year"]], "target", "epi_year", "epi_week").agg(F.sum("tests").alias("tests"), F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"))
    return sums.withColumn("positividade", ratio(F.col("positives"), F.col("tests")))


def period(panel: DataFrame, keys: list[str]) -> DataFrame:
    """Weeks seen, sums, largest population and risk, first and last week, rates and weekly means by ``keys``."""
    week = F.col("epi_year") * 100 + F.col("epi_week")
    sums = panel.groupBy(*keys).agg(
        F.countDistinct(week).alias("semanas"), *[F.sum(c).alias(c) for c in ("tests", "positives", "notificacoes", "obitos")], F.max("populacao").alias("populacao"), F.max("risco_composto").alias("risco_composto"),
        F.min("epi_week").alias("semana_min"), F.max("epi_week").alias("semana_max"))
    rate = lambda c, n, scale=1.0: ratio(F.col(c), F.col(n), scale)
    return sums.select(
        "*", rate("positives", "tests").alias("positividade"), rate("notificacoes", "populacao", 1e5).alias("incidencia_100k"), rate("tests", "populacao", 1e5).alias("solicitacoes_100k"),
        rate("tests", "semanas").alias("media_semanal_tests"), rate("notificacoes", "semanas").alias("media_semanal_notificacoes"))


ACUTE = ["aguda_confirmatoria", "aguda_provavel"]
CASE = ["requisicao", "codigo_amostra", "event_date", "municipio", "target"]


def arboviral_positives(rows: DataFrame, targets: tuple[str, ...] = ("dengue", "zika", "chikungunya")) -> DataFrame:
    """Released rows with a real value in a result field that reads positive, of the arboviruses; of equal ones the first field stays."""
    kept = rows.where(F.col("target").isin(*targets) & F.col("is_released") & F.col("field_has_real_value") & F.col("is_positive_like") & F.col("measure_role").isin("qualitative_result", "site_result"))
    classed = kept.withColumn("classe_positividade", arbovirus_evidence(F.col("exame"), F.col("metodologia")))
    return distinct_evidence(classed, ["record_id", "target", "exame", "metodologia", "field_label", "field_value", "classe_positividade"], ["field_index", "codigo_amostra"])


def evidence(positives: DataFrame, acute_only: bool = True) -> DataFrame:
    """Rows of an arbovirus, spelt alike, acute ones if asked; of equal evidence the first stays. Null keys are alike."""
    rows = arboviral(positives).drop("evidencia")
    rows = rows.where(F.col("classe_positividade").isin(*ACUTE)) if acute_only else rows
    return distinct_evidence(rows, [*CASE, "exame", "metodologia", "classe_positividade", "field_value"], ["record_id", "field_index"])


def cases(rows: DataFrame) -> DataFrame:
    """One row for each request, sample, day, town and target of ``evidence``: its commonest disease (of equals the first in order), its texts in
    the order in which they are first seen, the number of its values, the type of case, and its date's parts.

    A sample has few fields, so that its list is short."""
    texts = {"exames": "exame", "metodologias": "metodologia", "classes_positividade": "classe_positividade", "evidencias": "field_value"}
    listed = F.array_sort(F.collect_list(F.struct("record_id", "field_index", *[F.trim(c).alias(n) for n, c in texts.items()]))).alias("_l")
    usual = F.coalesce(F.mode(F.when(F.trim("agravo") != "", F.trim("agravo")), True), F.lit("")).alias("agravo")
    found = rows.groupBy(*CASE).agg(usual, F.count("field_value").alias("n_evidencias"), listed)
    joined = lambda n: F.array_join(F.array_distinct(F.filter(F.col("_l").getField(n), lambda v: v.isNotNull() & (v != ""))), " | ").alias(n)
    out = found.select(*CASE, "agravo", "n_evidencias", *[joined(n) for n in texts])
    kind = F.when(F.col("classes_positividade").contains(ACUTE[0]), "confirmatorio_agudo").when(F.col("classes_positividade").contains(ACUTE[1]), "provavel_agudo").otherwise("exposicao_previa")
    d = F.col("event_date")
    return out.select("*", kind.alias("tipo_caso"), F.year(d).cast("long").alias("ano"), F.month(d).cast("long").alias("mes"), weeks.epi_year(d).alias("epi_year"), weeks.epi_week(d).alias("epi_week"))


def case_summary(acute: DataFrame) -> DataFrame:
    """Acute cases by year and target, and by week, town and target, from one pass of grouping sets."""
    sets = acute.groupingSets([["ano", "target"], ["epi_year", "epi_week", "municipio", "target"]], "ano", "epi_year", "epi_week", "municipio", "target").agg(F.grouping("ano").alias("_by_week"), F.count(F.lit(1)).alias("casos_positivos"))
    return sets.select(F.when(F.col("_by_week") == 1, "semana_municipio").otherwise("ano").alias("resumo"), "ano", "epi_year", "epi_week", "municipio", "target", "casos_positivos")


def case_control(positives: DataFrame) -> DataFrame:
    """Rows and cases of all and of acute evidence: four counts."""
    parts = []
    for name, acute in (("todos", False), ("agudos", True)):
        rows = evidence(positives, acute)
        parts += [rows.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(f"{name}_filtrado").alias("dataset"), "linhas"), cases(rows).agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(f"{name}_casos").alias("dataset"), "linhas")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def demographic(exams: DataFrame, attributes: list[str]) -> DataFrame:
    """Requests and positives for every marginal of ``attributes``, with intervals, from one cube."""
    cube = exams.cube(*attributes).agg(F.count(F.lit(1)).alias("tests"), F.count_if(F.col("outcome") == "positive").alias("positives"), F.grouping_id().cast("long").alias("nivel"))
    low, high = wilson(F.col("positives"), F.col("tests"))
    return cube.select("*", low.alias("ci_low"), high.alias("ci_high"))
