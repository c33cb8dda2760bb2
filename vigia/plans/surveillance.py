"""Queries of the surveillance operators over the bound tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import measures, rules, text, weeks
from ..operators import aggregates, panel, territory
from . import bindings as b
from .registry import query

R = 6


def rounded(df, places: int = R):
    """Doubles rounded, so that the order of a sum does not show."""
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


_wl, _wh = b.wilson_sql("positives", "tests")


@query(f"WITH {b.EXAM}, {b.WEEKLY} SELECT *, round(positives / tests::DOUBLE, 6) AS positividade, round({_wl}, 6) AS ci_low, round({_wh}, 6) AS ci_high FROM weekly")
def positivity_weekly(spark, sf_dir):
    """The weekly panel with its score interval."""
    weekly = aggregates.weekly(b.exams(spark, sf_dir))
    low, high = measures.wilson(F.col("positives"), F.col("tests"))
    return rounded(weekly.select("*", measures.ratio(F.col("positives"), F.col("tests")).alias("positividade"), low.alias("ci_low"), high.alias("ci_high")))


@query(f"WITH {b.EXAM} SELECT year, target, count(DISTINCT record_id) AS tests, least(count(DISTINCT record_id), count(*) FILTER (outcome = 'positive')) AS positives, count(*) FILTER (outcome = 'negative') AS negatives, round(least(count(DISTINCT record_id), count(*) FILTER (outcome = 'positive')) / count(DISTINCT record_id)::DOUBLE, 6) AS positividade FROM exam GROUP BY 1, 2")
def positivity_by_year(spark, sf_dir):
    """O68."""
    return rounded(aggregates.positivity(b.exams(spark, sf_dir), ["year", "target"]))


@query(f"WITH {b.EXAM} SELECT exame, target, status, outcome, count(*) AS n FROM exam GROUP BY ALL")
def schema_catalog(spark, sf_dir):
    """O66."""
    return b.exams(spark, sf_dir).groupBy("exame", "target", "status", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {b.EXAM} SELECT year, status, exame, count(DISTINCT record_id) AS registros FROM exam GROUP BY ALL")
def backlog(spark, sf_dir):
    """O67."""
    return b.exams(spark, sf_dir).groupBy("year", "status", "exame").agg(F.countDistinct("record_id").alias("registros"))


@query(f"WITH {b.EXAM}, {b.WEEKLY} SELECT target, epi_year, epi_week, sum(tests)::BIGINT AS tests, sum(positives)::BIGINT AS positives, sum(negatives)::BIGINT AS negatives, round(sum(positives) / sum(tests)::DOUBLE, 6) AS positividade FROM weekly GROUP BY GROUPING SETS ((target, epi_year, epi_week), (target, epi_year))")
def statewide(spark, sf_dir):
    """O71, O89."""
    return rounded(aggregates.statewide(aggregates.weekly(b.exams(spark, sf_dir))))


_CASE = ", ".join(aggregates.CASE)


def _cases_sql(name: str, where: str) -> str:
    """CTEs ``name``_ev (evidence) and ``name`` (cases); a text counts where it is first seen."""
    texts = {"exames": "exame", "metodologias": "metodologia", "classes_positividade": "classe_positividade", "evidencias": "field_value"}
    order = f"record_id, field_index, {', '.join(texts.values())}"
    lists = ", ".join(f"list(trim({c}) ORDER BY {order}) AS l_{n}" for n, c in texts.items())
    joined = ", ".join(f"array_to_string(list_filter(l_{n}, lambda v, i: list_position(l_{n}, v) = i), ' | ') AS {n}" for n in texts)
    return f"""{name}_ev AS (SELECT * FROM pos WHERE {where} QUALIFY row_number() OVER (PARTITION BY {_CASE}, {', '.join(texts.values())} ORDER BY record_id, field_index) = 1),
{name}_l AS (SELECT {_CASE}, mode(agravo) AS agravo, count(field_value) AS n_evidencias, {lists} FROM {name}_ev GROUP BY {_CASE}), {name}_j AS (SELECT {_CASE}, agravo, n_evidencias, {joined} FROM {name}_l),
{name} AS (SELECT *, CASE WHEN classes_positividade LIKE '%aguda_confirmatoria%' THEN 'confirmatorio_agudo' WHEN classes_positividade LIKE '%aguda_provavel%' THEN 'provavel_agudo' ELSE 'exposicao_previa' END AS tipo_caso,
  year(event_date) AS ano, month(event_date) AS mes, isoyear(event_date) AS epi_year, week(event_date) AS epi_week FROM {name}_j)"""


_ACUTE = "classe_positividade IN ('aguda_confirmatoria', 'aguda_provavel')"


def positives_of(spark, sf_dir):
    return aggregates.arboviral_positives(b.result_fields(spark, sf_dir))


@query(f"WITH {b.ARBO_POSITIVE}, {_cases_sql('cs', 'true')} SELECT * REPLACE (CAST(event_date AS VARCHAR) AS event_date) FROM cs")
def case_consolidation(spark, sf_dir):
    """Every case."""
    return aggregates.cases(aggregates.evidence(positives_of(spark, sf_dir), False)).withColumn("event_date", F.col("event_date").cast("string"))


@query(f"WITH {b.ARBO_POSITIVE}, {_cases_sql('cs', _ACUTE)} SELECT CASE WHEN grouping(ano) = 1 THEN 'semana_municipio' ELSE 'ano' END AS resumo, ano, epi_year, epi_week, municipio, target, count(*) AS casos_positivos FROM cs GROUP BY GROUPING SETS ((ano, target), (epi_year, epi_week, municipio, target))")
def case_summary(spark, sf_dir):
    """Acute cases by year, and by week and town."""
    return aggregates.case_summary(aggregates.cases(aggregates.evidence(positives_of(spark, sf_dir))))


@query(f"WITH {b.ARBO_POSITIVE}, {_cases_sql('ct', 'true')}, {_cases_sql('ca', _ACUTE)} SELECT 'todos_filtrado' AS dataset, count(*) AS linhas FROM ct_ev UNION ALL SELECT 'todos_casos', count(*) FROM ct UNION ALL SELECT 'agudos_filtrado', count(*) FROM ca_ev UNION ALL SELECT 'agudos_casos', count(*) FROM ca")
def case_control(spark, sf_dir):
    """The control counts."""
    return aggregates.case_control(positives_of(spark, sf_dir))


@query(f"WITH {b.READING} SELECT n_nationkey, epi_year, epi_week, round(avg(value), 6) AS valor_medio, count(DISTINCT event_id) AS n_eventos, max(severidade) AS severidade_max FROM reading GROUP BY ALL")
def climate_weekly(spark, sf_dir):
    """O52, O74."""
    return rounded(aggregates.climate(b.readings(spark, sf_dir), ["n_nationkey"], {"value": "valor_medio"}))


@query(f"WITH {b.NOTIF} SELECT epi_year, epi_week, municipio, agravo, count(*) AS notificacoes, count(*) FILTER (o_orderstatus = 'F') AS encerrados FROM notif GROUP BY ALL")
def notified_weekly(spark, sf_dir):
    """O75."""
    return aggregates.notified(b.notifications(spark, sf_dir))


@query(f"WITH {b.NOTIF}, {b.DEATHS} SELECT epi_year, epi_week, municipio, agravo, count(*) AS obitos, count(*) FILTER (o_orderstatus = 'F') AS encerrados FROM obito WHERE epi_year BETWEEN 1990 AND 2100 GROUP BY ALL")
def deaths_weekly(spark, sf_dir):
    """The gate lets a source through if at most half of its years are impossible."""
    return aggregates.notified(panel.gate(b.deaths(spark, sf_dir), F.col("epi_year")), "obitos")


@query(f"WITH {b.FACILITY} SELECT municipio, count(*) AS cnes_estabelecimentos, sum(floor(greatest(s_acctbal, 0) / 100))::BIGINT AS cnes_leitos_total, sum(CASE WHEN s_acctbal > 5000 THEN floor(s_acctbal / 1000) ELSE 0 END)::BIGINT AS cnes_leitos_uti, count(*) FILTER (s_acctbal < 0) AS cnes_equipamentos_criticos FROM facility GROUP BY 1")
def capacity(spark, sf_dir):
    """O77."""
    return aggregates.capacity(*b.capacity_sources(spark, sf_dir)).select("municipio", "cnes_estabelecimentos", "cnes_leitos_total", "cnes_leitos_uti", "cnes_equipamentos_criticos")


@query(f"WITH {b.FACILITY} SELECT municipio, sum(floor(greatest(s_acctbal, 0) / 100))::BIGINT AS cnes_leitos_sus, count(*) AS cnes_equipamentos_total, sum(s_suppkey % 2)::BIGINT AS cnes_equipamentos_uso, count(*) AS cnes_equipes_total, count(*) FILTER (s_suppkey % 3 = 0) AS cnes_equipes_esf FROM facility GROUP BY 1")
def capacity_sources(spark, sf_dir):
    """The other sums of the four sources."""
    return aggregates.capacity(*b.capacity_sources(spark, sf_dir)).select("municipio", "cnes_leitos_sus", "cnes_equipamentos_total", "cnes_equipamentos_uso", "cnes_equipes_total", "cnes_equipes_esf")


_DEMO = "count(*) AS tests, count(*) FILTER (outcome = 'positive') AS positives, CAST(grouping(year, regional, status) AS BIGINT) AS nivel"


@query(f"WITH {b.EXAM}, c AS (SELECT year, regional, status, {_DEMO} FROM exam GROUP BY CUBE (year, regional, status)) SELECT *, round({_wl}, 6) AS ci_low, round({_wh}, 6) AS ci_high FROM c")
def demographic(spark, sf_dir):
    """O78."""
    return rounded(aggregates.demographic(b.exams(spark, sf_dir), ["year", "regional", "status"]))


_TAT = f"""{b.EXAM}, tat AS (SELECT *, CASE WHEN event_date - dt_recebimento BETWEEN 0 AND 365 THEN (event_date - dt_recebimento)::DOUBLE END AS tat_lab_dias,
  CASE WHEN event_date - dt_coleta BETWEEN 0 AND 365 THEN (event_date - dt_coleta)::DOUBLE ELSE tat_lab_dias END AS tat_dias,
  CASE WHEN dt_recebimento - dt_coleta BETWEEN 0 AND 120 THEN (dt_recebimento - dt_coleta)::DOUBLE END AS logistica_dias FROM exam)"""
_NET = """count(*) AS exames, round(median(tat_dias), 6) AS tat_mediano_dias, round(quantile_cont(tat_dias, 0.9), 6) AS tat_p90_dias, round(median(tat_lab_dias), 6) AS tat_lab_mediano_dias, round(median(logistica_dias), 6) AS logistica_mediana_dias,
  round(coalesce(avg((tat_lab_dias <= 2)::INT), avg((tat_dias <= 2)::INT)), 6) AS pct_liberado_48h, round(avg((tat_dias <= 2)::INT), 6) AS pct_liberado_48h_coleta, round(avg((tat_dias <= 7)::INT), 6) AS pct_liberado_7d, round(avg((tat_dias <= 14)::INT), 6) AS pct_liberado_14d, round(avg(rejeitado::INT), 6) AS pct_rejeitado,
  count(*) FILTER (status = 'pendente') AS backlog_estimado, round(avg((outcome = 'inconclusive')::INT), 6) AS pct_inconclusivo, round(avg((status = 'liberado')::INT), 6) AS pct_liberado"""
NETWORK = f"{_TAT}, network AS (SELECT municipio, {_NET} FROM tat GROUP BY 1)"


def network_of(spark, sf_dir):
    return rounded(aggregates.network(aggregates.turnaround(b.exams(spark, sf_dir)), ["municipio"]))


@query(f"WITH {NETWORK} SELECT * FROM network")
def network_sla(spark, sf_dir):
    """O43, O79."""
    return network_of(spark, sf_dir)


@query(f"""WITH {_TAT}, g AS (SELECT CASE WHEN grouping(municipio) = 1 THEN 'familia' ELSE 'municipio_familia' END AS granularidade, coalesce(municipio, 'ESTADO') AS municipio, regional, count(*) AS exames, count(DISTINCT municipio) AS n_municipios,
  round(median(tat_dias), 6) AS tat_mediano_dias, round(avg((tat_dias <= 7)::INT), 6) AS pct_liberado_7d, count(*) FILTER (status = 'pendente') AS backlog_estimado FROM tat GROUP BY GROUPING SETS ((regional), (municipio, regional)))
SELECT * FROM g WHERE granularidade = 'familia' OR exames >= 20""")
def network_by_family(spark, sf_dir):
    """O80, O106."""
    return rounded(aggregates.network_by_family(aggregates.turnaround(b.exams(spark, sf_dir))))


@query(f"WITH {NETWORK} SELECT count(*) AS n_municipios, sum(exames)::BIGINT AS exames_total, round(median(tat_mediano_dias), 6) AS tat_mediano_estadual, round(median(tat_p90_dias), 6) AS tat_p90_estadual, round(median(pct_liberado_7d), 6) AS pct_liberado_7d_mediano, sum(backlog_estimado)::BIGINT AS backlog_total FROM network")
def network_summary(spark, sf_dir):
    """O81."""
    return rounded(aggregates.network_summary(network_of(spark, sf_dir)))


_VULN = f"""{b.MASTER}, vr AS (SELECT *, 1 - (rank() OVER (ORDER BY pea_2010) + (count(*) OVER (PARTITION BY pea_2010) - 1) / 2.0::DOUBLE) / count(*) OVER () AS pea_inv, 1 - idh AS idh_inv, 1 AS g FROM master),
{b.robust_z_sql("vr", {"idh_inv": "idh_inv_z", "gini": "gini_z", "extrema_pobreza_pct": "extrema_pobreza_pct_z", "pea_inv": "pea_inv_z"}, "g", "vz")},
vuln AS (SELECT * EXCLUDE (g), (idh_inv_z + gini_z + extrema_pobreza_pct_z + pea_inv_z) / 4 AS indice_vulnerabilidade FROM vz)"""


@query(f"WITH {_VULN} SELECT municipio, round(idh_inv_z, 6) AS idh_inv_z, round(gini_z, 6) AS gini_z, round(extrema_pobreza_pct_z, 6) AS extrema_pobreza_pct_z, round(pea_inv_z, 6) AS pea_inv_z, round(indice_vulnerabilidade, 6) AS indice_vulnerabilidade FROM vuln")
def vulnerability(spark, sf_dir):
    """O91, O92, O96."""
    return rounded(panel.vulnerability(b.master(spark, sf_dir)).select("municipio", "idh_inv_z", "gini_z", "extrema_pobreza_pct_z", "pea_inv_z", "indice_vulnerabilidade"))


_il, _ih = b.poisson_sql("positives", "populacao")
_ml, _mh = b.poisson_sql("obitos", "populacao")
PANEL = f"""{b.EXAM}, {b.NOTIF}, {b.DEATHS}, {b.POPULATION}, {_VULN}, {b.WEEKLY}, {b.FACILITY},
nk AS (SELECT epi_year, epi_week, municipio, agravo, count(*) AS notificacoes FROM notif GROUP BY ALL),
ok AS (SELECT epi_year, epi_week, municipio, agravo, count(*) AS obitos FROM obito GROUP BY ALL),
cap AS (SELECT municipio, sum(floor(greatest(s_acctbal, 0) / 100))::BIGINT AS cnes_leitos_total FROM facility GROUP BY 1),
tw AS (SELECT epi_year, epi_week, municipio, sum(notificacoes)::BIGINT AS notificacoes_mun_semana FROM nk GROUP BY ALL),
j AS (SELECT w.target, w.municipio, w.epi_year, w.epi_week, tests, positives, negatives, coalesce(notificacoes, 0) AS notificacoes, coalesce(obitos, 0) AS obitos, notificacoes_mun_semana, populacao, indice_vulnerabilidade, cnes_leitos_total
  FROM (SELECT *, {b.DISEASE} AS agravo FROM weekly) w LEFT JOIN nk USING (epi_year, epi_week, municipio, agravo) LEFT JOIN ok USING (epi_year, epi_week, municipio, agravo) LEFT JOIN tw USING (epi_year, epi_week, municipio)
  LEFT JOIN pop ON pop.municipio = w.municipio AND pop.ano = w.epi_year LEFT JOIN vuln ON vuln.municipio = w.municipio LEFT JOIN cap ON cap.municipio = w.municipio),
panel AS (SELECT *, positives / tests::DOUBLE AS positividade, tests * 100000.0::DOUBLE / populacao AS solicitacoes_100k, positives * 100000.0::DOUBLE / populacao AS incidencia_100k, notificacoes * 100000.0::DOUBLE / populacao AS notificacoes_100k,
  obitos * 100000.0::DOUBLE / populacao AS mortalidade_100k, CASE WHEN notificacoes > 0 THEN obitos / notificacoes::DOUBLE END AS letalidade_proxy FROM j)"""


def panel_of(spark, sf_dir):
    exams = b.exams(spark, sf_dir)
    master = panel.vulnerability(b.master(spark, sf_dir)).select("municipio", "indice_vulnerabilidade")
    capacity_ = aggregates.capacity(*b.capacity_sources(spark, sf_dir)).select("municipio", "cnes_leitos_total")
    return panel.integrate(aggregates.weekly(exams), aggregates.notified(b.notifications(spark, sf_dir)), aggregates.notified(b.deaths(spark, sf_dir), "obitos"), b.population(spark, sf_dir), master, capacity_, b.disease_of(F.col("target")))


_CELL = "target, municipio, epi_year, epi_week"


@query(f"""WITH {PANEL} SELECT {_CELL}, tests, positives, notificacoes, obitos, notificacoes_mun_semana, populacao, cnes_leitos_total, round(incidencia_100k, 6) AS incidencia_100k, round(mortalidade_100k, 6) AS mortalidade_100k, round(letalidade_proxy, 6) AS letalidade_proxy,
  round({_il}, 6) AS incidencia_ci_low, round({_ih}, 6) AS incidencia_ci_high, round({_ml}, 6) AS mortalidade_ci_low, round({_mh}, 6) AS mortalidade_ci_high FROM panel""")
def panel_rates(spark, sf_dir):
    """O29, O35 to O37, O50 to O55."""
    cols = ["target", "municipio", "epi_year", "epi_week", "tests", "positives", "notificacoes", "obitos", "notificacoes_mun_semana", "populacao", "cnes_leitos_total", "incidencia_100k", "mortalidade_100k", "letalidade_proxy", "incidencia_ci_low", "incidencia_ci_high", "mortalidade_ci_low", "mortalidade_ci_high"]
    return rounded(panel_of(spark, sf_dir).select(*cols))


RISK = f"""{PANEL}, {b.robust_z_sql("panel", panel.Z, "target, municipio", "pz")},
risk AS (SELECT *, greatest(least(0.25::DOUBLE * greatest(least(coalesce(z_tests, 0), 5), 0) + 0.20::DOUBLE * greatest(least(coalesce(z_pos, 0), 5), 0) + 0.20::DOUBLE * greatest(least(coalesce(z_inc, 0), 5), 0) + 0.15::DOUBLE * greatest(least(coalesce(z_notif, 0), 5), 0)
  + 0.10::DOUBLE * greatest(least(coalesce(z_mort, 0), 5), 0) + 0.10::DOUBLE * greatest(least(coalesce(indice_vulnerabilidade, 0), 5), 0), 10), 0) AS risco_composto FROM pz),
scored AS (SELECT *, CASE WHEN risco_composto <= 1 THEN 'habitual' WHEN risco_composto <= 2 THEN 'atencao' WHEN risco_composto <= 3 THEN 'alerta' ELSE 'alto_alerta' END AS nivel_risco FROM risk)"""


def scored_of(spark, sf_dir):
    return panel.scored(panel_of(spark, sf_dir))


@query(f"WITH {RISK} SELECT {_CELL}, round(risco_composto, 6) AS risco_composto, nivel_risco FROM scored")
def composite_risk(spark, sf_dir):
    """O33, O91, O109."""
    return rounded(scored_of(spark, sf_dir).select("target", "municipio", "epi_year", "epi_week", "risco_composto", "nivel_risco"))


_plus = lambda c, w: f"{w}::DOUBLE * greatest(coalesce({c}, 0), 0)"
_V1 = " + ".join(_plus(c, w) for c, w in (("z_tests", 0.20), ("z_pos", 0.20), ("z_inc", 0.15), ("z_notif", 0.10), ("z_mort", 0.15), ("indice_vulnerabilidade", 0.10))) + " + 0.05::DOUBLE / (1 + coalesce(cnes_leitos_total, 0))"


@query(f"WITH {PANEL}, {b.robust_z_sql('panel', panel.Z, 'target, municipio', 'pz')}, v AS (SELECT *, {_V1} AS r FROM pz) SELECT {_CELL}, round(r, 6) AS risco_v1, CASE WHEN r <= 1 THEN 'habitual' WHEN r <= 2 THEN 'atencao' WHEN r <= 3 THEN 'alerta' ELSE 'alto_alerta' END AS nivel_v1 FROM v")
def composite_risk_v1(spark, sf_dir):
    """O108."""
    base = panel_of(spark, sf_dir).withColumn("severidade_max", F.lit(0))
    return rounded(panel.risk_v1(base).select("target", "municipio", "epi_year", "epi_week", "risco_v1", "nivel_v1"))


_ALERT = f"""{b.EXAM}, {b.WEEKLY}, a0 AS (SELECT target, municipio, epi_year, epi_week, tests, CASE WHEN tests >= 2 THEN positives / tests::DOUBLE END AS positividade FROM weekly),
a1 AS (SELECT *, avg(tests) OVER s AS stm, CASE WHEN count(tests) OVER s > 1 THEN stddev_samp(tests) OVER s ELSE 0 END AS sts, avg(tests) OVER e AS rtm, CASE WHEN count(tests) OVER e > 1 THEN stddev_samp(tests) OVER e ELSE 0 END AS rts,
  avg(positividade) OVER s AS spm, CASE WHEN count(positividade) OVER s > 1 THEN stddev_samp(positividade) OVER s ELSE 0 END AS sps, list(positividade) FILTER (positividade IS NOT NULL) OVER p AS ps FROM a0
  WINDOW s AS (PARTITION BY target, municipio, epi_week ORDER BY epi_year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), e AS (PARTITION BY target, municipio ORDER BY epi_year, epi_week ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING),
  p AS (PARTITION BY target, municipio ORDER BY epi_year, epi_week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a2 AS (SELECT *, list_slice(ps, greatest(len(ps) - 7, 1), len(ps)) AS l FROM a1),
a3 AS (SELECT *, CASE WHEN len(l) > 0 THEN list_avg(l) END AS rpm, CASE WHEN len(l) > 1 THEN list_stddev_samp(l) ELSE 0 END AS rps FROM a2),
a4 AS (SELECT *, greatest(stm + 2 * sts, rtm + 2 * rts) AS vt, greatest(spm + 2 * sps, rpm + 2 * rps) AS pt FROM a3),
a5 AS (SELECT *, tests >= greatest(5, coalesce(vt, 5)) AS va, coalesce(positividade >= pt AND tests >= 5, false) AS pa FROM a4),
alert AS (SELECT *, CASE WHEN va THEN tests / CASE WHEN vt > 0 THEN vt ELSE greatest(1, coalesce(stm, rtm, 1)) END ELSE 0 END + CASE WHEN pa THEN positividade / CASE WHEN pt > 0 THEN pt ELSE greatest(0.01, coalesce(spm, rpm, 0.01)) END ELSE 0 END AS sc FROM a5)"""


def alerts_of(spark, sf_dir):
    weekly = aggregates.weekly(b.exams(spark, sf_dir))
    return panel.early_alerts(weekly.withColumn("positividade", F.when(F.col("tests") >= 2, F.col("positives") / F.col("tests"))))


@query(f"""WITH {_ALERT} SELECT {_CELL}, tests, round(positividade, 4) AS positividade, round(vt, 4) AS volume_threshold, round(pt, 4) AS positivity_threshold, va AS volume_alert, round(sc, 3) AS alert_score,
  CASE WHEN sc >= 3 THEN 'alto' WHEN sc >= 2 THEN 'moderado' WHEN sc > 0 THEN 'baixo' ELSE 'sem_sinal' END AS alert_level FROM alert""")
def early_alerts(spark, sf_dir):
    """O99."""
    return alerts_of(spark, sf_dir).select("target", "municipio", "epi_year", "epi_week", "tests", *[F.round(c, 4).alias(c) for c in ("positividade", "volume_threshold", "positivity_threshold")], "volume_alert", F.round("alert_score", 3).alias("alert_score"), "alert_level")


@query(f"WITH {b.EXAM}, {b.WEEKLY}, t AS (SELECT target, epi_year, epi_week, sum(tests)::BIGINT AS tests FROM weekly GROUP BY ALL) SELECT target, epi_year, epi_week, tests, lag(tests, 1) OVER w AS tests_lag1, lag(tests, 4) OVER w AS tests_lag4, lead(tests, 1) OVER w AS tests_lead1, CASE WHEN count(tests) OVER f >= 2 THEN round(avg(tests) OVER f, 6) END AS tests_ma4, round((rank() OVER (PARTITION BY epi_year, epi_week ORDER BY tests) + (count(*) OVER (PARTITION BY epi_year, epi_week, tests) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY epi_year, epi_week), 6) AS pct FROM t WINDOW w AS (PARTITION BY target ORDER BY epi_year, epi_week), f AS (PARTITION BY target ORDER BY epi_year, epi_week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")
def window_functions(spark, sf_dir):
    """O93 to O96 on the statewide series."""
    from pyspark.sql import Window

    t = aggregates.weekly(b.exams(spark, sf_dir)).groupBy("target", "epi_year", "epi_week").agg(F.sum("tests").alias("tests"))
    w = Window.partitionBy("target").orderBy("epi_year", "epi_week")
    return t.select("*", F.lag("tests", 1).over(w).alias("tests_lag1"), F.lag("tests", 4).over(w).alias("tests_lag4"), F.lead("tests", 1).over(w).alias("tests_lead1"), F.round(measures.rolling(F.col("tests"), w, 4, 2), 6).alias("tests_ma4"), F.round(measures.average_rank_share(F.col("tests"), [F.col("epi_year"), F.col("epi_week")]), 6).alias("pct"))


_GEO = f"{b.MASTER}, pts AS (SELECT municipio, latitude, longitude FROM master WHERE latitude BETWEEN -18.5 AND -7 AND longitude BETWEEN -62.5 AND -50)"
_KM = "2 * 6371.0::DOUBLE * asin(sqrt(least(1, pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2))))"
EDGES = f"{_GEO}, dist AS (SELECT a.municipio, b.municipio AS vizinho, {_KM} AS dist_km FROM pts a, pts b WHERE a.municipio <> b.municipio), edges AS (SELECT municipio, vizinho, dist_km, row_number() OVER (PARTITION BY municipio ORDER BY dist_km, vizinho) AS rank_vizinho FROM dist WHERE dist_km <= 150 QUALIFY rank_vizinho <= 6)"


def edges_of(spark, sf_dir):
    return territory.neighbours(territory.valid_coordinates(b.master(spark, sf_dir)), 6, 150.0)


@query(f"WITH {EDGES} SELECT municipio, vizinho, round(dist_km, 6) AS dist_km, rank_vizinho FROM edges")
def nearest_towns(spark, sf_dir):
    """O38, O46, O58."""
    return rounded(edges_of(spark, sf_dir))


_LAST8 = "rw AS (SELECT DISTINCT epi_year, epi_week FROM panel ORDER BY epi_year DESC, epi_week DESC LIMIT 8)"
TOWN_TARGET = f"""{RISK}, {_LAST8}, recent AS (SELECT s.* FROM scored s SEMI JOIN rw USING (epi_year, epi_week)),
tt0 AS (SELECT municipio, target, count(*) AS semanas, sum(tests)::BIGINT AS tests, sum(positives)::BIGINT AS positives, sum(notificacoes)::BIGINT AS notificacoes, max(populacao) AS populacao, avg(risco_composto) AS risco_medio, max(risco_composto) AS risco_max,
  max(CASE nivel_risco WHEN 'habitual' THEN 0 WHEN 'atencao' THEN 1 WHEN 'alerta' THEN 2 ELSE 3 END)::BIGINT AS nivel_max FROM recent GROUP BY ALL),
tt1 AS (SELECT *, CASE WHEN notificacoes > 0 THEN tests / notificacoes::DOUBLE WHEN tests > 0 THEN NULL ELSE 0 END AS taxa_utilizacao, tests = 0 AND notificacoes > 0 AS silencio_laboratorial, notificacoes >= 3 AND tests < greatest(1, notificacoes * 0.2) AS baixo_uso,
  CASE WHEN notificacoes > 0 THEN tests * 100.0::DOUBLE / notificacoes END AS exames_por_100_notificacoes, CASE WHEN populacao > 0 THEN tests * 100000.0::DOUBLE / populacao END AS exames_por_100k FROM tt0),
tt AS (SELECT *, CASE WHEN silencio_laboratorial THEN 'silencio' WHEN baixo_uso THEN 'baixo' WHEN coalesce(taxa_utilizacao, 0) >= 1 THEN 'adequado_ou_alto' ELSE 'intermediario' END AS classificacao_uso FROM tt1)"""


@query(f"WITH {TOWN_TARGET} SELECT * REPLACE (round(risco_medio, 6) AS risco_medio, round(risco_max, 6) AS risco_max, round(taxa_utilizacao, 6) AS taxa_utilizacao, round(exames_por_100_notificacoes, 6) AS exames_por_100_notificacoes, round(exames_por_100k, 6) AS exames_por_100k) FROM tt")
def utilisation(spark, sf_dir):
    """O56, O111, O115."""
    return rounded(territory.town_target(scored_of(spark, sf_dir)))


TERRITORY = f"""{TOWN_TARGET}, t0 AS (SELECT municipio, count(DISTINCT target) AS alvos_monitorados, sum(tests)::BIGINT AS tests_8sem, sum(positives)::BIGINT AS positives_8sem, sum(notificacoes)::BIGINT AS notificacoes_8sem, avg(risco_medio) AS risco_medio, max(risco_max) AS risco_max, count(*) FILTER (nivel_max >= 2) AS alvos_alerta FROM tt GROUP BY 1),
t1 AS (SELECT *, 0.55::DOUBLE * least(risco_max, 10) + 0.25::DOUBLE * least(risco_medio, 10) + 0.20::DOUBLE * alvos_alerta / alvos_monitorados AS score_risco_territorial FROM t0),
q AS (SELECT quantile_cont(score_risco_territorial, 0.5) AS q50, quantile_cont(score_risco_territorial, 0.75) AS q75, quantile_cont(score_risco_territorial, 0.9) AS q90 FROM t1),
t2 AS (SELECT t1.*, CASE WHEN score_risco_territorial <= q50 THEN 'habitual' WHEN score_risco_territorial <= greatest(q75, q50 + 1e-6) THEN 'atencao' WHEN score_risco_territorial <= greatest(q90, q75 + 1e-6) THEN 'alerta' ELSE 'alto_alerta' END AS faixa_risco,
  100 * (rank() OVER (ORDER BY score_risco_territorial) + (count(*) OVER (PARTITION BY score_risco_territorial) - 1) / 2.0::DOUBLE) / count(*) OVER () AS pct, CASE WHEN risco_max >= 3 THEN 3 WHEN risco_max >= 2 THEN 2 WHEN risco_max >= 1 THEN 1 ELSE 0 END AS fx FROM t1, q),
t3 AS (SELECT *, CASE WHEN pct >= 90 THEN 3 WHEN pct >= 75 THEN 2 WHEN pct >= 50 THEN 1 ELSE 0 END AS rl, ['Baixo', 'Moderado', 'Alto', 'Crítico'] AS nm FROM t2)"""


@query(f"""WITH {TERRITORY} SELECT municipio, alvos_monitorados, tests_8sem, positives_8sem, notificacoes_8sem, round(risco_medio, 6) AS risco_medio, round(risco_max, 6) AS risco_max, alvos_alerta, round(score_risco_territorial, 6) AS score_risco_territorial, faixa_risco,
  nm[fx + 1] AS banda_absoluta, round(pct, 1) AS percentil_estadual, nm[rl + 1] AS banda_percentil, nm[greatest(fx, rl) + 1] AS banda_risco, CASE WHEN fx > rl THEN 'absoluto' WHEN rl > fx THEN 'percentil' ELSE 'ambos' END AS criterio_banda FROM t3""")
def territorial_risk(spark, sf_dir):
    """O96, O112."""
    return rounded(territory.territorial_risk(territory.town_target(scored_of(spark, sf_dir))))


def universe_of(spark, sf_dir):
    """Towns with their latest population (O100) and vulnerability."""
    people = b.population(spark, sf_dir).groupBy("municipio").agg(F.max_by("populacao", "ano").alias("populacao"))
    return panel.vulnerability(b.master(spark, sf_dir)).select("municipio", "indice_vulnerabilidade").join(people, "municipio", "left")


SILENCE = f"""{RISK}, {_LAST8}, u AS (SELECT v.municipio, indice_vulnerabilidade, coalesce(p.populacao, 0) AS populacao FROM vuln v LEFT JOIN (SELECT municipio, arg_max(populacao, ano) AS populacao FROM pop GROUP BY 1) p USING (municipio)),
rc AS (SELECT municipio, sum(tests)::BIGINT AS tests_recent, sum(notificacoes)::BIGINT AS notif_recent FROM scored SEMI JOIN rw USING (epi_year, epi_week) GROUP BY 1), hs AS (SELECT municipio, sum(tests)::BIGINT AS tests_hist, sum(notificacoes)::BIGINT AS notif_hist FROM scored GROUP BY 1),
s0 AS (SELECT u.*, coalesce(tests_recent, 0) AS tests_recent, coalesce(notif_recent, 0) AS notif_recent, coalesce(tests_hist, 0) AS tests_hist, coalesce(notif_hist, 0) AS notif_hist FROM u LEFT JOIN rc USING (municipio) LEFT JOIN hs USING (municipio)),
s1 AS (SELECT *, CASE WHEN tests_recent <= 0 AND (notif_recent > 0 OR (tests_hist > 0 AND populacao >= 5000 AND indice_vulnerabilidade >= 0.5)) THEN 'silencio_critico' WHEN tests_recent <= 0 AND (populacao >= 10000 OR (tests_hist > 0 AND populacao >= 3000)) THEN 'silencio_provavel'
  WHEN tests_recent <= 0 AND populacao >= 3000 THEN 'silencio_moderado' WHEN notif_recent >= 3 AND tests_recent < greatest(1, notif_recent * 0.2) THEN 'baixo_uso' ELSE '' END AS classificacao_silencio,
  2.0::DOUBLE * (tests_recent <= 0)::INT + 0.5::DOUBLE * (tests_hist <= 0 AND tests_recent <= 0)::INT + 2.0::DOUBLE * (notif_recent > 0)::INT + (populacao >= 10000)::INT + 0.5::DOUBLE * (populacao >= 5000)::INT + (indice_vulnerabilidade >= 0.5)::INT + 0.5::DOUBLE * (indice_vulnerabilidade >= 1)::INT AS score_silencio FROM s0)"""


@query(f"WITH {SILENCE} SELECT municipio, populacao, tests_recent, notif_recent, tests_hist, notif_hist, classificacao_silencio, round(score_silencio, 6) AS score_silencio FROM s1")
def silence(spark, sf_dir):
    """O100, O113 over every row of the panel; tests show silent towns on rows made by hand."""
    return rounded(territory.silence(universe_of(spark, sf_dir), scored_of(spark, sf_dir)).drop("indice_vulnerabilidade"))


_ACC = f"translate({{}}, '{text.ACCENTED}', '{text.PLAIN}')"
_KEY = lambda c: "trim(regexp_replace(" + _ACC.format(f"lower(coalesce({c}, ''))") + r", '\s+', ' ', 'g'), ' :;-_')"


@query(r"SELECT page_id, url, texto, length(texto) AS n_clean FROM (SELECT page_id, url, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS texto FROM (SELECT page_id, url, replace(replace(replace(replace(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS html FROM pages))".replace('\\"', '"'))
def html_clean(spark, sf_dir):
    """O9 (the part that SQL has too: no mending of broken UTF-8)."""
    c = text.text(F.col("html"))
    for name, value in text.ENTITIES:
        c = F.replace(c, F.lit(name), F.lit(value))
    clean = b.read(spark, sf_dir, "pages").select("page_id", "url", text.collapse(F.regexp_replace(c, "<[^>]+>", " ")).alias("texto"))
    return clean.select("*", F.length("texto").cast("long").alias("n_clean"))


@query(f"SELECT doc_id, md5({_KEY('text')}) AS chave, md5(trim(regexp_replace({_ACC.format('lower(text)')}, '[^a-z0-9]+', '_', 'g'), '_')) AS slug FROM documents")
def text_keys(spark, sf_dir):
    """O11, O12 of every document, whatever its language."""
    docs = b.read(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(text.normalize_key(F.col("text")).cast("binary")).alias("chave"), F.md5(text.slug(F.col("text")).cast("binary")).alias("slug"))


@query(r"WITH e AS (SELECT event_id, event_type || ': ' || json_extract_string(props, '$.k') AS raw FROM events) SELECT event_id, regexp_extract(raw, '^([^:]{1,120}):\s*(.*)$', 1) AS rotulo, regexp_extract(raw, '^([^:]{1,120}):\s*(.*)$', 2) AS valor, try_cast(regexp_extract(raw, '^([^:]{1,120}):\s*(.*)$', 2) AS DOUBLE) AS numero FROM e")
def label_value(spark, sf_dir):
    """O14, O19, O20."""
    raw = F.concat("event_type", F.lit(": "), F.get_json_object("props", "$.k"))
    return b.read(spark, sf_dir, "events").select("event_id", text.field_label(raw).alias("rotulo"), text.field_value(raw).alias("valor"), text.decimal_br(text.field_value(raw)).alias("numero"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%G') || '-SE' || strftime(o_orderdate, '%V') AS semana, CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS segunda, CAST(isoyear(o_orderdate) + floor((week(o_orderdate) - 1 + 2) / 53) AS BIGINT) AS ano_2, CAST((week(o_orderdate) + 1) % 53 + 1 AS BIGINT) AS semana_2 FROM orders")
def epi_weeks(spark, sf_dir):
    """O17, O18."""
    d = F.col("o_orderdate").cast("date")
    y, w = weeks.epi_year(d), weeks.epi_week(d)
    y2, w2 = weeks.advance(y, w, 2)
    return b.read(spark, sf_dir, "orders").select("o_orderkey", weeks.week_label(y, w).alias("semana"), weeks.monday(y, w).cast("string").alias("segunda"), y2.alias("ano_2"), w2.alias("semana_2"))


@query("SELECT c_custkey, CASE WHEN c_mktsegment LIKE 'M%' THEN 'MASCULINO' WHEN c_mktsegment LIKE 'F%' THEN 'FEMININO' ELSE 'IGNORADO' END AS sexo, CASE WHEN a < 1 THEN '<1' WHEN a <= 4 THEN '1-4' WHEN a <= 9 THEN '5-9' WHEN a <= 14 THEN '10-14' WHEN a <= 19 THEN '15-19' WHEN a <= 29 THEN '20-29' WHEN a <= 39 THEN '30-39' WHEN a <= 49 THEN '40-49' WHEN a <= 59 THEN '50-59' WHEN a <= 69 THEN '60-69' WHEN a <= 79 THEN '70-79' ELSE '80+' END AS faixa FROM (SELECT *, c_custkey % 97 AS a FROM customer)")
def demographics(spark, sf_dir):
    """O32."""
    return b.read(spark, sf_dir, "customer").select("c_custkey", text.sex(F.col("c_mktsegment")).alias("sexo"), text.age_group(F.col("c_custkey") % 97).alias("faixa"))


@query(r"SELECT s_suppkey, regexp_replace(upper(s_name), '[^A-Z0-9]', '', 'g') AS municipio_join, regexp_replace(upper(s_suppkey || ' - ' || s_name), '^\d+\s*[-.]?\s*', '') AS municipio_norm FROM supplier")
def town_names(spark, sf_dir):
    """O13."""
    return b.read(spark, sf_dir, "supplier").select("s_suppkey", text.join_town(F.col("s_name")).alias("municipio_join"), text.norm_town(F.concat(F.col("s_suppkey").cast("string"), F.lit(" - "), "s_name")).alias("municipio_norm"))


@query("SELECT p_partkey, CASE WHEN lower(p_type) LIKE '%promo%' THEN '1-URGENT' WHEN lower(p_type) LIKE '%economy%' THEN '2-HIGH' WHEN lower(p_type) LIKE '%standard%' THEN '3-MEDIUM' WHEN lower(p_type) LIKE '%large%' THEN '4-NOT SPECIFIED' WHEN lower(p_type) LIKE '%small%' THEN '5-LOW' ELSE '' END AS agravo, CASE WHEN p_name LIKE '%ring%' THEN 'anel' WHEN p_name LIKE '%bolt%' THEN 'parafuso' ELSE 'outros' END AS familia FROM part")
def rule_bridge(spark, sf_dir):
    """Rule lists as CASE expressions."""
    return b.read(spark, sf_dir, "part").select("p_partkey", b.disease_of(F.lower("p_type")).alias("agravo"), rules.family(F.col("p_name"), "outros", [("anel", ["ring"]), ("parafuso", ["bolt"])]).alias("familia"))
