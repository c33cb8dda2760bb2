"""Queries of the emergency, period, forecast, model, history and streaming operators, each with its SQL where SQL has one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules, weeks
from ..operators import aggregates, emergency, history, normalise, panel, period, predict, pressure, territory
from ..sources import tables
from ..sources.stages import written
from ..streaming import weekly as stream
from . import bindings as b
from .registry import query
from .surveillance import _ALERT, _LAST8, _NET, EDGES, NETWORK, PANEL, RISK, SILENCE, TERRITORY, TOWN_TARGET, alerts_of, edges_of, network_of, panel_of, rounded, scored_of, universe_of

_PRESSURE = f"""{NETWORK}, p95 AS (SELECT greatest(quantile_cont(exames, 0.95), 1) AS p95 FROM network),
pr AS (SELECT network.*, round(greatest(least(100 * (0.30::DOUBLE * greatest(least(exames / p95::DOUBLE, 1), 0) + 0.30::DOUBLE * least(backlog_estimado / greatest(exames, 1)::DOUBLE, 1) + 0.25::DOUBLE * least(coalesce(tat_p90_dias, 14) / 14::DOUBLE, 2) / 2 + 0.15::DOUBLE * least(coalesce(pct_rejeitado, 0) / 0.05::DOUBLE, 2) / 2), 100), 0), 2) AS indice_pressao_rede FROM network, p95),
pressure AS (SELECT *, CASE WHEN indice_pressao_rede <= 35 THEN 'baixa' WHEN indice_pressao_rede <= 55 THEN 'moderada' WHEN indice_pressao_rede <= 75 THEN 'alta' ELSE 'critica' END AS faixa_pressao FROM pr),
cut AS (SELECT quantile_cont(pct_liberado_48h, 0.25) AS q48, quantile_cont(pct_liberado_7d, 0.25) AS q7, quantile_cont(tat_p90_dias, 0.75) AS p75 FROM network),
crisis AS (SELECT pressure.*, coalesce(CASE WHEN q48 IS NOT NULL THEN pct_liberado_48h <= q48 ELSE pct_liberado_7d <= q7 END, false) OR coalesce(tat_p90_dias >= p75, false) AS sla_crise FROM pressure, cut)"""


def crisis_of(spark, sf_dir):
    return emergency.service_crisis(emergency.pressure(network_of(spark, sf_dir)))


@query(f"WITH {_PRESSURE} SELECT * FROM crisis")
def network_pressure(spark, sf_dir):
    """O33, O98, O117, O118."""
    return rounded(crisis_of(spark, sf_dir))


_RW = "rw9 AS (SELECT DISTINCT epi_year, epi_week FROM panel ORDER BY epi_year DESC, epi_week DESC LIMIT 9), lw AS (SELECT * FROM rw9 ORDER BY epi_year DESC, epi_week DESC LIMIT 1), pw AS (SELECT * FROM rw9 ORDER BY epi_year DESC, epi_week DESC OFFSET 1)"
_SUDDEN = f"""{_RW}, cu AS (SELECT municipio, sum(tests)::BIGINT AS exames_ultima_se FROM panel SEMI JOIN lw USING (epi_year, epi_week) GROUP BY 1), ba AS (SELECT municipio, median(tests) AS exames_mediana_8se, avg(tests) AS exames_media_8se FROM panel SEMI JOIN pw USING (epi_year, epi_week) GROUP BY 1),
su0 AS (SELECT municipio, coalesce(exames_mediana_8se, 0) AS exames_mediana_8se, coalesce(exames_media_8se, 0) AS exames_media_8se, coalesce(exames_ultima_se, 0) AS exames_ultima_se FROM ba FULL JOIN cu USING (municipio)),
su1 AS (SELECT *, (exames_mediana_8se >= 3 AND exames_ultima_se <= 0) AS ab, (exames_mediana_8se >= 5 AND exames_ultima_se <= 0.25 * exames_mediana_8se) AS qd FROM su0),
nb AS (SELECT e.municipio, median(coalesce(s.exames_ultima_se, 0)) AS exames_mediana_vizinhos FROM edges e LEFT JOIN su0 s ON e.vizinho = s.municipio GROUP BY 1),
sudden AS (SELECT su1.* EXCLUDE (ab, qd), CASE WHEN exames_mediana_8se > 0 THEN round(exames_ultima_se / exames_mediana_8se, 3) END AS razao_exames_vs_hist, ab OR qd AS silencio_gal_alerta, CASE WHEN ab THEN 'queda_absoluta' WHEN qd THEN 'queda_abrupta' ELSE 'estavel' END AS tipo_silencio_gal,
  coalesce(exames_mediana_vizinhos, 0) AS exames_mediana_vizinhos, (ab OR qd) AND coalesce(exames_mediana_vizinhos, 0) >= 5 AND exames_ultima_se < 0.5 * coalesce(exames_mediana_vizinhos, 0) AS silencio_gal_vs_vizinhos FROM su1 LEFT JOIN nb USING (municipio))"""
_PANEL_EDGES = f"{RISK}, {EDGES.split('pts AS', 1)[1].join(['pts AS', ''])}"


@query(f"WITH {_PANEL_EDGES}, {_SUDDEN} SELECT * REPLACE (round(exames_media_8se, 6) AS exames_media_8se) FROM sudden")
def sudden_silence(spark, sf_dir):
    """O59, O101."""
    return rounded(emergency.sudden_silence(scored_of(spark, sf_dir), edges_of(spark, sf_dir)))


_CONF = """rw8 AS (SELECT DISTINCT epi_year, epi_week FROM panel ORDER BY epi_year DESC, epi_week DESC LIMIT 8), cs AS (SELECT municipio, sum(tests)::BIGINT AS exames, sum(notificacoes)::BIGINT AS notif_join FROM panel SEMI JOIN rw8 USING (epi_year, epi_week) GROUP BY 1),
cn AS (SELECT municipio, sum(notificacoes)::BIGINT AS notif_sinan FROM nk SEMI JOIN rw8 USING (epi_year, epi_week) GROUP BY 1), cf AS (SELECT municipio, coalesce(exames, 0) AS exames, coalesce(notif_sinan, 0) AS notif_sinan FROM cs FULL JOIN cn USING (municipio)),
d1 AS (SELECT municipio, exames::DOUBLE AS exames_janela, notif_sinan::DOUBLE AS notificacoes_janela, 'sinan_sem_exame' AS tipo_divergencia FROM cf WHERE notif_sinan > 0 AND exames <= 0),
dw AS (SELECT municipio, sum(tests)::DOUBLE AS exames_janela, sum(notificacoes)::DOUBLE AS notificacoes_janela FROM panel SEMI JOIN lw USING (epi_year, epi_week) GROUP BY 1),
diverging AS (SELECT * FROM d1 UNION ALL SELECT *, CASE WHEN notificacoes_janela > 0 AND exames_janela <= 0 THEN 'notif_sem_exame_semana' ELSE 'exame_sem_notif_semana' END FROM dw WHERE ((notificacoes_janela >= 3 AND exames_janela <= 0) OR (exames_janela >= 20 AND notificacoes_janela <= 0)) AND municipio NOT IN (SELECT municipio FROM d1))"""


def divergence_of(spark, sf_dir):
    scored = scored_of(spark, sf_dir)
    return emergency.divergence(territory.confidence(scored, aggregates.notified(b.notifications(spark, sf_dir))), scored)


#: The week as of which the divergence query looks back: the last full one with notifications.
_AS_OF = 2001 * 53 + 30
_DISTRICT = f"""{b.EXAM.replace('n_name AS municipio', 'c_name AS municipio')}, {b.NOTIF.replace('n_name AS municipio', 'c_name AS municipio')}, {b.WEEKLY}, nk AS (SELECT epi_year, epi_week, municipio, agravo, count(*) AS notificacoes FROM notif GROUP BY ALL),
pa AS (SELECT w.municipio, w.epi_year, w.epi_week, tests, positives, coalesce(notificacoes, 0) AS notificacoes FROM (SELECT *, {b.DISEASE} AS agravo FROM weekly) w LEFT JOIN nk USING (epi_year, epi_week, municipio, agravo) WHERE epi_year * 53 + epi_week <= {_AS_OF})"""


@query(f"WITH {_DISTRICT}, {(_RW + ', ' + _CONF).replace('FROM panel', 'FROM pa')} SELECT * FROM diverging")
def divergence(spark, sf_dir):
    """O57, O119: by the smallest places at hand (each customer is one), as of a week in which both exams and notifications go on."""
    keys, tasks = ["epi_year", "epi_week", "municipio", "agravo"], b.tasks_for(spark, sf_dir, "lineitem")  # these cells grow with the exams
    noted = aggregates.notified(b.dealt(b.notifications(spark, sf_dir, district=True), tasks, *keys))
    weekly = aggregates.weekly(b.dealt(b.exams(spark, sf_dir, district=True), tasks, *aggregates.CELL)).where(weeks.ordinal(F.col("epi_year"), F.col("epi_week")) <= _AS_OF)
    seen = b.dealt(weekly.withColumn("agravo", b.disease_of(F.col("target"))), tasks, *keys).join(noted.select(*keys, "notificacoes"), keys, "left").fillna(0, ["notificacoes"])
    seen = written(seen.select("municipio", "epi_year", "epi_week", "tests", "positives", "notificacoes"), "districts")
    return emergency.divergence(territory.confidence(seen, noted), seen)


_CARD = f"""{_PANEL_EDGES}, {_SUDDEN}, {_CONF}, {_PRESSURE.split('tat AS', 1)[1].join(['tat AS', ''])},
card AS (SELECT c.municipio, tat_mediano_dias, indice_pressao_rede, faixa_pressao, sla_crise, coalesce(silencio_gal_alerta, false) AS silencio_gal_alerta, coalesce(silencio_gal_vs_vizinhos, false) AS silencio_gal_vs_vizinhos, d.municipio IS NOT NULL AS divergente FROM crisis c LEFT JOIN sudden s USING (municipio) LEFT JOIN diverging d ON d.municipio = c.municipio)"""


def card_of(spark, sf_dir):
    sudden = emergency.sudden_silence(scored_of(spark, sf_dir), edges_of(spark, sf_dir)).select("municipio", "silencio_gal_alerta", "silencio_gal_vs_vizinhos")
    other = divergence_of(spark, sf_dir).select("municipio", F.lit(True).alias("divergente"))
    base = crisis_of(spark, sf_dir).select("municipio", "tat_mediano_dias", "indice_pressao_rede", "faixa_pressao", "sla_crise")
    return base.join(sudden, "municipio", "left").join(other, "municipio", "left").fillna(False, ["silencio_gal_alerta", "silencio_gal_vs_vizinhos", "divergente"])


@query(f"""WITH {_CARD} SELECT *, CASE WHEN sla_crise AND faixa_pressao = 'critica' THEN 'CRÍTICO' WHEN sla_crise OR silencio_gal_vs_vizinhos OR silencio_gal_alerta OR divergente THEN 'ALTO' WHEN faixa_pressao IN ('alta', 'critica') THEN 'MODERADO' ELSE 'MONITORAMENTO' END AS prioridade,
  CASE WHEN sla_crise THEN 'risco' WHEN silencio_gal_alerta THEN 'silencio' WHEN divergente THEN 'utilizacao' WHEN faixa_pressao IN ('critica', 'alta') THEN 'risco' ELSE 'padrao' END AS sinal FROM card""")
def emergency_priority(spark, sf_dir):
    """O120."""
    return rounded(emergency.priority(card_of(spark, sf_dir)))


@query(f"""WITH {_CARD}, s AS (SELECT count(*) AS n_municipios, round(median(tat_mediano_dias), 6) AS tat_mediano, round(median(indice_pressao_rede), 6) AS pressao_mediana, count(*) FILTER (sla_crise) AS n_sla_crise, count(*) FILTER (faixa_pressao IN ('alta', 'critica')) AS n_pressao_alta, count(*) FILTER (silencio_gal_alerta) AS n_silencio, count(*) FILTER (divergente) AS n_divergentes FROM card)
SELECT *, n_sla_crise || ' em crise de SLA, ' || n_pressao_alta || ' com pressão alta, ' || n_silencio || ' em silêncio, ' || n_divergentes || ' divergentes, de ' || n_municipios AS resumo FROM s""")
def emergency_summary(spark, sf_dir):
    """O41, O87."""
    return rounded(emergency.summary(card_of(spark, sf_dir)))


_RETRO = f"""{RISK}, {_PRESSURE.split('tat AS', 1)[1].join(['tat AS', ''])}, rv AS (SELECT municipio, epi_year, epi_week, sum(tests)::BIGINT AS tests, sum(notificacoes)::BIGINT AS notificacoes FROM panel GROUP BY ALL),
wk AS (SELECT *, row_number() OVER (ORDER BY epi_year, epi_week) AS idx FROM (SELECT DISTINCT epi_year, epi_week FROM panel ORDER BY 1 DESC, 2 DESC LIMIT 21)), pl AS (SELECT rv.*, idx FROM rv JOIN wk USING (epi_year, epi_week)),
bk AS (SELECT municipio, i AS idx, median(tests) AS m8 FROM (SELECT municipio, tests, unnest(range(idx + 1, idx + 9)) AS i FROM pl) GROUP BY 1, 2),
retro AS (SELECT pl.*, coalesce(m8, 0) AS mediana_8 FROM pl LEFT JOIN bk USING (municipio, idx) WHERE idx BETWEEN (SELECT max(idx) FROM wk) - 12 AND (SELECT max(idx) FROM wk) - 1),
rf AS (SELECT retro.*, (rank() OVER (PARTITION BY epi_year, epi_week ORDER BY tests) + (count(*) OVER (PARTITION BY epi_year, epi_week, tests) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY epi_year, epi_week) AS pct, indice_pressao_rede, sla_crise FROM retro LEFT JOIN crisis USING (municipio)),
fl AS (SELECT municipio, epi_year, epi_week, tests, mediana_8, unnest(list_filter([CASE WHEN (mediana_8 >= 5 AND tests <= 0.25 * mediana_8) OR (mediana_8 >= 3 AND tests <= 0) THEN 'silencio_gal' END, CASE WHEN notificacoes >= 3 AND tests <= 0 THEN 'divergencia' END, CASE WHEN pct >= 0.75 OR coalesce(indice_pressao_rede >= 55, false) THEN 'pressao_alta' END, CASE WHEN coalesce(sla_crise, false) THEN 'sla_crise' END], lambda x: x IS NOT NULL)) AS tipo_alerta FROM rf),
fu AS (SELECT f.*, sum(v.tests)::BIGINT AS ef, max(v.tests) AS mf, sum(v.notificacoes)::BIGINT AS nf, count(v.tests) AS sf FROM fl f JOIN rv v ON v.municipio = f.municipio AND v.epi_year * 53 + v.epi_week BETWEEN f.epi_year * 53 + f.epi_week + 1 AND f.epi_year * 53 + f.epi_week + 2 GROUP BY ALL),
conf AS (SELECT municipio, epi_year, epi_week, tipo_alerta, tests, ef AS exames_futuro, CASE tipo_alerta WHEN 'silencio_gal' THEN ef <= 0.5 * greatest(mediana_8, 1) * sf OR mf <= 0 WHEN 'divergencia' THEN nf >= 2 AND ef < 0.5 * nf WHEN 'pressao_alta' THEN mf >= greatest(5, 0.75 * tests) ELSE ef >= greatest(3, 0.5 * tests) END AS confirmado FROM fu)"""


def confirmed_of(spark, sf_dir):
    """Weekly cells and the network are written once: the look back, the flags and the outcomes all read them."""
    cells = written(panel_of(spark, sf_dir).select("municipio", "epi_year", "epi_week", "tests", "notificacoes"), "cells")
    crisis = written(crisis_of(spark, sf_dir).select("municipio", "indice_pressao_rede", "sla_crise"), "network")
    return emergency.confirmed(emergency.retro_flags(emergency.retrospective(cells), crisis), cells)


@query(f"WITH {_RETRO} SELECT * REPLACE (CAST(confirmado AS BIGINT) AS confirmado) FROM conf")
def alert_confirmation(spark, sf_dir):
    """O60, O96, O102, O121."""
    return confirmed_of(spark, sf_dir).withColumn("confirmado", F.col("confirmado").cast("long"))


@query(f"WITH {_RETRO} SELECT coalesce(tipo_alerta, 'todos') AS tipo_alerta, count(*) AS alertas, count(confirmado) AS resolvidos, count(*) FILTER (confirmado) AS confirmados, round(count(*) FILTER (confirmado) / nullif(count(confirmado), 0)::DOUBLE, 6) AS taxa_confirmacao FROM conf GROUP BY ROLLUP (tipo_alerta)")
def confirmation_rates(spark, sf_dir):
    """O121, O128."""
    return rounded(emergency.confirmation_rates(confirmed_of(spark, sf_dir)))


def _period_sql(mode: str) -> str:
    before = {"previous": f"epi_year * 53 + epi_week BETWEEN {1999 * 53 + 20 - 10} AND {1999 * 53 + 19}", "last_year": "epi_year = 1998 AND epi_week BETWEEN 20 AND 29", "history": "epi_year < 1999 AND epi_week BETWEEN 20 AND 29"}[mode]
    years = f"greatest(count(DISTINCT CASE WHEN {before} THEN epi_year END), 1)" if mode == "history" else "1"
    return f"""p0 AS (SELECT *, epi_year = 1999 AND epi_week BETWEEN 20 AND 29 AS nw, {before} AS bf FROM scored),
p1 AS (SELECT municipio, target, coalesce(sum(tests) FILTER (nw), 0)::BIGINT AS tests, coalesce(sum(positives) FILTER (nw), 0)::BIGINT AS positives, coalesce(sum(notificacoes) FILTER (nw), 0)::BIGINT AS notificacoes, max(risco_composto) FILTER (nw) AS risco_max,
  coalesce(sum(tests) FILTER (bf), 0) / {years}::DOUBLE AS tests_base, coalesce(sum(positives) FILTER (bf), 0) / {years}::DOUBLE AS positives_base FROM p0 WHERE nw OR bf GROUP BY 1, 2),
per AS (SELECT *, CASE WHEN tests > 0 THEN positives / tests::DOUBLE END AS positividade, CASE WHEN tests_base > 0 THEN positives_base / tests_base END AS positividade_base, tests - tests_base AS delta_abs, CASE WHEN tests_base > 0 THEN (tests - tests_base) / tests_base * 100 END AS delta_pct,
  (CASE WHEN tests > 0 THEN positives / tests::DOUBLE END - CASE WHEN tests_base > 0 THEN positives_base / tests_base END) * 100 AS delta_pp FROM p1)"""


def period_of(spark, sf_dir, mode="previous"):
    return period.against_baseline(scored_of(spark, sf_dir), 1999, 20, 29, mode)


_PCOLS = "municipio, target, tests, positives, notificacoes, round(risco_max, 6) AS risco_max, round(tests_base, 6) AS tests_base, round(positives_base, 6) AS positives_base, round(positividade, 6) AS positividade, round(positividade_base, 6) AS positividade_base, round(delta_abs, 6) AS delta_abs, round(delta_pct, 6) AS delta_pct, round(delta_pp, 6) AS delta_pp"


@query(f"WITH {RISK}, {_period_sql('previous')} SELECT {_PCOLS} FROM per")
def period_previous(spark, sf_dir):
    """O82, O122 against the weeks just before."""
    return rounded(period_of(spark, sf_dir))


@query(f"WITH {RISK}, {_period_sql('last_year')} SELECT {_PCOLS} FROM per")
def period_last_year(spark, sf_dir):
    """O122 against the same weeks of the year before."""
    return rounded(period_of(spark, sf_dir, "last_year"))


@query(f"WITH {RISK}, {_period_sql('history')} SELECT {_PCOLS} FROM per")
def period_history(spark, sf_dir):
    """O122 against the same weeks of all years before."""
    return rounded(period_of(spark, sf_dir, "history"))


def _analysis_sql(mode: str) -> str:
    before = {"previous": "epi_year = 1999 AND epi_week BETWEEN 10 AND 19", "last_year": "epi_year = 1998 AND epi_week BETWEEN 20 AND 29", "history": "epi_year BETWEEN 1994 AND 1998 AND epi_week BETWEEN 20 AND 29"}[mode]
    spans = {"periodo": "epi_year = 1999 AND epi_week BETWEEN 20 AND 29", "base": before, "hist": "epi_year BETWEEN 1994 AND 1998 AND epi_week BETWEEN 20 AND 29"}
    counts = {"tests": "tests", "positives": "positivos", "notificacoes": "notificacoes", "obitos": "obitos"}
    sums = ", ".join(f"coalesce(sum({c}) FILTER ({on}), 0)::BIGINT AS {n}_{tag}" for tag, on in spans.items() for c, n in counts.items())
    weeks = ", ".join(f"count(DISTINCT epi_year * 100 + epi_week) FILTER ({on}) AS semanas_{tag}" for tag, on in spans.items())
    return f"""an0 AS (SELECT municipio, target, max(populacao) AS populacao, max(risco_composto) FILTER ({spans['periodo']}) AS risco_periodo, max(risco_composto) FILTER ({before}) AS risco_base, {weeks}, {sums} FROM scored GROUP BY 1, 2),
an1 AS (SELECT *, CASE WHEN tests_periodo > 0 THEN positivos_periodo / tests_periodo::DOUBLE END AS positividade_periodo, CASE WHEN tests_base > 0 THEN positivos_base / tests_base::DOUBLE END AS positividade_base, tests_periodo - tests_base AS delta_tests_abs, positivos_periodo - positivos_base AS delta_positivos_abs, notificacoes_periodo - notificacoes_base AS delta_notificacoes_abs,
  CASE WHEN tests_base > 0 THEN (tests_periodo - tests_base) / tests_base::DOUBLE END AS delta_tests_pct, notificacoes_periodo > 0 AND tests_periodo = 0 AS silencio_laboratorial, notificacoes_periodo >= 3 AND tests_periodo < greatest(1, notificacoes_periodo * 0.2::DOUBLE) AS baixo_uso_lacen FROM an0 WHERE semanas_periodo > 0 OR semanas_base > 0),
an AS (SELECT *, coalesce(positividade_periodo, 0) - coalesce(positividade_base, 0) AS delta_positividade_pp FROM an1)"""


def analysis_of(spark, sf_dir, mode="previous"):
    return period.analysis(scored_of(spark, sf_dir), 1999, 20, 29, mode)


def _analysis(mode: str):
    cols = ["municipio", "target", "semanas_periodo", "semanas_base", "tests_periodo", "tests_base", "positivos_periodo", "notificacoes_periodo", "notificacoes_base", "obitos_periodo", "positividade_periodo", "positividade_base", "delta_tests_abs", "delta_tests_pct", "delta_positividade_pp", "delta_notificacoes_abs", "incidencia_periodo_100k", "hist_media_semanal_tests", "silencio_laboratorial", "baixo_uso_lacen"]
    return lambda spark, sf_dir: rounded(analysis_of(spark, sf_dir, mode).select(*cols))


def _analysis_query(mode: str) -> str:
    return f"""WITH {RISK}, {_analysis_sql(mode)} SELECT municipio, target, semanas_periodo, semanas_base, tests_periodo, tests_base, positivos_periodo, notificacoes_periodo, notificacoes_base, obitos_periodo, round(positividade_periodo, 6) AS positividade_periodo, round(positividade_base, 6) AS positividade_base, delta_tests_abs, round(delta_tests_pct, 6) AS delta_tests_pct,
  round(delta_positividade_pp, 6) AS delta_positividade_pp, delta_notificacoes_abs, CASE WHEN populacao > 0 THEN round(notificacoes_periodo * 100000.0::DOUBLE / populacao, 6) END AS incidencia_periodo_100k, CASE WHEN semanas_hist > 0 THEN round(tests_hist / semanas_hist::DOUBLE, 6) END AS hist_media_semanal_tests, silencio_laboratorial, baixo_uso_lacen FROM an"""


@query(_analysis_query("previous"))
def period_analysis_previous(spark, sf_dir):
    """O122: against as many weeks just before."""
    return _analysis("previous")(spark, sf_dir)


@query(_analysis_query("last_year"))
def period_analysis_last_year(spark, sf_dir):
    """O122: against the same weeks of the year before."""
    return _analysis("last_year")(spark, sf_dir)


@query(_analysis_query("history"))
def period_analysis_history(spark, sf_dir):
    """O122: against the same weeks of five years before."""
    return _analysis("history")(spark, sf_dir)


_PERIOD = "semanas, tests, positives, notificacoes, obitos, populacao, semana_min, semana_max"


@query(f"""WITH {RISK}, g AS (SELECT municipio, target, count(DISTINCT epi_year * 100 + epi_week) AS semanas, sum(tests)::BIGINT AS tests, sum(positives)::BIGINT AS positives, sum(notificacoes)::BIGINT AS notificacoes, sum(obitos)::BIGINT AS obitos, max(populacao) AS populacao, max(risco_composto) AS risco_composto, min(epi_week) AS semana_min, max(epi_week) AS semana_max FROM scored GROUP BY 1, 2)
SELECT municipio, target, {_PERIOD}, round(risco_composto, 6) AS risco_composto, CASE WHEN tests > 0 THEN round(positives / tests::DOUBLE, 6) END AS positividade, CASE WHEN populacao > 0 THEN round(notificacoes * 100000.0::DOUBLE / populacao, 6) END AS incidencia_100k, CASE WHEN populacao > 0 THEN round(tests * 100000.0::DOUBLE / populacao, 6) END AS solicitacoes_100k,
  round(tests / semanas::DOUBLE, 6) AS media_semanal_tests, round(notificacoes / semanas::DOUBLE, 6) AS media_semanal_notificacoes FROM g""")
def period_totals(spark, sf_dir):
    """O82 over the whole panel."""
    return rounded(aggregates.period(scored_of(spark, sf_dir), ["municipio", "target"]))


_S = period.SCENARIOS
_SCEN = f"""{RISK}, {_analysis_sql('previous')}, sc AS (SELECT *,
  CASE WHEN silencio_laboratorial THEN '{_S[0]}' WHEN baixo_uso_lacen THEN '{_S[1]}' WHEN tests_periodo > 0 AND delta_positividade_pp >= 0.15 AND coalesce(delta_tests_pct >= 0.30, false) THEN '{_S[2]}' WHEN tests_periodo > 0 AND delta_positividade_pp >= 0.15 THEN '{_S[3]}' WHEN coalesce(delta_tests_pct >= 0.50, false) THEN '{_S[4]}'
    WHEN notificacoes_periodo > 0 AND delta_notificacoes_abs > 0 THEN '{_S[5]}' WHEN tests_periodo > 0 THEN '{_S[6]}' ELSE '{_S[7]}' END AS cenario_operacional,
  CASE WHEN silencio_laboratorial THEN 'ALTO' WHEN obitos_periodo >= 1 AND delta_positividade_pp >= 0.10 THEN 'CRÍTICO' WHEN coalesce(positividade_periodo >= 0.30, false) AND (delta_positividade_pp >= 0.15 OR coalesce(delta_tests_pct >= 0.50, false)) THEN 'CRÍTICO'
    WHEN delta_positividade_pp >= 0.10 OR coalesce(delta_tests_pct >= 0.30, false) OR baixo_uso_lacen THEN 'ALTO' WHEN delta_positividade_pp >= 0.05 OR coalesce(delta_tests_pct >= 0.15, false) OR notificacoes_periodo > 0 THEN 'MODERADO' ELSE 'MONITORAMENTO' END AS prioridade FROM an),
pj AS (SELECT *, round(greatest(0, (tests_periodo / 10.0::DOUBLE + greatest(delta_tests_abs / 10.0::DOUBLE, -(tests_periodo / 10.0::DOUBLE)) * 0.5::DOUBLE) * 2), 1) AS projecao_solicitacoes, least(greatest(coalesce(positividade_periodo, positividade_base, 0) + delta_positividade_pp / 2, 0), 1) AS positividade_projetada FROM sc)"""


def scenarios_of(spark, sf_dir):
    return period.projected(period.scenario(analysis_of(spark, sf_dir)), 1999, 20, 29)


@query(f"""WITH {_SCEN} SELECT municipio, target, cenario_operacional, prioridade, CASE prioridade WHEN 'CRÍTICO' THEN 4 WHEN 'ALTO' THEN 3 WHEN 'MODERADO' THEN 2 ELSE 1 END AS prioridade_score, projecao_solicitacoes, round(positividade_projetada, 6) AS positividade_projetada,
  strftime(strptime('1999-07-19', '%Y-%m-%d') + INTERVAL 7 DAY, '%d/%m/%Y') || ' a ' || strftime(strptime('1999-07-19', '%Y-%m-%d') + INTERVAL 20 DAY, '%d/%m/%Y') AS janela_alerta FROM pj""")
def scenarios(spark, sf_dir):
    """O123, O124."""
    return rounded(scenarios_of(spark, sf_dir).select("municipio", "target", "cenario_operacional", "prioridade", "prioridade_score", "projecao_solicitacoes", "positividade_projetada", "janela_alerta"))


@query(f"WITH {_SCEN} SELECT CASE WHEN grouping(cenario_operacional) = 0 THEN 'cenario' ELSE 'prioridade' END AS dimensao, coalesce(cenario_operacional, prioridade) AS valor, count(*) AS linhas, count(DISTINCT municipio) AS municipios, sum(tests_periodo)::BIGINT AS tests FROM sc GROUP BY GROUPING SETS ((cenario_operacional), (prioridade))")
def scenario_distribution(spark, sf_dir):
    """O48, O88."""
    return period.distributions(period.scenario(analysis_of(spark, sf_dir)))


_A = period.ACTIONS
_ACTION = f"CASE WHEN cenario_operacional = '{_S[0]}' THEN '{_A['silencio']}' WHEN cenario_operacional = '{_S[1]}' THEN '{_A['baixo']}' WHEN prioridade = 'CRÍTICO' THEN '{_A['CRÍTICO']}' WHEN prioridade = 'ALTO' THEN '{_A['ALTO']}' ELSE '{_A['MODERADO']}' END"


@query(f"""WITH {_SCEN}, ge AS (SELECT n_name AS municipio, min(s_name) AS gestor FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)
SELECT sc.municipio, target, prioridade, gestor, '[' || prioridade || '] Alerta: ' || target || ' em ' || sc.municipio AS assunto, {_ACTION} AS acao_sugerida, CASE prioridade WHEN 'CRÍTICO' THEN '{period.CHANNELS['CRÍTICO']}' WHEN 'ALTO' THEN '{period.CHANNELS['ALTO']}' ELSE '{period.CHANNELS['MODERADO']}' END AS canal_sugerido,
  'Alerta operacional (' || prioridade || '): ' || sc.municipio || ', ' || target || '. Cenário: ' || cenario_operacional || '. Solicitações: ' || tests_periodo || '; positivos: ' || positivos_periodo || '; variação de solicitações: ' || delta_tests_abs || '; notificações: ' || notificacoes_periodo || '. Janela: 26/07/1999 a 08/08/1999. Ação sugerida: ' || {_ACTION} AS mensagem
FROM sc LEFT JOIN ge USING (municipio) WHERE prioridade IN ('CRÍTICO', 'ALTO', 'MODERADO')""")
def manager_messages(spark, sf_dir):
    """O41, O63, O125."""
    contacts = b.read(spark, sf_dir, "supplier").join(b.towns(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")).select("municipio", F.col("s_name").alias("gestor"))
    return period.messages(scenarios_of(spark, sf_dir), contacts).drop("prioridade_score", "status_envio")


_CHECK = {p[0]: p[4] for p in rules.PROTOCOLS}
_TOP = "SELECT * FROM (SELECT municipio, target, {s} AS sinal, {v} AS score FROM {f} ORDER BY score DESC, municipio, target LIMIT 15)"


@query(f"""WITH {TOWN_TARGET}, a AS ({_TOP.format(s="'risco_territorial'", v="round(risco_max, 6)", f="tt")}), c AS ({_TOP.format(s="'utilizacao'", v="round(1.0::DOUBLE / (1 + coalesce(taxa_utilizacao, 0)), 6)", f="tt")}),
u AS (SELECT * FROM a UNION ALL SELECT * FROM c), f AS (SELECT *, row_number() OVER (PARTITION BY municipio, target ORDER BY score DESC, sinal) AS r FROM u)
SELECT municipio, target, sinal, score, CASE WHEN sinal LIKE '%risco%' THEN 'risco' ELSE 'utilizacao' END AS protocolo, CASE WHEN sinal LIKE '%risco%' THEN '48–72h' ELSE '15 dias' END AS prazo_acao, CASE WHEN sinal LIKE '%risco%' THEN '{_CHECK["risco"]}' ELSE '{_CHECK["utilizacao"]}' END AS checklist_operacional FROM f WHERE r = 1 ORDER BY score DESC, municipio, target LIMIT 20""")
def operational_queue(spark, sf_dir):
    """O61, O104, O106, O116, O126: a list of twenty is what the operator is for."""
    tt = territory.town_target(scored_of(spark, sf_dir))
    risk = tt.select("municipio", "target", F.lit("risco_territorial").alias("sinal"), F.round("risco_max", 6).alias("score"))
    use = tt.select("municipio", "target", F.lit("utilizacao").alias("sinal"), F.round(1.0 / (1 + F.coalesce("taxa_utilizacao", F.lit(0.0))), 6).alias("score"))
    return period.queue([risk, use]).select("municipio", "target", "sinal", "score", "protocolo", "prazo_acao", "checklist_operacional")


@query(f"WITH {b.EXAM}, {b.WEEKLY}, h AS (SELECT target, epi_year, epi_week, sum(tests) AS tests FROM weekly GROUP BY ALL), l AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY epi_year DESC, epi_week DESC) AS r FROM h), m AS (SELECT target, median(tests) FILTER (r <= 8) AS forecast_tests, max(epi_year) FILTER (r = 1) AS y, max(epi_week) FILTER (r = 1) AS w FROM l GROUP BY 1 HAVING count(*) >= 8) SELECT target, k AS forecast_step, CAST(y + floor((w - 1 + k) / 53) AS BIGINT) AS forecast_epi_year, (w - 1 + k) % 53 + 1 AS forecast_epi_week, round(forecast_tests, 6) AS forecast_tests FROM m, (SELECT unnest(range(1, 5)) AS k)")
def forecast_flat(spark, sf_dir):
    """O18, O133."""
    return rounded(predict.forecast_flat(aggregates.weekly(b.exams(spark, sf_dir))))


def _seasonal_sql(horizon: int = 4, tail: int = 4) -> str:
    """One CTE a step: the median of the last values and steps, mixed with that of the same week (no week comes twice within the horizon)."""
    out, before = [], "t"
    for k in range(1, horizon + 1):
        s = f"(SELECT median(tests) FROM h WHERE h.target = q.target AND h.municipio = q.municipio AND h.epi_week = (q.w - 1 + {k}) % 53 + 1)"
        r = f"list_aggregate({before}[greatest(len({before}) - {tail - 1}, 1):], 'median')"
        out.append(f"g{k}a AS (SELECT q.*, {s} AS s{k}, {r} AS r{k} FROM g{k - 1} q), g{k} AS (SELECT *, coalesce(0.6::DOUBLE * r{k} + 0.4::DOUBLE * s{k}, r{k}, s{k}) AS p{k} FROM g{k}a)")
        before = f"list_concat(t, [{', '.join(f'p{i}' for i in range(1, k + 1))}])"
    return ", ".join(out)


@query(f"""WITH {b.EXAM}, {b.WEEKLY}, h AS (SELECT target, municipio, epi_year, epi_week, sum(tests)::DOUBLE AS tests FROM weekly GROUP BY ALL), l AS (SELECT *, row_number() OVER (PARTITION BY target, municipio ORDER BY epi_year DESC, epi_week DESC) AS r FROM h),
g0 AS (SELECT target, municipio, list(tests ORDER BY r DESC) FILTER (r <= 8) AS t, max(epi_year) FILTER (r = 1) AS y, max(epi_week) FILTER (r = 1) AS w FROM l GROUP BY ALL), {_seasonal_sql()}
{" UNION ALL ".join(f"SELECT target, municipio, {k}::BIGINT AS forecast_step, CAST(y + floor((w - 1 + {k}) / 53) AS BIGINT) AS forecast_epi_year, (w - 1 + {k}) % 53 + 1 AS forecast_epi_week, round(p{k}, 6) AS forecast_tests, round(r{k}, 6) AS recent_median, round(s{k}, 6) AS seasonal_median FROM g4" for k in range(1, 5))}""")
def forecast_seasonal(spark, sf_dir):
    """O131, O132: each step looks at the steps before; tests compare with a loop too."""
    return rounded(predict.forecast_seasonal(aggregates.weekly(b.exams(spark, sf_dir)), 4, keys=("target", "municipio")))


@query(f"""WITH {PANEL}, h AS (SELECT target, epi_year, epi_week, sum(tests)::DOUBLE AS tests, sum(positives) / sum(tests)::DOUBLE AS pos, sum(notificacoes)::DOUBLE AS notif FROM panel GROUP BY ALL), l AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY epi_year DESC, epi_week DESC) AS r FROM h),
g AS (SELECT target, {", ".join(f"list({c} ORDER BY r DESC) FILTER (r <= 8) AS {t}" for c, t in (("tests", "t"), ("pos", "tp"), ("notif", "tn")))}, max(epi_year) FILTER (r = 1) AS y, max(epi_week) FILTER (r = 1) AS w FROM l GROUP BY 1 HAVING count(*) >= 6),
e AS (SELECT *, {", ".join(f"list_reduce({t}, lambda a, x: 0.6::DOUBLE * a + 0.4::DOUBLE * x) AS {m}" for t, m in (("t", "m"), ("tp", "mp"), ("tn", "mn")))}, list_stddev_pop(t) AS sd FROM g)
SELECT target, k AS forecast_step, CAST(y + floor((w - 1 + k) / 53) AS BIGINT) AS forecast_epi_year, (w - 1 + k) % 53 + 1 AS forecast_epi_week, round(m, 6) AS forecast_tests, round(greatest(m - sd, 0), 6) AS forecast_tests_low, round(m + sd, 6) AS forecast_tests_high,
  round(mp, 6) AS forecast_positividade, round(mn, 6) AS forecast_notificacoes FROM e, (SELECT unnest(range(1, 5)) AS k)""")
def forecast_ewma(spark, sf_dir):
    """O134."""
    return rounded(predict.forecast_ewma(panel_of(spark, sf_dir)))


_STATE_RATES = f"""st AS (SELECT target, epi_year, epi_week, sum(tests)::DOUBLE AS tests, sum(positives) / sum(tests)::DOUBLE AS positividade, sum(positives) * 1e5 / nullif(sum(populacao), 0) AS incidencia_100k, sum(notificacoes) * 1e5 / nullif(sum(populacao), 0) AS notificacoes_100k, sum(obitos) * 1e5 / nullif(sum(populacao), 0) AS mortalidade_100k FROM panel GROUP BY ALL),
mt AS ({" UNION ALL ".join(f"SELECT target, '{c}' AS indicador, epi_year, epi_week, {c} AS v FROM st" for c in predict.STATE)})"""


def _steps_sql(horizon: int = 4) -> str:
    """One CTE a step: the median of the last eight and of the steps so far, mixed with that of the same week."""
    out, before = [], "t"
    for k in range(1, horizon + 1):
        s, r = f"(SELECT median(v) FROM mt WHERE mt.target = q.target AND mt.indicador = q.indicador AND mt.epi_week = (q.w - 1 + {k}) % 53 + 1)", f"list_aggregate({before}, 'median')"
        out.append(f"f{k}a AS (SELECT q.*, {s} AS s{k}, {r} AS r{k} FROM f{k - 1} q), f{k} AS (SELECT *, coalesce(0.6::DOUBLE * r{k} + 0.4::DOUBLE * s{k}, r{k}, s{k}) AS p{k} FROM f{k}a)")
        before = f"list_concat(t, [{', '.join(f'p{i}' for i in range(1, k + 1))}])"
    return ", ".join(out)


@query(f"""WITH {PANEL}, {_STATE_RATES}, l AS (SELECT *, row_number() OVER (PARTITION BY target, indicador ORDER BY epi_year DESC, epi_week DESC) AS r FROM mt),
f0 AS (SELECT target, indicador, list(v) FILTER (r <= 8) AS t, max(epi_year) FILTER (r = 1) AS y, max(epi_week) FILTER (r = 1) AS w FROM l GROUP BY ALL HAVING count(*) >= 12), {_steps_sql()},
u AS ({" UNION ALL ".join(f"SELECT target, indicador, {k}::BIGINT AS forecast_step, CAST(y + floor((w - 1 + {k}) / 53) AS BIGINT) AS forecast_epi_year, (w - 1 + {k}) % 53 + 1 AS forecast_epi_week, p{k} AS p FROM f4" for k in range(1, 5))})
SELECT target, forecast_step, forecast_epi_year, forecast_epi_week, {", ".join(f"round(max(p) FILTER (indicador = '{c}'), 6) AS forecast_{c}" for c in predict.STATE)} FROM u GROUP BY ALL""")
def forecast_statewide(spark, sf_dir):
    """O71, O132."""
    return rounded(predict.forecast_statewide(panel_of(spark, sf_dir)))


_W = "PARTITION BY target, municipio ORDER BY epi_year, epi_week"


def _ma(c: str, n: int) -> str:
    f = f"({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({c}) OVER {f} >= {max(2, n // 2)} THEN avg({c}) OVER {f} END"


_AHEAD = ", ".join(f"lead({c}, {k}) OVER ({_W}) AS {n}" for c, k, n in (("tests", 1, "t1"), ("tests", 2, "t2"), ("positives", 1, "p1"), ("positividade", 1, "q1"), ("positividade", 2, "q2"), ("risco_composto", 1, "r1"), ("notificacoes", 1, "n1")))
FEATURES = f"""{RISK}, ft0 AS (SELECT *, {_ma("tests", 4)} AS tests_ma4, {_ma("tests", 8)} AS tests_ma8, {_ma("positives", 4)} AS positives_ma4, {_ma("positives", 8)} AS positives_ma8, {_ma("positividade", 4)} AS positividade_ma4, {_ma("positividade", 8)} AS positividade_ma8, {_ma("notificacoes", 8)} AS notificacoes_ma8, {_ma("incidencia_100k", 8)} AS incidencia_100k_ma8,
  lag(tests, 1) OVER ({_W}) AS tests_lag1, lag(tests, 4) OVER ({_W}) AS tests_lag4, (tests <= 1)::INT AS zr, {_AHEAD} FROM scored),
ft1 AS (SELECT *, tests_ma4 - tests_ma8 AS tests_trend, positividade_ma4 - positividade_ma8 AS positividade_trend, (sum(zr) OVER ({_W} ROWS UNBOUNDED PRECEDING) * zr)::BIGINT AS semanas_zero, sum(1 - zr) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS run FROM ft0),
feat AS (SELECT *, (sum(zr) OVER (PARTITION BY target, municipio, run ORDER BY epi_year, epi_week ROWS UNBOUNDED PRECEDING) * zr)::BIGINT AS semanas_zero_seguidas, CASE WHEN notificacoes > 0 THEN tests / notificacoes::DOUBLE END AS exames_por_notif,
  (coalesce(r1, 0) >= 1.2 OR (coalesce(q1, 0) >= 0.25 AND coalesce(t1, 0) >= 2) OR (coalesce(q2, 0) >= 0.25 AND coalesce(t2, 0) >= 2) OR coalesce(p1, 0) >= 2 OR (coalesce(p1, 0) > coalesce(positives, 0) AND coalesce(p1, 0) >= 1 AND coalesce(t1, 0) >= 2) OR (coalesce(n1, 0) >= 3 AND coalesce(t1, 0) >= 1 AND coalesce(q1, 0) >= 0.15))::INT AS y_alerta,
  (coalesce(t1, 0) <= 0)::INT AS y_silencio, (coalesce(t1, 0) <= 0 AND coalesce(n1, 0) > 0)::INT AS y_silencio_epi FROM ft1)"""


def features_of(spark, sf_dir):
    """The scored panel is written once; all features are windows over it."""
    return predict.features(written(scored_of(spark, sf_dir), "scored"))


_FCOLS = ["target", "municipio", "epi_year", "epi_week", "tests_lag1", "tests_lag4", "tests_ma4", "tests_ma8", "positividade_ma8", "tests_trend", "semanas_zero", "semanas_zero_seguidas", "exames_por_notif", "y_alerta", "y_silencio", "y_silencio_epi"]


@query(f"WITH {FEATURES} SELECT target, municipio, epi_year, epi_week, tests_lag1, tests_lag4, round(tests_ma4, 6) AS tests_ma4, round(tests_ma8, 6) AS tests_ma8, round(positividade_ma8, 6) AS positividade_ma8, round(tests_trend, 6) AS tests_trend, semanas_zero, semanas_zero_seguidas, round(exames_por_notif, 6) AS exames_por_notif, y_alerta, y_silencio, y_silencio_epi FROM feat")
def feature_panel(spark, sf_dir):
    """O93 to O95, O97, O135, O137."""
    return rounded(predict.labels(features_of(spark, sf_dir)).select(*_FCOLS))


@query(f"""WITH {RISK}, k104 AS (SELECT DISTINCT epi_year, epi_week FROM panel ORDER BY epi_year DESC, epi_week DESC LIMIT 104), f AS (SELECT scored.* FROM scored SEMI JOIN k104 USING (epi_year, epi_week))
SELECT target, municipio, epi_year, epi_week, lag(obitos, 1) OVER ({_W}) AS obitos_lag1, round({_ma("solicitacoes_100k", 4)}, 6) AS solicitacoes_100k_ma4, round({_ma("notificacoes", 8)}, 6) AS notificacoes_ma8, CASE WHEN {_ma("tests", 8)} >= 0.5 THEN 0 ELSE 4 END + (tests <= 0)::BIGINT AS semanas_sem_exame,
  round((rank() OVER (PARTITION BY epi_year, epi_week ORDER BY tests) + (count(*) OVER (PARTITION BY epi_year, epi_week, tests) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY epi_year, epi_week), 6) AS tests_pct_estadual, 0.5::DOUBLE AS confianca_dado, 0 AS vizinhos_em_alerta FROM f""")
def feature_panel_recent(spark, sf_dir):
    """O56, O135: the last 104 observed weeks, all metrics that the panel has, and the values that stand where no context is known."""
    rows = predict.with_context(predict.features(written(scored_of(spark, sf_dir), "scored"), weeks=104))
    return rounded(rows.select("target", "municipio", "epi_year", "epi_week", "obitos_lag1", "solicitacoes_100k_ma4", "notificacoes_ma8", F.col("semanas_sem_exame").cast("long").alias("semanas_sem_exame"), "tests_pct_estadual", "confianca_dado", "vizinhos_em_alerta"))


@query(f"""WITH {FEATURES}, la AS (SELECT * FROM feat QUALIFY row_number() OVER (PARTITION BY target, municipio ORDER BY epi_year DESC, epi_week DESC) = 1),
m AS (SELECT target, municipio, epi_year, epi_week, unnest([{{'metrica': 'tests', 'valor': tests::DOUBLE, 'base': tests_ma8}}, {{'metrica': 'positividade', 'valor': positividade, 'base': positividade_ma8}}, {{'metrica': 'incidencia_100k', 'valor': incidencia_100k, 'base': incidencia_100k_ma8}}, {{'metrica': 'notificacoes', 'valor': notificacoes::DOUBLE, 'base': notificacoes_ma8}}], recursive := true) FROM la),
d AS (SELECT *, (valor - base) / greatest(abs(base), 1e-6) AS dv FROM m)
SELECT target, municipio, epi_year, epi_week, metrica, round(valor, 6) AS valor, round(base, 6) AS base, round(dv, 4) AS desvio, CASE WHEN dv >= 0 THEN 'alta_atipica' ELSE 'queda_atipica' END AS tipo_anomalia, CASE WHEN abs(dv) >= 1 THEN 'alta' WHEN abs(dv) >= 0.5 THEN 'moderada' ELSE 'baixa' END AS severidade
FROM d WHERE abs(dv) >= 0.5 OR (metrica = 'tests' AND valor >= 5 AND valor >= base * 2) OR (metrica = 'positividade' AND valor >= 0.35 AND valor - base >= 0.15)""")
def anomalies(spark, sf_dir):
    """O100, O130."""
    found = predict.anomalies(features_of(spark, sf_dir))
    return found.select("target", "municipio", "epi_year", "epi_week", "metrica", F.round("valor", 6).alias("valor"), F.round("base", 6).alias("base"), F.round("desvio", 4).alias("desvio"), "tipo_anomalia", "severidade")


_LOGIT = f"""{FEATURES}, lg AS (SELECT *, round(1 / (1 + exp(-greatest(least(-2.2::DOUBLE + 2.8::DOUBLE * coalesce(positividade, 0) + 1.5::DOUBLE * tanh(coalesce(positividade_trend, 0) * 5) + 0.35::DOUBLE * least(coalesce(risco_composto, 0), 10) + 0.15::DOUBLE * ln(1 + coalesce(tests, 0)) + 0.12::DOUBLE * ln(1 + coalesce(notificacoes, 0))
  + 0.25::DOUBLE * greatest(least(coalesce(indice_vulnerabilidade, 0), 3), -3) + 0.4::DOUBLE * tanh(coalesce(tests_trend, 0) / 5), 20), -20))), 6) AS prob FROM feat)"""


@query(f"""WITH {FEATURES}, s AS (SELECT *, (tests <= 0)::INT + CASE WHEN coalesce(tests_ma8, 0) < 0.5 THEN 4 ELSE 0 END AS sx FROM feat)
SELECT target, municipio, epi_year, epi_week, round(1 / (1 + exp(-greatest(least(-1.0::DOUBLE + 0.55::DOUBLE * greatest(least(sx, 12), 0) + 0.8::DOUBLE * (tests <= 0)::INT + 0.35::DOUBLE * (coalesce(tests_ma8, 0) < 1)::INT + 0.25::DOUBLE * ln(1 + coalesce(notificacoes, 0)) + 0.2::DOUBLE * greatest(least(coalesce(indice_vulnerabilidade, 0), 3), -3) - 0.15::DOUBLE * ln(1 + greatest(coalesce(solicitacoes_100k, 0), 0)), 20), -20))), 6) AS prob_silencio FROM s""")
def silence_scores(spark, sf_dir):
    """O140: the score of a coming silence, without a model."""
    return rounded(predict.silence_logit(features_of(spark, sf_dir)).select("target", "municipio", "epi_year", "epi_week", "prob_silencio"))


def logit_of(spark, sf_dir):
    return predict.risk_logit(predict.labels(features_of(spark, sf_dir))).withColumn("prob", F.round("prob", 6))


@query(f"WITH {_LOGIT} SELECT target, municipio, epi_year, epi_week, prob FROM lg")
def risk_scores(spark, sf_dir):
    """O39, O140 without a model: the readable score."""
    return logit_of(spark, sf_dir).select("target", "municipio", "epi_year", "epi_week", "prob")


#: Families of the targets at hand, for models of their own.
_FAMILIES = [("comercial", ["promo", "economy"]), ("tamanho", ["large", "medium", "small"])]
_FAMILY = "CASE WHEN target LIKE '%promo%' OR target LIKE '%economy%' THEN 'comercial' WHEN target LIKE '%large%' OR target LIKE '%medium%' OR target LIKE '%small%' THEN 'tamanho' ELSE 'outros' END"


@query(f"""WITH {_LOGIT}, la AS (SELECT *, {_FAMILY} AS familia FROM lg QUALIFY row_number() OVER (PARTITION BY target, municipio ORDER BY epi_year DESC, epi_week DESC) = 1),
bd AS (SELECT *, round(CASE WHEN count(*) OVER (PARTITION BY familia) = 1 THEN 50 ELSE 100 * (rank() OVER (PARTITION BY familia ORDER BY prob) + (count(*) OVER (PARTITION BY familia, prob) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY familia) END, 1) AS pct,
  CASE WHEN nivel_risco = 'alto_alerta' OR risco_composto >= 3 OR (prob >= 0.25 AND risco_composto >= 2 AND positividade >= 0.35 AND tests >= 3) THEN 3 WHEN nivel_risco = 'alerta' OR risco_composto >= 2 OR prob >= 0.25 OR (positividade >= 0.5 AND tests >= 2) THEN 2 WHEN nivel_risco = 'atencao' OR risco_composto >= 1 OR (positividade >= 0.25 AND tests >= 1) THEN 1 ELSE 0 END AS fx FROM la),
b2 AS (SELECT *, CASE WHEN pct >= 90 THEN 3 WHEN pct >= 75 THEN 2 WHEN pct >= 50 THEN 1 ELSE 0 END AS rl, ['Baixo', 'Moderado', 'Alto', 'Crítico'] AS nm FROM bd)
SELECT target, municipio, prob, pct AS percentil, nm[fx + 1] AS banda_absoluta, nm[rl + 1] AS banda_percentil, nm[greatest(fx, rl) + 1] AS banda, CASE WHEN fx > rl THEN 'absoluto' WHEN rl > fx THEN 'percentil' ELSE 'ambos' END AS criterio_banda FROM b2""")
def risk_bands(spark, sf_dir):
    """O129."""
    rows = predict.latest(logit_of(spark, sf_dir), ["target", "municipio"]).withColumn("familia", rules.family(F.col("target"), "outros", _FAMILIES))
    return rounded(predict.bands(rows, ["familia"]).select("target", "municipio", "prob", "percentil", "banda_absoluta", "banda_percentil", "banda", "criterio_banda"))


_TEST = f"""{_LOGIT}, ws AS (SELECT *, row_number() OVER (ORDER BY epi_year, epi_week) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT epi_year, epi_week FROM lg)), ct AS (SELECT epi_year * 100 + epi_week AS c FROM ws WHERE i = greatest(floor(n * 0.8), 1)),
te AS (SELECT target, y_alerta AS y, prob, target || '|' || municipio || '|' || epi_year || '|' || epi_week AS id FROM lg, ct WHERE epi_year * 100 + epi_week > c)"""


def tested_of(spark, sf_dir):
    held = predict.temporal_split(logit_of(spark, sf_dir)).where("not treino")
    return held.select("target", F.col("y_alerta").alias("y"), "prob", F.concat_ws("|", "target", "municipio", "epi_year", "epi_week").alias("id"))


@query(f"""WITH {_TEST}, rk AS (SELECT *, rank() OVER (PARTITION BY target ORDER BY prob) + (count(*) OVER (PARTITION BY target, prob) - 1) / 2.0::DOUBLE AS rn, row_number() OVER (PARTITION BY target ORDER BY prob DESC, id) AS pl FROM te)
SELECT target, count(*) AS n, count(*) FILTER (y = 1) AS n_pos, round(count(*) FILTER (prob >= 0.5 AND y = 1) / nullif(count(*) FILTER (prob >= 0.5), 0)::DOUBLE, 6) AS precision, round(count(*) FILTER (prob >= 0.5 AND y = 1) / nullif(count(*) FILTER (y = 1), 0)::DOUBLE, 6) AS recall, round(avg((prob - y) * (prob - y)), 6) AS brier,
  round((sum(rn) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0::DOUBLE) / nullif(count(*) FILTER (y = 1) * count(*) FILTER (y = 0), 0), 6) AS auc, round(avg(y) FILTER (pl <= 20), 6) AS precision_at_k, round(avg(y) FILTER (pl <= 50), 6) AS precision_at_50, round(avg(y), 6) AS pos_rate,
  count(*) FILTER (prob >= 0.5) AS n_alerta_emitido, count(*) FILTER (prob >= 0.5 AND y = 1) AS n_confirmado FROM rk GROUP BY 1""")
def model_metrics(spark, sf_dir):
    """O96, O105, O138, O142."""
    return rounded(predict.metrics(written(tested_of(spark, sf_dir), "scored-rows"), ["target"], 0.5))  # read twice


@query(f"""WITH {_TEST}, c AS (SELECT round(0.05 + 0.05 * k, 2)::DOUBLE AS t FROM (SELECT unnest(range(17)) AS k)), s AS (SELECT t, 2.0::DOUBLE * count(*) FILTER (prob >= t AND y = 1) / nullif(count(*) FILTER (prob >= t) + count(*) FILTER (y = 1), 0) AS f1 FROM te, c GROUP BY 1)
SELECT t AS threshold, round(coalesce(f1, 0), 9) AS f1 FROM s ORDER BY round(coalesce(f1, 0), 9) DESC, t LIMIT 1""")
def best_threshold(spark, sf_dir):
    """O141."""
    return predict.best_threshold(tested_of(spark, sf_dir))


_SPEAR = "(rank() OVER (PARTITION BY {k} ORDER BY {c}) + (count(*) OVER (PARTITION BY {k}, {c}) - 1) / 2.0::DOUBLE)"


_CLIMATE_VARS = ["temperature_2m_max", "n_eventos_climaticos", "severidade_media"]


@query(f"""WITH {PANEL}, {b.READING}, wc AS (SELECT n_name AS municipio, epi_week, avg(value) AS temperature_2m_max, count(DISTINCT event_id) AS n_eventos_climaticos, avg(severidade) AS severidade_media FROM reading JOIN nation USING (n_nationkey) GROUP BY ALL), pc AS (SELECT panel.*, wc.* EXCLUDE (municipio, epi_week) FROM panel JOIN wc USING (municipio, epi_week)),
t AS ({" UNION ALL ".join(f"SELECT target, '{x}' AS climate_var, '{y}' AS indicador, {x}::DOUBLE AS x, {y}::DOUBLE AS y FROM pc" for x in _CLIMATE_VARS for y in predict.STATE)}), c AS (SELECT target, climate_var, indicador, count(*) AS n_obs FROM t WHERE x IS NOT NULL GROUP BY ALL HAVING count(*) >= 20),
r AS (SELECT *, {_SPEAR.format(k="target, climate_var, indicador", c="x")} AS rx, {_SPEAR.format(k="target, climate_var, indicador", c="y")} AS ry FROM t WHERE x IS NOT NULL AND y IS NOT NULL),
k AS (SELECT target, climate_var, indicador, CASE WHEN max(rx) > min(rx) AND max(ry) > min(ry) THEN corr(rx, ry) END AS rho FROM r GROUP BY ALL HAVING count(*) > 10)
SELECT target, climate_var, max(n_obs) AS n_obs, {", ".join(f"round(max(rho) FILTER (indicador = '{y}'), 6) AS spearman_{y}" for y in predict.STATE)} FROM c LEFT JOIN k USING (target, climate_var, indicador) GROUP BY ALL""")
def climate_association(spark, sf_dir):
    """O83. The weather at hand is of a year without exams: a town's weather in the same week of the year stands for it."""
    weather = b.readings(spark, sf_dir).join(b.towns(spark, sf_dir), "n_nationkey").groupBy("municipio", "epi_week").agg(F.avg("value").alias("temperature_2m_max"), F.countDistinct("event_id").alias("n_eventos_climaticos"), F.avg("severidade").alias("severidade_media"))
    return rounded(predict.climate_association(panel_of(spark, sf_dir).join(weather, ["municipio", "epi_week"]), _CLIMATE_VARS))


@query(f"""WITH {RISK}, w AS (SELECT target, {", ".join(f"lag(notificacoes_mun_semana, {k}) OVER ({_W}) AS x{k}" if k else "notificacoes_mun_semana AS x0" for k in range(5))}, tests, positividade FROM scored),
t AS ({" UNION ALL ".join(f"SELECT target, '{y}' AS indicador, {k}::BIGINT AS lag, x{k}::DOUBLE AS x, {y}::DOUBLE AS y FROM w" for y in ("tests", "positividade") for k in range(5))}), v AS (SELECT * FROM t WHERE x IS NOT NULL AND y IS NOT NULL),
r AS (SELECT *, {_SPEAR.format(k="target, indicador, lag", c="x")} AS rx, {_SPEAR.format(k="target, indicador, lag", c="y")} AS ry FROM v) SELECT target, indicador, lag, count(*) AS n, round(corr(rx, ry), 6) AS rho FROM r GROUP BY ALL HAVING count(*) >= 12""")
def lagged_association(spark, sf_dir):
    """O84."""
    keys = ["target", "indicador", "lag"]
    return rounded(predict.rank_correlation(predict.lagged(scored_of(spark, sf_dir), "notificacoes_mun_semana", ["tests", "positividade"], ["target"]), keys, 12))


_URGENT = "CASE prioridade WHEN 'CRÍTICO' THEN 4 WHEN 'ALTO' THEN 3 WHEN 'MODERADO' THEN 2 ELSE 1 END"


@query(f"""WITH {_LOGIT}, {_SCEN.removeprefix(RISK + ', ')}, {TERRITORY.removeprefix(RISK + ', ')}, {SILENCE.removeprefix(RISK + ', ' + _LAST8 + ', ')},
q1 AS (SELECT municipio, target, 'alerta_laboratorial' AS sinal, cenario_operacional AS motivo, prioridade, {_URGENT}::DOUBLE AS score FROM sc WHERE prioridade IN ('CRÍTICO', 'ALTO') ORDER BY score DESC, municipio, target LIMIT 20),
q2 AS (SELECT municipio, '' AS target, 'risco_territorial' AS sinal, printf('Faixa %s | score %.2f', faixa_risco, score_risco_territorial) AS motivo, CASE faixa_risco WHEN 'atencao' THEN 'MODERADO' ELSE 'ALTO' END AS prioridade, score_risco_territorial AS score FROM t2 WHERE faixa_risco <> 'habitual' ORDER BY score DESC, municipio LIMIT 10),
q3 AS (SELECT municipio, '' AS target, 'silencio_laboratorial' AS sinal, classificacao_silencio || ' | exames recentes=' || tests_recent || ' | notif=' || notif_recent AS motivo, CASE classificacao_silencio WHEN 'silencio_critico' THEN 'CRÍTICO' ELSE 'ALTO' END AS prioridade, score_silencio AS score FROM s1 WHERE classificacao_silencio IN ('silencio_critico', 'silencio_provavel') ORDER BY score DESC, municipio LIMIT 10),
qa AS (SELECT * FROM (SELECT * FROM q1 UNION ALL SELECT * FROM q2 UNION ALL SELECT * FROM q3) ORDER BY {_URGENT} DESC, score DESC, municipio, target, sinal LIMIT 20),
pm AS (SELECT municipio, max(prob) AS p FROM (SELECT * FROM lg QUALIFY row_number() OVER (PARTITION BY target, municipio ORDER BY epi_year DESC, epi_week DESC) = 1) GROUP BY 1),
qb AS (SELECT qa.*, CASE WHEN sinal NOT LIKE '%silencio%' THEN p END AS prob_ml FROM qa LEFT JOIN pm USING (municipio)), qc AS (SELECT *, prioridade IN ('CRÍTICO', 'ALTO') AND coalesce(prob_ml >= 0.55, false) AS alerta_hibrido FROM qb)
SELECT municipio, target, sinal, motivo || CASE WHEN alerta_hibrido THEN ' | ML confirma (prob=' || round(prob_ml, 2) || ')' ELSE '' END AS motivo, CASE WHEN prioridade = 'ALTO' AND alerta_hibrido THEN 'CRÍTICO' ELSE prioridade END AS prioridade, round(score, 6) AS score, prob_ml, alerta_hibrido FROM qc""")
def action_queue(spark, sf_dir):
    """O104, O126: the queue of a period, with the towns' latest risk scores; a list of twenty is what the operator is for."""
    rows = scored_of(spark, sf_dir)
    town_risk = territory.territorial_risk(territory.town_target(rows))
    queue = period.action_queue(period.scenario(analysis_of(spark, sf_dir)), town_risk, territory.silence(universe_of(spark, sf_dir), rows))
    told = predict.latest(logit_of(spark, sf_dir).select("target", "municipio", "epi_year", "epi_week", "prob"), ["target", "municipio"])
    return rounded(period.reinforced(queue, told).select("municipio", "target", "sinal", "motivo", "prioridade", "score", "prob_ml", "alerta_hibrido"))


_HIST = f"""{_LOGIT}, old AS (SELECT 'risco' AS tipo, municipio, target, epi_year, epi_week, prob, 1 AS v FROM lg WHERE prob >= 0.6), new AS (SELECT 'risco' AS tipo, municipio, target, epi_year, epi_week, round(prob - 0.05, 6) AS prob, 2 AS v FROM lg WHERE prob >= 0.5 AND prob < 0.75
  UNION ALL SELECT 'silencio', municipio, target, epi_year, epi_week, prob, 2 FROM lg WHERE y_silencio = 1 AND prob >= 0.5),
hi AS (SELECT * FROM (SELECT * FROM old UNION ALL SELECT * FROM new) QUALIFY row_number() OVER (PARTITION BY tipo, municipio, target, epi_year, epi_week ORDER BY v DESC, prob DESC) = 1),
oc AS (SELECT h.*, sum(p.tests) AS ts, sum(p.positives) AS ps, count(p.tests) AS semanas_vistas FROM hi h LEFT JOIN panel p ON p.municipio = h.municipio AND p.target = h.target AND p.epi_year * 53 + p.epi_week BETWEEN h.epi_year * 53 + h.epi_week + 1 AND h.epi_year * 53 + h.epi_week + CASE tipo WHEN 'risco' THEN 2 ELSE 1 END GROUP BY ALL)"""


@query(f"WITH {_HIST} SELECT tipo, municipio, target, epi_year, epi_week, v AS data_emissao, prob, semanas_vistas, CAST(CASE WHEN semanas_vistas > 0 THEN CASE tipo WHEN 'risco' THEN ps > 0 ELSE ts = 0 END END AS BIGINT) AS confirmado FROM oc")
def alert_history(spark, sf_dir):
    """O60, O106, O127: what was issued in any week of the panel, with newer versions (those under 0.75) merged in, and what came of it."""
    rows = logit_of(spark, sf_dir)
    shape = lambda df, kind, v: df.select(F.lit(kind).alias("tipo"), "municipio", "target", "epi_year", "epi_week", F.lit(v).alias("data_emissao"), "prob")
    old = shape(rows.where("prob >= 0.6"), "risco", 1)
    again = shape(rows.where("prob >= 0.5 and prob < 0.75").withColumn("prob", F.round(F.col("prob") - 0.05, 6)), "risco", 2)
    quiet = shape(rows.where("y_silencio = 1 and prob >= 0.5"), "silencio", 2)
    merged = history.upsert(old, again.unionByName(quiet))
    return history.with_outcomes(merged, scored_of(spark, sf_dir), {"risco": 2, "silencio": 1}).withColumn("confirmado", F.col("confirmado").cast("long"))


_NORMS = "least(greatest(coalesce(backlog_estimado, 0) / greatest(coalesce(exames, 0), 1)::DOUBLE, 0), 1) AS backlog_norm, greatest(least(coalesce(tat_p90_dias, 14) / 14::DOUBLE, 2), 0) / 2 AS tat_p90_norm, greatest(least(coalesce(pct_rejeitado, 0) / 0.05::DOUBLE, 2), 0) / 2 AS rejeicao_norm"


def _pressure_sql(keys: str, others: str, unknown: float) -> str:
    by = f"PARTITION BY {keys} ORDER BY epi_year, epi_week"
    ma = lambda n, least: f"CASE WHEN count(tests) OVER ({by} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) >= {least} THEN avg(tests) OVER ({by} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END"
    return f"""k104 AS (SELECT DISTINCT epi_year, epi_week FROM panel ORDER BY epi_year DESC, epi_week DESC LIMIT 104), pp0 AS (SELECT {keys}, epi_year, epi_week, sum(tests)::BIGINT AS tests, sum(notificacoes)::BIGINT AS notificacoes FROM fam SEMI JOIN k104 USING (epi_year, epi_week) GROUP BY ALL),
pp1 AS (SELECT *, lag(tests, 1) OVER ({by}) AS tests_lag1, {ma(4, 2)} AS tests_ma4, {ma(8, 3)} AS tests_ma8, (rank() OVER (PARTITION BY epi_year, epi_week{others} ORDER BY tests) + (count(*) OVER (PARTITION BY epi_year, epi_week{others}, tests) - 1) / 2.0::DOUBLE) / count(*) OVER (PARTITION BY epi_year, epi_week{others}) AS tests_pct_estadual,
  least(greatest(tests / greatest(quantile_cont(tests, 0.95) OVER (PARTITION BY epi_year, epi_week{others}), 1), 0), 1) AS volume_norm FROM pp0),
pp2 AS (SELECT pp1.*, round(greatest(least(100 * (0.40::DOUBLE * volume_norm + 0.25::DOUBLE * coalesce(backlog_norm, 0) + 0.20::DOUBLE * coalesce(tat_p90_norm, {unknown}) + 0.15::DOUBLE * coalesce(rejeicao_norm, 0)), 100), 0), 2) AS indice_pressao_proxy FROM pp1 LEFT JOIN norms USING ({keys})),
pp AS (SELECT *, CASE WHEN indice_pressao_proxy <= 35 THEN 'baixa' WHEN indice_pressao_proxy <= 55 THEN 'moderada' WHEN indice_pressao_proxy <= 75 THEN 'alta' ELSE 'critica' END AS faixa_pressao_proxy,
  (coalesce(lead(indice_pressao_proxy) OVER ({by}) >= 55, false) OR coalesce(lead(tests_pct_estadual) OVER ({by}) >= 0.75, false) OR (coalesce(lead(tests) OVER ({by}), 0) >= 1.5 * coalesce(tests_ma8, 0) AND coalesce(lead(tests) OVER ({by}), 0) >= 5 AND coalesce(tests_ma8, 0) >= 2))::INT AS y_pressao_alta FROM pp2)"""


_PP = "epi_year, epi_week, tests, notificacoes, tests_lag1, round(tests_ma8, 6) AS tests_ma8, round(tests_pct_estadual, 6) AS tests_pct_estadual, round(volume_norm, 6) AS volume_norm, indice_pressao_proxy, faixa_pressao_proxy, y_pressao_alta"
_PP_COLUMNS = ["epi_year", "epi_week", "tests", "notificacoes", "tests_lag1", "tests_ma8", "tests_pct_estadual", "volume_norm", "indice_pressao_proxy", "faixa_pressao_proxy", "y_pressao_alta"]


@query(f"WITH {RISK}, {NETWORK.split('tat AS', 1)[1].join(['tat AS', ''])}, norms AS (SELECT municipio, {_NORMS} FROM network), fam AS (SELECT * FROM scored), {_pressure_sql('municipio', '', 0.5)} SELECT municipio, {_PP} FROM pp")
def pressure_weekly(spark, sf_dir):
    """O136, O137: towns by week."""
    rows = pressure.pressure_labels(pressure.pressure_panel(scored_of(spark, sf_dir), network_of(spark, sf_dir)))
    return rounded(rows.select("municipio", *_PP_COLUMNS))


@query(f"""WITH {RISK}, {NETWORK.split('tat AS', 1)[1].join(['tat AS', ''])}, nf AS (SELECT municipio, {_FAMILY} AS familia, {_NET} FROM tat GROUP BY 1, 2 HAVING count(*) >= 20), norms AS (SELECT municipio, familia, {_NORMS} FROM nf),
fam AS (SELECT *, {_FAMILY} AS familia FROM scored), {_pressure_sql('municipio, familia', ', familia', 0.0)} SELECT municipio, familia, {_PP} FROM pp""")
def pressure_weekly_family(spark, sf_dir):
    """O136, O137: towns and families by week; service levels are those of the family where it has 20 exams."""
    family = rules.family(F.col("target"), "outros", _FAMILIES)
    keys = ("municipio", "familia")
    net = rounded(aggregates.network(aggregates.turnaround(b.exams(spark, sf_dir)).withColumn("familia", family), list(keys))).where("exames >= 20")
    rows = pressure.pressure_labels(pressure.pressure_panel(scored_of(spark, sf_dir).withColumn("familia", family), net, keys, unknown_turnaround=0.0), keys)
    return rounded(rows.select(*keys, *_PP_COLUMNS))


@query(f"WITH {RISK}, k8 AS (SELECT DISTINCT epi_year, epi_week FROM panel ORDER BY epi_year DESC, epi_week DESC LIMIT 8), r AS (SELECT panel.* FROM panel SEMI JOIN k8 USING (epi_year, epi_week)) SELECT max(epi_year) AS epi_year_max, max(epi_week) AS epi_week_max, sum(tests)::DOUBLE AS exames_8sem, sum(positives)::DOUBLE AS positivos_8sem, round(sum(positives) / nullif(sum(tests), 0)::DOUBLE, 6) AS positividade_8sem, count(DISTINCT municipio) AS municipios, count(DISTINCT target) AS agravos FROM r")
def executive_summary(spark, sf_dir):
    """O86."""
    return rounded(territory.executive_summary(scored_of(spark, sf_dir)))


@query(f"WITH {b.EXAM}, {b.POPULATION} SELECT municipio, target, count(*) AS exames FROM exam SEMI JOIN pop USING (municipio) GROUP BY 1, 2")
def known_towns(spark, sf_dir):
    """Exams of towns with a known population only."""
    known = normalise.in_universe(b.exams(spark, sf_dir), b.population(spark, sf_dir))
    return known.groupBy("municipio", "target").agg(F.count(F.lit(1)).alias("exames"))


@query(f"WITH {NETWORK} SELECT municipio, backlog_estimado, tat_mediano_dias, row_number() OVER (ORDER BY backlog_estimado DESC, tat_mediano_dias DESC NULLS LAST, municipio) AS ordem FROM network")
def network_ordered(spark, sf_dir):
    """O103: towns by backlog, then turnaround (both from the top, unknown last), then name, with the place of each."""
    return territory.ordered(network_of(spark, sf_dir).select("municipio", "backlog_estimado", "tat_mediano_dias"), [F.desc("backlog_estimado"), F.desc_nulls_last("tat_mediano_dias"), F.col("municipio")])


@query("WITH w AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS semana, event_type, value FROM events) SELECT CAST(semana AS VARCHAR) AS semana, event_type, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY 1, 2")
def stream_weekly(spark, sf_dir):
    """O144: the files as a stream, in complete mode; the SQL is its batch twin."""
    return rounded(stream.run_available(spark, f"{sf_dir}/events.parquet").withColumn("semana", F.col("semana").cast("string")), 4)


@query("WITH w AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS semana, event_type, value, max(ts) OVER () AS last FROM events) SELECT CAST(semana AS VARCHAR) AS semana, event_type, count(*) AS n, round(sum(value), 4) AS total FROM w WHERE semana + INTERVAL 7 DAY <= last - INTERVAL 1 DAY GROUP BY 1, 2")
def stream_closed_weeks(spark, sf_dir):
    """O144: append mode: the weeks that the watermark has closed."""
    return rounded(stream.run_closed_weeks(spark, f"{sf_dir}/events.parquet").withColumn("semana", F.col("semana").cast("string")), 4)


@query("SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2")
def stream_upsert(spark, sf_dir):
    """O145: the last value of each user and type, merged batch by batch."""
    return stream.run_upserts(spark, f"{sf_dir}/events.parquet", ["user_id", "event_type"], "ts").select("user_id", "event_type", "value")


@query("SELECT c_nationkey::BIGINT AS c_nationkey, CAST(right(k, 4) AS BIGINT) AS ano, v AS populacao FROM (UNPIVOT (SELECT c_nationkey, 1000 * count(*) AS Pop_2019, 1010 * count(*) AS Pop_2020, 1020 * count(*) AS Pop_2021 FROM customer GROUP BY 1) ON Pop_2019, Pop_2020, Pop_2021 INTO NAME k VALUE v)")
def melt_population(spark, sf_dir):
    """O107."""
    n = F.count(F.lit(1))
    wide = b.read(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("long").alias("c_nationkey")).agg(*[(n * k).alias(f"Pop_{y}") for y, k in ((2019, 1000), (2020, 1010), (2021, 1020))])
    return tables.melt_years(wide, ["c_nationkey"])


@query("SELECT 'linhas' AS medida, count(*) AS valor FROM lineitem UNION ALL SELECT 'no_periodo', count(*) FILTER (l_shipdate >= DATE '1997-01-01') FROM lineitem")
def run_counts(spark, sf_dir):
    """Counts are taken as the rows of an aggregate pass by."""
    line = b.read(spark, sf_dir, "lineitem").select("l_shipdate")
    inside = F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz")
    counts = line.agg(F.count(F.lit(1)).alias("linhas"), F.count_if(inside).alias("no_periodo"))
    return counts.unpivot([], ["linhas", "no_periodo"], "medida", "valor")


_RAW_FIELDS = """(1, 'Resultado', 'qualitative_result', CASE o_orderstatus WHEN 'F' THEN 'positive' WHEN 'O' THEN 'negative' ELSE 'pending' END), (2, 'CT', 'analytic_metric', 'numeric'), (3, '', 'empty_field', 'empty'), (4, '', 'empty_field', 'empty'), (5, '', 'empty_field', 'empty'), (6, '', 'empty_field', 'empty')"""


@query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS record_id, CAST(o_orderdate AS DATE) AS event_date, n_name AS municipio, 'Dengue ' || o_orderpriority AS exame, f.i AS field_index, f.l AS field_label, 'dengue' AS target, f.m AS measure_role, f.o AS outcome_class,
  f.i = 1 AND f.o IN ('positive', 'negative') AS is_interpretable_result, f.o = 'positive' AS is_positive_like FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey, LATERAL (VALUES {_RAW_FIELDS}) f(i, l, m, o)""")
def raw_results(spark, sf_dir):
    """Orders written as raw exams, taken apart to long rows; tests also hold the rules against rows made by hand."""
    orders = b.requests(spark, sf_dir)
    told = F.when(F.col("o_orderstatus") == "F", "Detectável").when(F.col("o_orderstatus") == "O", "Não detectável").otherwise("Aguardando processamento")
    raw = orders.select(
        F.col("o_orderkey").cast("string").alias("Sequencial"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("Data_Coleta_dt"), F.col("municipio").alias("Municipio_Solicitante"), F.lit("Dengue").alias("Agravo_Requisicao"), F.lit("RT-PCR").alias("Metodologia"),
        F.concat(F.lit("Dengue "), "o_orderpriority").alias("Exame"), F.lit("Exame Liberado").alias("Status_Exame"), F.concat(F.lit("Resultado: "), told).alias("Campo_Resultado_1"), F.concat(F.lit("CT: "), F.translate(F.round(F.col("o_totalprice") / 10000, 1).cast("string"), ".", ",")).alias("Campo_Resultado_2"))
    return normalise.long_results(raw).select("record_id", "event_date", "municipio", "exame", "field_index", "field_label", "target", "measure_role", "outcome_class", "is_interpretable_result", "is_positive_like")


@query(f"WITH {_ALERT.replace(b.EXAM + ', ' + b.WEEKLY + ', ', RISK + ', ')} SELECT a.target, a.municipio, a.epi_year, a.epi_week, a.tests, round(a.positividade, 4) AS positividade, round(vt, 4) AS volume_threshold, round(pt, 4) AS positivity_threshold, va AS volume_alert, pa AS positivity_alert, round(sc, 4) AS alert_score, CASE WHEN sc >= 3 THEN 'alto' WHEN sc >= 2 THEN 'moderado' ELSE 'baixo' END AS alert_level, round(risco_composto, 4) AS risco_composto, nivel_risco FROM alert a LEFT JOIN scored s ON a.target = s.target AND a.municipio = s.municipio AND a.epi_year = s.epi_year AND a.epi_week = s.epi_week WHERE sc > 0")
def alerts_in_context(spark, sf_dir):
    """O110: alerts with the composite risk of their cell."""
    return rounded(panel.alerts_in_context(alerts_of(spark, sf_dir).where("alert_level != 'sem_sinal'"), scored_of(spark, sf_dir)), 4)
