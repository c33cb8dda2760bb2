"""Queries of the context of a town, the features of models and the models themselves, each with its SQL where SQL has one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import aggregates, models, predict, pressure, territory
from ..sources.stages import written
from . import bindings as b
from .decisions import _FAMILIES, _FAMILY, _LOGIT, _NORMS, _W, _ma, _pressure_sql
from .registry import query
from .surveillance import _LAST8, EDGES, NETWORK, RISK, SILENCE, TERRITORY, edges_of, network_of, rounded, scored_of, universe_of

_CONFIDENCE = f"""seen AS (SELECT municipio, sum(tests)::BIGINT AS exames, sum(positives)::BIGINT AS positivos, count(DISTINCT (epi_year, epi_week)) AS semanas_com_dado, sum(notificacoes)::BIGINT AS notif_join FROM scored SEMI JOIN rw USING (epi_year, epi_week) GROUP BY 1),
nt AS (SELECT municipio, sum(notificacoes)::BIGINT AS notif_sinan FROM nk SEMI JOIN rw USING (epi_year, epi_week) GROUP BY 1),
c AS (SELECT municipio, coalesce(exames, 0) AS exames, coalesce(positivos, 0) AS positivos, coalesce(semanas_com_dado, 0) AS semanas_com_dado, coalesce(notif_join, 0) AS notif_join, coalesce(notif_sinan, 0) AS notif_sinan FROM seen FULL JOIN nt USING (municipio)),
c1 AS (SELECT *, notif_sinan > 0 AND exames <= 0 AS gap_sinan_sem_exame, notif_sinan > 0 AND notif_join <= 0 AS join_sinan_fraco FROM c),
c2 AS (SELECT *, round(least(semanas_com_dado / 8.0::DOUBLE, 1) * 0.35::DOUBLE + (exames > 0)::INT * 0.25::DOUBLE + (NOT gap_sinan_sem_exame)::INT * 0.20::DOUBLE + (NOT join_sinan_fraco)::INT * 0.20::DOUBLE, 3) AS confianca_dado FROM c1)"""
_READ = " ".join(f"WHEN {w} THEN '{t}'" for w, t in zip(("gap_sinan_sem_exame", "join_sinan_fraco", "confianca_dado < 0.35", "confianca_dado >= 0.8"), territory.READINGS, strict=False))
_BAND = "CASE WHEN confianca_dado <= 0.35 THEN 'baixa' WHEN confianca_dado <= 0.60 THEN 'moderada' WHEN confianca_dado <= 0.80 THEN 'boa' ELSE 'alta' END"


def confidence_of(spark, sf_dir, scored=None):
    return territory.confidence(scored if scored is not None else scored_of(spark, sf_dir), aggregates.notified(b.notifications(spark, sf_dir)))


@query(f"WITH {RISK}, {_LAST8}, {_CONFIDENCE} SELECT *, {_BAND} AS faixa_confianca, CASE {_READ} ELSE '{territory.READINGS[4]}' END AS interpretacao FROM c2")
def data_confidence(spark, sf_dir):
    """O55, O85."""
    return confidence_of(spark, sf_dir)


@query(f"""WITH {b.EXAM}, {b.NOTIF}, {b.DEATHS}, {b.FACILITY}, e AS (SELECT municipio, count(DISTINCT record_id) AS exames FROM exam GROUP BY 1), n1 AS (SELECT municipio, count(*) AS n1 FROM notif GROUP BY 1), n2 AS (SELECT municipio, count(*) AS n2, count(*) AS obitos FROM obito GROUP BY 1),
cap AS (SELECT municipio, sum(floor(greatest(s_acctbal, 0) / 100))::BIGINT AS cnes_leitos_total FROM facility GROUP BY 1),
i AS (SELECT municipio, coalesce(exames, 0) AS exames, greatest(coalesce(n1, 0), coalesce(n2, 0)) AS notificacoes, coalesce(obitos, 0) AS obitos, cnes_leitos_total FROM e FULL JOIN n1 USING (municipio) FULL JOIN n2 USING (municipio) LEFT JOIN cap USING (municipio))
SELECT *, CASE WHEN notificacoes > 0 THEN round(exames / notificacoes::DOUBLE, 6) END AS exames_por_notificacao, notificacoes > 0 AND exames = 0 AS lacuna FROM i""")
def integration(spark, sf_dir):
    """O55, O90."""
    deaths = aggregates.notified(b.deaths(spark, sf_dir), "obitos")
    beds = aggregates.capacity(*b.capacity_sources(spark, sf_dir)).select("municipio", "cnes_leitos_total")
    return rounded(territory.integration(b.exams(spark, sf_dir), aggregates.notified(b.notifications(spark, sf_dir)), deaths.withColumnRenamed("obitos", "notificacoes"), deaths, beds))


_WEATHER = """wt AS (SELECT n_name AS municipio, epi_week, avg(value) AS temperature_2m_max, coalesce(sum(value) FILTER (event_type = 'purchase'), 0) AS precipitation_sum_mm, min(value) AS relative_humidity_2m_min, count(DISTINCT event_id) AS n_eventos_climaticos FROM reading JOIN nation USING (n_nationkey) GROUP BY ALL)"""
_CNES = "cn2 AS (SELECT municipio, count(*) AS cnes_estabelecimentos, count(*) FILTER (s_suppkey % 3 = 0) AS cnes_equipes_esf FROM facility GROUP BY 1)"


def weather_of(spark, sf_dir):
    """Weather of a town by week of the year (the readings at hand are of a year without exams)."""
    rain = F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))), F.lit(0.0))
    return b.readings(spark, sf_dir).join(b.towns(spark, sf_dir), "n_nationkey").groupBy("municipio", "epi_week").agg(F.avg("value").alias("temperature_2m_max"), rain.alias("precipitation_sum_mm"), F.min("value").alias("relative_humidity_2m_min"), F.countDistinct("event_id").alias("n_eventos_climaticos"))


def panel_with_weather(spark, sf_dir):
    """The scored panel with the weather and the facilities of its towns, written once."""
    facilities = aggregates.capacity(*b.capacity_sources(spark, sf_dir)).select("municipio", "cnes_estabelecimentos", "cnes_equipes_esf")
    return written(scored_of(spark, sf_dir).join(weather_of(spark, sf_dir), ["municipio", "epi_week"], "left").join(facilities, "municipio", "left"), "panel-weather")


def near_alerts_of(spark, sf_dir, scored):
    """O59, O114: silent towns with their neighbours in alert, and what that makes of their class."""
    risk = territory.territorial_risk(territory.town_target(scored)).select("municipio", "score_risco_territorial", F.col("faixa_risco").isin("alerta", "alto_alerta").alias("em_alerta"))
    rolled = territory.around(edges_of(spark, sf_dir), risk, "score_risco_territorial", "em_alerta")
    return territory.silence_near_alerts(territory.silence(universe_of(spark, sf_dir), scored), rolled)


_NEAR = f"""{TERRITORY.removeprefix(RISK + ', ')}, {SILENCE.removeprefix(RISK + ', ' + _LAST8 + ', ')}, {EDGES.split('pts AS', 1)[1].join(['pts AS', ''])},
na AS (SELECT e.municipio, count(*) FILTER (t.faixa_risco IN ('alerta', 'alto_alerta')) AS vizinhos FROM edges e LEFT JOIN t2 t ON e.vizinho = t.municipio GROUP BY 1),
near AS (SELECT s1.*, coalesce(vizinhos, 0) AS vizinhos_em_alerta, coalesce(vizinhos, 0) > 0 AND classificacao_silencio <> '' AS silencio_com_vizinho_alerta FROM s1 LEFT JOIN na USING (municipio))"""


@query(f"""WITH {RISK}, {_NEAR} SELECT municipio, vizinhos_em_alerta, silencio_com_vizinho_alerta, round(score_silencio + CASE WHEN silencio_com_vizinho_alerta THEN 1.5 ELSE 0 END, 6) AS score_silencio,
  CASE WHEN vizinhos_em_alerta > 0 AND classificacao_silencio IN ('silencio_moderado', 'silencio_provavel', 'baixo_uso') THEN 'silencio_critico' ELSE classificacao_silencio END AS classificacao_silencio FROM near""")
def silence_near_alerts(spark, sf_dir):
    """O59, O114."""
    scored = written(scored_of(spark, sf_dir), "scored")
    return rounded(near_alerts_of(spark, sf_dir, scored).select("municipio", "vizinhos_em_alerta", "silencio_com_vizinho_alerta", "score_silencio", "classificacao_silencio"))


def context_of(spark, sf_dir):
    """O135: features of the last 104 weeks, all sixteen metrics, with the town's silence, neighbours and trust in its data."""
    full = panel_with_weather(spark, sf_dir)
    silent = near_alerts_of(spark, sf_dir, full).where("classificacao_silencio != ''")
    return predict.with_context(predict.features(full, weeks=104), silent, confidence_of(spark, sf_dir, full))


_LAST104 = "k104 AS (SELECT DISTINCT epi_year, epi_week FROM panel ORDER BY epi_year DESC, epi_week DESC LIMIT 104)"
_CONTEXT = f"""{RISK}, {_NEAR}, {_CONFIDENCE}, {b.READING}, {_WEATHER}, {_CNES}, {_LAST104},
fp AS (SELECT scored.*, wt.* EXCLUDE (municipio, epi_week), cn2.* EXCLUDE (municipio) FROM scored SEMI JOIN k104 USING (epi_year, epi_week) LEFT JOIN wt USING (municipio, epi_week) LEFT JOIN cn2 USING (municipio))"""


@query(f"""WITH {_CONTEXT}, fw AS (SELECT target, municipio, epi_year, epi_week, n_eventos_climaticos, cnes_estabelecimentos, round(lag(temperature_2m_max) OVER ({_W}), 9) AS temperature_2m_max_lag1, round({_ma('precipitation_sum_mm', 4)}, 9) AS precipitation_sum_mm_ma4, round({_ma('relative_humidity_2m_min', 8)}, 9) AS relative_humidity_2m_min_ma8,
  round({_ma('n_eventos_climaticos', 4)} - {_ma('n_eventos_climaticos', 8)}, 9) AS n_eventos_climaticos_trend, round({_ma('cnes_equipes_esf', 4)}, 9) AS cnes_equipes_esf_ma4, round({_ma('obitos', 8)}, 9) AS obitos_ma8, round({_ma('risco_composto', 4)}, 9) AS risco_composto_ma4 FROM fp)
SELECT fw.*, coalesce(nr.vizinhos_em_alerta, 0) AS vizinhos_em_alerta, coalesce(nr.silencio_com_vizinho_alerta, false)::BIGINT AS silencio_com_vizinho_alerta, coalesce(c2.confianca_dado, 0.5) AS confianca_dado, coalesce(c2.gap_sinan_sem_exame, false)::BIGINT AS gap_sinan_sem_exame
FROM fw LEFT JOIN (SELECT * FROM near WHERE classificacao_silencio <> '') nr ON nr.municipio = fw.municipio LEFT JOIN c2 ON c2.municipio = fw.municipio""")
def feature_context(spark, sf_dir):
    """O52, O135: weather and facilities in the panel, and the context of its towns."""
    cols = ["temperature_2m_max_lag1", "precipitation_sum_mm_ma4", "relative_humidity_2m_min_ma8", "n_eventos_climaticos_trend", "cnes_equipes_esf_ma4", "obitos_ma8", "risco_composto_ma4", "vizinhos_em_alerta", "silencio_com_vizinho_alerta", "confianca_dado", "gap_sinan_sem_exame"]
    return rounded(context_of(spark, sf_dir).select("target", "municipio", "epi_year", "epi_week", "n_eventos_climaticos", "cnes_estabelecimentos", *cols), 9)


def labelled_of(spark, sf_dir):
    """Features with context, labels and families of the last 104 weeks, written once."""
    family = rules.family(F.col("target"), "outros", _FAMILIES)
    return written(predict.labels(context_of(spark, sf_dir)).withColumn("familia", family), "labelled")


@query()
def gradient_boosting(spark, sf_dir):
    """O138, O139, O141 to O143: alerts (22 columns; of all targets and of each family) and silence (14 columns), fitted on the earlier weeks of the last
    104 and measured on the later ones; tests hold counts, cut-offs and measures against SQL over the written scores."""
    return rounded(models.backtest(models.train(labelled_of(spark, sf_dir)), models.OPERATIONAL))


def pressure_of(spark, sf_dir):
    """Pressure by town and week with service levels, weather, facilities and context: what the pressure model looks at."""
    full = panel_with_weather(spark, sf_dir)
    net = network_of(spark, sf_dir)
    rows = pressure.pressure_labels(pressure.pressure_panel(full, net))
    town = full.groupBy("municipio", "epi_year", "epi_week").agg(*[F.max(c).alias(c) for c in ("precipitation_sum_mm", "temperature_2m_max", "n_eventos_climaticos", "cnes_estabelecimentos", "cnes_leitos_total", "cnes_equipes_esf")])
    levels = net.select("municipio", "tat_p90_dias", "tat_mediano_dias", "pct_liberado_48h", "pct_liberado_7d", "pct_rejeitado", "backlog_estimado")
    known = rows.join(town, ["municipio", "epi_year", "epi_week"], "left").join(levels, "municipio", "left")
    return predict.with_context(known, near_alerts_of(spark, sf_dir, full).where("classificacao_silencio != ''"), confidence_of(spark, sf_dir, full))


@query()
def pressure_model(spark, sf_dir):
    """O139, O143: the model of a coming high pressure on the network, on the weeks that no fit has seen."""
    return rounded(models.backtest(models.train(written(pressure_of(spark, sf_dir), "pressure-rows"), (models.PRESSURE_TASK,), ("municipio",))))


@query(f"""WITH {RISK}, {NETWORK.split('tat AS', 1)[1].join(['tat AS', ''])}, norms AS (SELECT municipio, {_NORMS} FROM network), fam AS (SELECT * FROM scored), {_pressure_sql('municipio', '', 0.5)},
lp AS (SELECT * FROM pp QUALIFY row_number() OVER (PARTITION BY municipio ORDER BY epi_year DESC, epi_week DESC) = 1),
sc AS (SELECT *, round(1 / (1 + exp(-greatest(least(-1.8::DOUBLE + 2.5::DOUBLE * coalesce(indice_pressao_proxy, 0) / 100 + 0.8::DOUBLE * coalesce(tests_pct_estadual, 0) + 0.35::DOUBLE * tanh(coalesce(tests_ma4 - tests_ma8, 0) / 10), 20), -20))), 4) AS prob FROM lp)
SELECT municipio, epi_year, epi_week, prob, prob >= 0.40 AS acima_limiar, CASE WHEN prob <= 0.25 THEN 'baixa' WHEN prob <= 0.40 THEN 'moderada' WHEN prob <= 0.60 THEN 'alta' ELSE 'critica' END AS faixa FROM sc""")
def pressure_scores(spark, sf_dir):
    """O39, O140: the readable score of a coming high pressure, of each town's latest week."""
    rows = pressure.pressure_panel(scored_of(spark, sf_dir), network_of(spark, sf_dir))
    return models.predicted(models.pressure_logit(predict.latest(rows, ["municipio"])).withColumnRenamed("prob", "_logit"), [], "pressao", F.col("_logit"), 0.40, models.PRESSURE_BANDS).select("municipio", "epi_year", "epi_week", "prob", "acima_limiar", "faixa")


#: Importances by which the drivers query weighs the columns of a row.
_WEIGHTS = {"positividade": 0.31, "risco_composto": 0.22, "tests": 0.14, "notificacoes": 0.11, "tests_ma8": 0.09, "indice_vulnerabilidade": 0.07, "exames_por_notif": 0.04, "positividade_ma8": 0.02}
_DRIVEN = [*_WEIGHTS, "tests_trend"]


@query(f"""WITH {_LOGIT}, la AS (SELECT * FROM lg QUALIFY row_number() OVER (PARTITION BY target, municipio ORDER BY epi_year DESC, epi_week DESC) = 1),
dr AS (SELECT target, municipio, unnest([{", ".join(f"{{'i': {i}, 'c': '{c}', 's': round(abs(coalesce({c}, 0)::DOUBLE) * ({_WEIGHTS.get(c, 0.0)}::DOUBLE + 1e-6), 12)}}" for i, c in enumerate(_DRIVEN))}], recursive := true) FROM la),
tp AS (SELECT *, row_number() OVER (PARTITION BY target, municipio ORDER BY s DESC, i) AS r FROM dr) SELECT target, municipio, string_agg(c, '; ' ORDER BY r) AS drivers FROM tp WHERE r <= 5 GROUP BY ALL""")
def model_drivers(spark, sf_dir):
    """O140: what weighs most in the latest row of each series, by given importances."""
    rows = predict.latest(predict.features(written(scored_of(spark, sf_dir), "scored")), ["target", "municipio"])
    found = models.drivers(_DRIVEN, F.create_map(*[F.lit(x) for pair in _WEIGHTS.items() for x in pair]))
    return rows.select("target", "municipio", F.array_join(F.transform(found, lambda x: x["feature"]), "; ").alias("drivers"))
