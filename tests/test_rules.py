"""Rules of surveillance on rows made by hand, and operators on tables that are not the driver's."""

import math

import pytest
from pyspark.sql import functions as F

from vigia.functions import measures
from vigia.operators import aggregates, emergency, normalise, panel, period, predict, pressure, territory


def week_rows(spark, rows):
    """rows: municipio, target, year, week, tests, positives, notificacoes, obitos, risco."""
    schema = "municipio string, target string, epi_year long, epi_week long, tests long, positives long, notificacoes long, obitos long, risco_composto double"
    return spark.createDataFrame(rows, schema).withColumn("populacao", F.lit(10000).cast("long")).withColumn("positividade", F.when(F.col("tests") > 0, F.col("positives") / F.col("tests")))


def test_period_against_the_weeks_before(spark):
    rows = [("A", "x", 2020, w, 10, 1, 0, 0, 0.5) for w in range(6, 11)] + [("A", "x", 2020, w, 20, 8, 2, 0, 1.5) for w in range(11, 16)]
    rows += [("B", "x", 2020, 11, 0, 0, 3, 0, 0.1), ("C", "x", 2020, 8, 5, 1, 0, 0, 0.1), ("D", "x", 2019, 12, 5, 1, 0, 0, 0.1)]
    got = {r["municipio"]: r for r in period.scenario(period.analysis(week_rows(spark, rows), 2020, 11, 15)).collect()}
    assert got.keys() == {"A", "B", "C"}  # D has no row in either span
    a = got["A"]
    assert (a["tests_periodo"], a["tests_base"], a["semanas_periodo"], a["semanas_base"], a["delta_tests_pct"]) == (100, 50, 5, 5, 1.0)
    assert abs(a["delta_positividade_pp"] - 0.3) < 1e-12 and a["cenario_operacional"] == period.SCENARIOS[2] and a["prioridade"] == "CRÍTICO" and a["prioridade_score"] == 4
    assert got["B"]["silencio_laboratorial"] and got["B"]["cenario_operacional"] == period.SCENARIOS[0] and got["B"]["prioridade"] == "ALTO"
    assert got["C"]["cenario_operacional"] == period.SCENARIOS[7] and got["C"]["tests_periodo"] == 0 and got["C"]["prioridade"] == "MONITORAMENTO"


def test_first_weeks_of_a_year_have_a_short_baseline(spark):
    rows = [("A", "x", 2020, 1, 4, 0, 0, 0, 0.0), ("A", "x", 2019, 52, 50, 0, 0, 0, 0.0), ("A", "x", 2020, 3, 6, 0, 0, 0, 0.0)]
    r = period.analysis(week_rows(spark, rows), 2020, 3, 6).first()
    assert (r["tests_base"], r["tests_periodo"]) == (4, 6)


def test_history_has_a_deviation_by_year_only(spark):
    rows = [("A", "x", y, 10, n, 0, 0, 0, 0.0) for y, n in ((2017, 10), (2018, 14), (2019, 12), (2020, 20))]
    whole = period.analysis(week_rows(spark, rows), 2020, 10, 10, "history", (2015, 2020)).first()
    by_year = period.analysis(week_rows(spark, rows), 2020, 10, 10, "history", (2015, 2020), by_year=True).first()
    assert whole["z_solicitacoes_vs_historico"] == 0 and whole["hist_media_semanal_tests"] == 12 and whole["tests_base"] == 36
    assert abs(by_year["z_solicitacoes_vs_historico"] - (20 - 12) / 2.0) < 1e-12


@pytest.mark.parametrize("change, level", [
    (dict(obitos=1, delta_pos=0.10), "CRÍTICO"), (dict(obitos=1, delta_pos=0.09), "MODERADO"), (dict(pos=0.30, z=2.0), "CRÍTICO"), (dict(pos=0.30, pct=0.50), "CRÍTICO"), (dict(pos=0.29, pct=0.50), "ALTO"), (dict(z=1.5), "ALTO"),
    (dict(pct=0.30), "ALTO"), (dict(low=True), "ALTO"), (dict(delta_pos=0.05), "MODERADO"), (dict(pct=0.15), "MODERADO"), (dict(z=1.0), "MODERADO"), (dict(notif=1), "MODERADO"), (dict(), "MONITORAMENTO"), (dict(silent=True, obitos=9, delta_pos=0.5), "ALTO"),
])
def test_priority_of_a_period(spark, change, level):
    v = dict(tests=10, notif=0, obitos=0, pos=0.1, delta_pos=0.0, pct=None, z=0.0, silent=False, low=False, dn=0) | change
    row = spark.createDataFrame([tuple(v.values())], "tests_periodo long, notificacoes_periodo long, obitos_periodo long, positividade_periodo double, delta_positividade_pp double, delta_tests_pct double, z_solicitacoes_vs_historico double, silencio_laboratorial boolean, baixo_uso_lacen boolean, delta_notificacoes_abs long")
    assert period.scenario(row).first()["prioridade"] == level


def test_projection(spark):
    rows = [("A", "x", 2020, w, 10, 5, 0, 0, 0.0) for w in range(1, 3)] + [("A", "x", 2020, 3, 2, 0, 0, 0, 0.0)]
    r = period.projected(period.analysis(week_rows(spark, rows), 2020, 3, 4), 2020, 3, 4, 14).first()
    assert r["projecao_solicitacoes"] == round((1 + max(-9.0, -1.0) * 0.5) * 2, 1)  # the fall is held at the mean
    assert r["positividade_projetada"] == 0.0 and r["janela_alerta"] == "27/01/2020 a 09/02/2020"


def test_labels(spark):
    rows = [("A", "x", 2020, 1, 3, 0, 0, 0, 0.1), ("A", "x", 2020, 2, 4, 1, 0, 0, 0.2), ("A", "x", 2020, 3, 0, 0, 2, 0, 1.2), ("A", "x", 2020, 4, 5, 0, 0, 0, 0.0)]
    got = {r["epi_week"]: (r["y_alerta"], r["y_silencio"], r["y_silencio_epi"]) for r in predict.labels(week_rows(spark, rows)).collect()}
    assert got == {1: (1, 0, 0), 2: (1, 1, 1), 3: (0, 0, 0), 4: (0, 1, 0)}
    assert predict.labels(week_rows(spark, rows), drop_unresolved=True).count() == 3


def test_risk_logit(spark):
    row = spark.createDataFrame([(0.4, 0.1, 12.0, 9, 3, 5.0, -4.0)], "positividade double, positividade_trend double, risco_composto double, tests long, notificacoes long, indice_vulnerabilidade double, tests_trend double")
    z = -2.2 + 2.8 * 0.4 + 1.5 * math.tanh(0.5) + 0.35 * 10 + 0.15 * math.log1p(9) + 0.12 * math.log1p(3) + 0.25 * 3 + 0.4 * math.tanh(-0.8)
    assert abs(predict.risk_logit(row).first()["prob"] - 1 / (1 + math.exp(-z))) < 1e-12


def test_anomalies_up_and_down(spark):
    base = dict(tests=10.0, positividade=0.2, incidencia_100k=4.0, notificacoes=2.0)
    now = dict(tests=5.0, positividade=0.36, incidencia_100k=4.4, notificacoes=5.0)
    row = spark.createDataFrame([("x", "A", 2020, 1, *now.values(), *base.values())], "target string, municipio string, epi_year long, epi_week long, " + ", ".join(f"{c} double" for c in now) + ", " + ", ".join(f"{c}_ma8 double" for c in base))
    got = {r["metrica"]: (r["tipo_anomalia"], r["severidade"]) for r in predict.anomalies(row).collect()}
    assert got == {"tests": ("queda_atipica", "moderada"), "positividade": ("alta_atipica", "moderada"), "notificacoes": ("alta_atipica", "alta")}


def test_bands_by_severity_and_rank(spark):
    rows = [("a", 0.1, 0.5, 0.0, 1, "habitual"), ("a", 0.2, 3.0, 0.0, 1, "habitual"), ("a", 0.3, 0.0, 0.0, 1, None), ("b", 0.01, 0.0, 0.5, 2, "habitual")]
    got = [(r["banda_absoluta"], r["percentil"], r["banda_percentil"], r["banda"], r["criterio_banda"]) for r in predict.bands(spark.createDataFrame(rows, "k string, prob double, risco_composto double, positividade double, tests long, nivel_risco string"), ["k"]).orderBy("k", "prob").collect()]
    assert got == [("Baixo", 33.3, "Baixo", "Baixo", "ambos"), ("Crítico", 66.7, "Moderado", "Crítico", "absoluto"), ("Alto", 100.0, "Crítico", "Crítico", "percentil"), ("Alto", 50.0, "Moderado", "Alto", "absoluto")]


def test_emergency_priority_and_escalation(spark):
    rows = [("a", True, "critica", False, False, False), ("b", True, "alta", False, False, False), ("c", False, "baixa", True, False, False), ("d", False, "alta", False, False, False), ("e", False, "baixa", False, False, False), ("f", False, None, False, False, True)]
    card = emergency.priority(spark.createDataFrame(rows, "municipio string, sla_crise boolean, faixa_pressao string, silencio_gal_alerta boolean, silencio_gal_vs_vizinhos boolean, divergente boolean"))
    assert {r["municipio"]: (r["prioridade"], r["sinal"]) for r in card.collect()} == {"a": ("CRÍTICO", "risco"), "b": ("ALTO", "risco"), "c": ("ALTO", "silencio"), "d": ("MODERADO", "risco"), "e": ("MONITORAMENTO", "padrao"), "f": ("ALTO", "utilizacao")}
    told = spark.createDataFrame([("d", True), ("e", True), ("e", False)], "municipio string, pressao_predita_acima_limiar boolean")
    assert {r["municipio"]: r["prioridade"] for r in emergency.escalated(card, told).collect()} == {"a": "CRÍTICO", "b": "ALTO", "c": "ALTO", "d": "ALTO", "e": "MODERADO", "f": "ALTO"}


def test_pressure_panel_and_label(spark):
    rows = [("A", "x", 2020, w, n, 0, 0, 0, 0.0) for w, n in enumerate([4, 4, 4, 10], 1)] + [("B", "x", 2020, w, 1, 0, 0, 0, 0.0) for w in range(1, 5)]
    net = spark.createDataFrame([("A", 10, 5, 28.0, 0.05)], "municipio string, exames long, backlog_estimado long, tat_p90_dias double, pct_rejeitado double")
    got = {(r["municipio"], r["epi_week"]): r for r in pressure.pressure_labels(pressure.pressure_panel(week_rows(spark, rows), net)).collect()}
    p95 = 1 + 0.95 * 3
    assert got["A", 1]["indice_pressao_proxy"] == round(100 * (0.40 + 0.25 * 0.5 + 0.20 * 1.0 + 0.15 * 0.5), 2)
    assert got["B", 1]["indice_pressao_proxy"] == round(100 * (0.40 / p95 + 0.20 * 0.5), 2) and got["B", 1]["faixa_pressao_proxy"] == "baixa"
    assert [got["A", w]["y_pressao_alta"] for w in (1, 2, 3, 4)] == [1, 1, 1, 0] and got["B", 1]["y_pressao_alta"] == 0
    assert got["A", 1]["tests_ma8"] is None and got["A", 3]["tests_ma8"] == 4.0


def test_capacity_of_four_sources(spark):
    mk = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = {r["municipio"]: r.asDict() for r in aggregates.capacity(
        mk([("A", 1), ("A", 2)], "municipio string, id int"), mk([("A", "UTI adulto", 3, 2), ("A", "Clínico", 10, 10)], "municipio string, tipo string, existentes int, sus int"),
        mk([("A", "Ventilador", 2, 1), ("B", "Mesa", 4, 4)], "municipio string, tipo string, existentes int, uso int"), mk([("A", "ESF", 5), ("A", "Outra", 1)], "municipio string, tipo string, quantidade int")).collect()}
    assert (got["A"]["cnes_estabelecimentos"], got["A"]["cnes_leitos_total"], got["A"]["cnes_leitos_sus"], got["A"]["cnes_leitos_uti"], got["A"]["cnes_equipamentos_criticos"], got["A"]["cnes_equipes_total"], got["A"]["cnes_equipes_esf"]) == (2, 13, 12, 3, 2, 6, 5)
    assert got["B"]["cnes_estabelecimentos"] is None and got["B"]["cnes_equipamentos_total"] == 4 and got["B"]["cnes_equipamentos_criticos"] == 0


def test_confirmation(spark):
    rows = [("A", "x", 2020, w, 10, 0, 0, 0, 0.0) for w in range(1, 10)] + [("A", "x", 2020, 10, 1, 0, 0, 0, 0.0), ("A", "x", 2020, 11, 0, 0, 5, 0, 0.0), ("A", "x", 2020, 12, 0, 0, 5, 0, 0.0)]
    weekly = week_rows(spark, rows)
    net = spark.createDataFrame([("A", 10.0, True)], "municipio string, indice_pressao_rede double, sla_crise boolean")
    retro = emergency.retrospective(weekly, 3)
    assert {r["epi_week"]: r["mediana_8"] for r in retro.collect()} == {9: 10.0, 10: 10.0, 11: 10.0}  # the last week awaits nothing
    got = {(r["epi_week"], r["tipo_alerta"]): r["confirmado"] for r in emergency.confirmed(emergency.retro_flags(retro, net), weekly).collect()}
    assert got[10, "silencio_gal"] and got[11, "silencio_gal"] and got[11, "divergencia"] and not got[9, "sla_crise"] and not got[10, "sla_crise"] and (10, "divergencia") not in got


def test_pieces_that_no_query_uses(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 3.0), ("h", 5.0)], "k string, v double")
    assert sorted(r["s"] for r in df.select(measures.min_max(F.col("v"), 0, 10, ["k"]).alias("s")).collect()) == [0.0, 5.0, 10.0]
    edges = spark.createDataFrame([("A", "B", 1.0), ("A", "C", 2.0)], "municipio string, vizinho string, dist_km double")
    values = spark.createDataFrame([("B", 4, True)], "municipio string, v int, al boolean")
    rolled = territory.around(edges, values, "v", "al")
    assert [tuple(r) for r in rolled.select("municipio", "vizinhos_em_alerta", "mediana_vizinhos", "n_vizinhos").collect()] == [("A", 1, 2.0, 2)]
    silent = spark.createDataFrame([("A", "silencio_moderado", 2.0), ("Z", "", 0.0)], "municipio string, classificacao_silencio string, score_silencio double")
    near = {r["municipio"]: (r["classificacao_silencio"], r["score_silencio"], r["silencio_com_vizinho_alerta"]) for r in territory.silence_near_alerts(silent, rolled).collect()}
    assert near == {"A": ("silencio_critico", 3.5, True), "Z": ("", 0.0, False)}
    told = panel.harmonise(spark.createDataFrame([("Cuiabá", 4, 1)], "municipio string, exames int, positivos int"))
    assert told.first()["positividade"] == 0.25 and told.first()["municipio"] == "CUIABA"
    known = normalise.in_universe(df.withColumnRenamed("k", "municipio"), spark.createDataFrame([("h",), ("h",)], "municipio string"))
    assert known.count() == 1
    context = predict.with_context(spark.createDataFrame([("A",), ("B",)], "municipio string"), quality=spark.createDataFrame([("A", 0.9, True)], "municipio string, confianca_dado double, gap_sinan_sem_exame boolean"))
    assert {tuple(r) for r in context.select("municipio", "confianca_dado", "gap_sinan_sem_exame", "vizinhos_em_alerta").collect()} == {("A", 0.9, 1, 0), ("B", 0.5, 0, 0)}


def test_queue_with_predictions(spark):
    alerts = spark.createDataFrame([("a", "x", "alta", "ALTO", 3), ("b", "x", None, "CRÍTICO", 4), ("c", "x", "-", "MODERADO", 2), ("d", "y", "alta", "ALTO", 3)], "municipio string, target string, cenario_operacional string, prioridade string, prioridade_score int")
    risk = spark.createDataFrame([("a", "alerta", 2.345), ("c", "atencao", 1.0), ("e", "habitual", 0.1)], "municipio string, faixa_risco string, score_risco_territorial double")
    silent = spark.createDataFrame([("f", "silencio_provavel", 0, 0, 3.0, 2, True), ("g", "silencio_critico", 0, 4, 5.0, 0, False), ("h", "baixo_uso", 1, 9, 1.0, 0, False)], "municipio string, classificacao_silencio string, tests_recent long, notif_recent long, score_silencio double, vizinhos_em_alerta long, silencio_com_vizinho_alerta boolean")
    queue = period.action_queue(alerts, risk, silent)
    got = {(r["municipio"], r["sinal"]): (r["prioridade"], r["motivo"]) for r in queue.collect()}
    assert got == {
        ("a", "alerta_laboratorial"): ("ALTO", "alta"), ("b", "alerta_laboratorial"): ("CRÍTICO", "Prioridade CRÍTICO"), ("d", "alerta_laboratorial"): ("ALTO", "alta"), ("a", "risco_territorial"): ("ALTO", "Faixa alerta | score 2.35"),
        ("c", "risco_territorial"): ("MODERADO", "Faixa atencao | score 1.00"), ("f", "silencio_laboratorial"): ("CRÍTICO", "silencio_provavel | exames recentes=0 | notif=0 | vizinhos em alerta=2"), ("g", "silencio_laboratorial"): ("CRÍTICO", "silencio_critico | exames recentes=0 | notif=4"),
    }
    assert [r["municipio"] for r in period.action_queue(alerts, risk, silent, 3).orderBy(F.desc("score")).collect()] == ["g", "b", "f"]
    told = spark.createDataFrame([("a", 0.2, "Baixo"), ("a", 0.6, "Alto"), ("c", 0.9, "Crítico"), ("d", 0.1, "Crítico")], "municipio string, prob double, banda_risco string")
    quiet, press = spark.createDataFrame([("g", 0.5), ("f", 0.7)], "municipio string, prob double"), spark.createDataFrame([("d", 0.4), ("b", 0.3)], "municipio string, prob double")
    out = {(r["municipio"], r["sinal"]): r for r in period.reinforced(queue, told, quiet, press).collect()}
    assert {k: (r["prioridade"], r["alerta_hibrido"]) for k, r in out.items()} == {
        ("a", "alerta_laboratorial"): ("CRÍTICO", True), ("b", "alerta_laboratorial"): ("CRÍTICO", False), ("d", "alerta_laboratorial"): ("CRÍTICO", False), ("a", "risco_territorial"): ("CRÍTICO", True), ("c", "risco_territorial"): ("MODERADO", False),
        ("f", "silencio_laboratorial"): ("CRÍTICO", True), ("g", "silencio_laboratorial"): ("CRÍTICO", False),
    }
    assert out["a", "alerta_laboratorial"]["motivo"] == "alta | ML confirma (prob=0.6)" and out["d", "alerta_laboratorial"]["motivo"] == "alta | Pressão predita (prob=0.4)"
    watched = queue.limit(1).withColumn("prioridade", F.lit("MONITORAMENTO"))
    assert [r["prioridade"] for r in period.reinforced(watched, pressure=watched.select("municipio", F.lit(0.5).alias("prob"))).collect()] == ["MODERADO"]
