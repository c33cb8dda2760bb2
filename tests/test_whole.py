"""Queries that take every row: text keys, alert history, silence; the model's back-test."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from vigia.functions import text
from vigia.operators import history, models, territory
from vigia.plans import QUERIES, bindings
from vigia.sources.stages import path_of


def test_text_keys_of_every_language(spark):
    """By plain Python."""
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r["doc_id"]: (r["chave"], r["slug"]) for r in QUERIES["text_keys"](spark, SMALL).collect()}
    assert len(got) == len(docs) and {"en", "es", "fr", "de"} <= {r["lang"] for r in docs.values()}
    table, digest = str.maketrans(text.ACCENTED, text.PLAIN), lambda s: hashlib.md5(s.encode()).hexdigest()
    for i, r in docs.items():
        low = (r["text"] or "").lower().translate(table)
        assert got[i] == (digest(re.sub(r"[ \t\n\x0b\f\r]+", " ", low).strip(" ").strip(" :;-_")), digest(re.sub("[^a-z0-9]+", "_", low).strip("_")))


def test_alert_history_of_every_year(spark):
    got = QUERIES["alert_history"](spark, SMALL).collect()
    years = {r["epi_year"] for r in QUERIES["positivity_weekly"](spark, SMALL).select("epi_year").distinct().collect()}
    assert len(years) > 5 and {r["epi_year"] for r in got} == years
    assert {(r["tipo"], r["data_emissao"]) for r in got} >= {("risco", 1), ("risco", 2)}


def test_outcomes_across_the_turn_of_a_year(spark):
    alerts = [("risco", "a", "x", 1998, 52, 1, 0.9), ("risco", "a", "x", 1998, 53, 1, 0.9), ("silencio", "a", "x", 1998, 53, 1, 0.9), ("risco", "a", "x", 1999, 1, 1, 0.9)]
    issued = spark.createDataFrame(alerts, "tipo string, municipio string, target string, epi_year long, epi_week long, data_emissao int, prob double")
    weekly = spark.createDataFrame([("a", "x", 1998, 53, 3, 0), ("a", "x", 1999, 1, 0, 0), ("a", "x", 1999, 2, 5, 2)], "municipio string, target string, epi_year long, epi_week long, tests long, positives long")
    got = {(r["tipo"], r["epi_year"], r["epi_week"]): (r["semanas_vistas"], r["confirmado"]) for r in history.with_outcomes(issued, weekly, {"risco": 2, "silencio": 1}).collect()}
    assert got == {("risco", 1998, 52): (2, False), ("risco", 1998, 53): (2, True), ("silencio", 1998, 53): (1, True), ("risco", 1999, 1): (1, True)}


def test_a_task_takes_the_same_share_of_a_table_of_any_size(spark, monkeypatch):
    """Exams are dealt over tasks in proportion to their bytes, not over a fixed number, with the same results."""
    named = ["positivity_weekly", "divergence", "case_consolidation"]
    rows = lambda: {n: sorted(map(str, QUERIES[n](spark, SMALL).collect())) for n in named}
    assert bindings.tasks_for(spark, SMALL, "lineitem") == 0  # a small table is left to Spark
    want, (fs, at) = rows(), path_of(spark, f"{SMALL}/lineitem.parquet")
    monkeypatch.setattr(bindings, "SMALL_BYTES", 0)
    for share in (10_000, 5_000):
        monkeypatch.setattr(bindings, "TASK_BYTES", share)
        assert bindings.exams(spark, SMALL).rdd.getNumPartitions() == -(-fs.getFileStatus(at).getLen() // share) > 8
    assert rows() == want


#: Queries of F6 to F22, which share the step that deals the lines.
SHARED = ["positivity_weekly", "statewide", "alerts_in_context", "annual_top_targets", "composite_risk", "composite_risk_v1", "data_confidence", "early_alerts", "executive_summary",
          "forecast_ewma", "harmonised", "harmonised_annual", "lagged_association", "lagged_climate", "operational_queue", "period_history", "period_last_year"]


@pytest.mark.parametrize("name", SHARED)
def test_lines_of_each_query_are_dealt_by_their_bytes(spark, monkeypatch, name):
    """In each query, parts and orders meet the lines over tasks in proportion to the stored bytes."""
    seen, deal, share = [], bindings.dealt, 12_000
    lines = -(-bindings.stored_bytes(spark, SMALL, "lineitem") // share)
    monkeypatch.setattr(bindings, "SMALL_BYTES", 0)
    monkeypatch.setattr(bindings, "TASK_BYTES", share)
    monkeypatch.setattr(bindings, "dealt", lambda df, tasks, *keys: seen.append((keys, tasks)) or deal(df, tasks, *keys))
    QUERIES[name](spark, SMALL)
    assert lines > spark.sparkContext.defaultParallelism
    asked = {k[0]: n for k, n in seen}
    assert asked["l_orderkey"] == asked["o_orderkey"] == lines and asked["l_partkey"] == asked["p_partkey"] == (lines + 1) // 2


def test_silence_counts_every_test_of_a_town(spark):
    whole = {r["municipio"]: r for r in QUERIES["silence"](spark, SMALL).collect()}
    sums = {r["municipio"]: r["n"] for r in QUERIES["positivity_weekly"](spark, SMALL).groupBy("municipio").agg(F.sum("tests").alias("n")).collect()}
    assert {m: r["tests_hist"] for m, r in whole.items()} == {m: sums.get(m, 0) for m in whole}


def test_silent_towns(spark):
    towns = spark.createDataFrame([("a", 0.5, 6000), ("b", 0.0, 12000), ("c", 0.0, 3500), ("d", 0.0, 500), ("e", 0.0, 500)], "municipio string, indice_vulnerabilidade double, populacao long")
    weekly = spark.createDataFrame([("z", "x", 2000, w, 1, 0) for w in range(11, 19)] + [("a", "x", 2000, 2, 4, 0), ("d", "x", 2000, 18, 0, 7), ("e", "x", 2000, 18, 1, 9)], "municipio string, target string, epi_year long, epi_week long, tests long, notificacoes long")
    got = {r["municipio"]: (r["tests_recent"], r["tests_hist"], r["classificacao_silencio"]) for r in territory.silence(towns, weekly).collect()}
    assert got == {"a": (0, 4, "silencio_critico"), "b": (0, 0, "silencio_provavel"), "c": (0, 0, "silencio_moderado"), "d": (0, 0, "silencio_critico"), "e": (1, 1, "baixo_uso")}


def test_back_test_weeks_are_held_out(spark, monkeypatch):
    """No fit sees a week that is measured, all have the trees of the operator, and families and cut-offs are there."""
    fitted, kept, fit, measure = [], [], models._fit, models.backtest

    def spy(rows, task, family, calibrate, trees):
        fitted.append((rows.agg(F.max(F.col("epi_year") * 100 + F.col("epi_week"))).first()[0], trees))
        return fit(rows, task, family, calibrate, 3)

    monkeypatch.setattr(models, "_fit", spy)
    monkeypatch.setattr(models, "backtest", lambda trained, *a: kept.append(trained) or measure(trained, *a))
    got = QUERIES["gradient_boosting"](spark, SMALL).collect()
    first = kept[0].scores.where("fase = 'teste'").agg(F.min(F.col("epi_year") * 100 + F.col("epi_week"))).first()[0]
    assert len(fitted) > 1 and all(last < first and trees == 80 for last, trees in fitted)
    assert {r["metodo"] for r in got if r["escopo"] == "global" and r["status"] == "ok"} == {"calibrado", "fixo", "operacional"}
    assert any(r["escopo"].startswith("familia:") for r in got) and any(r["escopo"].startswith("modelo:") for r in got)
    assert kept[0].bundles[0].columns == models.RISK  # all 22
