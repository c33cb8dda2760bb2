"""Boosted models: counts, cut-offs and measures against SQL over the written scores; storing, choosing by family, explaining."""

import math
import random

import duckdb
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vigia.operators import models, predict

SCHEMA = "target string, municipio string, familia string, epi_year long, epi_week long, tests long, positividade double, risco_composto double, tests_ma8 double, y_alerta int, y_silencio int, note string"


def rows(seed=5, weeks=20):
    rng = random.Random(seed)
    out = []
    for target, family in (("a", "f1"), ("b", "f1"), ("c", "f2"), ("d", "f3")):
        for town in range(8 if family != "f3" else 1):
            for w in range(weeks):
                tests, risk = rng.randint(0, 9), rng.random() * 4
                y = int(risk > 2 + (family == "f2") and rng.random() < 0.9)
                out.append((target, f"T{town}", family, 2020 + w // 52, w % 52 + 1, tests, rng.choice([None, rng.random()]), risk, None if w < 4 else rng.random(), y, int(tests == 0), "x"))
    return out


@pytest.fixture(scope="module")
def trained(spark):
    return models.train(spark.createDataFrame(rows(), SCHEMA), trees=8)


@pytest.fixture(scope="module")
def duck(trained):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW s AS SELECT * FROM read_parquet('{trained.scores._folder.removeprefix('file://')}/*.parquet')")
    return con


def test_all_rows_take_part_once_in_each_model_that_is_meant_for_them(trained, duck):
    assert {b.tag for b in trained.bundles} == {"risco_global", "risco_f1", "risco_f2", "silencio_global"}
    assert trained.skipped == [("risco", "f3", "amostra insuficiente")]
    # 20 weeks: 16 for training, of which the last 4 calibrate; 25 series
    got = dict(duck.execute("SELECT modelo || '_' || familia_modelo || '_' || fase, count(*) FROM s GROUP BY 1").fetchall())
    assert got == {f"{tag}_{phase}": n * 4 for tag, n in (("risco_global", 25), ("risco_f1", 16), ("risco_f2", 8), ("silencio_global", 25)) for phase in ("calibracao", "teste")}
    assert {b.tag: b.n_train for b in trained.bundles} == {"risco_global": 400, "risco_f1": 256, "risco_f2": 128, "silencio_global": 400}
    assert {b.tag: b.calibrated for b in trained.bundles} == {"risco_global": True, "risco_f1": True, "risco_f2": False, "silencio_global": True}
    assert set(trained.bundles[0].columns) == {"positividade", "risco_composto", "tests", "tests_ma8"} and trained.bundles[0].importance[0][0] == "risco_composto"


_F1 = """SELECT {keys}, t, round(coalesce(2.0 * count(*) FILTER (prob >= t AND y = 1) / nullif(count(*) FILTER (prob >= t) + count(*) FILTER (y = 1), 0), 0), 9) AS f1
FROM s, (SELECT round(0.05 + 0.05 * k, 2)::DOUBLE AS t FROM range(17) x(k)) WHERE fase = 'calibracao' GROUP BY ALL"""


def test_cut_offs_against_sql(trained, duck):
    want = duck.execute(f"SELECT modelo, familia_modelo, arg_max(t, (f1, -t)) FROM ({_F1.format(keys='modelo, familia_modelo')}) GROUP BY 1, 2").fetchall()
    assert {(b.name, b.family): b.threshold for b in trained.bundles} == {(m, f): t for m, f, t in want}


def test_backtest_against_sql(trained, duck):
    got = {(r["modelo"], r["escopo"], r["metodo"]): r for r in models.backtest(trained, 0.3).collect() if r["status"] == "ok"}
    want = duck.execute(f"""WITH g AS (SELECT modelo, familia_modelo, arg_max(t, (f1, -t)) AS t FROM ({_F1.format(keys='modelo, familia_modelo')}) GROUP BY 1, 2), f AS (SELECT modelo, familia, arg_max(t, (f1, -t)) AS t FROM ({_F1.format(keys='modelo, familia_modelo, familia')}) WHERE familia_modelo = 'global' GROUP BY 1, 2),
te AS (SELECT * FROM s WHERE fase = 'teste'),
e AS (SELECT modelo, 'global' AS escopo, 'calibrado' AS metodo, t, y, prob, te.* EXCLUDE (modelo, y, prob) FROM te JOIN g USING (modelo, familia_modelo) WHERE familia_modelo = 'global'
  UNION ALL SELECT modelo, 'global', 'fixo', 0.5::DOUBLE, y, prob, te.* EXCLUDE (modelo, y, prob) FROM te WHERE familia_modelo = 'global' UNION ALL SELECT modelo, 'global', 'operacional', 0.3::DOUBLE, y, prob, te.* EXCLUDE (modelo, y, prob) FROM te WHERE familia_modelo = 'global'
  UNION ALL SELECT modelo, 'modelo:' || familia_modelo, 'calibrado', t, y, prob, te.* EXCLUDE (modelo, y, prob) FROM te JOIN g USING (modelo, familia_modelo) WHERE familia_modelo <> 'global'
  UNION ALL SELECT modelo, 'familia:' || familia, 'calibrado', f.t, y, prob, te.* EXCLUDE (modelo, y, prob) FROM te JOIN f USING (modelo, familia) WHERE familia_modelo = 'global' AND modelo = 'risco' AND familia <> 'f3'),
r AS (SELECT *, rank() OVER (PARTITION BY modelo, escopo, metodo ORDER BY prob) + (count(*) OVER (PARTITION BY modelo, escopo, metodo, prob) - 1) / 2.0 AS rk, row_number() OVER (PARTITION BY modelo, escopo, metodo ORDER BY prob DESC, concat_ws('|', target, municipio, familia, epi_year, epi_week)) AS pl FROM e)
SELECT modelo, escopo, metodo, any_value(t) AS limiar, count(*) AS n, sum(y) AS n_pos, count(*) FILTER (prob >= t AND y = 1) / nullif(count(*) FILTER (prob >= t), 0) AS precision, count(*) FILTER (prob >= t AND y = 1) / nullif(sum(y), 0) AS recall, avg((prob - y) ** 2) AS brier,
  (sum(rk) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / nullif(sum(y) * sum(1 - y), 0) AS auc, avg(y) FILTER (pl <= 20) AS precision_at_k, avg(y) FILTER (pl <= 50) AS precision_at_50, avg(y) AS pos_rate, count(*) FILTER (prob >= t) AS n_alerta_emitido FROM r GROUP BY ALL""").fetchall()
    names = [d[0] for d in duck.description]
    assert len(want) == len(got) == 10
    for row in want:
        r = got[row[:3]]
        for name, v in zip(names[3:], row[3:], strict=True):
            assert (r[name] is None) == (v is None) and (v is None or math.isclose(r[name], v, rel_tol=1e-9, abs_tol=1e-9)), (row[:3], name)
    assert [r["escopo"] for r in models.backtest(trained).where("status != 'ok'").collect()] == ["modelo:f3"]


def test_stored_models_score_alike_in_another_session(spark, trained, tmp_path):
    models.save(trained.bundles, f"file://{tmp_path}/store")
    df = spark.createDataFrame(rows(9, 3), SCHEMA)
    levels = models.RISK_BANDS
    first = models.predicted(df, trained.bundles, "risco", F.lit(0.1), 0.25, levels)
    again = spark.newSession()
    back = models.load(again, f"file://{tmp_path}/store", "risco")
    assert [(b.tag, b.threshold, b.importance) for b in back] == sorted((b.tag, b.threshold, b.importance) for b in trained.bundles if b.name == "risco")[:1] + sorted((b.tag, b.threshold, b.importance) for b in trained.bundles if b.name == "risco")[1:]
    second = models.predicted(again.createDataFrame(rows(9, 3), SCHEMA), back, "risco", F.lit(0.1), 0.25, levels)
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))
    methods = {r["familia"]: r["metodo"] for r in first.collect()}
    assert methods == {"f1": "familia", "f2": "familia", "f3": "global"} and first.columns[: len(df.columns)] == df.columns
    assert first._jdf.queryExecution().executedPlan().toString().count("Scan") == 1 and "Exchange" not in first._jdf.queryExecution().executedPlan().toString()


def test_without_a_model_the_readable_score_stands_in(spark, trained):
    df = spark.createDataFrame(rows(2, 1), SCHEMA)
    got = models.predicted(df, [b for b in trained.bundles if b.family == "f1"], "risco", F.lit(0.6), 0.25, models.RISK_BANDS).collect()
    assert {(r["familia"], r["metodo"]) for r in got} == {("f1", "familia"), ("f2", "logit"), ("f3", "logit")}
    other = next(r for r in got if r["familia"] == "f2")
    assert (other["prob"], other["limiar"], other["acima_limiar"], other["faixa"], other["drivers"]) == (0.6, 0.25, True, "muito_alto", "")


def test_drivers_by_hand(spark):
    df = spark.createDataFrame([(2.0, -5.0, None, 0.0)], "a double, b double, c double, d double")
    weights = F.create_map(*[F.lit(x) for x in ("a", 0.5, "b", 0.3, "c", 0.9)])
    got = df.select(models.spelled(models.drivers(["d", "c", "b", "a"], weights, 3)).alias("s")).first()["s"]
    assert got == "b=-5.000 (imp=0.300); a=2.000 (imp=0.500); d=0.000 (imp=0.000)"


def test_pressure_logit_by_hand(spark):
    df = spark.createDataFrame([(40.0, 0.5, 3.0), (None, None, None)], "indice_pressao_proxy double, tests_pct_estadual double, tests_trend double")
    got = [r["prob"] for r in models.pressure_logit(df).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(1.8 - 1.0 - 0.4 - 0.35 * math.tanh(0.3))), 1 / (1 + math.exp(1.8))])


def test_too_few_rows_give_no_model(spark):
    found = models.train(spark.createDataFrame(rows(1, 2), SCHEMA), trees=2)
    assert found.bundles == [] and found.scores.count() == 0
    assert sorted(r["status"] for r in models.backtest(found).collect()) == ["sem modelo: amostra insuficiente"] * 3 + ["sem modelo: pouca variabilidade ou amostra"] * 2
    assert predict.THRESHOLDS[0] == 0.05 and predict.THRESHOLDS[-1] == 0.85 and isinstance(SparkSession.active(), SparkSession)
