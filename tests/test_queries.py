"""Every registered query of the surveillance library against its SQL on the smallest tables; forecasts against loops."""

import datetime
import math
from statistics import median

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tests.conftest import SMALL
from vigia.operators import aggregates, history, panel, predict, territory
from vigia.plans import QUERIES, SQL
from vigia.plans import bindings as b
from vigia.streaming import weekly

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)[:10]
    return round(float(v), 5) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    got = QUERIES[name](spark, SMALL)
    columns = sorted(got.columns)
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    rows = want.fetchall()
    key = lambda r: tuple((v is None, str(v)) for v in r)
    a = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=key)
    e = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in rows), key=key)
    assert a == e


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(spark, name):
    """They run and have rows, but for alerts, of which so few exams may give none."""
    assert QUERIES[name](spark, SMALL).count() >= (0 if name in ("alerts_in_context", "manager_messages") else 1)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(SQL) <= set(__spark_entry__.queries())


def test_seasonal_forecast_by_loop(spark):
    series = {"a": [(2020, w, (w * 7) % 13 + 1) for w in range(1, 53, 3)] + [(2021, w, w % 5 + 2) for w in range(1, 53, 2)], "b": [(2021, 53, 4)]}
    weekly = spark.createDataFrame([(t, y, w, n) for t, rows in series.items() for y, w, n in rows], "target string, epi_year long, epi_week long, tests long")
    got = {(r["target"], r["forecast_step"]): r for r in predict.forecast_seasonal(weekly, 5).collect()}
    for t, rows in series.items():
        seen = [(w, float(n)) for _, w, n in rows]
        y, w = rows[-1][:2]
        for step in range(1, 6):
            w += 1
            if w > 53:
                y, w = y + 1, 1
            same, near = [v for k, v in seen if k == w], median([v for _, v in seen[-4:]])
            pred = 0.6 * near + 0.4 * median(same) if same else near
            r = got[t, step]
            assert (r["forecast_epi_year"], r["forecast_epi_week"]) == (y, w) and abs(r["forecast_tests"] - pred) < 1e-9
            seen.append((w, pred))


def test_statewide_forecast_by_loop(spark):
    """Gaps, unknown rates, a short series; each step counts in the steps after it."""
    rows = [("a", "t", 2020 + i // 53, i % 53 + 1, (i * 7) % 13, (i * 7) % 13 // 2, i % 3, 0, 1000 + i) for i in range(40, 70, 2)] + [("b", "t", 2020, w, 3, 1, 0, 0, None) for w in range(1, 13)] + [("c", "t", 2020, w, 3, 1, 0, 0, 9) for w in range(1, 12)]
    frame = spark.createDataFrame(rows, "target string, municipio string, epi_year long, epi_week long, tests long, positives long, notificacoes long, obitos long, populacao long")
    got = {(r["target"], r["forecast_step"]): r for r in predict.forecast_statewide(frame).collect()}
    assert {t for t, _ in got} == {"a", "b"}
    of = {
        "tests": lambda r: float(r[4]), "positividade": lambda r: r[5] / r[4] if r[4] else None, "incidencia_100k": lambda r: r[5] / r[8] * 1e5 if r[8] else None,
        "notificacoes_100k": lambda r: r[6] / r[8] * 1e5 if r[8] else None, "mortalidade_100k": lambda r: r[7] / r[8] * 1e5 if r[8] else None,
    }
    for t in ("a", "b"):
        mine = [r for r in rows if r[0] == t]
        for c, f in of.items():
            seen, (y, w) = [(r[3], f(r)) for r in mine], mine[-1][2:4]
            near = [f(r) for r in mine][-8:]
            for step in range(1, 5):
                y, w = (y, w + 1) if w < 53 else (y + 1, 1)
                same, last = [v for k, v in seen if k == w and v is not None], [v for v in near if v is not None]
                want = (0.4 * median(same) + 0.6 * median(last)) if same and last else median(same) if same else median(last) if last else None
                r = got[t, step]
                assert (r["forecast_epi_year"], r["forecast_epi_week"]) == (y, w)
                assert (r[f"forecast_{c}"] is None) == (want is None) and (want is None or abs(r[f"forecast_{c}"] - want) < 1e-6), (t, c, step)
                seen.append((w, want))
                near.append(want)


def test_a_constant_has_no_rank_correlation(spark):
    rows = [("x", float(i), 1.0, float(i * i), None, 0.0, float(-i)) for i in range(25)]
    frame = spark.createDataFrame(rows, "target string, rain double, tests double, positividade double, incidencia_100k double, notificacoes_100k double, mortalidade_100k double")
    (r,) = predict.climate_association(frame, ["rain"]).collect()
    assert (r["n_obs"], r["spearman_tests"], r["spearman_incidencia_100k"], r["spearman_notificacoes_100k"]) == (25, None, None, None)
    assert abs(r["spearman_positividade"] - 1) < 1e-9 and abs(r["spearman_mortalidade_100k"] + 1) < 1e-9


def test_cases_of_a_surveillance_table(spark):
    """Filters, respelling, equal evidence once, texts in the order seen, the commonest disease, null keys."""
    names = "record_id long, field_index long, requisicao string, codigo_amostra string, event_date string, municipio string, target string, agravo string, exame string, metodologia string, field_label string, field_value string, field_has_real_value boolean, is_released boolean, is_positive_like boolean, measure_role string"
    row = lambda i, f, sample="s1", target="dengue", agravo="DENGUE", exame="Dengue, NS1", method="Teste", value="Reagente", real=True, out=True, pos=True, role="qualitative_result", town="A": (i, f, "r1", sample, "2024-12-30", town, target, agravo, exame, method, "Resultado", value, real, out, pos, role)
    rows = [
        row(1, 2), row(1, 1, exame="Dengue, IgM", agravo="ZIKA"), row(1, 3), row(1, 4, exame="Dengue, IgM", value="Detectável"), row(2, 1, sample="s2", exame="Dengue, IgG"),
        row(3, 1, real=False), row(3, 2, out=False), row(3, 3, pos=False), row(3, 4, role="observation"), row(3, 5, target="covid"), row(4, 1, sample=None, town=None, method="IgM", exame=" "), row(5, 1, sample=None, town=None, method="IgM", exame=" "),
    ]
    positives = aggregates.arboviral_positives(spark.createDataFrame(rows, names).withColumn("event_date", F.col("event_date").cast("date")))
    got = {r["codigo_amostra"]: r for r in aggregates.cases(aggregates.evidence(positives, False)).collect()}
    assert set(got) == {"s1", "s2", None}
    s1, s2, none = got["s1"], got["s2"], got[None]
    assert s1["agravo"] == "DENGUE" and s1["exames"] == "Dengue, IgM | Dengue, NS1" and s1["evidencias"] == "Reagente | Detectável" and s1["n_evidencias"] == 3
    assert (s1["tipo_caso"], s2["tipo_caso"], none["tipo_caso"]) == ("confirmatorio_agudo", "exposicao_previa", "provavel_agudo")
    assert (s1["ano"], s1["mes"], s1["epi_year"], s1["epi_week"], none["n_evidencias"], none["exames"]) == (2024, 12, 2025, 1, 1, "")
    counts = {r["dataset"]: r["linhas"] for r in aggregates.case_control(positives).collect()}
    assert counts == {"todos_filtrado": 5, "todos_casos": 3, "agudos_filtrado": 4, "agudos_casos": 2}
    sums = {(r["resumo"], r["municipio"], r["casos_positivos"]) for r in aggregates.case_summary(aggregates.cases(aggregates.evidence(positives))).collect()}
    assert sums == {("ano", None, 2), ("semana_municipio", "A", 1), ("semana_municipio", None, 1)}
    assert aggregates.cases(aggregates.evidence(positives.limit(0))).count() == 0


def test_early_alerts_by_loop(spark):
    weekly = aggregates.weekly(b.exams(spark, SMALL)).withColumn("positividade", F.when(F.col("tests") >= 2, F.col("positives") / F.col("tests")))
    got = [r.asDict() for r in panel.early_alerts(weekly, 2).collect()]
    by = {}
    for r in sorted(got, key=lambda r: (r["target"], r["municipio"], r["epi_year"], r["epi_week"])):
        by.setdefault((r["target"], r["municipio"]), []).append(r)

    def top(values):
        if not values:
            return None
        m = sum(values) / len(values)
        return m + 2 * (math.sqrt(sum((v - m) ** 2 for v in values) / (len(values) - 1)) if len(values) > 1 else 0.0)

    for rows in by.values():
        for i, r in enumerate(rows):
            before = rows[:i]
            for column, name in (("tests", "volume_threshold"), ("positividade", "positivity_threshold")):
                past = [x[column] for x in before if x[column] is not None]
                cuts = [c for c in (top([x[column] for x in before if x["epi_week"] == r["epi_week"] and x[column] is not None]), top(past[-8:])) if c is not None]
                want = max(cuts) if cuts else None
                assert (r[name] is None) == (want is None) and (want is None or abs(r[name] - want) < 1e-9)


def test_neighbours_by_all_pairs(spark):
    rows = [(f"t{i}", -7.5 - (i * 37 % 100) / 10, -50.5 - (i * 53 % 110) / 10) for i in range(80)]
    points = spark.createDataFrame(rows, "municipio string, latitude double, longitude double")
    got = {(r["municipio"], r["rank_vizinho"]): r["vizinho"] for r in territory.neighbours(points).collect()}

    def km(a, c):
        h = math.sin(math.radians(c[1] - a[1]) / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(c[1])) * math.sin(math.radians(c[2] - a[2]) / 2) ** 2
        return 2 * 6371 * math.asin(math.sqrt(h))

    want = {}
    for a in rows:
        near = sorted((km(a, c), c[0]) for c in rows if c[0] != a[0])
        want |= {(a[0], k): n for k, (d, n) in enumerate(near[:6], 1) if d <= 120}
    assert got == want


def test_upsert_keeps_the_last(spark):
    old = spark.createDataFrame([("a", 1, 0.5), ("b", 1, 0.7)], "k string, data_emissao int, prob double")
    new = spark.createDataFrame([("a", 2, 0.1), ("c", 2, 0.9)], "k string, data_emissao int, prob double")
    assert {tuple(r) for r in history.upsert(old, new, ["k"]).collect()} == {("a", 2, 0.1), ("b", 1, 0.7), ("c", 2, 0.9)}


def test_positives_do_not_exceed_tests(spark):
    bad = QUERIES["positivity_weekly"](spark, SMALL).where("positives > tests or ci_low > positividade + 1e-6 or ci_high < positividade - 1e-6 or ci_low < 0 or ci_high > 1")
    assert bad.count() == 0


def test_upserts_go_on_after_a_restart(spark, tmp_path):
    def arrive(name, rows):
        frame = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        out = weekly.run_upserts(spark, str(tmp_path / "in"), ["user_id"], "ts", home=str(tmp_path / "home"))
        return {(r["user_id"], r["value"]) for r in out.collect()}

    arrive("a", [(1, "2024-01-01 00:00:00", 1, "x", 0.5, None), (2, "2024-01-01 00:00:00", 2, "x", 0.7, None)])
    assert run() == {(1, 0.5), (2, 0.7)}
    arrive("b", [(3, "2024-01-02 00:00:00", 1, "x", 0.1, None), (4, "2023-12-31 00:00:00", 2, "x", 0.2, None)])
    assert run() == {(1, 0.1), (2, 0.7)}
    assert run() == {(1, 0.1), (2, 0.7)}


def test_service_levels_of_a_surveillance_table(spark):
    rows = [
        ("A", "2024-01-01", "2024-01-03", "2024-01-04", "negative", "liberado", False),
        ("A", "2024-01-01", None, "2024-01-11", "negative", "liberado", None),
        ("A", None, "2024-01-05", "2024-01-10", "inconclusive", "pendente", True),
        ("B", "2024-01-05", None, "2024-01-04", "negative", "pendente", True),
    ]
    exams = spark.createDataFrame(rows, "municipio string, coleta string, recebimento string, liberacao string, outcome string, status string, rejeitado boolean")
    dated = exams.select("*", F.col("coleta").cast("date").alias("dt_coleta"), F.col("recebimento").cast("date").alias("dt_recebimento"), F.col("liberacao").cast("date").alias("event_date"))
    got = {r["municipio"]: r for r in aggregates.network(aggregates.turnaround(dated), ["municipio"]).collect()}
    a, b = got["A"], got["B"]
    assert (a["tat_mediano_dias"], a["tat_lab_mediano_dias"], a["logistica_mediana_dias"]) == (5.0, 3.0, 2.0)
    assert (a["pct_liberado_48h"], a["pct_liberado_48h_coleta"], a["backlog_estimado"]) == (0.5, 0.0, 1)
    assert abs(a["pct_rejeitado"] - 1 / 3) < 1e-9 and b["pct_rejeitado"] == 1.0
    assert (b["tat_mediano_dias"], b["pct_liberado_48h"], b["logistica_mediana_dias"]) == (None, None, None)
