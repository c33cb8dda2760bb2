"""Scans that keep what they can't read, parts that are merged, joins that choose their key, ranks in ranges."""

import collections
import random

import pytest

from pyspark.sql import functions as F

from vigia.functions import rules
from vigia.operators import aggregates, emergency, normalise, panel, partial, predict, ranks
from vigia.sources import tables


@pytest.mark.parametrize(
    ("head", "form"),
    [
        ("a;b;c\n1;2,5;3\n", ("UTF-8", ";")), ("a,b\n1,2\n3,4\n", ("UTF-8", ",")), ("a\tb\n", ("UTF-8", "\t")), ("a|b|c\n1|2|3", ("UTF-8", "|")),
        ("município;n\nCuiabá;1\n".encode("latin-1"), ("ISO-8859-1", ";")), (b"\xef\xbb\xbfa;b\n", ("UTF-8", ";")), ("é".encode()[:1], ("UTF-8", ";")), ("", ("UTF-8", ";")), ("one column\nx, y\n", ("UTF-8", ";")),
    ],
)
def test_encoding_and_separator(head, form):
    assert tables.text_form(head if isinstance(head, bytes) else head.encode()) == form


def test_good_lines_and_quarantine_are_all_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('nome;n\nCuiabá;1\nsó um\n"a;b";2\nx;y;z\n;\nfim;3'.encode("latin-1"))
    found = tables.scan_checked(spark, f"file://{tmp_path}/a.csv", ["nome", "n"])
    assert sorted((r["nome"], r["n"]) for r in found.rows.where("n is not null").collect()) == [("Cuiabá", "1"), ("a;b", "2"), ("fim", "3")]
    assert sorted(r["line"] for r in found.quarantine.collect()) == ["só um", "x;y;z"] and all(r["file"].endswith("a.csv") for r in found.quarantine.collect())
    assert found.counts == {"lines": 6, "quarantined": 2, "rows": 4}


def test_the_encoding_is_that_of_all_files(spark, tmp_path):
    """a first file of a header alone, and letters that come late, tell nothing by their first bytes."""
    files = {"part-0.csv": "nome;n\n", "part-1.csv": "nome;n\n" + "a,b;1\n" * 20_000 + "São;2\n"}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content.encode("latin-1"))
    found = tables.scan_checked(spark, f"file://{tmp_path}", ["nome", "n"])
    assert found.rows.where("nome = 'São'").count() == 1 and found.counts == {"lines": 20_001, "quarantined": 0, "rows": 20_001}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content.encode())
    assert tables.form_of(spark, f"file://{tmp_path}") == ("UTF-8", ";") and tables.form_of(spark, f"file://{tmp_path}/part-0.csv") == ("UTF-8", ";")
    (tmp_path / "part-1.csv").write_bytes(b"")
    assert tables.form_of(spark, f"file://{tmp_path}") == ("UTF-8", ";")


def test_a_file_taken_twice_counts_once(spark, tmp_path):
    files = {"a": [(k % 40, "positive") for k in range(100)], "b": [(k, "negative") for k in range(30, 60)]}
    for name in ("a", "b", "a"):
        rows = spark.createDataFrame([("x", k, o) for k, o in files[name]], "g string, record_id long, outcome string")
        partial.append(partial.partial(rows, ["g"]), str(tmp_path / "store"), name)
    r = partial.merged(spark, str(tmp_path / "store"), ["g"]).first()
    assert (r["exames"], r["positives"], r["negatives"], r["arquivos"]) == (130, 100, 30, 2) and abs(r["registros_estimados"] - 60) <= 1


@pytest.mark.parametrize(("hits", "rows", "way"), [(5, 50, "codigo"), (4, 10, "nome"), (5, 51, "nome"), (0, 3, "nome")])
def test_join_by_code_needs_five_hits_and_a_tenth(spark, hits, rows, way):
    left = spark.createDataFrame([(k if k < hits else 1000 + k, f"t{k}", "x") for k in range(rows)], "code long, name string, value string")
    right = spark.createDataFrame([(k, f"t{k + 1}", 10 * k) for k in range(10)] + [(None, "t0", 5), (3, "t4", 7)], "code long, name string, v long")
    got = {r["name"]: (r["v"], r["juncao"]) for r in normalise.gated_join(left, right, "code", "name").collect()}
    by_code = {f"t{k}": min(10 * k, 7 if k == 3 else 10 * k) for k in range(min(hits, 10))}
    by_name = {"t0": 5} | {f"t{k + 1}": 10 * k for k in range(10)} | {"t4": 7}
    want = by_code if way == "codigo" else by_name
    assert got == {f"t{k}": (want.get(f"t{k}"), way) for k in range(rows)}


def test_ranks_by_plain_python(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 0.0, 0.5, rng.random()])) for _ in range(500)] + [("c", 1.0)] * 50
    got = {(r["k"], r["v"]): (r["n"], r["n_before"], r["avg_rank"]) for r in ranks.value_ranks(spark.createDataFrame(rows, "k string, v double").repartition(5), ["k"], "v").collect()}
    counts = collections.Counter(rows)
    order = lambda v: (v is not None, v or 0.0)
    assert got == {(k, v): (n, before := sum(m for (k2, w), m in counts.items() if k2 == k and order(w) < order(v)), before + (n + 1) / 2) for (k, v), n in counts.items()}


def test_rank_correlation_by_plain_python(spark):
    rng = random.Random(4)
    rows = [(g, float(rng.randint(0, 5)), rng.choice([None, float(rng.randint(0, 9))])) for g in "ab" for _ in range(80)] + [("c", 1.0, float(k)) for k in range(30)]

    def average(values):
        return {v: sum(w < v for w in values) + (sum(w == v for w in values) + 1) / 2 for v in set(values)}

    got = {r["k"]: (r["n"], r["rho"]) for r in predict.rank_correlation(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], 12).collect()}
    for g in "ab":
        known = [(x, y) for k, x, y in rows if k == g and y is not None]
        rx, ry = average([x for x, _ in known]), average([y for _, y in known])
        a, b = [rx[x] - (len(known) + 1) / 2 for x, _ in known], [ry[y] - (len(known) + 1) / 2 for _, y in known]
        rho = sum(p * q for p, q in zip(a, b, strict=True)) / (sum(p * p for p in a) * sum(q * q for q in b)) ** 0.5
        assert got[g][0] == len(known) and got[g][1] == pytest.approx(rho)
    assert got["c"] == (30, None)
    plan = predict.rank_correlation(spark.createDataFrame(rows, "k string, x double, y double"), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(k#" not in plan or "_range" in plan


def test_metrics_have_no_window_over_a_key(spark):
    rows = spark.createDataFrame([("a", str(i), i % 2, i / 50) for i in range(50)], "k string, id string, y int, prob double")
    found = predict.metrics(rows, ["k"], 0.5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # of the highest scores each task keeps fifty before they meet
    r = found.first()
    assert (r["n"], r["n_pos"], r["n_alerta_emitido"]) == (50, 25, 25) and r["precision_at_k"] == 0.5


def test_a_source_without_dates_counts_at_mid_year(spark):
    rows = [("2001-03-04", 2001), (None, 2002), (None, 2003), (None, None)]
    df = spark.createDataFrame(rows, "d string, ano long").withColumn("event_date", F.col("d").cast("date"))
    dated = lambda frame: sorted(str(r["event_date"]) for r in aggregates.with_fallback_date(frame).collect())
    assert dated(df) == ["2001-07-01", "2002-07-01", "2003-07-01"]
    assert dated(df.limit(2)) == ["2001-03-04"]  # a half is not more than a half


def test_panel_under_other_names(spark):
    rows = [("5103403 - Cuiabá", "dengue", 2024.0, "7", 10, 4, 80.0), ("x", "dengue", 2024.0, "54", 0, 0, None)]
    got = {r["municipio"]: r for r in panel.harmonise(spark.createDataFrame(rows, "mun string, alvo string, ano double, semana string, testes long, positivos long, taxa_positividade double")).collect()}
    a, x = got["CUIABA"], got["X"]
    assert (a["epi_year"], a["epi_week"], a["tests"], a["positividade"], a["periodo"], str(a["periodo_data"])) == (2024, 7, 10.0, 0.8, "2024-SE07", "2024-02-12")
    assert x["periodo_data"] is None and x["positividade"] is None and x["notificacoes"] == 0.0 and x["incidencia_100k"] is None
    assert a["risco_composto"] == pytest.approx((0.6745 * (10 - 5) / 5) / 3) and x["risco_composto"] == pytest.approx(-(0.6745 * 5 / 5) / 3)
    year = panel.harmonise_annual(spark.createDataFrame([("zika", "2020", "8", "2")], "agravo string, year string, tests string, positives string")).first()
    assert tuple(year) == ("zika", 2020, 8.0, 2.0, 0.0, 0.0, 0.25, None, None)


def test_protocols_of_a_table_of_ones_own(spark):
    table = [(p[0], "quem", "quando", f"o que: {p[0]}", "lista") for p in rules.PROTOCOLS]
    rows = spark.createDataFrame([("a", True, True, "risco"), ("b", False, True, "silencio"), ("c", False, False, "padrao"), ("d", True, False, "risco")], "municipio string, sla_crise boolean, silencio_gal_alerta boolean, sinal string")
    got = {r["municipio"]: (r["protocolo"], r["acao_sugerida"], r["prazo_acao"], r["checklist_operacional"]) for r in emergency.protocolled(rows, table).collect()}
    assert got == {"a": ("emergencia", rules.SILENCE_ACTION, "quando", rules.CRISIS_ACTION[1]), "b": ("silencio", rules.SILENCE_ACTION, "quando", "lista"), "c": ("padrao", "o que: padrao", "quando", "lista"), "d": ("emergencia", rules.CRISIS_ACTION[0], "24–48h", rules.CRISIS_ACTION[1])}


def test_family_crisis_without_any_known_share(spark):
    df = spark.createDataFrame([("a", None, 10.0), ("b", None, 90.0), ("c", None, None)], "familia string, pct_liberado_48h double, tat_p90_dias double")
    assert {r["familia"]: r["sla_crise"] for r in emergency.family_crisis(df).collect()} == {"a": False, "b": True, "c": False}
    assert [r["sla_crise"] for r in emergency.family_crisis(df.where("familia = 'c'")).collect()] == [False]
