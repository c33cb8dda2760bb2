"""Scalar operators on rows made by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from vigia.functions import measures, rules, text, weeks
from vigia.operators import normalise
from vigia.sources import tables


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (text.norm_town, "5103403 - Cuiabá", "CUIABA"), (text.norm_town, "Município de  Sinop", "SINOP"), (text.normalize_key, "  Não Reagente: ", "nao reagente"), (text.slug, "Hepatite B (HBsAg)", "hepatite_b_hbsag"),
        (text.strip_html, "<b>a&amp;b</b>  <i>c</i>", "a&b c"), (text.fix_mojibake, "NÃ£o", "Não"), (text.decimal_br, "1.234,56", 1234.56), (lambda c: text.decimal_br(c, True), "1.234,56", 0.123456),
        (text.date_of, "20240229", datetime.date(2024, 2, 29)), (text.date_of, "31/12/2023", datetime.date(2023, 12, 31)), (text.date_of, "2024-05-06 10:00", datetime.date(2024, 5, 6)), (text.date_of, "30/02/2024", None), (text.date_of, "19890101", None),
        (text.field_label, "CT: 31,2", "CT"), (text.field_value, "CT: 31,2", "31,2"), (text.field_label, "Presente", "Presente"), (text.field_value, "Presente", ""), (text.exam_status, "Exame Liberado", "liberado"), (text.exam_status, None, "status_ausente"),
        (text.sex, "feminino", "FEMININO"), (text.race, "Indígena", "INDIGENA"), (rules.bridge, "hepatite_b_hbv", "hepatite"), (rules.bridge, "mtb", ""), (rules.family, "lf_lam", "tuberculose"), (rules.target_of_text, "Febre amarela", "febre_amarela"),
        (text.strip_html_full, "caf&eacute; &#233; <br>ﬁm", "café é fim"), (text.join_town, "Poxoréu", "POXOREO"), (text.network_status, "Amostra rejeitada", "rejeitado"),
    ],
)
def test_text(spark, f, given, want):
    assert one(spark, f(F.col("v")), v=given) == want if given is not None else one(spark, f(F.lit(None).cast("string"))) == want


@pytest.mark.parametrize(
    ("value", "target", "want"),
    [("Não Reagente", "dengue", "negative"), ("Detectável", "zika", "positive"), ("Resistente", "rifampicina", "resistant"), ("Sensível", "rifampicina", "susceptible"), ("Traços", "mtb", "trace"), ("", "hiv", "empty"), ("1,5", "hiv", "numeric"), ("Em processamento", "hiv", "pending"), ("Amostra contaminada", "hiv", "inconclusive"), ("azul", "hiv", "other_text")],
)
def test_outcome(spark, value, target, want):
    assert one(spark, rules.outcome(F.col("v"), F.col("t")), v=value, t=target) == want


@pytest.mark.parametrize(("label", "value", "want"), [("Dengue IgM", "Reagente", "qualitative_result"), ("CT", "31", "analytic_metric"), ("Valor", "1,5", "analytic_metric"), ("Carga viral", "300", "quantitative_result"), ("Cotovelo direito", "+", "site_result"), ("Presente", "", "empty_field"), ("Detectável", "", "analytic_metric")])
def test_role(spark, label, value, want):
    assert one(spark, rules.measure_role(F.col("a"), F.col("b")), a=label, b=value) == want


def test_weeks(spark):
    d = F.lit("2021-01-03").cast("date")
    assert (one(spark, weeks.epi_year(d)), one(spark, weeks.epi_week(d))) == (2020, 53)
    y, w = weeks.advance(F.lit(2026), F.lit(53), 1)
    assert (one(spark, y), one(spark, w)) == (2027, 1)
    assert one(spark, weeks.monday(F.lit(2021), F.lit(1))) == datetime.date(2021, 1, 4)
    assert one(spark, weeks.monday(F.lit(2021), F.lit(53))) is None
    assert one(spark, weeks.week_label(F.lit(2024), F.lit(7))) == "2024-SE07"


def test_intervals(spark):
    none = measures.wilson(F.lit(0), F.lit(0))
    assert one(spark, none[0]) is None and one(spark, none[1]) is None
    over, all_ = measures.wilson(F.lit(5), F.lit(3)), measures.wilson(F.lit(3), F.lit(3))
    assert one(spark, over[0]) == one(spark, all_[0]) and one(spark, over[1]) == 1.0
    low, high = measures.poisson(F.lit(0), F.lit(1000))
    assert one(spark, low) == 0.0 and abs(one(spark, high) - 196.0) < 1e-9
    assert one(spark, measures.bins(F.lit(2.0), measures.RISK_CUTS, measures.RISK_LEVELS)) == "atencao"
    assert abs(one(spark, measures.haversine_km(F.lit(-15.6), F.lit(-56.1), F.lit(-15.65), F.lit(-56.13))) - 6.42) < 0.05


def test_column_names():
    names = ["Município", "CODIGO IBGE", "População 2020", "Data da Coleta"]
    assert tables.find_column(names, ["municipio"]) == "Município"
    assert tables.find_column(names, any_of=["data"], all_of=["coleta"]) == "Data da Coleta"
    assert tables.find_column(names, any_of=["data"], none_of=["coleta"]) is None


def test_resolve_and_scan(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;dois\n3;quatro\n", encoding="utf-8")
    read = tables.scan_table(spark, f"file://{tmp_path}/a", ["x", "y"])
    out = tables.resolve(read, {"Y": [], "z": ["nada"], "primeiro": ["X"]})
    assert [tuple(r) for r in out.orderBy("primeiro").collect()] == [("dois", None, "1"), ("quatro", None, "3")]
    tables.write(read, f"file://{tmp_path}/b.parquet", by=["x"])
    assert tables.scan_table(spark, f"file://{tmp_path}/b").count() == 2
    seen, counts = tables.counted(read, "contagem", grandes=F.col("x") > 2)
    seen.collect()
    assert counts.get == {"rows": 2, "grandes": 1}


def test_long_results(spark):
    rows = [("1", "Exame Liberado", "05/01/2021", "5103403 - Cuiabá", "Dengue IgM: Não Reagente", "CT: 31,2", "Rifampicina: Resistente", "Valor: 1,5", None, "", "visto: traços"), (None, None, None, None, "x: y", None, None, None, None, None, None)]
    columns = ["Sequencial", "Status_Exame", "Data_Coleta_dt", "Municipio_Solicitante", *normalise.FIELDS, "Observacao_Resultado"]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    got = {r["field_index"]: r for r in normalise.long_results(raw).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7]
    assert (got[1]["target"], got[1]["outcome_class"], got[1]["is_negative_like"], got[1]["epi_week"]) == ("dengue", "negative", True, 1)
    assert (got[2]["target"], got[2]["measure_role"]) == ("dengue", "analytic_metric")
    assert (got[3]["target"], got[3]["outcome_class"], got[3]["is_positive_like"]) == ("rifampicina", "resistant", True)
    assert (got[4]["target"], got[4]["measure_role"]) == ("rifampicina", "analytic_metric")
    assert (got[7]["measure_role"], got[7]["outcome_class"]) == ("observation", "trace")


def test_protocols(spark):
    key = lambda s, f="", u="", t="": one(spark, rules.protocol_key(F.lit(s), F.lit(f), F.lit(u), F.lit(t)))
    assert [key("pressao"), key("", "silencio_critico"), key("risco_territorial", t="dengue"), key("risco"), key("", u="baixo"), key("", t="hepatite_a"), key("")] == ["emergencia", "silencio", "arbovirose", "risco", "utilizacao", "hepatite", "padrao"]
