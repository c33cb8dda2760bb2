"""Raw exam rows with label/value fields to long result rows (O19 to O27, O107)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text, weeks

FIELDS = [f"Campo_Resultado_{i}" for i in range(1, 7)]
DATES = ["Data_Solicitacao_dt", "Data_Coleta_dt", "Data_Liberacao_dt", "Data_Cadastro_dt", "DT_Atualizacao"]
TOWNS = {"residencia": ["Municipio_Residencia_Paciente", "Municipio_Solicitante", "Municipio_Notificacao_Sinan", "Municipio_Notificacao_Gal"]}


def long_results(raw: DataFrame, first_year: int = 1990) -> DataFrame:
    """One row for each of the six fields of an exam, and for its remark.

    The target of a field that only measures is that of the field before it: a fold over the row's
    own array, so nothing is shuffled. Rows without a date, or before ``first_year``, are left out.
    """
    c = lambda n: F.col(n) if n in raw.columns else F.lit(None).cast("string")
    date = F.coalesce(*[text.date_of(c(n)) for n in DATES])
    exam, method, disease = (text.strip_html(c(n)) for n in ("Exame", "Metodologia", "Agravo_Requisicao"))
    cells = [text.strip_html(c(n)) for n in FIELDS]

    def cell(field: Column) -> Column:
        x = field["raw"]
        label, value = text.field_label(x), text.field_value(x)
        own = rules.own_target(label, exam, method, disease)
        return F.struct(field["i"].alias("field_index"), label.alias("field_label"), value.alias("field_value"), text.has_real_value(x).alias("field_has_real_value"), own.alias("own"), rules.carries(label).alias("carries"), rules.measure_role(label, value).alias("measure_role"))

    base = raw.select(
        text.record_id([c(n) for n in ("Sequencial", "Codigo_Amostra", "Requisicao", "Num_Interno")], [exam, method, c("Data_Cadastro_dt")]).alias("record_id"), date.alias("event_date"),
        F.coalesce(text.first_filled(*[c(n) for n in TOWNS["residencia"]]), F.lit("IGNORADO")).alias("municipio"), F.coalesce(F.nullif(text.normalize_key(disease), F.lit("")), F.lit("ignorado")).alias("agravo"),
        exam.alias("exame"), method.alias("metodologia"), text.exam_status(c("Status_Exame")).alias("status_exame"), text.schema_signature(cells).alias("schema_signature"), text.strip_html(c("Observacao_Resultado")).alias("observacao_resultado"),
        F.array(*[F.struct(F.lit(i).alias("i"), x.alias("raw")) for i, x in enumerate(cells, 1)]).alias("cells"),
    ).where(F.col("event_date").isNotNull() & (F.year("event_date") >= first_year))
    # one expression for all fields: written out six times it would outgrow what Spark compiles
    exam, method, disease = F.col("exame"), F.col("metodologia"), F.col("agravo")
    base = base.withColumn("fields", F.transform("cells", cell)).drop("cells")

    def carry(state: Column, f: Column) -> Column:
        target = F.when(f["carries"] & state["before"].isNotNull(), state["before"]).otherwise(f["own"])
        before = F.when(f["measure_role"].isin("qualitative_result", "quantitative_result", "site_result"), target).otherwise(state["before"])
        row = F.struct(f["field_index"].alias("field_index"), f["field_label"].alias("field_label"), f["field_value"].alias("field_value"), f["field_has_real_value"].alias("field_has_real_value"), target.alias("target"), f["measure_role"].alias("measure_role"))
        return F.struct(before.alias("before"), F.concat(state["rows"], F.array(row)).alias("rows"))

    shape = "array<struct<field_index:int,field_label:string,field_value:string,field_has_real_value:boolean,target:string,measure_role:string>>"
    start = F.struct(F.lit(None).cast("string").alias("before"), F.array().cast(shape).alias("rows"))
    remark = F.struct(F.lit(7).alias("field_index"), F.lit("observacao_resultado").alias("field_label"), F.col("observacao_resultado").alias("field_value"), F.lit(True).alias("field_has_real_value"), rules.own_target(F.lit("observacao_resultado"), F.col("exame"), F.col("metodologia"), F.col("agravo")).alias("target"), F.lit("observation").alias("measure_role"))
    rows = F.aggregate("fields", start, carry, lambda s: s["rows"])
    every = F.when(F.col("observacao_resultado") != "", F.concat(rows, F.array(remark))).otherwise(rows)
    tall = base.select("*", F.explode(every).alias("f")).drop("fields").select("*", "f.*").drop("f")
    outcome = rules.outcome(F.col("field_value"), F.col("target"))
    out = tall.select("*", outcome.alias("outcome_class"), F.year("event_date").alias("year"), weeks.epi_year(F.col("event_date")).alias("epi_year"), weeks.epi_week(F.col("event_date")).alias("epi_week"), (F.col("status_exame") == "liberado").alias("is_released"))
    told = ["positive", "negative", "trace", "inconclusive", "susceptible", "resistant"]
    return out.select("*", ((F.col("measure_role") == "qualitative_result") & F.col("field_has_real_value") & F.col("outcome_class").isin(told)).alias("is_interpretable_result"), F.col("outcome_class").isin("positive", "trace", "resistant").alias("is_positive_like"), F.col("outcome_class").isin("negative", "susceptible").alias("is_negative_like"))


def arboviral(rows: DataFrame) -> DataFrame:
    """Rows that any of three columns marks as an arbovirus, with what their method shows."""
    marked = F.upper("exame").rlike(rules.ARBO) | F.upper("agravo").rlike(rules.ARBO) | F.upper("target").rlike(rules.ARBO)
    respelt = F.regexp_replace(F.lower(F.trim("target")), "^chikungunia$", "chikungunya")
    return rows.where(marked).withColumn("target", respelt).withColumn("evidencia", rules.arbovirus_evidence(F.col("exame"), F.col("metodologia")))


def distinct_evidence(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each of ``keys``, the first by ``order``: a grouping, combined before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def with_demographics(rows: DataFrame, people: DataFrame) -> DataFrame:
    """Attributes by record; a record with several sets of them takes the least, so that no row is doubled."""
    rest = [c for c in people.columns if c != "record_id"]
    one = people.groupBy("record_id").agg(F.min(F.struct(*rest)).alias("_p")).select("record_id", *[F.col(f"_p.{c}").alias(c) for c in rest])
    return rows.join(one, "record_id", "left")


#: Rows, and share of rows, that a join by code must hit to count.
LEAST_HITS, LEAST_SHARE = 5, 0.1


def gated_join(left: DataFrame, right: DataFrame, code: str, name: str) -> DataFrame:
    """``left`` with the other columns of ``right``, by code if at least ``LEAST_HITS`` rows and ``LEAST_SHARE`` of all have one there, else by name;
    ``juncao`` says which. A code or name that ``right`` has several times counts as the least of its rows.

    The choice is one row inside the plan: nothing is collected, and both joins are equal joins."""
    rest = [c for c in right.columns if c not in (code, name)]
    least = lambda key, tag: right.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_{tag}")).agg(F.min(F.struct(*rest)).alias(f"_by_{tag}"))
    both = left.join(least(code, "code"), F.col(code) == F.col("_code"), "left").join(least(name, "name"), F.col(name) == F.col("_name"), "left")
    known = right.where(F.col(code).isNotNull()).select(F.col(code).alias("_known")).distinct()
    hit = left.select(code).join(known, F.col(code) == F.col("_known"), "left").agg(F.count("_known").alias("_hits"), F.count(F.lit(1)).alias("_all"))
    gate = hit.select((F.col("_hits") >= F.greatest(F.lit(float(LEAST_HITS)), F.col("_all") * LEAST_SHARE)).alias("_gate"))
    chosen = F.when(F.col("_gate"), F.col("_by_code")).otherwise(F.col("_by_name"))
    return both.join(F.broadcast(gate), F.lit(True)).select(*left.columns, *[chosen[c].alias(c) for c in rest], F.when(F.col("_gate"), "codigo").otherwise("nome").alias("juncao"))


def in_universe(rows: DataFrame, towns: DataFrame, key: str = "municipio") -> DataFrame:
    """Rows of the towns that ``towns`` knows. The list of towns is distinct first; Spark broadcasts it if it is small."""
    return rows.join(towns.select(key).distinct(), key, "left_semi")
