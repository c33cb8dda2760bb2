"""Alert history: keyed upsert that keeps the last version, outcomes, rates (O127, O128, O145)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.weeks import ordinal

KEY = ["tipo", "municipio", "target", "epi_year", "epi_week"]


def upsert(history: DataFrame, arrivals: DataFrame, key: list[str] | None = None, version: str = "data_emissao") -> DataFrame:
    """The union with one row a key: that of the latest ``version`` (of equals, the one with the larger rest). One grouping, combined before the shuffle."""
    key = key or KEY
    rest = [c for c in history.columns if c not in key and c != version]
    both = history.unionByName(arrivals, allowMissingColumns=True)
    last = both.groupBy(*key).agg(F.max(F.struct(version, *rest)).alias("_l"))
    return last.select(*key, *[F.col(f"_l.{c}").alias(c) for c in (version, *rest)]).select(*history.columns)


def top_alerts(rows: DataFrame, kind: str, n: int = 200) -> DataFrame:
    """O104: the ``n`` highest, with the type of alert."""
    return rows.orderBy(F.desc("prob"), "municipio", "target", "epi_year", "epi_week").limit(n).select(F.lit(kind).alias("tipo"), "municipio", "target", "epi_year", "epi_week", F.round("prob", 6).alias("prob"))


def with_outcomes(history: DataFrame, panel: DataFrame, horizon: dict[str, int]) -> DataFrame:
    """O60, O127: alerts of each type get what came within its horizon in weeks; no observed week leaves them open.

    Outcomes are sent back to the weeks that may await them, so the join is on equal keys."""
    at = ordinal(F.col("epi_year"), F.col("epi_week"))
    longest = max(horizon.values())
    sent = panel.select("municipio", "target", F.col("tests").alias("_t"), F.col("positives").alias("_p"), at.alias("_then"), F.explode(F.sequence(at - longest, at - 1)).alias("_at"))
    within = F.create_map(*[F.lit(x) for kv in horizon.items() for x in kv])
    joined = history.withColumn("_at", at).join(sent, ["municipio", "target", "_at"], "left").where(F.col("_then").isNull() | (F.col("_then") - F.col("_at") <= F.element_at(within, F.col("tipo"))))
    sums = joined.groupBy(*KEY, "prob").agg(F.sum("_t").alias("_t"), F.sum("_p").alias("_p"), F.count("_then").alias("semanas"))
    kept = history.join(sums, [*KEY, "prob"], "left").fillna({"semanas": 0})
    came = F.when(F.col("tipo") == "risco", F.col("_p") > 0).otherwise(F.col("_t") == 0)
    return kept.select(*history.columns, F.col("semanas").alias("semanas_vistas"), F.when(F.col("semanas") > 0, came).alias("confirmado"))


def rates(history: DataFrame) -> DataFrame:
    """O128."""
    return history.groupBy("tipo").agg(F.count(F.lit(1)).alias("alertas"), F.count("confirmado").alias("resolvidos"), F.avg(F.col("confirmado").cast("double")).alias("taxa"))
