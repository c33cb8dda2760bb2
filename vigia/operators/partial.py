"""Aggregates that are kept by file and merged with those of later files, without reading the files again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: size of a sketch (two to this power of places); its error is about 0.8 %.
SKETCH_BITS = 14


def partial(rows: DataFrame, keys: list[str], record: str = "record_id") -> DataFrame:
    """One file's part: exams, positives, negatives, and a sketch of the distinct records. Outcomes count as in the weekly panel, by row."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("exames"), F.count_if(F.col("outcome") == "positive").alias("positives"), F.count_if(F.col("outcome") == "negative").alias("negatives"), F.hll_sketch_agg(F.col(record), SKETCH_BITS).alias("registros"))


def append(part: DataFrame, store: str, source: str) -> None:
    """Adds the part of ``source`` to the store; the part of a source that was there before is replaced, so that a file taken twice counts once."""
    part.write.mode("overwrite").parquet(f"{store}/source={source}")


def merged(spark: SparkSession, store: str, keys: list[str]) -> DataFrame:
    """Sums of all parts, and how many distinct records they hold together, by their sketches (``registros_estimados``)."""
    parts = spark.read.parquet(store)
    return parts.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("exames", "positives", "negatives")], F.hll_sketch_estimate(F.hll_union_agg("registros")).alias("registros_estimados"), F.count_distinct("source").alias("arquivos"))


def exact(rows: DataFrame, keys: list[str], record: str = "record_id") -> DataFrame:
    """The distinct records themselves, from all rows."""
    return rows.groupBy(*keys).agg(F.count_distinct(record).alias("registros"))
