"""Ranks over keys of any size: sorted ranges are counted on their own, and their sums put before each other.

A window over one key ranks all its rows in one task. Here equal values are counted first (combined before the
shuffle), the distinct values are dealt into ranges of key and value, each range is numbered on its own, and a small
table of the ranges' sums, one row for each key and range, gives what comes before a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stages import written


def cumulated(rows: DataFrame, keys: list[str], value: str, sums: list[str], ranges: int | None = None) -> DataFrame:
    """``rows`` (a row for each distinct key and value) with ``<sum>_before`` for each of ``sums``: its sum over the smaller values of the key.

    Nulls come first. Rows are dealt to ``ranges`` sorted ranges (by default the session's shuffle partitions) and written,
    so that the ranges stay the same when they are read twice.
    """
    spark = rows.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(rows.repartitionByRange(n, *keys, value).withColumn("_range", F.spark_partition_id()), "ranges")
    part = dealt.groupBy(*keys, "_range").agg(*(F.sum(c).alias(f"_{c}_sum") for c in sums))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range at most
    part = part.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_range").alias("_r"), *(F.coalesce(F.sum(f"_{c}_sum").over(earlier), F.lit(0)).alias(f"_{c}_earlier") for c in sums))
    inside = Window.partitionBy("_range", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    same: Column = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    local = dealt.select("*", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_{c}_inside") for c in sums))
    return local.join(part, same).select(*rows.columns, *((F.col(f"_{c}_inside") + F.col(f"_{c}_earlier")).alias(f"{c}_before") for c in sums))


def value_ranks(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value, n (rows of the value), n_before (rows of the key with a smaller value), average rank of its ties from 1."""
    counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return cumulated(counts, keys, value, ["n"]).withColumn("avg_rank", F.col("n_before") + (F.col("n") + 1) / F.lit(2.0))
