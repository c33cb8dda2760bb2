"""Incremental weekly counters and alert upserts as structured streams over arriving files (O144, O145)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.history import upsert
from ..sources.published import Published
from ..sources.stages import path_of, shared_folder

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def events(spark: SparkSession, path: str, schema: str = SCHEMA, at_once: int | None = None) -> DataFrame:
    """A stream over the files of ``path``, which may be one file: its folder is watched for that name then. ``at_once``: how many make a batch."""
    folder, name = path, "*.parquet"
    files = spark.read.schema(schema).parquet(path).inputFiles()
    if len(files) == 1 and files[0].endswith("/" + path.rsplit("/", 1)[-1]):
        folder, name = path.rsplit("/", 1)
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    reader = reader.option("maxFilesPerTrigger", at_once) if at_once else reader
    return reader.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def weekly_counts(stream: DataFrame, late: str = "14 days") -> DataFrame:
    """Counts and sums by type and week (from Monday on). State for a week goes once the watermark has passed it."""
    week = F.window("ts", "7 days", "7 days", "4 days")
    return stream.withWatermark("ts", late).groupBy(week.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def run_available(spark: SparkSession, path: str) -> DataFrame:
    """All files that are there, as a stream in complete mode; each batch replaces a table in the shared folder. Returns the last one."""
    out, state = work_folder(spark, "weekly"), work_folder(spark, "weekly-state")

    def replace(batch: DataFrame, _: int) -> None:
        batch.select(F.col("w.start").cast("date").alias("semana"), "event_type", "n", "total").write.mode("overwrite").parquet(out)

    running = weekly_counts(events(spark, path)).writeStream.outputMode("complete").foreachBatch(replace).option("checkpointLocation", state).trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.parquet(out)


def run_closed_weeks(spark: SparkSession, path: str) -> DataFrame:
    """The same stream in append mode: only weeks that no late event can change any more."""
    out, state = work_folder(spark, "closed"), work_folder(spark, "closed-state")
    rows = weekly_counts(events(spark, path), "1 day").select(F.col("w.start").cast("date").alias("semana"), "event_type", "n", "total")
    rows.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("semana date, event_type string, n long, total double").parquet(out)


#: Buckets of a keyed history; a batch rewrites those that its keys fall into.
BUCKETS = 64


def run_upserts(spark: SparkSession, path: str, key: list[str], version: str, home: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """O145: each batch of arrivals is merged into the history, which is kept in ``buckets`` by a hash of the key: only those that a batch
    touches are read and written, and files that the last two versions don't need go.

    Under a given ``home`` in shared storage a later run goes on where the last one ended, even if that was lost: batch n is
    always merged into version n, so that a batch that is taken again writes version n + 1 again. Without one, the
    history starts anew. The number of buckets of a home stays the same."""
    home = (home or work_folder(spark, "history")).rstrip("/")
    stream = events(spark, path)
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("long")
    table = Published(spark, f"{home}/table", ["bucket"], StructType([*stream.schema, StructField("bucket", LongType())]))

    def merge(batch: DataFrame, number: int) -> None:
        table.merge(batch.withColumn("bucket", bucket), lambda old, new: upsert(old, new, [*key, "bucket"], version), number)

    running = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    return table.read().drop("bucket")


#: State with a row for each record lies on the executors' disks: in memory all its stores on an executor together take 500 MB, however many records there are.
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",  # it looks up each key that is put or removed
}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state on disk; one that goes on where it ended keeps it where it was."""
    before = {k: spark.conf.get(k, None) for k in ON_DISK}
    try:
        for k, v in ON_DISK.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def distinct_weekly(stream: DataFrame, record: str, late: str = "14 days") -> DataFrame:
    """O144: distinct records by type and week: a record counts once, however often it arrives within the watermark."""
    week = F.window("ts", "7 days", "7 days", "4 days")
    once = stream.withWatermark("ts", late).dropDuplicatesWithinWatermark([record])
    return once.groupBy(week.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def run_distinct(spark: SparkSession, path: str, record: str = "event_id", late: str = "14 days", home: str | None = None, files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """O144: (weeks that the watermark has closed with their distinct records, rows that came too late to count).

    Late is what is older than the highest time of all batches before, less ``late``; such rows go to a side table of their own. Under a given ``home``
    both go on where they ended. ``files`` is the number of files of a batch."""
    home = (home or work_folder(spark, "distinct")).rstrip("/")
    form = "semana date, event_type string, n long, total double"
    source = lambda: events(spark, path, at_once=files)
    rows = distinct_weekly(source(), record, late).select(F.col("w.start").cast("date").alias("semana"), "event_type", "n", "total")
    with state_on_disk(spark):
        rows.writeStream.outputMode("append").format("parquet").option("path", f"{home}/weeks").option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start().awaitTermination()
    side = source()

    def apart(batch: DataFrame, number: int) -> None:
        batch.agg(F.max("ts").alias("ts")).coalesce(1).write.mode("overwrite").parquet(f"{home}/highest/batch={number}")
        if number:
            before = spark.read.parquet(f"{home}/highest").where(F.col("batch") < number).agg((F.max("ts") - F.expr(f"INTERVAL {late}")).alias("_from"))  # a row for each batch
            batch.join(F.broadcast(before), F.lit(True)).where("ts < _from").drop("_from").write.mode("overwrite").parquet(f"{home}/late/batch={number}")

    side.writeStream.foreachBatch(apart).option("checkpointLocation", f"{home}/late-state").trigger(availableNow=True).start().awaitTermination()
    fs, at = path_of(spark, f"{home}/late")
    late_rows = spark.read.schema(side.schema).parquet(f"{home}/late/batch=*") if fs.exists(at) else spark.createDataFrame([], side.schema)
    return spark.read.schema(form).parquet(f"{home}/weeks"), late_rows
