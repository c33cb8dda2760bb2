"""Tables that are written in parts and published at once (O5, O127, O145).

A table is cut by the values of some columns (weeks, or buckets of a key). A write makes new files for the parts that
changed, in a folder of its version, then a manifest that says which version each part has, then moves the pointer. A
reader follows the pointer, so that it sees the table before a write or after it; files of other parts are not touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .stages import path_of

ROWS, DIGEST, VERSION = "_rows", "_digest", "version"


class Published:
    """The table in folder ``home``, cut by ``by``; ``schema`` is that of its rows. There is one writer at a time."""

    def __init__(self, spark: SparkSession, home: str, by: list[str], schema: StructType, keep: int = 2):
        self.spark, self.home, self.by, self.schema, self.keep = spark, home.rstrip("/"), by, schema, keep
        self.fields = [f for f in schema if f.name in by]

    def current(self) -> int:
        """The number of the published version; 0 if there is none yet."""
        fs, at = path_of(self.spark, f"{self.home}/CURRENT")
        if not fs.exists(at):
            return 0
        stream = fs.open(at)
        try:
            return int(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _point(self, number: int) -> None:
        """Moves the pointer in one step."""
        jvm = self.spark._jvm
        fs, new = path_of(self.spark, f"{self.home}/CURRENT.new")
        out = fs.create(new, True)
        out.write(bytearray(str(number).encode()))
        out.close()
        overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(new, path_of(self.spark, f"{self.home}/CURRENT")[1], overwrite)

    def manifest(self, number: int | None = None) -> DataFrame:
        """The parts of a version: ``by``, rows, digest, and the version whose files they are in."""
        number = self.current() if number is None else number
        form = StructType([*self.fields, *StructType.fromDDL(f"{ROWS} long, {DIGEST} decimal(38,0), {VERSION} long")])
        if number == 0:
            return self.spark.createDataFrame([], form)
        return self.spark.read.schema(form).parquet(f"{self.home}/manifests/{number}")

    def _folders(self, parts: DataFrame) -> list[str]:
        """The folders of parts: as many as the table has weeks or buckets."""
        name = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None else v
        return [f"{self.home}/data/{VERSION}={r[VERSION]}/" + "/".join(f"{c}={name(r[c])}" for c in self.by) for r in parts.collect()]

    def read(self, number: int | None = None, parts: DataFrame | None = None) -> DataFrame:
        """The table as it was published (or as version ``number``); with ``parts`` (columns ``by``) only these."""
        listed = self.manifest(number)
        if parts is not None:
            listed = listed.join(F.broadcast(parts.select(*self.by).distinct()), self.by, "left_semi")
        folders = self._folders(listed)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        whole = StructType([*self.schema, *StructType.fromDDL(f"{VERSION} long")])
        return self.spark.read.schema(whole).option("basePath", f"{self.home}/data").parquet(*folders).select(*self.schema.names)

    def _digests(self, df: DataFrame) -> DataFrame:
        rest = [F.col(c) for c in self.schema.names]
        return df.groupBy(*self.by).agg(F.count(F.lit(1)).alias(ROWS), F.sum(F.xxhash64(*rest).cast("decimal(38,0)")).cast("decimal(38,0)").alias(DIGEST))

    def _write(self, df: DataFrame, old: DataFrame, whole: bool, number: int) -> int:
        """Files for the parts of ``df`` that are not in ``old`` as they are, the manifest, the pointer; gives the number of parts written."""
        new = self._digests(df).cache()
        try:
            same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (*self.by, ROWS, DIGEST)]
            changed = new.alias("n").join(old.alias("o"), same, "left_anti").select(*self.by, ROWS, DIGEST)
            met = [F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}")) for c in self.by]
            rows = df.alias("d").join(F.broadcast(changed.select(*self.by)).alias("c"), met, "left_semi")
            rows.repartition(*self.by).write.mode("overwrite").partitionBy(*self.by).parquet(f"{self.home}/data/{VERSION}={number}")
            stay = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in self.by]
            kept = old.alias("o").join(changed.alias("n"), stay, "left_anti")
            if whole:
                kept = kept.alias("o").join(new.alias("n"), stay, "left_semi")
            listed = kept.unionByName(changed.withColumn(VERSION, F.lit(number).cast("long")))
            listed.repartition(1).write.mode("overwrite").parquet(f"{self.home}/manifests/{number}")  # a row for each part; the joins before it keep their own tasks
            written = changed.count()
        finally:
            new.unpersist()
        self._point(number)
        self.prune(number)
        return written

    def publish(self, df: DataFrame) -> int:
        """``df`` is the whole table from now on; only parts that differ are written. Gives their number."""
        number = self.current()
        return self._write(df.select(*self.schema.names), self.manifest(number), True, number + 1)

    def merge(self, df: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame], base: int | None = None) -> int:
        """Puts the rows of ``df`` into the parts that they belong to: ``combine`` gets the rows of these parts and ``df``. Other parts
        are neither read nor written. Taken again on the same ``base`` version, it writes the same version again."""
        number = self.current() if base is None else base
        df = df.select(*self.schema.names)
        return self._write(combine(self.read(number, df), df).select(*self.schema.names), self.manifest(number), False, number + 1)

    def prune(self, number: int) -> None:
        """Deletes the files of parts that none of the last ``keep`` versions needs, and older manifests."""
        last = number - self.keep
        if last < 1:
            return
        fs, at = path_of(self.spark, f"{self.home}/manifests/{last}")
        if not fs.exists(at):
            return
        needed: set[str] = set()
        for k in range(last + 1, number + 1):
            needed |= set(self._folders(self.manifest(k)))
        for folder in set(self._folders(self.manifest(last))) - needed:
            fs.delete(path_of(self.spark, folder)[1], True)
        fs.delete(at, True)
