"""Reading and writing tables: text and Parquet scans, column names, unions, warehouses, run counts."""

from __future__ import annotations

import codecs
import re
import unicodedata
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stages import path_of, written


def scan_csv(spark: SparkSession, paths: str | list[str], columns: list[str], sep: str = ";", encoding: str = "UTF-8", corrupt: str = "DROPMALFORMED") -> DataFrame:
    """O1: every column is a string; lines that don't fit are left out (or kept, with ``PERMISSIVE``)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.schema(schema).options(sep=sep, encoding=encoding, header=True, mode=corrupt, multiLine=False).csv(paths)


#: Bytes of a file from which its encoding and separator are told; separators that are known.
HEAD_BYTES, SEPARATORS = 1 << 16, ";,\t|"


def text_form(head: bytes, candidates: str = SEPARATORS) -> tuple[str, str]:
    """O1: (encoding, separator) of a delimited text by its first bytes: UTF-8 if they are that (a character may be cut off at the end), else
    ISO-8859-1; the separator that most lines hold as often as the first line does, the more the better."""
    head = head.removeprefix(b"\xef\xbb\xbf")
    try:
        text, encoding = codecs.getincrementaldecoder("utf-8")().decode(head), "UTF-8"
    except UnicodeDecodeError:
        text, encoding = head.decode("latin-1"), "ISO-8859-1"
    lines = [x for x in text.splitlines() if x.strip()]
    lines = lines[:-1] if len(lines) > 1 and len(head) >= HEAD_BYTES else lines  # the last may be cut off
    alike = lambda c: sum(x.count(c) == lines[0].count(c) for x in lines)
    best = max(candidates, key=lambda c: (min(lines[0].count(c), 1) * alike(c), lines[0].count(c))) if lines else candidates[0]
    return encoding, best


def head_of(spark: SparkSession, path: str) -> bytes:
    """The first bytes of a file, or of the first file of a folder that has more than a header, in any store. A folder without such a file
    gives the first bytes of its first file with any."""
    fs, at = path_of(spark, path)
    if fs.getFileStatus(at).isDirectory():
        files = sorted((f.getPath() for f in fs.listStatus(at) if f.isFile() and f.getLen() > 0 and not f.getPath().getName().startswith(("_", "."))), key=lambda f: f.toString())
    else:
        files = [at]
    first = b""
    for file in files:
        stream = fs.open(file)
        try:
            head = bytes(stream.readNBytes(HEAD_BYTES))
        finally:
            stream.close()
        if len([x for x in head.splitlines() if x.strip()]) > 1:
            return head
        first = first or head
    return first


def form_of(spark: SparkSession, path: str) -> tuple[str, str]:
    """O1: (encoding, separator) of a file or a folder: UTF-8 only if every line of every file is that, as a first file may hold no letter that tells;
    the separator by ``text_form``."""
    _, sep = text_form(head_of(spark, path))
    valid = spark.read.text(path).agg(F.bool_and(F.is_valid_utf8("value"))).first()[0]
    return "ISO-8859-1" if valid is False else "UTF-8", sep


@dataclass
class Scanned:
    """Rows that fit, lines that don't (with the file that they are from), and how many there are of each."""

    rows: DataFrame
    quarantine: DataFrame
    counts: dict[str, int]


def scan_checked(spark: SparkSession, path: str, columns: list[str], form: tuple[str, str] | None = None) -> Scanned:
    """A delimited text with a header, each column a string. Lines with more or fewer fields than ``columns`` go to a quarantine table.

    Its lines are looked at for their encoding, unless ``form`` gives it, then parsed once, and written; counts are taken by an observation as it passes. Every line but the header is in one of the two."""
    encoding, sep = form or form_of(spark, path)
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in columns], T.StructField("_line", T.StringType())])
    read = spark.read.schema(schema).options(sep=sep, encoding=encoding, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_line", enforceSchema=True).csv(path)
    seen = Observation(f"scan-{uuid.uuid4().hex}")
    wrong = F.col("_line").isNotNull()
    passing = read.withColumn("_file", F.input_file_name()).observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(wrong).alias("quarantined"), F.count_if(~wrong).alias("rows"))
    held = written(passing, "scanned")
    return Scanned(held.where("_line is null").select(*columns), held.where("_line is not null").select(F.col("_line").alias("line"), F.col("_file").alias("file")), dict(seen.get))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path can be read, asked through Spark's own file systems."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).limit(0).collect()
        return True
    except Exception as error:  # the error class says that nothing is there
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def scan_table(spark: SparkSession, base: str, columns: list[str] | None = None, **csv) -> DataFrame:
    """O2: ``base``.parquet if it is there, else ``base``.csv."""
    if exists(spark, f"{base}.parquet"):
        return spark.read.parquet(f"{base}.parquet")
    return scan_csv(spark, f"{base}.csv", columns or [], **csv)


def plain(name: str) -> str:
    name = unicodedata.normalize("NFKD", name.strip().upper())
    return re.sub(r"\s+", " ", "".join(c for c in name if not unicodedata.combining(c)))


def find_column(names: list[str], candidates: list[str] | None = None, any_of=(), all_of=(), none_of=()) -> str | None:
    """O3: the first candidate (as it is, then without case and accents), else the name with the best token score."""
    by_plain = {plain(n): n for n in reversed(names)}
    for c in candidates or []:
        if c in names:
            return c
        if plain(c) in by_plain:
            return by_plain[plain(c)]
    if not (any_of or all_of):
        return None

    def points(name: str) -> float | None:
        n = plain(name)
        found = [sum(plain(t) in n for t in tokens) for tokens in (any_of, all_of, none_of)]
        if found[2] or found[1] < len(all_of) or (any_of and not found[0]):
            return None
        return 2 * found[0] + 3 * found[1] - len(n) / 1000

    scored = [(p, n) for n in names if (p := points(n)) is not None]
    return max(scored)[1] if scored else None


def resolve(df: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """O3: a select with canonical names; what isn't there is a null string."""
    found = {name: find_column(df.columns, [name, *others]) for name, others in wanted.items()}
    return df.select(*[F.col(f"`{source}`").alias(name) if source else F.lit(None).cast("string").alias(name) for name, source in found.items()])


def union_years(tables: list[DataFrame], date: str, first_year: int) -> DataFrame:
    """Many files as one relation; the filter is on the raw column, so that it reaches the scans."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.where(F.col(date) >= F.lit(f"{first_year}-01-01").cast(out.schema[date].dataType))


def write(df: DataFrame, path: str, form: str = "parquet", by: list[str] | None = None) -> None:
    """A whole table, by partitions if asked."""
    writer = df.write.mode("overwrite")
    writer = writer.partitionBy(*by) if by else writer
    writer.option("header", True).csv(path) if form == "csv" else writer.parquet(path)


def counted(df: DataFrame, name: str, **conditions) -> tuple[DataFrame, Observation]:
    """The relation, and an observation that has its row counts (and those under conditions) when an action has run."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()]), seen


def melt_years(df: DataFrame, keys: list[str], prefix: str = "Pop_") -> DataFrame:
    """O107: columns like Pop_2019 to rows (keys…, ano, populacao)."""
    years = [c for c in df.columns if re.fullmatch(prefix + r"\d{4}", c)]
    tall = df.unpivot(keys, years, "_c", "populacao")
    return tall.select(*keys, F.substring("_c", len(prefix) + 1, 4).cast("long").alias("ano"), "populacao")
