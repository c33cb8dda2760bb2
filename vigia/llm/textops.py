"""Vectorised helpers on Arrow text columns, shared by the corpus operators.

Inside a task a text column is one byte buffer with offsets. Words are found and
hashed with whole-array numpy operations over slices of that buffer, so that the
cost a byte is that of a few array passes and the memory is bounded by the slice,
not by the batch.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..sources.stages import path_of, shared_folder

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
#: Bytes of text that one vectorised step works on (a longer text is one step).
SLICE_BYTES = 1 << 20

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def byte_class(pattern: str) -> np.ndarray:
    """Table of the bytes in a class: 'space' is all but white space, 'alnum' is 0-9, a-z and what is not ASCII."""
    table = np.ones(256, dtype=bool)
    if pattern == "space":
        table[[0x20, *range(0x09, 0x0E)]] = False
    elif pattern == "alnum":
        table[:0x30] = table[0x3A:0x61] = table[0x7B:0x80] = False
    elif pattern == "letters":
        table[:0x30] = table[0x3A:0x41] = table[0x5B:0x61] = table[0x7B:0x80] = False
    else:
        raise ValueError(pattern)
    return table


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of whole rows of about ``limit`` bytes; only one run is copied at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, rows, done = 0, len(column), 0
    while first < rows:
        end = min(rows, max(int(np.searchsorted(ends, done + limit, side="right")), first + 1))
        data, offsets = column_bytes(column.slice(first, end - first))
        yield first, end, data, offsets
        first, done = end, int(ends[end - 1])
    give_back()


def give_back() -> None:
    """Workers live on between tasks: what Arrow and the C library hold back would add up, so it goes to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(max(n, SLICE_BYTES) + 1, base, dtype=U64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=U64)
    return _powers[0], _powers[1]


class Words:
    """Words of a slice: ``start`` and ``end`` in bytes, ``first[d]`` the number of the first word of document d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = is_word[data]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[heads] = False
        after[heads[heads > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self, longest: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of as many of its first characters as ``longest`` bytes hold."""
        n = len(self.data)
        up, down = powers(n)
        if self._sums is None:
            self._sums = np.zeros(n + 1, U64)
            np.cumsum((self.data.astype(U64) + U64(1)) * up[:n], out=self._sums[1:])
        end = self.end
        if longest is not None:
            end = np.minimum(self.end, self.start + longest)
            for _ in range(3):  # a character has three bytes after its first at most
                end = end - ((end < self.end) & ((self.data[np.minimum(end, n - 1)] & 0xC0) == 0x80))
        return mix((self._sums[end] - self._sums[self.start]) * down[self.start] + (end - self.start).astype(U64) * U64(BASE))


def hash_word(word: bytes) -> int:
    """The hash that ``Words.hashes`` gives for these bytes."""
    data = np.frombuffer(word, np.uint8)
    return int(Words(data, np.array([0, len(data)]), np.ones(256, bool)).hashes()[0])


#: Settings of a session that writes a table: its shuffle files can go when it is there, since it stands for
#: the plan from then on, and Python tasks get batches of bounded size.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


_scratch: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder of the shared one for all tables that are written inside, and that go with it at the end."""
    _scratch.append(f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}")
    try:
        yield _scratch[-1]
    finally:
        fs, at = path_of(spark, _scratch.pop())
        fs.delete(at, True)


def materialize(df: DataFrame, name: str, batch_bytes: int | None = None, folder: str | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it again: lineage is cut, sizes are known, a lost executor loses nothing.
    ``batch_bytes``: what Python tasks get at once, if not what ``WRITING`` says; ``folder``: where, if not in the folder of ``scratch`` or the shared one."""
    spark = df.sparkSession
    path = f"{folder or (_scratch[-1] if _scratch else shared_folder(spark))}/{name}-{uuid.uuid4().hex}"
    settings = WRITING | ({"spark.sql.execution.arrow.maxBytesPerBatch": str(batch_bytes)} if batch_bytes else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    written = spark.read.schema(df.schema).parquet(path)
    written._folder = path
    return written


def discard(*written: DataFrame) -> None:
    """Deletes tables of ``materialize`` that nothing will read again."""
    for df in written:
        fs, at = path_of(df.sparkSession, df._folder)
        fs.delete(at, True)


#: A key with more than this part of all rows counts as hot; there are fewer such keys than its inverse.
HOT_SHARE = 1 / 1000


def join_counted(rows: DataFrame, keyed: DataFrame, keys: list[str], how: str, total: int) -> DataFrame:
    """``rows`` joined with ``keyed``, which has each key once and the number of its rows as ``_n``.

    Rows of a hot key don't meet in one task: the hot keys, fewer than 1,000 of them, are broadcast, and only the
    other rows are dealt by their keys. ``rows`` is read twice, so it should be a written table. Keys aren't null.
    """
    hot = F.broadcast(keyed.where(F.col("_n") > total * HOT_SHARE))
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(keyed.drop("_n"), keys, how)
    return rows.join(hot.drop("_n"), keys, how).unionByName(rest)


#: Bits of a filter for each key; bits of a block of it, all of one key being in one block; bits that a key sets.
KEY_BITS, BLOCK_BITS, KEY_HASHES = 10, 1 << 15, 4
#: Blocks of 4 KB that are broadcast together at most: 64 MB, for 50 million keys. More keys make more parts, not larger ones.
PART_BLOCKS = 1 << 14


def _block_bits(key: list[Column]) -> list[Column]:
    """The places of a key in its block."""
    h = F.xxhash64(F.lit(KEY_HASHES), *key)
    return [F.shiftright(h, 15 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for k in range(KEY_HASHES)]


def _filter(wanted: DataFrame, key: list[Column], blocks: int) -> DataFrame:
    """A Bloom filter of the keys of ``wanted``: _block, _words (512 numbers of 64 bits). Bits are united before each shuffle."""
    at = wanted.select(F.pmod(F.xxhash64(*key), F.lit(blocks)).alias("_block"), F.explode(F.array(*_block_bits(key))).alias("_bit"))
    word = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit").bitwiseAND(F.lit(63))))
    words = at.groupBy("_block", F.shiftright("_bit", 6).alias("_at")).agg(word.alias("_word"))
    whole = words.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("_at", "_word"))).alias("_known"))  # 512 at most
    return whole.select("_block", F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)), lambda k: F.coalesce(F.element_at("_known", k), F.lit(0).cast("long"))).alias("_words"))


def picked(rows: DataFrame, key: list[Column], wanted: DataFrame, wanted_key: list[Column], how: str = "left_semi", mark: str | None = None) -> DataFrame:
    """The rows whose key may be among those of ``wanted``, a written table: all that are, and about one in a hundred that aren't
    ('left_anti': the others). Nothing of ``rows`` is shuffled. The filter has ten bits for each key of ``wanted``, whatever their number;
    it is broadcast in parts of 64 MB at most, each with the rows whose key falls into it. A null counts as a key.

    ``mark`` names a column to add, the number (not null) of the row's block of the filter. A join of what is picked should have it in its
    condition: else the optimizer moves a semi or anti join below the filter, and all rows are shuffled."""
    blocks = max(1, -(-wanted.count() * KEY_BITS // BLOCK_BITS))
    whole = _filter(wanted, wanted_key, blocks)
    block, found = F.pmod(F.xxhash64(*key), F.lit(blocks)), None
    for first in range(0, blocks, PART_BLOCKS):
        inside = lambda b, first=first: (b >= first) & (b < first + PART_BLOCKS)
        part = rows if blocks <= PART_BLOCKS else rows.where(inside(block))
        held = F.broadcast(whole if blocks <= PART_BLOCKS else whole.where(inside(F.col("_block"))))
        bits = [F.call_function("shiftright", F.element_at(held["_words"], F.shiftright(b, 6) + 1), b.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1)) == 1 for b in _block_bits(key)]
        among = reduce(lambda a, b: a & b, [held["_words"].isNotNull(), *bits])
        met = part.join(held, block == held["_block"], "left").where(among if how == "left_semi" else ~F.coalesce(among, F.lit(False)))
        met = (met.withColumn(mark, held["_block"]) if mark else met).drop(held["_block"], held["_words"])
        found = met if found is None else found.unionByName(met)
    return found


def without(docs: DataFrame, lost: DataFrame, key: list[Column], lost_key: list[Column], more: Column | None = None) -> DataFrame:
    """``docs`` but for the rows with a key (not null) that stands in ``lost`` and for which ``more`` holds. Most rows stay where they
    are: only those that may be lost are dealt to a join. ``lost`` is a written table; no column of it has a name of ``docs``."""
    same = reduce(lambda a, b: a & b, (a == b for a, b in zip(key, lost_key, strict=True)))
    mark = f"_held_{uuid.uuid4().hex}"
    maybe = picked(docs, key, lost, lost_key, mark=mark)
    same = same & (F.col(mark) >= 0)
    kept = maybe.join(lost, same if more is None else same & more, "left_anti").drop(mark)
    return picked(docs, key, lost, lost_key, "left_anti").unionByName(kept)


def id_schema(docs: DataFrame, id_col: str, rest: str) -> StructType:
    """Columns ``id``, of the type that ``docs`` has, and ``rest`` (DDL)."""
    return StructType([StructField("id", docs.schema[id_col].dataType), *StructType.fromDDL(rest)])


def typed(schema: pa.Schema, batch: pa.RecordBatch) -> pa.Schema:
    """``schema`` with the type that the first column of ``batch``, the id, has."""
    return schema.set(0, pa.field(schema.field(0).name, batch.schema.field(0).type))


def record_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, schema, strict=True)], schema=schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
