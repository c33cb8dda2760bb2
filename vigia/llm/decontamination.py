"""Benchmark decontamination with an FM-index for each shard of training text.

A window is a run of consecutive words of a benchmark item (all of a short item).
Each task turns its shard into the sequence of words that occur in the benchmark at
all, cut where another word stands between them (no window can reach across such a
cut), and builds an FM-index over it: suffix array, Burrows-Wheeler transform, a
wavelet matrix for rank, and every ``SAMPLE``-th suffix position. All windows are
searched backwards at once; occurrences are located through the sampled positions
and merged to removal spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import ASCII_LOWER, U64, Words, byte_class, id_schema, materialize, record_batch, slices, typed, without

WINDOW = 13
#: Every so many text positions the suffix array is kept for locating.
SAMPLE = 16
#: Pairs of a window and an item in one block of windows: what is collected and broadcast at once has about 150 bytes for each.
BLOCK_WINDOWS = 200_000
WORD = byte_class("alnum")

SPANS = "array<struct<first:int,last:int,start:int,end:int>>"
_span = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
HITS_SCHEMA = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("item_ids", pa.list_(pa.string())), ("spans", pa.list_(_span))])
PIECES = pa.schema([("item", pa.string()), ("window", pa.binary())])


@dataclass
class Windows:
    """Distinct windows of a benchmark block. Words are numbered 1.. by their place in ``vocabulary`` (sorted hashes)."""

    vocabulary: np.ndarray
    words: np.ndarray  # one row for each window, right-aligned: its last word is in the last column, unused places hold 0
    lengths: np.ndarray
    owner_first: np.ndarray  # the owners of window w are owners[owner_first[w]:owner_first[w + 1]]
    owners: np.ndarray  # item ids as strings, None for a null id
    shortest: int = field(default=WINDOW)


def _pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """(item, window) for every window of the items: the hashes of its words, eight bytes each."""
    for batch in batches:
        for i, j, data, offsets in slices(batch.column(1)):
            words = Words(ASCII_LOWER[data], offsets, WORD)
            hashes = words.hashes() if len(words) else np.zeros(0, U64)
            sizes = np.minimum(words.counts, window)
            many = np.where(sizes > 0, words.counts - sizes + 1, 0)
            row = np.repeat(np.arange(j - i), many)
            at = np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            yield record_batch(PIECES, [batch.column(0).slice(i, j - i).take(pa.array(row)), [hashes[a : a + n].tobytes() for a, n in zip(at, sizes[row], strict=True)]])


def windows_of(pieces: pa.Table, window: int = WINDOW) -> Windows | None:
    """The windows of a block from rows (item, window), which are distinct; None without any."""
    if not pieces.num_rows:
        return None
    distinct, which = np.unique(np.array(pieces.column(1).to_pylist(), object), return_inverse=True)
    lengths = np.array([len(w) // 8 for w in distinct])
    hashes = np.frombuffer(b"".join(distinct), U64)
    vocabulary, numbers = np.unique(hashes, return_inverse=True)
    words = np.zeros((len(distinct), window), np.int64)
    words[np.arange(window)[None, :] >= window - lengths[:, None]] = numbers + 1
    order = np.argsort(which, kind="stable")
    owners = np.array(pieces.column(0).to_pylist(), object)[order]
    return Windows(vocabulary, words, lengths, np.searchsorted(which[order], np.arange(len(distinct) + 1)), owners, int(lengths.min()))


class WaveletMatrix:
    """Rank of any symbol in a sequence, a bit of the symbol at each level."""

    def __init__(self, symbols: np.ndarray, highest: int):
        self.levels = max(1, int(highest).bit_length())
        self.ones, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bits = (symbols >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bits)]))
            self.zeros.append(len(bits) - int(self.ones[-1][-1]))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often each symbol stands before the position beside it."""
        begin, end = np.zeros_like(position), position.copy()
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            one = ((symbol >> level) & 1).astype(bool)
            b, e = self.ones[k][begin], self.ones[k][end]
            begin, end = np.where(one, self.zeros[k] + b, begin - b), np.where(one, self.zeros[k] + e, end - e)
        return end - begin


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """By prefix doubling."""
    n, step = len(sequence), 1
    rank = np.unique(sequence, return_inverse=True)[1].astype(np.int64)
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        changes = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = changes
        if changes[-1] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Of a sequence of numbers up to ``highest``, 0 being a cut. Inside, all are one higher and a lone 0 ends the text."""

    def __init__(self, sequence: np.ndarray, highest: int):
        sequence = np.append(sequence + 1, 0)
        self.n = len(sequence)
        order = suffix_array(sequence)
        self.bwt = sequence[order - 1]
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=highest + 2))])
        self.tree = WaveletMatrix(self.bwt, highest + 1)
        kept = (order % SAMPLE == 0) | (order == self.n - 1)
        self.position = np.where(kept, order, -1)

    def search(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """For each window the rows [low, high) of the suffix array that start with it."""
        low, high = np.zeros(len(windows.words), np.int64), np.full(len(windows.words), self.n, np.int64)
        for column in range(windows.words.shape[1] - 1, -1, -1):
            symbol = windows.words[:, column]
            going = (symbol > 0) & (low < high)
            if not going.any():
                break
            s = symbol[going] + 1
            low[going], high[going] = self.smaller[s] + self.tree.rank(s, low[going]), self.smaller[s] + self.tree.rank(s, high[going])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array: steps back to a sampled one."""
        found, steps, at = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64), rows.copy()
        open_ = np.arange(len(rows))
        while len(open_):
            here = self.position[at[open_]]
            done = here >= 0
            found[open_[done]] = here[done] + steps[open_[done]]
            open_ = open_[~done]
            symbol = self.bwt[at[open_]]
            at[open_] = self.smaller[symbol] + self.tree.rank(symbol, at[open_])
            steps[open_] += 1
        return found


def _shard_hits(words: Words, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of every occurrence in the documents of a shard."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(words):
        return nothing
    hashes = words.hashes()
    place = np.searchsorted(windows.vocabulary, hashes)
    place[place == len(windows.vocabulary)] = 0
    number = np.where(windows.vocabulary[place] == hashes, place + 1, 0)
    # runs of benchmark words inside one document, at least as long as the shortest window
    new = np.ones(len(number), bool)
    new[1:] = (number[1:] == 0) | (number[:-1] == 0) | (np.diff(words.doc) != 0)
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(number)))
    good = (number[heads] > 0) & (sizes >= windows.shortest)
    heads, sizes = heads[good], sizes[good]
    if not len(heads):
        return nothing
    # runs one after another, each followed by a cut (0)
    ends = np.cumsum(sizes + 1)
    source = np.repeat(heads - (ends - sizes - 1), sizes + 1) + np.arange(ends[-1])
    sequence = number[np.minimum(source, len(number) - 1)]
    sequence[ends - 1] = 0
    index = FMIndex(sequence, len(windows.vocabulary))
    low, high = index.search(windows)
    many = np.maximum(high - low, 0)
    window = np.repeat(np.arange(len(many)), many)
    rows = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
    return window, source[index.locate(rows)]


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as disjoint sorted spans."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[new], np.append(ends[:-1][new[1:]], ends[-1])


def _hits(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
    windows: Windows | None = block.value
    for batch in batches:
        for first, end, data, offsets in slices(batch.column(1)):
            words = Words(ASCII_LOWER[data], offsets, WORD)
            window, at = _shard_hits(words, windows) if windows else (np.zeros(0, np.int64),) * 2
            doc = np.searchsorted(words.first, at, side="right") - 1
            order = np.argsort(doc, kind="stable")
            window, at, doc = window[order], at[order], doc[order]
            items, spans = [], []
            bounds = np.searchsorted(doc, np.arange(end - first + 1))
            for d in range(end - first):
                w, a = window[bounds[d] : bounds[d + 1]], at[bounds[d] : bounds[d + 1]] - words.first[d]
                if not len(w):
                    items.append([]), spans.append([])
                    continue
                s, e = _merged(a, a + windows.lengths[w])
                items.append(sorted({x for k in np.unique(w) for x in windows.owners[windows.owner_first[k] : windows.owner_first[k + 1]] if x is not None}))
                # spans leave by word and by character of the text
                head = words.offsets[d]
                text = data[head : words.offsets[d + 1]]
                chars = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
                start, stop = chars[words.start[words.first[d] + s] - head], chars[words.end[words.first[d] + e - 1] - head]
                spans.append([dict(zip(("first", "last", "start", "end"), map(int, x), strict=True)) for x in zip(s, e, start, stop, strict=True)])
            yield record_batch(typed(HITS_SCHEMA, batch), [batch.column(0).slice(first, end - first), words.counts, items, spans])


def _blocks(benchmark: DataFrame, window: int, block_windows: int) -> tuple[DataFrame, int]:
    """Distinct (item, window, block) of the benchmark, written, and the number of blocks. Windows are made in tasks."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("text"))
    pieces = materialize(items.mapInArrow(lambda it: _pieces(it, window), "item string, window binary").distinct(), "windows")
    blocks = max(1, -(-pieces.count() // block_windows))
    return pieces.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks))), blocks


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row for each row of ``docs``: id, n_words, n_hit, item_ids (as strings, sorted), spans (merged; first, last: words, start, end: characters).

    Windows are dealt to blocks of about ``block_windows``, so that what is collected and broadcast has a bound that
    doesn't depend on the benchmark's size. With several blocks the documents get row numbers and are read once for each
    block, and the spans of a row are united: the result is that of one block. Documents and items that are null
    or have no word have no hit; items with a null id hit words, but have no id to name. Null, repeated and shared ids
    of documents give a row each. An empty benchmark hits nothing; other columns, of whatever name, are left aside.
    """
    spark = docs.sparkSession
    pieces, blocks = _blocks(benchmark, window, block_windows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    many = blocks > 1
    if many:
        numbered = materialize(rows.select(F.monotonically_increasing_id().alias("row"), "id", "text"), "numbered")
        rows = numbered.select(F.col("row").alias("id"), "text")
    found = []
    for k in range(blocks):
        block = spark.sparkContext.broadcast(windows_of(pieces.where(F.col("block") == k).select("item", "window").toArrow(), window))
        found.append(rows.mapInArrow(lambda it, block=block: _hits(it, block), id_schema(rows, "id", f"n_words long, item_ids array<string>, spans {SPANS}")))
        if many:
            found[k] = materialize(found[k].where((F.size("spans") > 0) | F.lit(k == 0)), "hits")
    out = found[0]
    if many:
        out = _united(found).join(numbered.select(F.col("row"), F.col("id").alias("_name")), F.col("id") == F.col("row")).select(F.col("_name").alias("id"), "n_words", "item_ids", "spans")
    counted = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return out.select(F.col("id").alias(id_col), "n_words", counted.alias("n_hit"), "item_ids", "spans")


def _united(found: list[DataFrame]) -> DataFrame:
    """One row for each row number: hits of several blocks, spans that meet or overlap being merged. A block holds each
    document once, so that at most as many rows meet as there are blocks."""
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    gathered = every.groupBy("id").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    none = F.lit(None).cast(SPANS[6:-1])
    def join_last(acc, s):
        meets = s["first"] <= acc["open"]["last"]
        grown = F.struct(acc["open"]["first"].alias("first"), F.greatest(acc["open"]["last"], s["last"]).alias("last"), acc["open"]["start"].alias("start"), F.greatest(acc["open"]["end"], s["end"]).alias("end"))
        closed = F.when(acc["open"].isNull() | meets, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
        return F.struct(closed.alias("done"), F.when(meets, grown).otherwise(s).alias("open"))

    start = F.struct(F.array().cast(SPANS).alias("done"), none.alias("open"))
    merged = F.aggregate("spans", start, join_last, lambda acc: F.when(acc["open"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))
    return gathered.withColumn("spans", merged)


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The digest of ``hits``, a row for each row of ``docs``: id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null, empty and wordless texts have no words and aren't contaminated; other cases as in ``hits``."""
    found = hits(docs, benchmark, id_col, text_col, **kw)
    bad = (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))
    return found.select(id_col, "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), bad.alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without contaminated rows; columns unchanged, whatever their names. Rows are told by two hashes of the text:
    equal texts are judged alike, whatever their id, so that null, repeated and shared ids need no care."""
    marks = [F.xxhash64(text_col), F.xxhash64(F.lit(1), text_col)]
    marked = docs.select(F.struct(marks[0].alias("a"), marks[1].alias("b")).alias("row"), F.col(text_col).alias("text"))
    bad = report(marked, benchmark, "row", "text", **kw).where("contaminated").select(F.col("row.a").alias("_bad_a"), F.col("row.b").alias("_bad_b")).distinct()
    bad = materialize(bad, "contaminated")
    return without(docs, bad, marks, [bad["_bad_a"], bad["_bad_b"]])


def strip_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """id and the text with its merged removal spans cut out (null stays null), a row for each row of ``docs``."""
    row = F.struct(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = hits(docs.select(row.alias("row"), F.col(text_col).alias("text")), benchmark, "row", "text", **kw)
    text = F.col("row.text")
    begins = F.concat(F.array(F.lit(0)), F.col("spans.end"))
    ends = F.concat(F.col("spans.start"), F.array(F.length(text)))
    kept = F.transform(F.arrays_zip(begins.alias("b"), ends.alias("e")), lambda s: F.substring(text, s["b"] + 1, s["e"] - s["b"]))
    return found.select(F.col("row.id").alias(id_col), F.when(text.isNotNull(), F.array_join(kept, "")).alias(text_col))


def items_digest(item_ids: list) -> str:
    """What ``items_sha256`` is for these items."""
    return hashlib.sha256(",".join(sorted(map(str, item_ids))).encode()).hexdigest()
