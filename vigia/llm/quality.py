"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network in numpy.

Each word has a sparse random index vector; a word's vector is the sum of the index
vectors of its neighbours over the whole corpus. Words are numbered by hash, so the
table has a fixed size, each task adds up its own, and the sums are combined before
they reach the driver. A document is the pool of its words' vectors; a network with one
hidden layer gives the probability, and its temperature is fitted on labels kept apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import U64, Words, id_schema, record_batch, slices, typed
from .toxicity import held_out, labelled_sample

#: Rows of the word table, length of a word vector, places of an index vector that aren't 0, neighbours on each side.
WORDS, SIZE, SPARSE, REACH = 4096, 48, 2, 2
#: Labelled documents that are fitted on, about; a fifth of them sets the temperature.
TRAIN_ROWS = 8_000
HIDDEN = 32

#: Letters and digits make words, runs of other visible characters too ("$$$" or "|" is a word).
_kind = np.zeros(256, np.uint8)
_kind[33:127] = 2
_kind[48:58] = _kind[65:91] = _kind[97:123] = _kind[128:] = 1
_visible = _kind > 0


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words with their rows in the word table."""
    words = Words.__new__(Words)
    words.data, words.offsets, words._sums = data, offsets, None
    kind = _kind[data]
    before, after = np.zeros_like(kind), np.zeros_like(kind)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    before[heads] = 0
    after[heads[heads > 0] - 1] = 0
    words.start = np.flatnonzero((kind > 0) & (kind != before))
    words.end = np.flatnonzero((kind > 0) & (kind != after)) + 1
    words.first = np.searchsorted(words.start, offsets)
    rows = (words.hashes() >> U64(52)).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    return words, rows


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each row's index vector."""
    rng = np.random.default_rng(11)
    return rng.integers(0, SIZE, (WORDS, SPARSE)), rng.choice([-1.0, 1.0], (WORDS, SPARSE))


SUMS = pa.schema([("word", pa.int32()), ("seen", pa.int64()), ("vector", pa.list_(pa.float64()))])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word table of one task: one row for each word that it saw."""
    places, signs = index_vectors()
    total, seen = np.zeros(WORDS * SIZE), np.zeros(WORDS, np.int64)
    for batch in batches:
        for _, _, data, offsets in slices(batch.column(0)):
            words, rows = words_of(data, offsets)
            if not len(rows):
                continue
            seen += np.bincount(rows, minlength=WORDS)
            doc = words.doc
            for gap in range(1, REACH + 1):
                a, b = rows[:-gap], rows[gap:]
                same = doc[:-gap] == doc[gap:]
                a, b = a[same], b[same]
                for k in range(SPARSE):
                    total += np.bincount(a * SIZE + places[b, k], weights=signs[b, k], minlength=WORDS * SIZE)
                    total += np.bincount(b * SIZE + places[a, k], weights=signs[a, k], minlength=WORDS * SIZE)
    used = np.flatnonzero(seen)
    table = total.reshape(WORDS, SIZE)[used]
    vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1, dtype=np.int32) * SIZE), pa.array(table.ravel()))
    yield record_batch(SUMS, [used.astype(np.int32), seen[used], vectors])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The word table over all documents, WORDS x SIZE, rows of length 1. The sums are whole numbers, so their order is of no account."""
    parts = docs.select(text_col).mapInArrow(_contexts, "word int, seen long, vector array<double>")
    sums = parts.groupBy("word").agg(F.sum("seen").alias("seen"), *[F.sum(F.col("vector")[k]).alias(f"v{k}") for k in range(SIZE)])
    got = sums.toArrow()
    table = np.zeros((WORDS, SIZE), np.float32)
    word = got.column("word").to_numpy()
    if len(word):
        table[word] = np.stack([got.column(f"v{k}").to_numpy() for k in range(SIZE)], axis=1)
    norm = np.sqrt((table * table).sum(axis=1, keepdims=True))
    return table / np.maximum(norm, 1e-6)


def pooled(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each document: the mean and the spread of its words' vectors, and pooled counts of the words themselves."""
    words, rows = words_of(data, offsets)
    n = len(offsets) - 1
    out = np.zeros((n, 2 * SIZE + 6), np.float32)
    if not len(rows):
        return out
    counts = words.counts
    there = np.flatnonzero(counts)
    first = words.first[:-1][there]
    share = 1.0 / counts[there][:, None]
    # documents as rows of word counts, a block of documents at a time
    for k in range(0, len(there), 256):
        block = there[k : k + 256]
        a, b = words.first[block[0]], words.first[block[-1] + 1]
        at = np.repeat(np.arange(len(block)), counts[block])
        bag = np.bincount(at * WORDS + rows[a:b], minlength=len(block) * WORDS).reshape(len(block), WORDS).astype(np.float32)
        bag *= share[k : k + 256]
        mean = bag @ table
        out[block, :SIZE] = mean
        out[block, SIZE : 2 * SIZE] = np.sqrt(np.maximum(bag @ (table * table) - mean * mean, 0))
        out[block, 2 * SIZE] = (bag * bag).sum(axis=1)
        out[block, 2 * SIZE + 1] = bag.max(axis=1)
    doc = words.doc
    for c, gap in ((2, 1), (3, 2)):
        again = np.zeros(len(rows))
        again[gap:] = (rows[gap:] == rows[:-gap]) & (doc[gap:] == doc[:-gap])
        out[there, 2 * SIZE + c] = np.add.reduceat(again, first) * share[:, 0]
    head = data[words.start]
    out[there, 2 * SIZE + 4] = np.add.reduceat((_kind[head] == 2).astype(float), first) * share[:, 0]
    out[there, 2 * SIZE + 5] = np.add.reduceat(((data[np.minimum(words.start + 1, words.end - 1)] >= 65) & (data[np.minimum(words.start + 1, words.end - 1)] <= 90)).astype(float), first) * share[:, 0]
    return out


@dataclass
class Network:
    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh((x - self.center) / self.scale @ self.w1 + self.b1)
        return h @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 60, seed: int = 5) -> Network:
    """Adam on batches; the last fifth of the rows sets the temperature by the least log loss."""
    rng = np.random.default_rng(seed)
    cut = max(1, len(x) * 4 // 5)
    center, scale = x[:cut].mean(axis=0), x[:cut].std(axis=0) + 1e-3
    z = ((x[:cut] - center) / scale).astype(np.float32)
    shapes = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN,), (1,)]
    params = [(rng.normal(0, 1 / np.sqrt(s[0]), s) if k in (0, 2) else np.zeros(s)).astype(np.float32) for k, s in enumerate(shapes)]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(cut)
        for k in range(0, cut, 128):
            rows = order[k : k + 128]
            h = np.tanh(z[rows] @ params[0] + params[1])
            miss = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30))) - y[rows]) / len(rows)
            back = np.outer(miss, params[2]) * (1 - h * h)
            grads = [z[rows].T @ back + 1e-4 * params[0], back.sum(axis=0), h.T @ miss + 1e-4 * params[2], np.array([miss.sum()])]
            t += 1
            for p, g, a, b in zip(params, grads, m, v, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= 0.005 * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
    net = Network(center, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    kept = slice(cut, None) if len(x) > cut else slice(0, None)
    logits, truth = net.logits(x[kept]), y[kept]
    losses = {t: np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in np.geomspace(0.25, 8, 41)}
    net.temperature = float(min(losses, key=losses.get))
    return net


VECTORS = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("vector", pa.binary())])
SCORED = pa.schema([("id", pa.int64()), ("score", pa.float64())])


def learn(docs: DataFrame, labels: DataFrame, learnable, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network | float]:
    """Word vectors from all documents, the network from about ``rows`` labelled ones. Labels of one class, or none, give a constant."""
    table = word_vectors(docs, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def vectors(batches):
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                yield record_batch(VECTORS, [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), [r.tobytes() for r in pooled(data, offsets, shared.value)]])

    sample = labelled_sample(docs, labels, learnable, label_col, id_col, text_col, rows)
    got = sample.mapInArrow(vectors, "id long, label int, vector binary").toArrow()
    y = got.column("label").to_numpy()
    if len(set(y.tolist())) < 2:
        return table, float(y[0]) if len(y) else 0.5
    x = np.stack([np.frombuffer(b, np.float32) for b in got.column("vector").to_pylist()])
    # an order that depends on the rows alone
    key = np.array(got.column("id").to_pylist(), np.int64)
    order = np.lexsort([key, (key * 2654435761) % 1_000_003])
    return table, fit(x[order], y[order].astype(np.float32))


def score(docs: DataFrame, table: np.ndarray, net: Network | float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of each row. Null and empty texts are scored like any text without words; an id, of any type, may be
    null or repeated; an empty table gives no row; other columns, of whatever name, are left aside."""
    shared = docs.sparkSession.sparkContext.broadcast((table, net))

    def run(batches):
        table, net = shared.value
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                found = np.full(j - i, net) if isinstance(net, float) else net.scores(pooled(data, offsets, table))
                yield record_batch(typed(SCORED, batch), [batch.column(0).slice(i, j - i), found.astype(float)])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, id_schema(docs, id_col, "score double")).withColumnRenamed("id", id_col)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """id, held_out, score, predicted for each row of ``docs``, learned from labels that are not held out.

    Null ids are never held out and never learned from; null texts count as empty; repeated rows give a row each;
    an empty ``docs`` gives no row; without labels, or with those of one class, all scores are one constant.
    """
    table, net = learn(docs, labels, ~held_out(id_col), label_col, id_col, text_col)
    return score(docs, table, net, id_col, text_col).select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
