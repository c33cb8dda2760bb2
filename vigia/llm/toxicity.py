"""Toxicity: a counterfactual-regularised linear classifier.

Features are words and word beginnings, by hash; the vocabulary is chosen from the
labelled sample. Labelled texts have counterfactuals: where a text names a group, its
identity terms are swapped for others of their set, and into every text terms of a set
are put that were not there. The square of the change in score, between terms and against
the plain text, is added to the loss, so that a neutral mention of a group does not move
the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import ASCII_LOWER, U64, Words, byte_class, hash_word, id_schema, materialize, record_batch, slices, without

#: Labelled documents that are fitted on, about; features that are kept; documents that must have a feature.
TRAIN_ROWS, VOCABULARY, LEAST_DOCS = 12_000, 2_000, 4
#: Bytes of a word that count as its beginnings, at most: a character is never cut.
BEGINNINGS = (4, 5, 6)
L1, COUNTERFACTUAL = 2e-4, 5.0

#: Sets of identity terms in the languages of the corpus; those of one set are swapped for each other.
IDENTITY = [
    ["women", "men", "girls", "boys"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist"],
    ["black", "white", "asian", "latino", "arab"],
    ["gay", "lesbian", "straight", "transgender", "bisexual"],
    ["immigrant", "refugee", "citizen", "foreigner"],
    ["young", "old", "disabled", "deaf", "blind"],
    ["frauen", "männer", "mädchen", "jungen"],
    ["muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch"],
    ["schwarze", "weiße", "asiaten", "araber"],
    ["schwul", "lesbisch", "heterosexuell", "transgeschlechtlich"],
    ["einwanderer", "flüchtlinge", "bürger", "ausländer"],
    ["femmes", "hommes", "filles", "garçons"],
    ["musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"],
    ["noirs", "blancs", "asiatiques", "arabes"],
    ["gai", "lesbienne", "hétérosexuel", "transgenre"],
    ["immigré", "réfugié", "citoyen", "étranger"],
    ["mujeres", "hombres", "niñas", "niños"],
    ["musulmán", "cristiano", "judío", "hindú", "budista", "ateo"],
    ["negros", "blancos", "asiáticos", "árabes"],
    ["homosexual", "lesbiana", "heterosexual", "transgénero"],
    ["inmigrante", "refugiado", "ciudadano", "extranjero"],
]

WORD = byte_class("alnum")
#: Identity terms have no beginnings among the features: what is said of a group is swapped with its term.
NAMED = np.array(sorted(hash_word(t.encode()) for terms in IDENTITY for t in terms), U64)


def feature_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, list[np.ndarray]]:
    """The words of a slice and, for each kind of feature, its hash at each word (0: not there)."""
    words = Words(ASCII_LOWER[data], offsets, WORD)
    if not len(words):
        return words, [np.zeros(0, U64)]
    size = words.end - words.start
    out = [words.hashes()]
    plain = NAMED[np.minimum(np.searchsorted(NAMED, out[0]), len(NAMED) - 1)] != out[0]
    for k in BEGINNINGS:
        out.append(np.where((size > k) & plain, words.hashes(k) ^ U64(k * 0x51ED2701), U64(0)))
    return words, out


class Vocabulary:
    """Sorted feature hashes with a small table that rules out most words before the search."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes.astype(U64))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.hashes & U64(0xFFFF)).astype(np.int64)] = True

    def __len__(self) -> int:
        return len(self.hashes)

    def place(self, hashes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.hashes, hashes)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, feature, count) of a slice."""
        words, kinds = feature_hashes(data, offsets)
        docs, marks, doc = [], [], words.doc
        for h in kinds:
            at = np.flatnonzero(self.maybe[(h & U64(0xFFFF)).astype(np.int64)])
            place = self.place(h[at])
            good = (place < len(self.hashes)) & (self.hashes[np.minimum(place, len(self.hashes) - 1)] == h[at]) if len(self.hashes) else np.zeros(len(at), bool)
            docs.append(doc[at[good]])
            marks.append(place[good])
        pair, n = np.unique(np.concatenate(docs) * max(1, len(self.hashes)) + np.concatenate(marks), return_counts=True)
        return pair // max(1, len(self.hashes)), pair % max(1, len(self.hashes)), n


@dataclass
class Model:
    vocabulary: Vocabulary
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, mark, n = self.vocabulary.counts(data, offsets)
        z = self.bias + np.bincount(doc, weights=self.weights[mark] * np.log1p(n), minlength=len(offsets) - 1) if len(doc) else np.full(len(offsets) - 1, self.bias)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Swaps:
    """Feature changes, one for each labelled text and identity term swapped or put in: ``gone`` falls by ``loss``, ``come`` rises by ``gain``."""

    gone: np.ndarray
    loss: np.ndarray
    come: np.ndarray
    gain: np.ndarray

    def __len__(self) -> int:
        return len(self.gone)

    def change(self, weights: np.ndarray) -> np.ndarray:
        return self.gain * weights[self.come] - self.loss * weights[self.gone]

    def back(self, change: np.ndarray, size: int) -> np.ndarray:
        """In single precision, as the matrix of the texts is: otherwise that would be copied in double precision at each step."""
        return (np.bincount(self.come, self.gain * change, size) - np.bincount(self.gone, self.loss * change, size)).astype(np.float32)


def swaps(vocabulary: Vocabulary, doc: np.ndarray, mark: np.ndarray, n: np.ndarray, sets=IDENTITY) -> Swaps:
    """Counterfactuals of the labelled texts: terms that are there for others of their set, and terms that are put in.

    The k-th text takes two terms of the k-th set (counted round): the one is put in, the other is put in, and the
    one is put in for the other."""
    parts: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0)]]

    def add(*columns) -> None:
        for part, x in zip(parts, np.broadcast_arrays(*columns), strict=True):
            part.append(x)

    size = int(doc.max(initial=-1)) + 1
    for k, terms in enumerate(sets):
        place = [int(vocabulary.place(np.array([hash_word(t.encode())], U64))[0]) for t in terms]
        held = np.zeros((size, len(terms)), np.int64)  # texts of the sample by terms of the set
        for i, m in enumerate(place):
            held[doc[mark == m], i] = n[mark == m]
        for i, m in enumerate(place):
            texts = np.flatnonzero(held[:, i])
            for other, to in enumerate(place):
                if other != i and len(texts):
                    own, there = held[texts, i], held[texts, other]
                    add(m, np.log1p(own), to, np.log1p(there + own) - np.log1p(there))
        own = np.arange(k, size, len(sets))
        turn = own // len(sets)
        one, two = turn % len(terms), (turn + 1) % len(terms)
        gain = lambda i: np.log1p(held[own, i] + 1) - np.log1p(held[own, i])  # noqa: B023, E731
        at = np.array(place)
        add(at[one], 0.0, at[one], gain(one))
        add(at[two], 0.0, at[two], gain(two))
        add(at[one], gain(one), at[two], gain(two))
    return Swaps(*(np.concatenate(p) for p in parts))


def fit(x: np.ndarray, y: np.ndarray, changes: Swaps, l1: float = L1, penalty: float = COUNTERFACTUAL, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model with an L1 norm and the counterfactual penalty: accelerated proximal steps."""
    w, b = np.zeros(x.shape[1], np.float32), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    v, c = w, b
    balance = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum())).astype(np.float32)
    b = c = 0.0
    # a bound of the curvature: the largest eigenvalue, by power steps
    u = np.full(x.shape[1], 1 / np.sqrt(max(1, x.shape[1])), np.float32)
    for _ in range(12):
        u = x.T @ (balance * (x @ u)) * np.float32(0.25) + np.float32(2 * penalty / max(1, len(changes))) * changes.back(changes.change(u), len(u)) + np.float32(1e-6)
        size = float(np.linalg.norm(u))
        u = u / np.float32(max(size, 1e-9))
    rate = 1 / (1.5 * size + 0.5)
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ v + np.float32(c), -30, 30)))
        miss = balance * (p - y)
        grad = x.T @ miss
        if len(changes):
            grad += np.float32(2 * penalty / len(changes)) * changes.back(changes.change(v), len(v))
        after = v - np.float32(rate) * grad
        after = np.sign(after) * np.maximum(np.abs(after) - np.float32(rate * l1), np.float32(0))
        bias = c - rate * float(miss.sum())
        pull = np.float32(k / (k + 3))
        v, c, w, b = after + pull * (after - w), bias + pull * (bias - b), after, bias
    return w, b


COUNTED = pa.schema([("feature", pa.int64()), ("toxic", pa.int64()), ("clean", pa.int64())])
VECTORS = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("marks", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, by label; added up for a batch before they leave."""
    for batch in batches:
        labels = np.array(batch.column(2).to_pylist(), np.int64)
        for i, j, data, offsets in slices(batch.column(1)):
            words, kinds = feature_hashes(data, offsets)
            doc = words.doc
            pairs = np.unique(np.stack([np.concatenate([doc] * len(kinds)).astype(U64), np.concatenate(kinds)], axis=1), axis=0) if len(words) else np.zeros((0, 2), U64)
            pairs = pairs[pairs[:, 1] != 0]
            feature, at = np.unique(pairs[:, 1], return_inverse=True)
            toxic = np.bincount(at, weights=labels[i:j][pairs[:, 0].astype(np.int64)], minlength=len(feature)).astype(np.int64) if len(pairs) else np.zeros(0, np.int64)
            total = np.bincount(at, minlength=len(feature))
            yield record_batch(COUNTED, [feature.view(np.int64), toxic, total - toxic])


def labelled_sample(docs: DataFrame, labels: DataFrame, learnable, label_col: str, id_col: str, text_col: str, rows: int) -> DataFrame:
    """id (a hash of it), text, label of about ``rows`` labelled documents, chosen by hash of the id.

    Labels that are null are left out; an id labelled twice takes the larger label. The chosen ids
    are at most a little more than ``rows``, so that side is small by construction.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).where(learnable).groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    n = marked.count()
    share = F.lit(round(1_000_000 * min(1.0, rows / max(1, n))))
    chosen = marked.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < share).select(F.col(id_col).alias("id"), "label")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "id").select(F.xxhash64("id").alias("id"), F.coalesce("text", F.lit("")).alias("text"), "label")


def learn(sample: DataFrame, vocabulary: int = VOCABULARY, sets=IDENTITY, least_docs: int = LEAST_DOCS, penalty: float = COUNTERFACTUAL) -> Model:
    """Fits on ``sample`` (id, text, label), which is bounded; no labels, or those of one class, give a constant.

    Of the features of at least ``least_docs`` texts, the ``vocabulary`` that tell the classes apart best are kept."""
    spark = sample.sparkSession
    sample = sample.persist()
    found = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(found) < 2:
        sample.unpersist()
        return Model(Vocabulary(np.zeros(0, U64)), np.zeros(0, np.float32), 4.0 if found.get(1) else -4.0)
    n1, n0 = found[1], found[0]
    counted = sample.mapInArrow(_features, "feature long, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).where(F.col("a") + F.col("b") >= least_docs)
    # log odds, times how often: what tells the classes apart comes first
    odds = F.log((F.col("a") + 0.5) / (n1 - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (n0 - F.col("b") + 0.5))
    top = counted.select("feature", (F.abs(odds) * F.sqrt((F.col("a") + F.col("b")).cast("double"))).alias("_rank")).orderBy(F.desc("_rank"), "feature").limit(vocabulary)
    chosen = np.array([r["feature"] for r in top.collect()], np.int64).view(U64)
    named = np.array([hash_word(t.encode()) for terms in sets for t in terms], U64)
    words = Vocabulary(np.concatenate([chosen, named]))
    shared = spark.sparkContext.broadcast(words)

    def vectors(batches):
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(1)):
                doc, mark, n = shared.value.counts(data, offsets)
                cut = np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x.astype(np.int32))) for x in (mark, n)]
                yield record_batch(VECTORS, [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), *lists])

    got = sample.mapInArrow(vectors, "id long, label int, marks array<int>, counts array<int>").orderBy("id").toArrow().combine_chunks()
    sample.unpersist()
    marks, counts = got.column("marks").combine_chunks(), got.column("counts").combine_chunks()
    doc = np.repeat(np.arange(len(got)), np.diff(marks.offsets.to_numpy()))
    mark, n = marks.flatten().to_numpy(), counts.flatten().to_numpy()
    x = np.zeros((len(got), len(words)), np.float32)
    x[doc, mark] = np.log1p(n)
    weights, bias = fit(x, got.column("label").to_numpy().astype(np.float32), swaps(words, doc, mark, n, sets), penalty=penalty)
    return Model(words, weights.astype(np.float64), bias)


def _score_batches(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, ...): id, what stands after the text, and the score."""
    for batch in batches:
        schema = pa.schema([*(batch.schema.field(k) for k in range(batch.num_columns) if k != 1), pa.field("score", pa.float64())])
        others = [batch.column(k) for k in range(batch.num_columns) if k != 1]
        for i, j, data, offsets in slices(batch.column(1)):
            yield record_batch(schema, [*(c.slice(i, j - i) for c in others), shared.value.scores(data, offsets)])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of each row. Null and empty texts have the score of no word at all; an id, of any type, may be
    null or repeated; an empty table gives no row; other columns, of whatever name, are left aside."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the model's vocabulary
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda it: _score_batches(it, shared), id_schema(docs, id_col, "score double")).withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """id, held_out, score, predicted for each row of ``docs``, learned from labels that are not held out.

    Null ids are never held out and never learned from; null texts count as empty; repeated rows give a row each;
    an empty ``docs`` gives no row; without labels, or with those of one class, all scores are one constant.
    """
    model = learn(labelled_sample(docs, labels, ~held_out(id_col), label_col, id_col, text_col, TRAIN_ROWS))
    return score(docs, model, id_col, text_col).select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows predicted toxic; columns unchanged, whatever their names.

    Only id and text go through the scoring task. Rejected rows are told by two hashes of id and text, so that rows
    with a null id, and texts that share an id, are each judged by themselves; equal rows have equal scores. Null and
    empty texts are scored as texts without a word; an empty table gives no row.
    """
    model = learn(labelled_sample(docs, labels, ~held_out(id_col), "toxic", id_col, text_col, TRAIN_ROWS))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    marks = [F.xxhash64(id_col, text_col), F.xxhash64(text_col)]
    rows = docs.select(marks[0].alias("id"), F.col(text_col).alias("text"), marks[1].alias("mark"))
    scored = rows.mapInArrow(lambda it: _score_batches(it, shared), "id long, mark long, score double")
    lost = materialize(scored.where(F.col("score") >= threshold).select(F.col("id").alias("_lost_id"), F.col("mark").alias("_lost_mark")).distinct(), "toxic")
    return without(docs, lost, marks, [lost["_lost_id"], lost["_lost_mark"]])
