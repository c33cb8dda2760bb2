"""Language identification by hierarchical discrimination.

First the language family is predicted, then one-versus-one linear support vector
machines separate the languages within it. Features are hashed byte trigrams of the
whole text. Only the training sample, of a documented bound, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import ASCII_LOWER, id_schema, record_batch, slices, typed

DIMENSIONS = 2048
#: Learning documents a language, about.
PER_LANGUAGE = 1500

#: Families of language codes. A language that isn't here is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "da": "germanic", "sv": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic", "bg": "slavic",
}

_letters = np.zeros(256, bool)
_letters[97:123] = _letters[128:] = True


def trigram_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A unit vector of square roots of trigram counts for each document; what isn't a letter counts as a space."""
    low = ASCII_LOWER[data]
    low = np.where(_letters[low], low, 32).astype(np.uint32)
    rows = np.zeros((len(offsets) - 1, DIMENSIONS), np.float32)
    if len(low) < 3:
        return rows
    grams = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    hashed = ((grams * np.uint32(2654435761)) >> np.uint32(21)).astype(np.int64)
    for d in range(len(rows)):
        a, b = offsets[d], offsets[d + 1] - 2
        if b > a:
            rows[d] = np.bincount(hashed[a:b], minlength=DIMENSIONS)
    np.sqrt(rows, out=rows)
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.maximum(norm, 1e-9)


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, steps: int = 150) -> np.ndarray:
    """Weights (the last is the bias) of a squared-hinge linear SVM; y is -1 or 1. Accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    lipschitz = 2 * c * 2.0 * 0.5 + 1e-3 + c
    w = v = np.zeros(x.shape[1], np.float32)
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v))
        grad = 1e-3 * v - 2 * c * (x.T @ (share * y * slack))
        after = v - grad / lipschitz
        v = after + k / (k + 3) * (after - w)
        w = after
    return w


@dataclass
class Model:
    families: list[str]
    languages: dict[str, list[str]]
    top: np.ndarray  # families x (dimensions + 1), one against the rest
    pairs: dict[str, dict[tuple[int, int], np.ndarray]]

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score (0 to 1: of the weakest decision on the way)."""
        x = np.hstack([rows, np.ones((len(rows), 1), np.float32)])
        margins = x @ self.top.T
        best = margins.argmax(axis=1)
        names = np.empty(len(rows), object)
        sure = np.full(len(rows), 10.0)
        if len(self.families) > 1:
            ordered = np.sort(margins, axis=1)
            sure = ordered[:, -1] - ordered[:, -2]
        for k, family in enumerate(self.families):
            here = np.flatnonzero(best == k)
            choice = self.languages[family]
            votes = np.zeros((len(here), len(choice)))
            weakest = np.full((len(here), len(choice)), 10.0)
            for (i, j), w in self.pairs[family].items():
                m = x[here] @ w
                votes[np.arange(len(here)), np.where(m > 0, i, j)] += 1
                weakest[:, i], weakest[:, j] = np.minimum(weakest[:, i], m), np.minimum(weakest[:, j], -m)
            won = (votes + 1e-3 * np.tanh(weakest)).argmax(axis=1) if len(here) else np.zeros(0, int)
            for r, w in zip(here, won, strict=True):
                names[r] = choice[w]
            sure[here] = np.minimum(sure[here], weakest[np.arange(len(here)), won])
        return names, 1 / (1 + np.exp(-2.0 * sure))


def train(x: np.ndarray, lang: np.ndarray) -> Model:
    family = np.array([FAMILIES.get(c, f"other:{c}") for c in lang])
    families = sorted(set(family))
    top = np.stack([linear_svm(x, np.where(family == f, 1.0, -1.0).astype(np.float32)) if len(families) > 1 else np.zeros(x.shape[1] + 1, np.float32) for f in families])
    languages = {f: sorted(set(lang[family == f])) for f in families}
    pairs = {f: {} for f in families}
    for f, names in languages.items():
        for i in range(len(names)):
            for j in range(i + 1, len(names)):
                here = (lang == names[i]) | (lang == names[j])
                pairs[f][i, j] = linear_svm(x[here], np.where(lang[here] == names[i], 1.0, -1.0).astype(np.float32))
    return Model(families, languages, top, pairs)


LEARN = pa.schema([("lang", pa.string()), ("vector", pa.binary())])
SCORED = pa.schema([("id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def learn(docs: DataFrame, learnable, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """Fits on a sample, chosen by hash, of about ``per_language`` documents a language; None without any."""
    rows = docs.where(learnable & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    limit = F.lit(0)
    for lang, n in counts.items():
        limit = F.when(F.col("lang") == lang, round(1_000_000 * min(1.0, per_language / n))).otherwise(limit)
    sample = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000)) < limit)

    def vectors(batches):
        for batch in batches:
            for i, j, data, offsets in slices(batch.column(0)):
                yield record_batch(LEARN, [batch.column(1).slice(i, j - i), [v.astype(np.float16).tobytes() for v in trigram_rows(data, offsets)]])

    got = sample.select("text", "lang").mapInArrow(vectors, "lang string, vector binary").toArrow()
    x = np.stack([np.frombuffer(v, np.float16) for v in got.column(1).to_pylist()]).astype(np.float32)
    lang = np.array(got.column(0).to_pylist(), dtype=object)
    order = np.lexsort([x[:, k] for k in range(8)])  # rows come in any order; the sums of training do not
    return train(x[order], lang[order])


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score for each row. Null texts and texts without a letter are 'und' with score 0. An id, of any type,
    may be null or repeated; an empty table gives no row; other columns, of whatever name, are left aside."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size depends on the number of languages only
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("lettered"))

    def run(batches: Iterator[pa.RecordBatch]):
        model = shared.value
        for batch in batches:
            lettered = np.array(batch.column(2).to_pylist(), bool)
            for i, j, data, offsets in slices(batch.column(1)):
                names, scores = np.full(j - i, "und", object), np.zeros(j - i)
                if model is not None:
                    found, sure = model.predict(trigram_rows(data, offsets))
                    names, scores = np.where(lettered[i:j], found, "und"), np.where(lettered[i:j], sure, 0.0)
                yield record_batch(typed(SCORED, batch), [batch.column(0).slice(i, j - i), list(names), scores])

    return rows.mapInArrow(run, id_schema(docs, id_col, "lang_pred string, score double")).withColumnRenamed("id", id_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred, score: learns from two thirds of the documents (by crc32 of the id), predicts all.

    Null ids are not held out; null languages are not learned; without anything to learn from, all are 'und'. Null, empty,
    repeated and very long texts as in ``predict``.
    """
    out = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
    model = learn(docs, ~out, id_col, text_col, lang_col)
    return predict(docs, model, id_col, text_col).select(id_col, out.alias("held_out"), "lang_pred", "score")

