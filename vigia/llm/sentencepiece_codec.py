"""SentencePiece encoding and decoding by a depth-first walk over a trie of marked words.

A marked word is a run of word marks (the visible space) with the characters up to the
next mark. No piece reaches over such a border, so a text's pieces are those of its
words. The distinct words of a slice are sorted; in that order the common prefix of
neighbours is a path of their trie, and walking the list is walking the trie depth
first. The forward state of each prefix stays on a stack and is reused by all words
that share it:

* unigram models: the best score of the prefix and the last piece on its best path
  (Viterbi);
* BPE models: the last piece of the prefix's encoding. A sequence of pieces is a BPE
  encoding exactly if each neighbouring pair is, so that each prefix has one last piece
  that fits the state before it, and the walk gives the merges' own result.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textops import give_back, id_schema, record_batch, typed

MARK = "▁"
#: Characters of a batch that are worked on at once.
SLICE_CHARS = 2_000_000
#: Distinct words whose pieces, and neighbouring pieces whose fit, a worker remembers: of each, two generations of so many.
CACHE_WORDS, CACHE_PAIRS = 250_000, 250_000


@dataclass
class Vocabulary:
    """What a model file holds, small enough to broadcast (its size is that of the vocabulary)."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]  # may be matched in a text
    bytes: list[int]  # ids of the 256 byte pieces, or []
    unknown: int
    kind: str  # 'bpe' or 'unigram'


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte = message[at]
            at, value, shift = at + 1, value | (byte & 127) << shift, shift + 7
            if byte < 128:
                return value

    while at < len(message):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield number, message[at : at + size]
            at += size


#: Numbers of fields of a model file, and of its kinds of model.
TRAINER, NORMALIZER = 2, 3
MODEL_TYPE, MARK_AS_SUFFIX = 3, 24
CHARACTER_MAP, DUMMY_PREFIX, REMOVE_EXTRA_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
KINDS = {1: "unigram", 2: "bpe"}


def model_kind(serialized: bytes) -> str:
    """'unigram' or 'bpe'. A model that changes texts before it cuts them, or doesn't mark words in front, is refused: it would be encoded wrongly."""
    parts = {n: dict(_fields(v)) for n, v in _fields(serialized) if n in (TRAINER, NORMALIZER)}
    trainer, normalizer = parts.get(TRAINER, {}), parts.get(NORMALIZER, {})
    kind = KINDS.get(trainer.get(MODEL_TYPE, 1))
    changes = normalizer.get(CHARACTER_MAP) or normalizer.get(REMOVE_EXTRA_SPACES, 1) or not normalizer.get(DUMMY_PREFIX, 1) or not normalizer.get(ESCAPE_SPACES, 1)
    if kind is None or changes or trainer.get(MARK_AS_SUFFIX, 0):
        raise ValueError(f"this model's {'type' if kind is None else 'normaliser'} isn't supported: unigram or BPE, texts as they are, a word mark in front")
    return kind


def load_vocabulary(model_path: str) -> Vocabulary:
    """Reads a model file on the driver; its kind is read from the file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = range(sp.get_piece_size())
    at = {sp.id_to_piece(i): i for i in ids}
    spelled = [f"<0x{b:02X}>" for b in range(256)]
    return Vocabulary(
        [sp.id_to_piece(i) for i in ids],
        [sp.get_score(i) for i in ids],
        [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in ids],
        [at[s] for s in spelled] if all(s in at and sp.is_byte(at[s]) for s in spelled) else [],
        sp.unk_id(),
        model_kind(sp.serialized_model_proto()),
    )


class Recent(dict):
    """What was met lately: at most ``size`` new entries and as many from before. A hit among the older ones makes it new again."""

    def __init__(self, size: int):
        self.size, self.older = size, {}

    def __missing__(self, key):
        found = self.older.get(key)
        if found is not None:
            self.remember(key, found)
        return found

    def remember(self, key, value) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.ids = {p: i for i, p in enumerate(vocabulary.pieces) if vocabulary.normal[i]}
        self.longest = max(map(len, self.ids), default=1)
        self.joined = {c for p in self.ids if len(p) > 1 for c in p}
        self.known = Recent(CACHE_WORDS)
        self.fits = Recent(CACHE_PAIRS)
        self.halves: dict[str, tuple[str, str]] = {}
        self.low = min(vocabulary.scores, default=0.0) - 10.0
        if vocabulary.kind == "bpe":
            longer = sorted((p for p in self.ids if len(p) > 1), key=lambda p: -vocabulary.scores[self.ids[p]])
            self.rank = {p: k for k, p in enumerate(longer)}
            #: pieces of several characters, read from their end: the 0 of a node says that a piece begins there
            self.ends: dict = {}
            for p in longer:
                node = self.ends
                for c in reversed(p):
                    node = node.setdefault(c, {})
                node[0] = True

    def merges(self, text: str, stop: int = 0) -> list[str]:
        """BPE by its definition: the best-scored neighbours are joined first, the leftmost of equals; ends at ``stop`` parts."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple] = []
        left_over = len(parts)

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (k := self.rank.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (k, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap and left_over > stop:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= len(parts) or parts[j] != right:
                continue
            parts[i], parts[j] = left + right, None
            left_over -= 1
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def _halves(self, piece: str) -> tuple[str, str]:
        """The two pieces that are joined last when ``piece`` comes about."""
        found = self.halves.get(piece)
        if found is None:
            parts = self.merges(piece, 2)
            found = self.halves[piece] = (parts[0], parts[-1])
        return found

    def _fit(self, left: str, right: str) -> bool:
        """Whether both stay as they are side by side: their merges are undone, the latest first, and nothing
        that could be joined across the border may come before what was undone."""
        rank = self.rank.get
        a, b, limit = left, right, len(self.rank)
        while True:
            joined = rank(a + b)
            if joined is not None and joined < limit:
                found = False
                break
            ra, rb = rank(a, -1), rank(b, -1)
            if ra > rb:
                limit, a = ra, self._halves(a)[1]
            elif rb >= 0:
                limit, b = rb + 1, self._halves(b)[0]
            else:
                found = True
                break
        self.fits.remember((left, right), found)
        return found

    def _bpe(self, word: str, first: int, last: list) -> None:
        """Adds the last pieces of the prefixes that end after ``first``; last[j] is that of the prefix of j characters."""
        ends, fits, fit = self.ends, self.fits, self._fit
        for i in range(first, len(word) + 1):
            node, k, begins = ends, i, []
            while k:
                k -= 1
                node = node.get(word[k])
                if node is None:
                    break
                if 0 in node:
                    begins.append(k)
            for k in reversed(begins):
                piece = word[k:i]
                if k:
                    good = fits[last[k], piece]
                    if good is None:
                        good = fit(last[k], piece)
                    if not good:
                        continue
                last.append(piece)
                break
            else:
                last.append(word[i - 1])

    def _viterbi(self, word: str, first: int, last: list) -> None:
        """Adds (score, last piece) of the best paths to the prefixes that end after ``first``."""
        for i in range(first, len(word) + 1):
            best = None
            for j in range(max(0, i - self.longest), i):
                piece = word[j:i]
                k = self.ids.get(piece)
                if k is None and j < i - 1:
                    continue
                score = (last[j][0] if j else 0.0) + (self.v.scores[k] if k is not None else self.low)
                if best is None or score > best[0]:
                    best = (score, piece)
            last.append(best)

    def _path(self, word: str, last: list) -> list[int]:
        out, i = [], len(word)
        while i:
            piece = last[i] if self.v.kind == "bpe" else last[i][1]
            out.append(piece)
            i -= len(piece)
        ids = []
        for piece in reversed(out):
            k = self.ids.get(piece)
            if k is not None:
                ids.append(k)
            elif self.v.bytes:
                ids += [self.v.bytes[b] for b in piece.encode()]
            elif not ids or ids[-1] != self.v.unknown:
                ids.append(self.v.unknown)
        return ids

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Pieces of distinct words: the trie walk."""
        found: dict[str, list[int]] = {}
        last: list = [None]
        previous = ""
        walk = self._bpe if self.v.kind == "bpe" else self._viterbi
        for word in sorted(words):
            shared, most = 0, min(len(word), len(previous))
            while shared < most and word[shared] == previous[shared]:
                shared += 1
            del last[shared + 1 :]
            walk(word, shared + 1, last)
            found[word] = self._path(word, last)
            previous = word
        return found

    def split(self, text: str) -> list[str]:
        """Marked words of a text; a character in no longer piece is a word of its own."""
        if not text:
            return []
        words, lead = [], ""
        for chunk in text.replace(" ", MARK).split(MARK):
            lead += MARK
            if chunk:  # a run of marks belongs to the word after it
                words.append(lead + chunk)
                lead = ""
        if lead:
            words.append(lead)
        return words

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        parts = [self._cut(self.split(t)) if t else [] for t in texts]
        here = {w: self.known[w] for w in set().union(*parts)}
        for w, ids in self.encode_words([w for w, ids in here.items() if ids is None]).items():
            here[w] = array("i", ids).tobytes()
            self.known.remember(w, here[w])
        return [np.frombuffer(b"".join([here[w] for w in p]), dtype=np.int32) for p in parts]

    def _cut(self, words: list[str]) -> list[str]:
        """Cuts at line feeds when they stand in no longer piece, the case in which lines glue words together."""
        if "\n" in self.joined:
            return words
        out = []
        for w in words:
            if "\n" in w:
                head = w.split("\n")
                for i, part in enumerate(head):
                    if i:
                        out.append("\n")
                    if part:
                        out.append(part)
            else:
                out.append(w)
        return out

    def decode(self, ids) -> str:
        """The text of ids: byte pieces are joined to characters, marks become spaces, the first one goes."""
        if not hasattr(self, "spelled"):
            at = {k: bytes([b]) for b, k in enumerate(self.v.bytes)}
            self.spelled = [at.get(i) or (p.replace(MARK, " ").encode() if self.v.normal[i] else " ⁇ ".encode() if i == self.v.unknown else b"") for i, p in enumerate(self.v.pieces)]
        spelled = self.spelled
        text = b"".join([spelled[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_encoders: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One for each worker process, so that what it has learned outlives a task."""
    if shared.id not in _encoders:
        _encoders.clear()
        _encoders[shared.id] = Encoder(shared.vocabulary)
    return _encoders[shared.id]


class _Shared:
    """A broadcast vocabulary with a name that stays the same in every task."""

    def __init__(self, spark: SparkSession, vocabulary: Vocabulary):
        self.broadcast = spark.sparkContext.broadcast(vocabulary)
        self.id = hashlib.sha1("\0".join(vocabulary.pieces).encode()).hexdigest()

    @property
    def vocabulary(self) -> Vocabulary:
        return self.broadcast.value


def _runs(column: pa.Array) -> Iterator[tuple[int, int, list[str | None]]]:
    """(first row, end row, texts) of runs of whole rows of about ``SLICE_CHARS`` bytes; a longer text is a run of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, done = 0, 0
    while first < len(column):
        end = max(int(np.searchsorted(ends, done + SLICE_CHARS, side="right")), first + 1)
        yield first, end, column.slice(first, end - first).to_pylist()
        first, done = end, int(ends[end - 1])
    give_back()


ENCODED = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))])
DECODED = pa.schema([("id", pa.int64()), ("text", pa.string())])
CHECKED = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("round_trip", pa.bool_()), ("ids", pa.list_(pa.int32()))])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32), type=pa.int32()))


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ids of each row. Null and empty texts have no ids; rows are kept as they come, with any id, null or repeated;
    a text of any length is encoded whole; an empty table gives no row; other columns, of whatever name, are left aside."""
    shared = _Shared(docs.sparkSession, load_vocabulary(model_path))

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            for i, j, texts in _runs(batch.column(1)):
                yield record_batch(typed(ENCODED, batch), [batch.column(0).slice(i, j - i), _lists(encoder.encode_batch(texts))])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, id_schema(docs, id_col, "ids array<int>")).withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and text of each row of ids; null ids give the empty text; rows as in ``encode``."""
    shared = _Shared(tokens.sparkSession, load_vocabulary(model_path))

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            yield record_batch(typed(DECODED, batch), [batch.column(0), [encoder.decode(x or []) for x in batch.column(1).to_pylist()]])

    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, id_schema(tokens, id_col, "text string")).withColumnRenamed("id", id_col)


def encode_checked(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 (of the ids joined by commas), round_trip (the ids decode to the text), ids.

    Null and empty texts have no ids, the digest of the empty string and a round trip to the empty text. Rows as in ``encode``.
    """
    shared = _Shared(docs.sparkSession, load_vocabulary(model_path))

    def run(batches):
        encoder = _encoder(shared)
        spelled = [str(i) for i in range(len(shared.vocabulary.pieces))]
        for batch in batches:
            for i, j, texts in _runs(batch.column(1)):
                ids = encoder.encode_batch(texts)
                digests, back = [], []
                for a, t in zip(ids, texts, strict=True):
                    listed = a.tolist()
                    digests.append(hashlib.sha256(",".join([spelled[k] for k in listed]).encode()).hexdigest())
                    back.append(encoder.decode(listed) == (t or ""))
                yield record_batch(typed(CHECKED, batch), [batch.column(0).slice(i, j - i), [len(a) for a in ids], digests, back, _lists(ids)])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, id_schema(docs, id_col, "n_tokens long, ids_sha256 string, round_trip boolean, ids array<int>")).withColumnRenamed("id", id_col)


def default_model() -> str:
    """The public model that the queries use; its path is a parameter everywhere else."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")
