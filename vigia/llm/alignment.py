"""Cross-tokenizer alignment: which tokens of two tokenizers end at the same byte of a text.

Each slice of a batch stays in Arrow from end to end: the token lists are flattened with their
parent indices, byte ends are segmented cumulative sums of the tokens' lengths, an Acero hash join
on (document, end) keys finds the common ends, and ``Table.group_by`` counts the linked id pairs,
of a document and then of a task. Spark merges the tasks' counts.

The table of pair counts is bounded by the vocabularies, whatever the corpus: tokens that end
together agree from the end, so the shorter one is a suffix of the longer, and there are at most
``pair_bound`` such pairs. That bound is what allows to send the counts to every task.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import give_back, id_schema, materialize, record_batch, typed

#: Bytes of text that are encoded and aligned at once (a longer text is one step).
STEP_BYTES = 1 << 20
#: Rows of partial counts that a task holds before it adds them up again.
PARTIAL_ROWS = 1 << 20

ALIGNED = pa.schema([("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
                     ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])
COUNTED = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
DIGEST = pa.schema([("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE of the ``tokenizers`` library (the JSON text of its file); gets the text with a space before it."""

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(content.decode())
        self.tokenizer.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]

    def token_bytes(self) -> list[bytes]:
        alphabet = byte_alphabet()
        found = {i: bytes(alphabet[c] for c in t) for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        return [found.get(i, b"") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]

    def cuts(self) -> bool:
        """Whether texts fall into words by the usual expression, unchanged, and no plain text is an added token."""
        form = json.loads(self.tokenizer.to_str())
        pre = form["pre_tokenizer"] or {}
        return pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not form["normalizer"] and all(t["special"] for t in form["added_tokens"])


class Pieces:
    """A SentencePiece model (the bytes of its file); it puts the space before the text by itself."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=content)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def token_bytes(self) -> list[bytes]:
        m = self.model
        spelled = lambda i: bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
        return [spelled(i) for i in range(m.get_piece_size())]


def load(path: str) -> tuple[str, bytes]:
    """(kind, content) of a tokenizer file: JSON is byte-level, another file is a SentencePiece model."""
    with open(path, "rb") as f:
        content = f.read()
    return ("bytes" if content.lstrip()[:1] == b"{" else "pieces"), content


@dataclass
class Side:
    """One tokenizer inside a task: how it encodes, the bytes and the decimal spelling of each id as Arrow arrays, and whether texts may be cut into words."""

    tokenizer: ByteLevel | Pieces
    bytes: pa.Array
    spelled: pa.Array
    cuts: bool = False


_sides: dict[bytes, Side] = {}


def side(kind: str, content: bytes) -> Side:
    key = hashlib.sha1(content).digest()
    if key not in _sides:
        tokenizer = (ByteLevel if kind == "bytes" else Pieces)(content)
        listed = tokenizer.token_bytes()
        _sides[key] = Side(tokenizer, pa.array(listed, pa.large_binary()), pa.array([str(i) for i in range(len(listed))], pa.large_string()), kind == "bytes" and tokenizer.cuts())  # pieces of whole texts cost less than their words
    return _sides[key]


def pair_bound(a: Side, b: Side) -> int:
    """How many pairs of ids can end together at most: those of which one is a suffix of the other."""
    of_a, of_b = Counter(a.bytes.to_pylist()), Counter(b.bytes.to_pylist())
    ends = lambda one, other, first: sum(n * other[t[k:]] for t, n in one.items() for k in range(first, len(t)))
    return ends(of_a, of_b, 0) + ends(of_b, of_a, 1)


@dataclass
class Flat:
    """The tokens of a slice: document, id, byte end within the document; bytes of all tokens one after the other; bytes of each document."""

    doc: np.ndarray
    id: pa.Array
    end: np.ndarray
    data: np.ndarray
    size: np.ndarray


#: A space between two characters that are no white space: the usual expression of byte-level vocabularies cuts before it.
CUT = re.compile(r"(?<=\S) (?=\S)")


def _encoded(texts: list[str], s: Side) -> pa.ListArray:
    """The ids of each text, as if it were encoded whole. Where the tokenizer allows it (``Side.cuts``), texts are cut into words, and each
    distinct word of the slice is encoded once: those without white space at an end as one text, the others each as a text. Where a
    token reaches over the end of a word in bytes, or a word is not spelled byte for byte, all texts are encoded whole."""
    whole = lambda: pa.array([x if t else [] for x, t in zip(s.tokenizer.encode(texts), texts, strict=True)], pa.list_(pa.int32()))
    if not s.cuts:
        return whole()
    cut = [CUT.split(t) if t else [] for t in texts]
    code = pa.array([w for words in cut for w in words], pa.large_string()).dictionary_encode()
    listed = code.dictionary.to_pylist()
    odd = np.array([w[0].isspace() or w[-1].isspace() for w in listed], bool)
    order = np.argsort(odd, kind="stable")  # the place of a word: plain ones first
    plain = len(listed) - int(odd.sum())
    alone = [listed[k] for k in order[plain:]]
    ids = pa.array([i for x in s.tokenizer.encode(([" ".join([listed[k] for k in order[:plain]])] if plain else []) + alone) for i in x], pa.int32())
    reach = pc.cumulative_sum(pc.binary_length(s.bytes.take(ids)).cast(pa.int64())).to_numpy()
    ends = np.cumsum(1 + pc.binary_length(code.dictionary).to_numpy()[order])
    last = np.searchsorted(reach, ends, side="right")  # tokens up to the end of each word
    if len(ends) and (last[-1] != len(ids) or (last == 0).any() or (reach[last - 1] != ends).any()):
        return whole()
    counts = np.diff(last, prepend=0)
    place = np.empty(len(listed), np.int64)
    place[order] = np.arange(len(listed))
    word = place[code.indices.to_numpy()]
    per = counts[word]
    upto = np.concatenate([[0], np.cumsum(per)])
    tokens = np.repeat((last - counts)[word] - upto[:-1], per) + np.arange(upto[-1])
    return pa.ListArray.from_arrays(pa.array(upto[np.concatenate([[0], np.cumsum([len(words) for words in cut])]).astype(np.int64)], pa.int32()), ids.take(pa.array(tokens)))


def _flat(column: pa.ListArray, s: Side) -> Flat:
    doc, ids = pc.list_parent_indices(column).to_numpy(), pc.list_flatten(column)
    spelled = s.bytes.take(ids)
    reach = np.concatenate([[0], pc.cumulative_sum(pc.binary_length(spelled)).to_numpy()])  # over the slice
    first = column.offsets.to_numpy()
    data = spelled.buffers()[2]
    return Flat(doc, ids, reach[1:] - reach[first[:-1]][doc], np.frombuffer(data, np.uint8)[: reach[-1]] if data is not None else np.zeros(0, np.uint8), np.diff(reach[first]))


def _kept(flat: Flat, keep: np.ndarray) -> Flat:
    """Without the tokens of documents that aren't kept."""
    if keep.all():
        return flat
    tokens = keep[flat.doc]
    return Flat(flat.doc[tokens], flat.id.filter(pa.array(tokens)), flat.end[tokens], flat.data[np.repeat(keep, flat.size)], np.where(keep, flat.size, 0))


def _same(data: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each document whether its ``size`` bytes in ``data`` are those in ``other``."""
    wrong = np.flatnonzero(data != other)
    same = np.ones(len(size), bool)
    same[np.searchsorted(np.cumsum(size), wrong, side="right")] = False
    return same


def _joined(strings: pa.Array, offsets: np.ndarray, by: str) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), strings), pa.scalar(by, strings.type))


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def align(texts: list[str], a: Side, b: Side) -> list:
    """Columns n_a, n_b, n_groups, groups_sha256, and the lists a, b, n of the linked id pairs with their number of links."""
    n, some = len(texts), [t or "" for t in texts]
    spaced = pa.array([f" {t}" for t in some], pa.large_string())
    size = np.where(np.array([t != "" for t in some], bool), pc.binary_length(spaced).to_numpy(), 0)
    sides = [_flat(_encoded(some, s), s) for s in (a, b)]
    keep = (sides[0].size == size) & (sides[1].size == size)
    whole = np.frombuffer(spaced.buffers()[2], np.uint8)
    starts = np.concatenate([[0], np.cumsum(pc.binary_length(spaced).to_numpy())])[:-1]
    while True:  # a second time only if the bytes of some document differ
        sides, size = [_kept(f, keep) for f in sides], np.where(keep, size, 0)
        text = whole[np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(size.sum())] if not keep.all() or len(whole) != size.sum() else whole
        keep = keep & _same(sides[0].data, text, size) & _same(sides[1].data, text, size)
        if size[~keep].sum() == 0:
            break
    step = int(size.max(initial=0)) + 1
    flat = [pa.table({"key": f.doc * np.int64(step) + f.end, x: f.id, f"at_{x}": np.arange(len(f.doc))}) for f, x in zip(sides, "ab", strict=True)]
    met = flat[0].join(flat[1], keys="key", join_type="inner", use_threads=False)
    met = met.take(pc.sort_indices(met["at_a"])).combine_chunks()
    doc = met["key"].to_numpy() // step
    groups = np.bincount(doc, minlength=n)
    cuts = [np.concatenate([[0], met[f"at_{x}"].to_numpy() + 1]) for x in "ab"]
    parts = [_joined(s.spelled.take(f.id), c, ",") for s, f, c in zip((a, b), sides, cuts, strict=True)]
    spelled = _joined(pc.binary_join_element_wise(*parts, pa.scalar("|", parts[0].type)), np.concatenate([[0], np.cumsum(groups)]), ";")
    digests = [hashlib.sha256(x.as_buffer()).hexdigest() if g else "" for x, g in zip(spelled, groups, strict=True)]
    pairs = pa.table({"doc": doc, "a": met["a"], "b": met["b"]}).group_by(["doc", "a", "b"], use_threads=False).aggregate([([], "count_all")])
    pairs = pairs.take(pc.sort_indices(pairs["doc"])).combine_chunks()
    per = np.bincount(pairs["doc"].to_numpy(), minlength=n)
    lists = [_lists(pairs[c].combine_chunks().cast(t), per) for c, t in (("a", pa.int32()), ("b", pa.int32()), ("count_all", pa.int64()))]
    return [*(np.bincount(f.doc, minlength=n) for f in sides), groups, digests, *lists]


def _steps(column: pa.Array) -> Iterator[tuple[int, int, list[str | None]]]:
    """(first row, end row, texts) of runs of whole rows of about ``STEP_BYTES``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, done = 0, 0
    while first < len(column):
        end = max(int(np.searchsorted(ends, done + STEP_BYTES, side="right")), first + 1)
        yield first, end, column.slice(first, end - first).to_pylist()
        first, done = end, int(ends[end - 1])
    give_back()


def alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, n_a, n_b, n_groups, groups_sha256, and lists a, b, n: the id pairs linked in it and their number of links.

    A link is a token of A and one of B that end at the same byte. Null and empty texts, and those that a tokenizer
    doesn't spell byte for byte, have no tokens: zeros, an empty digest and empty lists. Ids may be null or repeated, of
    any type; a text is encoded whole, whatever its length; an empty table gives no row; other columns, of whatever
    name, are left aside. The tokenizers' files are read on the driver and sent to the tasks.
    """
    files = docs.sparkSession.sparkContext.broadcast((load(path_a), load(path_b)))

    def run(batches):
        a, b = (side(*x) for x in files.value)
        for batch in batches:
            for i, j, texts in _steps(batch.column(1)):
                yield record_batch(typed(ALIGNED, batch), [batch.column(0).slice(i, j - i), *align(texts, a, b)])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, id_schema(docs, id_col, "n_a long, n_b long, n_groups long, groups_sha256 string, a array<int>, b array<int>, n array<long>"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n): how many links of the corpus hold each id pair. Counts are added up in each task before the shuffle."""

    def run(batches):
        held: list[pa.Table] = []

        def added() -> pa.Table:
            found = pa.concat_tables(held).group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")])
            return found.rename_columns(["a", "b", "n"]).cast(COUNTED)

        for batch in batches:
            held.append(pa.table({c: pc.list_flatten(batch.column(k)) for k, c in enumerate("abn")}).cast(COUNTED))
            if sum(map(len, held)) > PARTIAL_ROWS:
                held[:] = [added()]
        if held:
            yield from added().to_batches()

    parts = aligned.select("a", "b", "n").mapInArrow(run, "a int, b int, n long")
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"))


def best_links(counts: DataFrame) -> DataFrame:
    """(a, b, n, best): whether no other A id is linked more often to this B id (ties are all best)."""
    most = counts.groupBy("b").agg(F.max("n").alias("_most"))
    return counts.join(most, "b").select("a", "b", "n", (F.col("n") == F.col("_most")).alias("best"))


def digest(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; rows as in ``alignments``.

    The aligned documents are written once, so that no text is encoded twice; the pair counts, bounded by the two
    vocabularies (``pair_bound``), are sent to the tasks that sum them up.
    """
    aligned = materialize(alignments(docs, path_a, path_b, id_col, text_col), "aligned")
    found = best_links(materialize(pair_counts(aligned), "pair-counts")).toArrow()
    code = (found["a"].to_numpy().astype(np.int64) << 32) | found["b"].to_numpy()
    order = np.argsort(code)
    known = docs.sparkSession.sparkContext.broadcast((code[order], found["n"].to_numpy()[order], found["best"].to_numpy()[order]))

    def run(batches):
        codes, counts, best = known.value
        for batch in batches:
            a, b, n = (batch.column(k) for k in (5, 6, 7))
            doc, times = pc.list_parent_indices(a).to_numpy(), pc.list_flatten(n).to_numpy()
            at = np.searchsorted(codes, (pc.list_flatten(a).to_numpy().astype(np.int64) << 32) | pc.list_flatten(b).to_numpy())

            def summed(x, doc=doc, rows=batch.num_rows):
                out = np.zeros(rows, np.int64)
                np.add.at(out, doc, x)
                return out

            yield record_batch(typed(DIGEST, batch), [*batch.columns[:4], summed(times), summed(times * best[at]), summed(times * counts[at]), batch.column(4)])

    columns = id_schema(docs, id_col, "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return aligned.mapInArrow(run, columns).withColumnRenamed("id", id_col)


def default_paths() -> tuple[str, str]:
    """The public tokenizers that the query uses; their paths are parameters everywhere else."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
