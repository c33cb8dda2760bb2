"""Cross-tokenizer alignment against a plain version with the two libraries, one text at a time."""

import collections
import hashlib

import pytest

from vigia.llm import alignment

TEXTS = [None, "", " ", "\n", "Hello  world", "  lead and trail ", "日本語 ☃ text\nnext line", "a▁b is spelled otherwise", "aaaaaaaaaaaaaaaaaaaa", "<s> </s> <|endoftext|> <0x0A>",
         "tab\there \x00 nul", "x" * 3000, "the " * 4000, "Hello  world", "naïve café – “quoted” 😀", "é combining"]


@pytest.fixture(scope="module")
def sides():
    return [alignment.side(*alignment.load(p)) for p in alignment.default_paths()]


def plain(texts, sides):
    """Per text (n_a, n_b, groups as strings, links), by loops."""
    out = []
    for t in texts:
        tokens = []
        for s in sides:
            ids, at, ends = s.tokenizer.encode([t or ""])[0] if t else [], 0, {}
            spelled = b"".join(s.bytes[i].as_py() for i in ids)
            for i in ids:
                at += len(s.bytes[i].as_py())
                ends[at] = i
            tokens.append((spelled, ends))
        if not t or any(spelled != b" " + t.encode() for spelled, _ in tokens):
            out.append((0, 0, [], []))
            continue
        (_, a), (_, b) = tokens
        common, before, groups = sorted(a.keys() & b.keys()), 0, []
        for end in common:
            groups.append("|".join(",".join(str(x[e]) for e in sorted(x) if before < e <= end) for x in (a, b)))
            before = end
        out.append((len(a), len(b), groups, [(a[e], b[e]) for e in common]))
    counts = collections.Counter(link for *_, links in out for link in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(na, nb, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for na, nb, groups, links in out]


def values(row):
    return tuple(row[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))


def test_digest_equals_a_plain_version(spark, sides, monkeypatch):
    sample = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    texts = TEXTS + sample
    docs = spark.createDataFrame([(i, t, -1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n int, a string").repartition(5)
    expected = plain(texts, sides)
    for step in (1, 1 << 20):
        monkeypatch.setattr(alignment, "STEP_BYTES", step)
        got = {r["doc_id"]: values(r) for r in alignment.digest(docs, *alignment.default_paths()).collect()}
        assert [got[i] for i in range(len(texts))] == expected
    assert expected[7][0] == 0 and expected[4][2] > 1


def test_null_and_repeated_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "one two"), (3, "one two"), (3, "one two"), (3, None)], "doc_id long, text string")
    rows = alignment.digest(docs, *alignment.default_paths()).collect()
    assert sorted((r["doc_id"] is None, r["n_links"], r["count_sum"]) for r in rows) == [(False, 0, 0), (False, 2, 6), (False, 2, 6), (True, 2, 6)]
    assert alignment.digest(docs.limit(0), *alignment.default_paths()).collect() == []


def test_pairs_stay_below_the_bound_of_the_vocabularies(spark, sides):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    aligned = alignment.alignments(docs, *alignment.default_paths())
    links = {(r["a"], r["b"]) for r in alignment.pair_counts(aligned).collect()}
    a, b = ([x.as_py() for x in s.bytes] for s in sides)
    assert all(a[x].endswith(b[y]) or b[y].endswith(a[x]) for x, y in links)
    assert 1000 < len(links) < alignment.pair_bound(*sides) < 1_000_000


def test_partial_counts_are_added_up_within_a_task(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "one two three") for i in range(300)], "doc_id long, text string")
    aligned = alignment.alignments(docs, *alignment.default_paths())
    monkeypatch.setattr(alignment, "PARTIAL_ROWS", 2)
    assert {r["n"] for r in alignment.pair_counts(aligned).collect()} == {300}


def test_repeated_words_are_encoded_once_and_ids_are_those_of_whole_texts(monkeypatch):
    odd = [None, "", " a", "a ", "  a  b ", "a \n b", "don't  do 'll x's", "x ▁y ▁ z▁ q", "<s> </s> <|endoftext|> a", "　a b", "\x1c a b\x1d c", "é é ́x", "日本 語", "\x00 a b", "a\tb c", "1 2 33 4'5", "a b" * 5]
    texts = [t or "" for t in odd] + ["the same words " * 500] * 3
    for path in alignment.default_paths():
        s = alignment.side(*alignment.load(path))
        assert alignment._encoded(texts, s).to_pylist() == [x if t else [] for x, t in zip(s.tokenizer.encode(texts), texts, strict=True)]
        assert alignment._encoded([], s).to_pylist() == []
    s, sizes = alignment.side(*alignment.load(alignment.default_paths()[0])), []
    encode = s.tokenizer.encode
    monkeypatch.setattr(s.tokenizer, "encode", lambda x: sizes.append(sum(map(len, x))) or encode(x))
    alignment.align(["the same words " * 500] * 3, s, alignment.side(*alignment.load(alignment.default_paths()[1])))
    assert sizes and max(sizes) < 100
