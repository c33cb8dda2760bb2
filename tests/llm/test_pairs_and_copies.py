"""Exact dedup, n-gram join and decontamination against brute force on small tables."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from vigia.llm import decontamination, exact_dedup, ngram_join
from vigia.llm.components import connected
from vigia.llm.textops import ASCII_LOWER, Words, byte_class, hash_word, slices

SCHEMA = "doc_id long, text string, keep_id string, _id int"


def table(spark, texts, schema=SCHEMA):
    """Documents 0.. with two columns whose names clash with those of the operators."""
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], schema).repartition(3)


def near_copies(seed=3, bases=12):
    rng = random.Random(seed)
    words = ["ab", "cd", "éf", "gh", "the", "Of", "x9", "longer", "tail"]
    out = []
    for _ in range(bases):
        base = [rng.choice(words) + str(rng.randint(0, 60)) for _ in range(rng.randint(3, 80))]
        for _ in range(rng.randint(1, 7)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(rng.choice([" ", "\n", " \t"]).join(copy))
    passage = " ".join(f"shared{i}" for i in range(12))
    out += [passage + " " + " ".join(f"w{k}{i}" for i in range(30)) for k in range(40)]
    return [*out, None, "", "   \n", "one", "one", "ONE", "one two three four", "One two  three four", "a b c d e", "x" * 5000, "y " * 3000]


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_components(sets):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize(("block", "crowd"), [(256, 32), (3, 2)])
def test_ngram_join_is_exact(spark, monkeypatch, block, crowd):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    texts = near_copies()
    sets = [shingles(t) for t in texts]
    got = {r["doc_id"]: r for r in ngram_join.join(table(spark, texts)).collect()}
    assert len(got) == len(texts)
    assert [got[i]["n_shingles"] for i in range(len(texts))] == [len(s) for s in sets]
    assert [got[i]["component_id"] for i in range(len(texts))] == brute_components(sets)


def test_ngram_join_chain_and_blocks():
    """Links only through the middle of a chain, whatever the order of a block."""
    base = np.arange(100, dtype=np.uint64)
    chain = [base + np.uint64(9 * k) for k in range(5)]
    edges = ngram_join.link_block([10, 11, 12, 13, 14], chain)
    assert {tuple(sorted(e)) for e in edges} >= {(10, 11), (11, 12), (12, 13), (13, 14)}


def test_ngram_join_empty_and_repeated(spark):
    assert ngram_join.join(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g")], "doc_id long, text string")
    # a row with a null id is a document too
    found = [(r["doc_id"], r["component_id"]) for r in ngram_join.join(rows).collect()]
    assert sorted(found, key=lambda f: (f[0] is None, f)) == [(1, 1), (1, 1), (2, 1), (None, 1)]
    kept = ngram_join.one_of_each(rows).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept if r["doc_id"] is not None) == [(False, 1), (False, 1)]


def test_ngram_join_ids_that_name_no_row(spark):
    """An id with two texts, null ids, and ids that are strings."""
    a, b, c = "a b c d e f g", "h i j k l m n o", "p q r s t u v"
    rows = spark.createDataFrame([(5, a, 1), (3, a, 1), (5, b, 1), (None, c, 1), (None, c, 1), (7, None, 1)], "doc_id long, text string, n int")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(rows).collect()), key=str)
    assert got == sorted([(5, 3, 3), (3, 3, 3), (5, 4, 5), (None, 3, None), (None, 3, None), (7, 0, 7)], key=str)
    left = ngram_join.one_of_each(rows)
    assert left.columns == rows.columns
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted([(3, a), (5, b), (None, c), (None, c), (7, None)], key=str)
    named = spark.createDataFrame([("x", a), ("b", a), ("c", b)], "doc_id string, text string")
    assert sorted((r["doc_id"], r["component_id"]) for r in ngram_join.join(named).collect()) == [("b", "b"), ("c", "c"), ("x", "b")]
    assert sorted(r["doc_id"] for r in ngram_join.one_of_each(named).collect()) == ["b", "c"]


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(20)]
    best = {}
    for a, b in edges:
        best.setdefault(a, a), best.setdefault(b, b)
    for _ in range(len(edges)):
        for a, b in edges:
            best[a] = best[b] = min(best[a], best[b])
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got.get(n, n) == c for n, c in best.items())


def test_exact_dedup(spark):
    texts = ["same", "same", None, "", "Same", "same ", "x" * 70 + "a", "x" * 70 + "b", "x" * 70 + "a", "é" * 40, "long " * 40_000]
    got = {r["doc_id"]: r for r in exact_dedup.decisions(table(spark, texts)).collect()}
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        alike = [k for k, u in enumerate(plain) if u == t]
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (max(alike), len(alike), i == max(alike))
        assert got[i]["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    kept = exact_dedup.drop_duplicates(table(spark, texts))
    assert kept.columns == ["doc_id", "text", "keep_id", "_id"]
    assert {r["doc_id"] for r in kept.collect()} == {max(k for k, u in enumerate(plain) if u == t) for t in plain}


def test_exact_dedup_empty_null_ids_and_repeats(spark):
    assert exact_dedup.decisions(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = spark.createDataFrame([(None, "a"), (1, "a"), (2, "a"), (2, "a"), (None, "b")], "doc_id long, text string")
    got = exact_dedup.decisions(rows).collect()
    assert len(got) == 5
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got if r["doc_id"] is not None} == {(1, 2, 4, False), (2, 2, 4, True)}
    assert all(r["kept"] for r in got if r["doc_id"] is None)


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute_hits(text, items):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(WORD, low)
    hit, used = set(), set()
    for item, body in items:
        own = re.findall(WORD, (body or "").lower())
        k = min(13, len(own))
        for a in range(len(own) - k + 1 if k else 0):
            for p in range(len(words) - k + 1):
                if words[p : p + k] == own[a : a + k]:
                    hit |= set(range(p, p + k))
                    used.add(item)
    return len(words), len(hit), sorted(used)


def contaminated_tables():
    rng = random.Random(11)
    pool = [f"t{i}" for i in range(40)] + ["Aé", "z9"]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.choice([3, 8, 13, 20, 40])))) for i in range(25)]
    items += [(25, None), (26, ""), (27, "--- !!"), (28, "solo"), (29, items[4][1]), (30, "t1 t1 t1 t1")]
    texts = [None, "", "...", "Solo", "t1 t1 t1 t1 t1 t1 t1"]
    for _ in range(60):
        text = [rng.choice(pool) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            body = (rng.choice(items)[1] or "").split()
            at = rng.randint(0, len(text))
            text[at:at] = body[rng.randint(0, 3) :]
        texts.append(rng.choice([" ", ", ", "\n"]).join(text).upper() if rng.random() < 0.3 else " - ".join(text))
    return texts, items


@pytest.mark.parametrize("block_windows", [decontamination.BLOCK_WINDOWS, 90])
def test_decontamination(spark, block_windows):
    texts, items = contaminated_tables()
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = {r["doc_id"]: r for r in decontamination.report(table(spark, texts), bench, block_windows=block_windows).collect()}
    for i, text in enumerate(texts):
        n, hit, used = brute_hits(text, items)
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"]) == (n, hit, len(used)), text
        assert got[i]["items_sha256"] == decontamination.items_digest(used)
        assert got[i]["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_many_blocks_give_what_one_gives(spark):
    """Null, repeated and shared ids of documents, and an item without an id."""
    items = [(1, "a b c d e"), (None, "red green blue"), (2, "blue white"), (3, "c d e f g h")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(None, "x a b c d e f g h"), (None, "red green blue white"), (7, "blue white"), (7, "nothing here"), (8, None), (8, None), (9, "red green blue")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_hit int")
    one, many = (sorted(map(str, decontamination.report(docs, bench, block_windows=k).collect())) for k in (1000, 2))
    assert one == many and len(one) == len(rows)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"]) for r in decontamination.report(docs, bench, block_windows=2).collect())
    assert got == [("7", 2, 0, 0), ("7", 2, 2, 1), ("8", 0, 0, 0), ("8", 0, 0, 0), ("9", 3, 3, 0), ("None", 4, 4, 1), ("None", 9, 8, 2)]
    left = decontamination.drop_contaminated(docs, bench, block_windows=2)
    assert left.columns == docs.columns and sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == [(7, "nothing here"), (8, ""), (8, "")]
    named = docs.select(F.concat(F.lit("d"), F.coalesce("doc_id", F.lit(0))).alias("doc_id"), "text")
    assert sorted(r["text"] or "" for r in decontamination.strip_spans(named, bench, block_windows=2).collect()) == ["", "", "", "", "", "nothing here", "x "]


def test_removal_spans(spark):
    bench = spark.createDataFrame([(1, "red green blue"), (2, "blue white")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "ä Red, green; blue white end"), (2, None), (3, "nothing")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in decontamination.strip_spans(docs, bench).collect()}
    assert got == {1: "ä  end", 2: None, 3: "nothing"}


def test_decontamination_without_benchmark_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.report(table(spark, ["a b", None]), none).collect()
    assert [(r["n_hit"], r["contaminated"]) for r in got] == [(0, False), (0, False)]
    assert decontamination.report(spark.createDataFrame([], SCHEMA), none).count() == 0


def test_fm_index_finds_what_is_there():
    rng = np.random.default_rng(2)
    sequence = rng.integers(0, 5, 400)
    sequence[-1] = 0
    index = decontamination.FMIndex(sequence, 4)
    for _ in range(60):
        at = int(rng.integers(0, 390))
        phrase = sequence[at : at + int(rng.integers(1, 6))]
        if (phrase == 0).any():
            continue
        w = decontamination.Windows(np.arange(4), np.pad(phrase, (13 - len(phrase), 0))[None, :], np.array([len(phrase)]), np.array([0, 1]), np.array([0]))
        low, high = index.search(w)
        found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        assert found == [p for p in range(400 - len(phrase) + 1) if (sequence[p : p + len(phrase)] == phrase).all()]


def test_words_and_hashes():
    texts = pa.array(["Ab cd", None, "", " é\tab ", "cd" * 9])
    for _, _, data, offsets in slices(texts, 7):
        words = Words(ASCII_LOWER[data], offsets, byte_class("space"))
        for a, b, h in zip(words.start, words.end, words.hashes(), strict=True):
            assert int(h) == hash_word(bytes(words.data[a:b]))
    assert hash_word(b"ab") != hash_word(b"ba")
