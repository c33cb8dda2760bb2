"""Merkle manifest against a plain version: lists, loops and hashlib."""

import hashlib
import random
import zlib

import pytest

from vigia.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, _g string, leaf int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def up(nodes):
    """(top, for each leaf its levels of (left, right) siblings)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, k in enumerate(at):
            first = k - k % 3
            ways[leaf].append((nodes[first:k], nodes[k + 1 : first + 3]))
        at, nodes = [k // 3 for k in at], [digest(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], ways


def plain(rows):
    """Rows (id, leaf, subroot, root, proof, folded, verified), sorted."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row, leaf_of(row, row[4])))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        tops[s] = up([leaf for _, leaf in groups[s]])
    root, over = up([tops[s][0] for s in order])
    out = []
    for s, more in zip(order, over, strict=True):
        for (row, leaf), way in zip(groups[s], tops[s][1], strict=True):
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            folded = leaf_of(row, row[4].replace("\n", "")) if changed else leaf
            for left, right in way + more:
                folded = digest(*left, folded, *right)
            proof = digest(*(h for left, right in way + more for h in left + right))
            out.append((row[0], leaf, tops[s][0], root, proof, folded, folded == root))
    return out


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, v) for v in r))


def texts(n, seed=1):
    rng = random.Random(seed)
    return [rng.choice([None, "", "a\nb", "line\n\nline", "é 日本 " * rng.randint(1, 9), "same"]) for _ in range(n)]


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_equals_a_plain_version(spark, levels):
    rng = random.Random(levels)
    ids = rng.sample(range(-5000, 5000), 60) + [2**40 + k for k in range(9)] + [-(2**62), 2**62, 2**63 - 1, -(2**63)]
    rows = [(i, rng.choice([None, "", "web", "wéb", "z"]) if k % 3 else "web", rng.choice([None, "en"]), k, t) for k, (i, t) in enumerate(zip(ids, texts(len(ids)), strict=True))]
    rows.append((7_000, "alone", None, None, "x\ny" * 5000))
    assert ordered(merkle.manifest(made(spark, rows), merkle.FIELDS, deep=levels).collect()) == ordered(plain(rows))


def test_null_and_repeated_ids_are_leaves_of_their_own(spark):
    rows = [(i, s, "en", 1, t) for i, s, t in [(None, "a", "x"), (None, "a", "y\n"), (None, None, "x"), (5, "a", "q\n"), (5, "a", "q\n"), (5, "a", "r\n"), (5, "b", "q\n"), (4, "a", "w"), (6, "a", None), (69, "a", "\n")]]
    rows += [(5, "a", "en", 1, "q\n")] * 7
    got, expected = ordered(merkle.manifest(made(spark, rows), merkle.FIELDS).collect()), ordered(plain(rows))
    assert got == expected and len({r[3] for r in got}) == 1


def test_one_row_and_no_row(spark):
    one = [(1, None, None, None, None)]
    assert ordered(merkle.manifest(made(spark, one), merkle.FIELDS).collect()) == ordered(plain(one))
    assert plain(one)[0][4] == hashlib.sha256(b"").hexdigest()
    none = merkle.manifest(made(spark, one).limit(0), merkle.FIELDS)
    assert none.collect() == [] and none.columns[0] == "doc_id"


def test_documents_of_the_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select(*merkle.FIELDS).collect()]
    got = merkle.manifest(docs, merkle.FIELDS).collect()
    assert ordered(got) == ordered(plain(rows))
    assert any(not r["verified"] for r in got) and any(r["verified"] for r in got)
