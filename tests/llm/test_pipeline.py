"""The stages of the corpus pipeline, each against a plain version of itself on its own input."""

import hashlib
import os
import re

from pyspark.sql import functions as F

import corpus_pipeline
from vigia.llm import sentencepiece_codec
from vigia.llm.queries import queries
from vigia.llm.textops import shared_folder

from .test_pairs_and_copies import brute_components, brute_hits, shingles

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact dedup", "n-gram jaccard join", "benchmark decontamination", "sentencepiece"]

    clean = stages["toxicity"](spark, docs, SF)
    judged = {r["doc_id"]: r["predicted"] for r in queries()["op8_toxicity"](spark, SF).collect()}
    rows = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == columns and rows.keys() == {i for i, p in judged.items() if not p}

    once = stages["exact dedup"](spark, spark.createDataFrame(list(rows.values()), docs.schema), SF)
    last = {}
    for i, r in rows.items():
        last[r["text"]] = max(i, last.get(r["text"], i))
    kept = {r["doc_id"]: r for r in once.collect()}
    assert once.columns == columns and kept.keys() == set(last.values())

    far = stages["n-gram jaccard join"](spark, spark.createDataFrame(list(kept.values()), docs.schema), SF)
    ids = sorted(kept)
    roots = brute_components([shingles(kept[i]["text"]) for i in ids])
    single = {r["doc_id"]: r for r in far.collect()}
    assert far.columns == columns and single.keys() == {ids[k] for k, root in enumerate(roots) if root == k}

    fresh = stages["benchmark decontamination"](spark, spark.createDataFrame(list(single.values()), docs.schema), SF)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[k : k + 13]) for _, t in items for w in [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())] for k in range(max(1, len(w) - 12))}
    suspects = [i for i, r in single.items() if any(w[0] in r["text"].lower() for w in windows)]
    bad = {i for i in suspects for n, hit, _ in [brute_hits(single[i]["text"], items)] if hit and 20 * hit >= n}
    left = {r["doc_id"]: r for r in fresh.collect()}
    assert fresh.columns == columns and left.keys() == single.keys() - bad

    tokens = stages["sentencepiece"](spark, spark.createDataFrame(list(left.values()), docs.schema), SF).collect()
    encoder = sentencepiece_codec.Encoder(sentencepiece_codec.load_vocabulary(sentencepiece_codec.default_model()))
    assert {r["doc_id"] for r in tokens} == left.keys()
    for r in tokens:
        assert r["round_trip"] and encoder.decode(r["ids"]) == left[r["doc_id"]]["text"]
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


ROWS = [
    (1, "you are a lovely reader of this short note", "en", "web", 5, "a", 1), (9, "you are a lovely reader of this short note", "en", "web", 5, "b", 2), (None, "you are a lovely reader of this short note", None, None, None, None, None),
    (4, None, "en", "web", None, "c", 3), (5, "", "en", "web", 0, "d", 4), (6, "   \n", "en", "web", 0, "e", 5), (7, "one two", "en", "web", 1, "f", 6), (7, "one two", "en", "web", 1, "f", 6), (8, "one two", "en", "web", 1, "g", 7),
    (20, " ".join(f"w{k}" for k in range(60)), "en", "web", 1, "h", 8), (21, " ".join(f"w{k}" for k in range(59)) + " tail", "en", "web", 1, "i", 9), (22, "long " * 30_000, "en", "web", 1, "j", 10),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _block string, _lost int"


def test_stages_on_nulls_repeats_long_texts_and_clashing_names(spark):
    """What each stage keeps of a table with columns whose names its own steps use."""
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    left = lambda name, df=docs: stages[name](spark, df, SF)
    ids = lambda df: sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["_lost"] or 0) for r in df.collect())
    every = ids(docs)

    sample = spark.read.parquet(f"{SF}/documents.parquet")  # has the labels that are learned from
    mixed = docs.withColumn("doc_id", F.col("doc_id") + 10**6).unionByName(sample.select("*", F.lit(None).cast("string").alias("_block"), F.lit(None).cast("int").alias("_lost")))
    clean = left("toxicity", mixed)
    mine = [r["text"] for r in clean.where("doc_id >= 1000000 or doc_id is null").collect()]
    assert clean.columns == docs.columns and 100 < clean.count() < mixed.count()
    assert len(mine) > 5 and all(mine.count(t) == sum(r[1] == t for r in ROWS) for t in set(mine))  # equal texts go or stay together
    once = left("exact dedup")  # null counts as empty: of 4 and 5 the latter stays; 7 twice and 8 are one group
    assert once.columns == docs.columns and ids(once) == sorted(x for x in every if x[1] not in (1, 4, 7) or not x[0])
    far = left("n-gram jaccard join")  # the smallest id of a group stays, as often as it is there; what has no word links with nothing
    assert far.columns == docs.columns and ids(far) == sorted(x for x in every if x[1] not in (8, 9, 21))
    fresh = left("benchmark decontamination")
    assert fresh.columns == docs.columns and ids(fresh) == every
    tokens = left("sentencepiece").collect()
    assert len(tokens) == len(ROWS) and all(r["round_trip"] for r in tokens) and sum(r["n_tokens"] == 0 for r in tokens) == 2


def test_a_run_leaves_only_what_its_result_reads(spark):
    """Once the rows are written, one table can go: the input of the last stage."""
    folder = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) > 100 and [x.split("-")[0] for x in set(os.listdir(folder)) - before] == ["benchmark"]
