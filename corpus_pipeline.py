"""The corpus pipeline: five stages, each a job that is written and read again before the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``; all but the last
return the columns they got, whatever their names. An empty table gives an empty one; texts are read
whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigia.llm import decontamination, exact_dedup, ngram_join, sentencepiece_codec, toxicity
from vigia.llm.textops import discard, materialize, scratch, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null and empty texts have the score of no word at all; rows with a null or a shared id are each judged by
    their own text, so that equal rows go or stay together; without labels, or with those of one class, all have one score."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays. Null counts as the empty text. A row that is there several times with the id that stays is
    kept each time; rows with a null id stay, as which row it is can't be told."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links join, the one with the smallest id stays. Null, empty and wordless texts link with nothing and stay, and so
    do rows with a null id and repeated rows of the smallest id; texts that share an id are each judged by themselves."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of whose words a twentieth or more stands in benchmark windows; the others stay as they are. Null, empty and wordless texts stay; equal
    texts are judged alike, whatever their id; an empty benchmark takes nothing away."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with a check that they decode to its text: a row for each row. Null and empty texts have no ids."""
    return sentencepiece_codec.encode_checked(docs, sentencepiece_codec.default_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: A classifier, components of links and a tokenizer are not SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other. What a stage writes on its way goes when its rows are written, and these when the next stage's are; what is
    left, and read by the result, is the input of the last stage."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            kept = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"), folder=shared_folder(spark))
        if before is not None:
            discard(before)
        docs = before = kept
    return STAGES[-1][1](spark, docs, sf_dir)
