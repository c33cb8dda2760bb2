"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Each step looks only at the rows that the step before could not tell apart. The
first two steps move narrow rows (id, length, prefix hash); the full content is
hashed only for rows whose length and prefix another row shares.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import discard, join_counted, materialize, picked, without

#: Characters that the prefix hash covers.
PREFIX_CHARS = 64


def _shared(rows: DataFrame, keys: list[str], total: int) -> DataFrame:
    """The rows whose keys another row has too."""
    many = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return join_counted(rows, many, keys, "left_semi", total)


def _head(text: Column) -> Column:
    return F.xxhash64(F.substring(text, 1, PREFIX_CHARS))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=lambda text: text) -> DataFrame:
    """Rows of groups of equal texts of at least two rows: id, keep_id (largest id), group_size, text_sha256, _len, _head.

    ``normalise`` is a Column function applied first (identity by default). Null counts as the
    empty text, so null and empty rows are equal. A row repeated with its id counts, and is returned,
    as often as it is there. A row with a null id counts in group_size; keep_id is null if no row of
    the group has an id. An empty table, or one without equal texts, gives no row.
    """
    text: Column = normalise(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    narrow = materialize(rows.select("_id", F.octet_length("_text").alias("_len"), _head(F.col("_text")).alias("_head")), "dedup-narrow")
    total = narrow.count()
    alike = materialize(_shared(narrow, ["_len"], total), "dedup-lengths")
    # the survivors are written, so that their size is known when the plan for the content is made
    ids = materialize(_shared(alike, ["_len", "_head"], total).distinct(), "dedup-survivors")
    # hashed where they are read, so that no text is shuffled: what the picking lets through beside them is dropped after
    likely = picked(rows, [rows["_id"]], ids, [ids["_id"]], mark="_held").select("_id", "_held", F.octet_length("_text").alias("_len"), _head(F.col("_text")).alias("_head"), F.sha2("_text", 256).alias("_sha"))
    same = likely["_id"].eqNullSafe(ids["_id"]) & (likely["_len"] == ids["_len"]) & (likely["_head"] == ids["_head"]) & (likely["_held"] >= 0)
    full = materialize(likely.join(ids, same, "left_semi").drop("_held"), "dedup-hashed")
    discard(narrow, alike, ids)
    equal = full.groupBy("_sha", "_len").agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_keep")).where("_n > 1").withColumn("_size", F.col("_n"))
    return join_counted(full, equal, ["_sha", "_len"], "inner", total).select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"), F.col("_sha").alias("text_sha256"), "_len", "_head")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows of a group that do not have its largest id; columns unchanged, whatever their names.

    A repeated row (same id and text) is kept once for each time it stands there. Rows with a null id stay: which row
    it is can't be told. An empty table gives no row. The join is by id, length and prefix; only rows that agree in these are hashed as a whole.
    """
    found = groups(docs, id_col, text_col)
    lost = found.where(F.col(id_col) != F.col("keep_id"))
    lost = materialize(lost.select(F.col(id_col).alias("_lost_id"), F.col("_len").alias("_lost_len"), F.col("_head").alias("_lost_head"), F.col("text_sha256").alias("_lost_sha")).distinct(), "dedup-lost")
    text = F.coalesce(docs[text_col], F.lit(""))
    # both hashes are 64 characters; contains, unlike equality, is no key of the join, so that it is worked out for matches only
    key, lost_key = [docs[id_col], F.octet_length(text), _head(text)], [lost["_lost_id"], lost["_lost_len"], lost["_lost_head"]]
    return without(docs, lost, key, lost_key, F.sha2(text, 256).contains(lost["_lost_sha"]))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty. A row with a null id has its group's size and keep_id (null if no row of the group has
    an id) and is kept, as which row it is can't be told. Repeated rows give a row each; an empty table gives none;
    other columns, of whatever name, are left aside.
    """
    every = docs.select(F.col(id_col).alias("_id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("_digest"))
    found = groups(docs, id_col, text_col).select(F.col(id_col).alias("_found"), "keep_id", "group_size", "text_sha256").distinct()
    joined = every.join(found, F.col("_id").eqNullSafe(F.col("_found")) & (F.col("_digest") == F.col("text_sha256")), "left")
    keep = F.when(F.col("group_size").isNull(), F.col("_id")).otherwise(F.col("keep_id"))
    return joined.select(F.col("_id").alias(id_col), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.coalesce(F.col("_id") == keep, F.lit(True)).alias("kept"), F.col("_digest").alias("text_sha256"))
