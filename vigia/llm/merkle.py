"""Merkle manifest of a dataset: a digest for each row, for each group and for the whole, and a proof for each row.

Leaf coordinates come from bitmaps, not from sorting the rows. The ids of a group are merged into 64-bit words (only
words that hold an id are kept), a popcount directory holds what comes before each word, level by level of 65,536
entries, and the rank of an id is what its word's entry says and the bits below its own.

The tree is then reduced by slots. A block of 3^6 consecutive nodes of a group is one keyed array of slots, from which a
task makes six levels at once; the blocks' nodes are the slots of the next round. The same tables, read from the root
down, give every leaf the siblings on its way. No step holds more than a block, whatever the size of a group.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.ranks import cumulated
from .textops import discard, give_back, materialize, record_batch

FAN = 3
#: Levels that one block of slots makes; it has FAN ** BLOCK_LEVELS slots.
BLOCK_LEVELS = 6
#: Added to an id's word, so that words count from 0 for the least id of 64 bits.
FIRST_WORD = 1 << 57
#: Bits of an entry of the popcount directory above the words of 64 ids.
DIRECTORY_BITS = 16


def encoded(column: Column) -> Column:
    """A value as the digest takes it: ``-`` if null, else its UTF-8 byte count, a colon, the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _digest(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(encoded, columns)), 256))


def leaves(docs: DataFrame, fields: list[str], text_col: str, id_col: str, group_col: str) -> DataFrame:
    """_g (group; the empty string for null), id, leaf, other (leaf of the tampered row; null if it is no other), _row."""
    columns = {c: docs[c] for c in fields}
    tampered = [F.replace(docs[text_col], F.lit("\n"), F.lit("")) if c == text_col else x for c, x in columns.items()]
    chosen = F.pmod(F.crc32(docs[id_col].cast("string").cast("binary")), F.lit(2)) == 0
    changed = chosen & F.contains(docs[text_col], F.lit("\n"))
    return docs.select(
        F.coalesce(F.concat(F.lit("g"), docs[group_col].cast("string")), F.lit("")).alias("_g"), docs[id_col].alias("id"),
        _digest(list(columns.values())).alias("leaf"), F.when(changed, _digest(tampered)).alias("other"), F.monotonically_increasing_id().alias("_row"))


def _directory(words: DataFrame, lowest: int, highest: int) -> DataFrame:
    """``words`` (_g, _word, _bits, _n) with _before, the rows of the group in earlier words.

    Each level sums up within its parents, of which none has more than 65,536 entries; there are as many levels as the
    words of the table reach over.
    """
    below = Window.partitionBy("_g", "_up").orderBy("_word").rowsBetween(Window.unboundedPreceding, -1)
    up = F.shiftright("_word", DIRECTORY_BITS).alias("_up")
    here = words.select("*", up).withColumn("_inner", F.coalesce(F.sum("_n").over(below), F.lit(0)))
    if lowest >> DIRECTORY_BITS == highest >> DIRECTORY_BITS:
        return here.withColumn("_before", F.col("_inner")).drop("_inner", "_up")
    entries = words.groupBy("_g", up).agg(F.sum("_n").alias("_n")).withColumnRenamed("_up", "_word")
    above = _directory(entries, lowest >> DIRECTORY_BITS, highest >> DIRECTORY_BITS).select("_g", F.col("_word").alias("_up"), F.col("_before").alias("_earlier"))
    return here.join(above, ["_g", "_up"]).withColumn("_before", F.col("_inner") + F.col("_earlier")).drop("_inner", "_earlier", "_up")


def ranked(rows: DataFrame, keys: list[Column]) -> DataFrame:
    """``rows`` with _rank, from 0, within _g by integer ``keys``, nulls first. Rows that agree in all keys are told apart by _row.

    ``rows`` is a written table, which is read again. Only where keys repeat is there a second index, over the rows that
    share a key, by the next one.
    """
    keyed = rows.withColumn("_key", keys[0].cast("long"))
    word, bit = F.shiftright("_key", 6) + F.lit(FIRST_WORD), F.col("_key").bitwiseAND(F.lit(63)).cast("int")
    shifted = lambda x: F.call_function("shiftleft", F.lit(x).cast("long"), bit)
    words = keyed.where("_key is not null").groupBy("_g", word.alias("_word")).agg(F.bit_or(shifted(1)).alias("_bits"), F.count(F.lit(1)).alias("_n"))
    words = materialize(words, "id-words")
    lowest, highest, repeats = words.agg(F.min("_word"), F.max("_word"), F.max(F.when(F.bit_count("_bits") < F.col("_n"), True))).first()
    nulls = keyed.where("_key is null").groupBy("_g").agg(F.count(F.lit(1)).alias("_nulls"))
    most_nulls = nulls.agg(F.max("_nulls")).first()[0] or 0
    listed = (_directory(words, lowest, highest) if lowest is not None else words.withColumn("_before", F.lit(0).cast("long"))).select("_g", "_word", "_bits", "_before")
    more = F.lit(0).cast("long")
    if repeats:  # of each repeated id its place in the word and the number of rows besides the first
        own = keyed.where("_key is not null").groupBy("_g", "_key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1")
        extra = own.groupBy("_g", word.alias("_word")).agg(F.collect_list(F.struct(bit.alias("bit"), (F.col("_m") - 1).alias("more"))).alias("_extra"))
        listed = listed.join(extra, ["_g", "_word"], "left")
        more = F.aggregate(F.coalesce("_extra", F.array().cast("array<struct<bit:int,more:bigint>>")), F.lit(0).cast("long"), lambda s, x: s + F.when(x["bit"] < bit, x["more"]).otherwise(0))
    lower = F.bit_count(F.col("_bits").bitwiseAND(F.bitwise_not(shifted(-1)))).cast("long")
    rank = F.coalesce(F.col("_before") + lower + more, F.lit(0))
    placed = keyed.withColumn("_word", word).join(listed, ["_g", "_word"], "left").withColumn("_rank", rank).select(*keyed.columns, "_rank")
    if most_nulls:
        placed = placed.join(nulls, "_g", "left").withColumn("_rank", F.col("_rank") + F.when(F.col("_key").isNull(), 0).otherwise(F.coalesce("_nulls", F.lit(0)))).drop("_nulls")
    if repeats or most_nulls > 1:
        same = keyed.groupBy("_g", "_key").agg(F.count(F.lit(1)).alias("_m")).where("_m > 1").select(F.col("_g").alias("_g1"), F.col("_key").alias("_k1"))
        tied = keyed.join(same, (F.col("_g") == F.col("_g1")) & F.col("_key").eqNullSafe(F.col("_k1")), "left_semi")
        tied = materialize(tied.withColumn("_g", F.concat("_g", F.lit("\0"), F.coalesce(F.col("_key").cast("string"), F.lit("")))).drop("_key"), "tied")
        inner = ranked(tied, keys[1:] or [F.col("_row")]).select(F.col("_row").alias("_r"), F.col("_rank").alias("_within"))
        placed = placed.join(inner, F.col("_row") == F.col("_r"), "left").withColumn("_rank", F.col("_rank") + F.coalesce("_within", F.lit(0))).drop("_r", "_within")
    return placed.drop("_key")


def levels_of(n: int) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and each of the levels above them, left to right."""
    out = [nodes]
    for _ in range(levels):
        nodes = [hashlib.sha256("".join(nodes[i : i + FAN]).encode()).hexdigest() for i in range(0, len(nodes), FAN)]
        out.append(nodes)
    return out


def _block(row: dict, r: int, deep: int) -> list[list[str]]:
    return _reduced([x["leaf"].hex() for x in row["slots"]], min(deep, max(0, levels_of(row["n"]) - deep * r)))


def _slots(rows: DataFrame, sizes: DataFrame, r: int, deep: int) -> DataFrame:
    """Blocks of round ``r``: _g, _block, n (nodes of the group's first round), slots in order."""
    size = FAN**deep
    slot = (F.col("_rank") % size).cast("int")
    block = F.expr(f"_rank div {size}")
    made = rows.groupBy("_g", block.alias("_block")).agg(F.array_sort(F.collect_list(F.struct(slot.alias("slot"), "leaf", "other", "id", "name"))).alias("slots"))
    return materialize(made.join(sizes, "_g"), f"slots-{r}")


def _rising(rows: DataFrame, sizes: DataFrame, most: int, deep: int) -> list[DataFrame]:
    """The blocks of each round, until each group is one block; ``most`` is the size of the largest group."""
    rounds, id_type = [], rows.schema["id"].dataType
    for r in range(max(1, -(-levels_of(most) // deep))):
        rounds.append(_slots(rows, sizes, r, deep))
        rows = _tops(rounds[-1], r, deep).select("_g", F.col("_block").alias("_rank"), F.unhex("node").alias("leaf"), F.lit(None).cast("binary").alias("other"), F.lit(None).cast(id_type).alias("id"), F.lit(None).cast("string").alias("name"))
    return rounds


TOPS = pa.schema([("_g", pa.string()), ("_block", pa.int64()), ("node", pa.string())])
WAYS = pa.schema([("_g", pa.string()), ("_block", pa.int64()), ("way", pa.string()), ("subroot", pa.string()), ("root", pa.string())])
PROOFS = pa.schema([("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])


def _rows(batches, more=()):
    """The rows of record batches, a slot array at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in ("_g", "_block", "n", "slots", *more)}
        give_back()


def _tops(slots: DataFrame, r: int, deep: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            tops = [_block(row, r, deep)[-1][0] for row in _rows([batch])]
            yield record_batch(TOPS, [batch.column("_g"), batch.column("_block"), tops])

    return slots.mapInArrow(run, "_g string, _block long, node string")


def ways(levels: list[list[str]], above: str) -> list[str]:
    """For each node of the lowest level its siblings up to the top and then ``above``: ``left|right;`` for each level."""
    out = [above]
    for nodes in reversed(levels[:-1]):
        out = ["".join([*nodes[i - i % FAN : i], "|", *nodes[i + 1 : i - i % FAN + FAN], ";", out[i // FAN]]) for i in range(len(nodes))]
    return out


def fold(leaf: str, way: str) -> str:
    """The root that a leaf and the siblings on its way give."""
    for level in way.split(";")[:-1]:
        left, _, right = level.partition("|")
        leaf = hashlib.sha256(f"{left}{leaf}{right}".encode()).hexdigest()
    return leaf


def _descend(slots: DataFrame, above: DataFrame, r: int, deep: int, to_group: bool) -> DataFrame:
    """Ways of the nodes of a round's blocks: of blocks of the round below, or (``to_group``) of the groups that they stand for."""

    def run(batches):
        for row in _rows(batches, ("way", "subroot", "root")):
            names = [x["name"] for x in row["slots"]] if to_group else [row["_g"]] * len(row["slots"])
            below = [0] * len(names) if to_group else [row["_block"] * FAN**deep + x["slot"] for x in row["slots"]]
            subroots = [x["leaf"].hex() for x in row["slots"]] if to_group else [row["subroot"]] * len(names)
            yield record_batch(WAYS, [names, below, ways(_block(row, r, deep), row["way"]), subroots, [row["root"]] * len(names)])

    return materialize(slots.join(above, ["_g", "_block"]).mapInArrow(run, "_g string, _block long, way string, subroot string, root string"), f"ways-{r}")


#: What takes a way's marks out, so that its siblings are left.
UNMARKED = str.maketrans("", "", "|;")


def _proofs(slots: DataFrame, above: DataFrame, deep: int) -> DataFrame:
    id_type = slots.schema["slots"].dataType.elementType["id"].dataType

    def run(batches):
        for row in _rows(batches, ("way", "subroot", "root")):
            own, found = [x["leaf"].hex() for x in row["slots"]], ways(_block(row, 0, deep), row["way"])
            folded = [fold((x["other"] or x["leaf"]).hex(), w) for x, w in zip(row["slots"], found, strict=True)]
            proofs = [hashlib.sha256(w.translate(UNMARKED).encode()).hexdigest() for w in found]
            n = len(own)
            yield record_batch(PROOFS, [[x["id"] for x in row["slots"]], own, [row["subroot"]] * n, [row["root"]] * n, proofs, folded, [x == row["root"] for x in folded]])

    kept = StructType([StructField("id", id_type), *StructType.fromDDL("leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")])
    return slots.join(above, ["_g", "_block"]).mapInArrow(run, kept)


def manifest(docs: DataFrame, fields: list[str], text_col: str = "text", id_col: str = "doc_id", group_col: str = "source", deep: int = BLOCK_LEVELS) -> DataFrame:
    """One row for each row of ``docs``: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of ``fields``. Groups are ordered by their UTF-8 bytes, null first; leaves of a group by id,
    null first, rows of one id by leaf; rows that agree in both are leaves of their own. Ids are integers. Rows whose id
    is null are not tampered with. An empty table gives no row; other columns, of whatever name, count only if named in ``fields``.
    ``deep`` is the number of levels of a block.
    """
    kept = StructType([StructField("id", docs.schema[id_col].dataType), *StructType.fromDDL("leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")])
    rows = materialize(leaves(docs, fields, text_col, id_col, group_col), "leaves")
    sizes = materialize(rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n")), "group-sizes")
    most, groups = sizes.agg(F.max("n"), F.count(F.lit(1))).first()
    if not groups:
        return rows.sparkSession.createDataFrame([], kept).withColumnRenamed("id", id_col)
    by_leaf = F.conv(F.substring(F.hex("leaf"), 1, 15), 16, 10)
    placed = ranked(rows, [F.col("id"), by_leaf]).withColumn("name", F.lit(None).cast("string"))
    within = _rising(placed, sizes, most, deep)
    tops = _tops(within[-1], len(within) - 1, deep).select(F.col("_g").alias("name"), F.unhex("node").alias("leaf"))
    order = cumulated(tops.withColumn("n", F.lit(1).cast("long")), [], "name", ["n"]).withColumnRenamed("n_before", "_rank")
    subroots = order.select(F.lit("").alias("_g"), "_rank", "leaf", F.lit(None).cast("binary").alias("other"), F.lit(None).cast("long").alias("id"), "name")
    whole = _rising(subroots, rows.sparkSession.range(1).select(F.lit("").alias("_g"), F.lit(groups).cast("long").alias("n")), groups, deep)
    above = _tops(whole[-1], len(whole) - 1, deep).select("_g", "_block", F.lit("").alias("way"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    for r, slots in reversed(list(enumerate(whole))):
        above = _descend(slots, above, r, deep, to_group=r == 0)
    for r, slots in reversed(list(enumerate(within))[1:]):
        above = _descend(slots, above, r, deep, to_group=False)
    proofs = materialize(_proofs(within[0], above, deep), "proofs")
    discard(rows, sizes, *within, *whole)
    return proofs.withColumnRenamed("id", id_col)


#: The columns of a document that its leaf holds.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
