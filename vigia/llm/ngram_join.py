"""N-gram Jaccard self-join with a token-group matrix, exact, as connected components.

A document is the set of hashes of its word 5-grams. Documents with equal sets are one
class. Of the classes, those that share a token of their prefixes (the only ones that
can be similar) are partitioned into groups of similar ones; each group keeps the union
of its tokens, a row of the token-group matrix. A set is compared with the members of a
group only if its overlap with the union leaves a similar member possible.

This happens twice:

* inside blocks of sets with a common prefix token, where the matrix is an array. A
  frequent token's sets are dealt over several blocks, and bit vectors of the sets rule
  out those without a possible partner before texts are brought together;
* between the components of the first step that still share a prefix token: unions are
  bit vectors, built up over all members without gathering them, and the groups that
  qualify are opened in blocks of bounded size.

No pairs of a group are listed anywhere, and nothing is left out: tokens that stand in
many documents only come last in the order by which prefixes are taken.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected
from .textops import ASCII_LOWER, U64, Words, byte_class, discard, give_back, join_counted, materialize, mix, picked, record_batch, slices, without

SHINGLE = 5
PERCENT = 80
#: Sets that meet in a block, and their shingles; sets from which on a block counts as a group of its own.
BLOCK, BLOCK_SHINGLES, CROWD = 256, 4_000_000, 32
#: A token counts as frequent if it stands in the wide prefixes of so many sets; tokens are counted by stretches of so many.
OVERALL, STRETCH = 16, 1_000_000
#: Tokens that the order treats as frequent, at most: what is broadcast is 8 bytes for each.
FREQUENT = 1_000_000
WORD = byte_class("space")
#: Bytes of text that one vectorised step works on here, and that a Python task gets at once: its executor's heap is grown by then.
STEP_BYTES, BATCH_BYTES = 1 << 18, 1 << 21

_MULTIPLIER = U64(0xD6E8FEB86659FD93)


def _kept(df: DataFrame, name: str) -> DataFrame:
    return materialize(df, name, BATCH_BYTES)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each document; fewer words than ``size`` are one shingle, none give none."""
    words = Words(ASCII_LOWER[data], offsets, WORD)
    hashes = words.hashes() if len(words) else np.zeros(0, U64)

    def rolled(width: int) -> np.ndarray:
        n = len(hashes) - width + 1
        h = np.full(n, U64(width))
        for k in range(width):
            h = h * _MULTIPLIER + hashes[k : k + n]
        return mix(h)

    whole = rolled(size) if len(hashes) >= size else np.zeros(0, U64)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        n = b - a
        if n >= size:
            s = np.sort(whole[a : b - size + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif n:
            h = U64(n)
            with np.errstate(over="ignore"):
                for x in hashes[a:b]:
                    h = h * _MULTIPLIER + x
            out.append(mix(np.array([h], U64)))
        else:
            out.append(np.zeros(0, U64))
    return out


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _signature(s: np.ndarray) -> tuple[int, int]:
    return int(np.add.reduce(mix(s ^ U64(0xA5A5A5A5A5A5A5A5))).view(np.int64)), int(np.bitwise_xor.reduce(mix(s + U64(0x9E3779B9))).view(np.int64))


def bit_words(s: np.ndarray) -> np.ndarray:
    """A bit vector of a set: at least four bits a token, its length a power of two, so that vectors fold onto shorter ones."""
    m = max(64, 1 << (4 * len(s) - 1).bit_length())
    bits = np.zeros(m, np.uint8)
    bits[(s & U64(m - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    cut = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64), pa.int64()))


FIRST = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bits", pa.list_(pa.int64())), ("token", pa.int64()), ("seen", pa.int64())])
FIRST_DDL = "id long, n long, s1 long, s2 long, bits array<long>, token long, seen long"


def _first_pass(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A signature and a bit vector for each document, and how often each token stands in the wide prefix of a set.

    The prefixes that are taken later skip frequent tokens, so counts reach half as far again."""
    known: set[tuple] = set()
    stretch: list[np.ndarray] = []
    size = 0

    def counted():
        token, seen = np.unique(np.concatenate(stretch), return_counts=True) if stretch else (np.zeros(0, U64), np.zeros(0, np.int64))
        none = pa.nulls(len(token), pa.int64())
        return record_batch(FIRST, [none, none, none, none, pa.nulls(len(token), pa.list_(pa.int64())), token.view(np.int64), seen])

    for batch in batches:
        for i, j, data, offsets in slices(batch.column(1), STEP_BYTES):
            n, s1, s2, bits = [], [], [], []
            for s in shingle_sets(data, offsets):
                a, b = _signature(s) if len(s) else (0, 0)
                n.append(len(s)), s1.append(a), s2.append(b), bits.append(bit_words(s) if len(s) else np.zeros(0, np.int64))
                if len(s) and (key := (len(s), a, b)) not in known:
                    known.add(key)
                    wide = prefix_length(len(s), percent)
                    stretch.append(s[: wide + wide // 2 + 16])
                    size += len(stretch[-1])
            none = pa.nulls(j - i, pa.int64())
            yield record_batch(FIRST, [batch.column(0).slice(i, j - i), n, s1, s2, _lists(bits), none, none])
            if size >= STRETCH:
                yield counted()
                stretch, size = [], 0
    yield counted()


PREFIX = pa.schema([("token", pa.int64()), ("id", pa.int64())])


def _prefixes(batches: Iterator[pa.RecordBatch], shared, percent: int) -> Iterator[pa.RecordBatch]:
    """(token, document) for the prefix of every set that the task has not met before: rare tokens first, then the frequent ones, each by hash."""
    frequent: np.ndarray = shared.value
    known: set[tuple] = set()
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for i, _, data, offsets in slices(batch.column(1), STEP_BYTES):
            tokens, owners = [], []
            for k, s in enumerate(shingle_sets(data, offsets)):
                if not len(s):
                    continue
                key = (len(s), *_signature(s))
                if key in known:
                    continue
                known.add(key)
                take = prefix_length(len(s), percent)
                if len(frequent):
                    place = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    often = frequent[place] == s
                    s = np.concatenate([s[~often], s[often]])
                tokens.append(s[:take])
                owners.append(np.full(take, ids[i + k]))
            if tokens:
                yield record_batch(PREFIX, [np.concatenate(tokens).view(np.int64), np.concatenate(owners)])


def link_block(ids: list[int], sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Edges that join the components of the similar sets of a block, by a token-group matrix.

    Rows of the matrix are kept as (token, group) pairs, so that its size is that of the unions.
    """
    if len(ids) < 2:
        return []
    universe, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    cut = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    local = [numbers[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    here = np.zeros(len(universe), bool)
    capacity = 1024
    pair_token, pair_group, pairs = np.empty(capacity, np.int64), np.empty(capacity, np.int64), 0
    groups: list[list[int]] = []
    unions: list[set] = []
    edges = []
    for k in np.argsort([-len(s) for s in sets], kind="stable"):
        q, n = local[k], len(local[k])
        here[q] = True
        overlap = np.bincount(pair_group[:pairs][here[pair_token[:pairs]]], minlength=len(groups))
        home = -1
        for g in np.flatnonzero(100 * overlap >= percent * n):
            for m in groups[g]:
                common = int(here[local[m]].sum())
                if 100 * common >= percent * (n + len(local[m]) - common):
                    edges.append((ids[k], ids[m]))
                    home = g if home < 0 else home
                    break
        here[q] = False
        if home < 0:
            home = len(groups)
            groups.append([])
            unions.append(set())
        groups[home].append(int(k))
        new = [t for t in q.tolist() if t not in unions[home]]
        unions[home].update(new)
        while pairs + len(new) > capacity:
            capacity *= 2
            pair_token, pair_group = np.resize(pair_token, capacity), np.resize(pair_group, capacity)
        pair_token[pairs : pairs + len(new)] = new
        pair_group[pairs : pairs + len(new)] = home
        pairs += len(new)
    return edges


EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _link_blocks(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (block, rep, text) sorted by block: each block is linked when it is complete."""
    block, ids, sets = None, [], []
    us, vs = [], []

    def finish():
        for u, v in link_block(ids, sets, percent):
            us.append(u), vs.append(v)
        give_back()

    for batch in batches:
        names, reps = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, _, data, offsets in slices(batch.column(2), STEP_BYTES):
            for k, s in enumerate(shingle_sets(data, offsets), i):
                if names[k] != block:
                    finish()
                    block, ids, sets = names[k], [], []
                ids.append(reps[k])
                sets.append(s)
        if us:
            yield record_batch(EDGES, [us, vs])
            us, vs = [], []
    finish()
    if us:
        yield record_batch(EDGES, [us, vs])


def _linked(blocks: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Edges from ``blocks`` (block, rep): the texts are brought to their blocks.

    Most texts are in no block. They are left out before the join shuffles what remains."""
    likely = picked(rows, [rows["id"]], blocks, [blocks["rep"]], mark="_held")
    texts = likely.join(blocks, (likely["id"] == blocks["rep"]) & (likely["_held"] >= 0)).select("block", "rep", "text")
    return texts.repartition("block").sortWithinPartitions("block").mapInArrow(lambda it: _link_blocks(it, percent), "u long, v long")


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    return np.bitwise_or.reduce(x.reshape(-1, size), axis=0)


def partners(sizes: np.ndarray, bits: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Which sets of a block can be similar to another one, by size and bit vectors. A bit that one
    has and the other lacks is at least one token that the other lacks."""
    found = np.zeros(len(sizes), bool)
    lengths = np.array([len(b) for b in bits])
    classes = {m: (np.flatnonzero(lengths == m), np.stack([b for b in bits if len(b) == m])) for m in set(lengths.tolist())}
    for k, n in enumerate(sizes):
        for m, (rows, table) in classes.items():
            if m > lengths[k]:
                continue
            fits = rows[(100 * sizes[rows] >= percent * n) & (percent * sizes[rows] <= 100 * n) & (rows != k)]
            if not len(fits):
                continue
            other = table[np.searchsorted(rows, fits)]
            own = _folded(bits[k], m)
            lost = np.bitwise_count(own & ~other).sum(axis=1)
            gained = np.bitwise_count(other & ~own).sum(axis=1)
            good = (100 * (n - lost) >= percent * n) & (100 * (sizes[fits] - gained) >= percent * sizes[fits])
            if good.any():
                found[k] = True
                found[fits[good]] = True
    return found


PLACES = pa.schema([("block", pa.string()), ("rep", pa.int64())])


def _with_partner(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (block, rep, n, bits) sorted by block: the (block, rep) that stay."""
    block, reps, sizes, bits = None, [], [], []
    names, stay = [], []

    def finish():
        if len(reps) > 1:
            for k in np.flatnonzero(partners(np.array(sizes), bits, percent)):
                names.append(block), stay.append(reps[k])
        give_back()

    for batch in batches:
        keys, ids, counts = (batch.column(k).to_pylist() for k in (0, 1, 2))
        flat, cut = batch.column(3).flatten().to_numpy(zero_copy_only=False).view(U64), np.concatenate([[0], np.cumsum(batch.column(3).value_lengths().to_numpy(zero_copy_only=False))])
        for k, key in enumerate(keys):
            if key != block:
                finish()
                block, reps, sizes, bits = key, [], [], []
            reps.append(ids[k]), sizes.append(counts[k]), bits.append(flat[cut[k] : cut[k + 1]].copy())
        if names:
            yield record_batch(PLACES, [names, stay])
            names, stay = [], []
    finish()
    if names:
        yield record_batch(PLACES, [names, stay])


QUERIES = pa.schema([("rep", pa.int64()), ("comp", pa.string())])


def _bounded(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (rep, n, bits, comp, union bits): those stay whose set can have enough tokens in the union."""
    for batch in batches:
        n = batch.column(1).to_numpy()
        keep = np.zeros(batch.num_rows, bool)
        left, right = batch.column(2), batch.column(4)
        a, b = (c.flatten().to_numpy().view(U64) for c in (left, right))
        ca, cb = (np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy())]) for c in (left, right))
        for k in range(batch.num_rows):
            x, y = a[ca[k] : ca[k + 1]], b[cb[k] : cb[k + 1]]
            size = min(len(x), len(y))
            x, y = _folded(x, size), _folded(y, size)
            keep[k] = 100 * (n[k] - int(np.bitwise_count(x & ~y).sum())) >= percent * n[k]
        mask = pa.array(keep)
        yield record_batch(QUERIES, [batch.column(0).filter(mask), batch.column(3).filter(mask)])


def _cells():
    """Aggregate: blocks that sets of ``n`` shingles are dealt over, so that neither their number nor their shingles exceed a block's, on average."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long")


def _across(shared: DataFrame, rows: DataFrame, sets: DataFrame, comps: DataFrame, dealt: DataFrame, percent: int) -> DataFrame | None:
    """Edges between components of the first step: sets that share a prefix token with a group of another component,
    that the group's union bounds, meet its members.

    A group is a component. Where a block is crowded with small ones, whose sets have been compared
    with each other, the block is the group. Both are parted by classes of size, of which only neighbours can hold
    similar sets. Sets ask groups of a higher rank (small components,
    crowded blocks, large components), or of the same rank and a smaller name.
    """
    reps = shared.select("rep").distinct().join(comps, F.col("rep") == comps["node"], "left").select("rep", F.coalesce("component", "rep").alias("comp"))
    first = dealt.where("is_first").select("rep", "block")
    crowds = first.groupBy("block").agg(F.count(F.lit(1)).alias("_b")).where(F.col("_b") >= CROWD)
    large = reps.groupBy("comp").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > BLOCK)
    ranked = reps.join(large, "comp", "left").join(first.join(crowds, "block"), "rep", "left")
    rank = F.when(F.col("_c").isNotNull(), 2).when(F.col("_b").isNotNull(), 1).otherwise(0)
    group = F.when(rank == 1, F.concat(F.lit("b"), "block")).otherwise(F.concat(F.lit("c"), F.col("comp").cast("string")))
    # sizes of similar sets differ by a factor of 100 / percent at most, so that their classes, a little wider, differ by one at most
    size = F.floor(F.log(F.col("n").cast("double")) / math.log(100.0 / percent * 1.0001)).cast("long")
    ranked = ranked.join(sets.select("rep", "n"), "rep").select("rep", "comp", rank.alias("rank"), group.alias("base"), size.alias("cls"))
    placed = _kept(shared.join(ranked.withColumn("grp", F.concat_ws("/", "base", "cls")), "rep"), "placed")
    mixed = placed.groupBy("token").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a < _b").select("token")
    open_ = _kept(placed.join(mixed, "token", "left_semi"), "open")
    if open_.isEmpty():
        discard(placed, open_)
        return None
    groups = open_.groupBy("token", *[F.col(c).alias(f"_{c}") for c in ("grp", "base", "cls", "rank")]).agg(F.min("comp").alias("_a"), F.max("comp").alias("_b"))
    near = (F.abs(F.col("_cls") - F.col("cls")) <= 1) & (F.col("_base") != F.col("base"))
    asks = ((F.col("_rank") > F.col("rank")) | ((F.col("_rank") == F.col("rank")) & (F.col("_base") < F.col("base")))) & ((F.col("_a") != F.col("comp")) | (F.col("_b") != F.col("comp")))
    queries = open_.join(groups, "token").where(asks & near).select("rep", F.col("_grp").alias("comp")).distinct()
    queries = _kept(queries, "queries")
    discard(open_)

    of_group = placed.select("rep", F.col("grp").alias("comp")).distinct()
    members = of_group.join(queries.select("comp").distinct(), "comp", "left_semi")
    words = members.join(sets.select("rep", "bits"), "rep").withColumn("size", F.size("bits"))
    least = words.groupBy("comp").agg(F.min("size").alias("least"))
    # a union's bits: the members' words, folded to the shortest vector, are added up place by place
    # (those of one length first, so that a large group has met before it is joined with its shortest length)
    places = words.select("comp", "size", F.posexplode("bits").alias("at", "word")).groupBy("comp", "size", "at").agg(F.bit_or("word").alias("word"))
    union = (
        places.join(least, "comp").groupBy("comp", (F.col("at") % F.col("least")).alias("at")).agg(F.bit_or("word").alias("word"))
        .groupBy("comp").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("row")).select("comp", F.col("row.word").alias("union"))
    )
    asked = queries.join(sets.select("rep", "n", "bits"), "rep").join(union, "comp").select("rep", "n", "bits", "comp", "union")
    good = _kept(asked.mapInArrow(lambda it: _bounded(it, percent), "rep long, comp string"), "qualified")

    # open the groups: members and visitors of a group are dealt to a grid of blocks, so that each pair meets in one
    inside = of_group.join(good.select("comp").distinct(), "comp", "left_semi")
    heights = sets.select("rep", "n")
    sizes = inside.join(heights, "rep").groupBy("comp").agg(_cells().alias("mb")).join(good.join(heights, "rep").groupBy("comp").agg(_cells().alias("vb")), "comp")
    grid = sizes.select("comp", "mb", "vb")
    cell = lambda m, v: F.concat_ws(":", "comp", m, v)
    mine = inside.join(grid, "comp").select("rep", "comp", F.pmod(F.xxhash64("rep"), "mb").alias("m"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("vb") - 1)).alias("v"))
    theirs = good.join(grid, "comp").select("rep", "comp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1)).alias("m"), F.pmod(F.xxhash64("rep"), "vb").alias("v"))
    blocks = _kept(mine.unionByName(theirs).select(cell("m", "v").alias("block"), "rep"), "grid")
    discard(placed, queries, good)
    outer = _kept(_linked(blocks, rows, percent), "links-outer")
    discard(blocks)
    return outer


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id (the smallest id reachable by links, itself included), class_id
    (the smallest id with an equal set).

    Documents link when 100 * intersection >= percent * union. Null, empty and wordless texts have no
    shingle and link with nothing. Ids may be of any type that has an order; rows with a null id, or with an id
    that several rows share, are documents of their own, and component_id is null where no reachable row has an id.
    An empty table gives no row; other columns, of whatever name, are left aside.
    """
    found = _found(docs, id_col, text_col, percent)
    return found.select(F.col("name").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("class").alias("class_id"))


def _found(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """name (the id), n, component, class, and mark: a hash of the text where ids name no row, else null."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType
    integral = kind.simpleString() in ("bigint", "int", "smallint", "tinyint")
    if integral and rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null").isEmpty():
        named = lambda c: F.col(c).cast(kind)
        found = _components(rows.select(F.col("id").cast("long"), "text"), percent)
        return found.select(named("id").alias("name"), "n", named("component").alias("component"), named("rep").alias("class"), F.lit(None).cast("long").alias("mark"))
    numbered = _kept(rows.select(F.col("id").alias("name"), F.monotonically_increasing_id().alias("id"), "text"), "numbered")
    marked = numbered.select("id", "name", F.xxhash64("text").alias("mark"))
    found = _kept(_components(numbered.select("id", "text"), percent).join(marked, "id"), "numbered-components")
    total = found.count()
    for key, name in (("component", "least"), ("rep", "class")):
        least = found.groupBy(key).agg(F.min("name").alias(name), F.count(F.lit(1)).alias("_n"))
        found = _kept(join_counted(found, least, [key], "inner", total), "numbered-names")
    discard(numbered)
    return found.select("name", "n", F.col("least").alias("component"), "class", "mark")


def _components(rows: DataFrame, percent: int) -> DataFrame:
    """(id, n, rep, component) for ``rows`` (id: long, unique; text). Tables that no later step reads are deleted on the way."""
    spark = rows.sparkSession
    first = _kept(rows.mapInArrow(lambda it: _first_pass(it, percent), FIRST_DDL), "signatures")

    described = first.where("id is not null").select("id", "n", "s1", "s2")
    classes = described.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("_n"))
    placed = join_counted(described.where("n > 0"), classes, ["n", "s1", "s2"], "inner", described.count()).select("id", "n", "rep")
    placed = _kept(placed.unionByName(described.where("n = 0").select("id", "n", F.col("id").alias("rep"))), "classes")

    often = first.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= OVERALL)
    often = often.orderBy(F.desc("seen"), "token").limit(FREQUENT).select("token").toArrow()
    frequent = np.sort(often.column(0).to_numpy().view(U64)) if often.num_rows else np.zeros(0, U64)
    shared_order = spark.sparkContext.broadcast(frequent)

    prefixes = _kept(rows.mapInArrow(lambda it: _prefixes(it, shared_order, percent), "token long, id long"), "prefixes")
    several = prefixes.groupBy("token").agg(F.min("id").alias("_a"), F.max("id").alias("_b")).where("_a < _b").select("token")
    met = prefixes.join(several, "token", "left_semi")
    by_class = _kept(met.join(placed.select("id", "rep"), "id").select("token", "rep").distinct(), "met")
    discard(prefixes)
    different = by_class.groupBy("token").agg(F.min("rep").alias("_a"), F.max("rep").alias("_b")).where("_a < _b").select("token")
    shared = _kept(by_class.join(different, "token", "left_semi"), "shared")
    discard(by_class)

    sets = first.where("id is not null").select(F.col("id").alias("rep"), "n", "bits").join(shared.select("rep").distinct(), "rep", "left_semi")
    sets = _kept(sets, "sets")
    discard(first)

    # two tokens of each set name its groups: the first and the last by hash
    keys = shared.groupBy("rep").agg(F.min("token").alias("a"), F.max("token").alias("b")).select("rep", F.explode(F.array_distinct(F.array("a", "b"))).alias("key"), "a")
    keys = _kept(keys.select("rep", "key", (F.col("key") == F.col("a")).alias("is_first")).join(sets.select("rep", "n"), "rep"), "group-keys")
    blocks = keys.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), _cells().alias("blocks")).where("_n > 1").drop("_n")
    dealt = keys.join(blocks, "key").select(F.concat_ws(":", "key", F.pmod(F.xxhash64("rep", "key"), "blocks")).alias("block"), "rep", "is_first")
    dealt = _kept(dealt, "dealt")
    discard(keys)
    compared = dealt.join(sets, "rep").select("block", "rep", "n", "bits").repartition("block").sortWithinPartitions("block")
    possible = _kept(compared.mapInArrow(lambda it: _with_partner(it, percent), "block string, rep long"), "possible")
    inner = _kept(_linked(possible, rows, percent), "links-inner")
    comps = connected(inner)
    outer = _across(shared, rows, sets, comps, dealt, percent)
    discard(shared, sets, dealt, possible, inner)
    if outer is not None and not outer.isEmpty():
        comps = connected(comps.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(outer))
    found = placed.join(comps, placed["rep"] == comps["node"], "left")
    return found.select("id", "n", "rep", F.coalesce("component", "rep").alias("component"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id; columns unchanged, whatever their names.

    Rows with a null id stay, as which row it is can't be told; so do repeated rows of the smallest id. Texts that share an
    id are each judged by themselves. Null, empty and wordless texts stay. An empty table gives no row.
    """
    lost = _found(docs, id_col, text_col, percent).where(F.col("name") != F.col("component")).select(F.col("name").alias("_lost"), F.col("mark").alias("_mark"))
    lost = _kept(lost.distinct(), "near-copies")
    same = lost["_mark"].isNull() | (lost["_mark"] == F.xxhash64(docs[text_col]))
    return without(docs, lost, [docs[id_col]], [lost["_lost"]], same)
