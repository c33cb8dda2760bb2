"""Chat formatting by quotation linking.

Lines that begin with '>' are quotes, and the number of marks is their level. Quoted
passages are normalised and hashed, and joined to the message of the same conversation
in which the passage first stood as its author's own words. The link of the outermost
quotes makes a message the reply to that one; messages leave in reply order, without
their quotes, each with its thread, its depth and its place there.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .textops import discard, give_back, materialize, record_batch

_quote = re.compile(r"^\s*((?:>\s?)+)")
#: Fixed value: the line that mail programs put before a quote.
_intro = re.compile(r"^(?:On\b.*\bwrote|Am\b.*\bschrieb.*|Le\b.*\ba écrit|El\b.*\bescribió)\s*:\s*$")


def parse(text: str | None) -> tuple[str, list[tuple[int, str]], list[str]]:
    """(own text, quoted passages with their level, own passages). A passage is a run of lines of one level without a blank line."""
    own: list[str] = []
    quotes: list[tuple[int, list[str]]] = []
    passages: list[list[str]] = [[]]
    level_before = 0
    for line in (text or "").split("\n"):
        m = _quote.match(line)
        level = m[1].count(">") if m else 0
        body = line[m.end() :] if m else line
        if level:
            if not body.strip():
                level_before = -1
                continue
            if level != level_before:
                quotes.append((level, []))
                if level_before == 0 and own and _intro.match(own[-1].strip()):
                    own.pop()
                    if passages[-1]:
                        passages[-1].pop()
            quotes[-1][1].append(body)
            passages.append([])
        else:
            own.append(line)
            if body.strip():
                passages[-1].append(body)
            else:
                passages.append([])
        level_before = level
    kept = "\n".join(own).strip("\n") if quotes else (text or "")
    return kept, [(level, "\n".join(lines)) for level, lines in quotes], ["\n".join(p) for p in passages if p]


def normalised(passage: str) -> str:
    return " ".join(passage.lower().split())


def keys(passage: str) -> dict[str, int]:
    """Hashes under which a passage can be found, as a whole and by its lines, with the characters that each stands for."""
    found = {}
    for piece in (passage, *passage.split("\n")):
        plain = normalised(piece)
        if plain:
            found[hashlib.md5(plain.encode()).hexdigest()] = len(plain)
    return found


PARSED = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n_quotes", pa.int64()), ("max_level", pa.int64()),
    ("own", pa.list_(pa.string())), ("quoted", pa.list_(pa.struct([("level", pa.int64()), ("key", pa.string()), ("weight", pa.int64())]))),
])
PARSED_DDL = "conv_id long, turn long, role string, text string, n_quotes long, max_level long, own array<string>, quoted array<struct<level:long,key:string,weight:long>>"


def _parsed(batches):
    for batch in batches:
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            columns: list[list] = [[], [], [], [], []]
            for text in part.column(3).to_pylist():
                kept, quotes, own = parse(text)
                outer = min((level for level, _ in quotes), default=0)
                for column, value in zip(columns, (
                    kept, len(quotes), max((level for level, _ in quotes), default=0), sorted({k for p in [*own, "\n".join(own)] for k in keys(p)}),
                    [{"level": level - outer, "key": k, "weight": w} for level, p in quotes for k, w in keys(p).items()],
                ), strict=True):
                    column.append(value)
            yield record_batch(PARSED, [part.column(0), part.column(1), part.column(2), *columns])
        give_back()


def threads(messages: DataFrame) -> DataFrame:
    """One row for each message: conv_id, turn, role, text (without quotes), n_quotes, max_level, n_linked, parent_turn, root_turn, depth, position, formatted.

    ``messages`` has conv_id, turn, role, text. A message is the reply to the earlier message that
    most characters of its outermost quotes come from (of equals the latest); one without such a
    link begins a thread at its own turn. ``position`` counts the messages of a thread in reply order: each message
    is followed by its replies and all that replies to them, earlier turns first; so (conv_id, root_turn, position) is the
    reply order. Null texts are empty; messages with a null conversation or turn stay, unlinked; of repeated
    (conv_id, turn) rows all stay and share their links and place; turns may be negative and of any size; texts of any length
    are parsed whole; an empty table gives no row; other columns, of whatever name, are left aside.
    """
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text"))
    parsed = materialize(rows.mapInArrow(_parsed, PARSED_DDL), "chat-parsed")
    # a passage belongs to the message where it first stood; the group is combined before the shuffle
    first = parsed.select("conv_id", "turn", F.explode("own").alias("key")).groupBy("conv_id", "key").agg(F.min("turn").alias("origin"))
    quoted = parsed.select("conv_id", "turn", F.explode("quoted").alias("q")).select("conv_id", "turn", "q.level", "q.key", "q.weight").distinct()
    linked = quoted.join(first, ["conv_id", "key"]).where("origin < turn")
    votes = linked.groupBy("conv_id", "turn", "origin").agg(F.sum(F.when(F.col("level") == 0, F.col("weight")).otherwise(0)).alias("votes"), F.count(F.lit(1)).alias("n"))
    parent = votes.groupBy("conv_id", "turn").agg(F.max(F.when(F.col("votes") > 0, F.struct("votes", "origin"))).alias("best"), F.sum("n").alias("n_linked"))
    replies = materialize(parent.select("conv_id", "turn", F.col("best.origin").alias("parent_turn"), "n_linked"), "chat-replies")
    places = _places(replies.where("parent_turn is not null").select("conv_id", "turn", "parent_turn"))
    out = parsed.drop("own", "quoted").join(replies, ["conv_id", "turn"], "left").join(places, ["conv_id", "turn"], "left")
    mark = F.coalesce("role", F.lit("unknown"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(
        "conv_id", "turn", "role", "text", "n_quotes", "max_level", zero("n_linked"), "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"), zero("depth"), zero("position"),
        F.concat(F.lit("<|"), mark, F.lit("|>\n"), "text", F.lit("\n<|end|>\n")).alias("formatted"),
    )


def _followed(links: DataFrame) -> DataFrame:
    """(conv_id, turn, last, steps) for ``links`` (conv_id, turn, to), of which each turn has one at most: where the links end, and after how many.

    The known part of each chain doubles in a round, so that a chain of n links takes about log n of them; rows keep their size."""
    known = links.select("conv_id", "turn", F.col("to").alias("last"), F.lit(1).cast("long").alias("steps"))
    while True:
        ahead = known.select("conv_id", F.col("turn").alias("last"), F.col("last").alias("_last"), F.col("steps").alias("_steps"))
        joined = known.join(ahead, ["conv_id", "last"], "left")
        before, known = known, materialize(joined.select("conv_id", "turn", F.coalesce("_last", "last").alias("last"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"), F.col("_last").isNotNull().alias("moved")), "chat-chains")
        if hasattr(before, "_folder"):
            discard(before)
        if known.where("moved").isEmpty():
            return known.drop("moved")


def _places(replies: DataFrame) -> DataFrame:
    """conv_id, turn, root_turn, depth, position of every reply (conv_id, turn, parent_turn).

    The message before a first reply is its parent; that before a later one is the last message of the reply before it, which the
    links to the latest replies lead to. The number of links to the root is the position."""
    up = _followed(replies.select("conv_id", "turn", F.col("parent_turn").alias("to"))).select("conv_id", "turn", F.col("last").alias("root_turn"), F.col("steps").alias("depth"))
    latest = replies.groupBy("conv_id", "parent_turn").agg(F.max("turn").alias("to")).withColumnRenamed("parent_turn", "turn")
    tail = _followed(latest).select("conv_id", F.col("turn").alias("sibling"), "last")
    siblings = replies.withColumn("sibling", F.lag("turn").over(Window.partitionBy("conv_id", "parent_turn").orderBy("turn")))
    back = siblings.join(tail, ["conv_id", "sibling"], "left").select("conv_id", "turn", F.coalesce("last", "sibling", "parent_turn").alias("to"))
    return up.join(_followed(back).select("conv_id", "turn", F.col("steps").alias("position")), ["conv_id", "turn"])
