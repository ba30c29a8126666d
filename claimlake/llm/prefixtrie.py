"""Trie of conversation prefixes by ROLLUP over positional columns of turn ids.

A turn's id is a digest of its role and text, with the text's bytes counted in it. Each
conversation is laid out in blocks of ``WIDTH`` turns, one row a block: the turn ids in columns, and
the node of the trie that the blocks before lead to (two 64-bit sums of position-tagged hashes).
``GROUP BY block, node before, ROLLUP (columns)`` then aggregates the prefixes of every length of
all blocks at once; ``grouping_id`` tells their lengths. No conversation meets in one row or group,
however long it is.

Subtree totals need no walk: a node's smallest member stands for it, so each conversation stands
for its own last nodes. A second ROLLUP sums, over a node's members, what they stand for, and what
the smallest member stands for above the node is subtracted.

Hot groups: turns are numbered within ranges of rows, with the ranges' counts added, so one
conversation may hold any share of all rows; running sums are taken in two levels; lookups of keys
with more than 1/10,000 of the rows are broadcast (so at most 10,000 keys); the ids of the members
that end in a node are joined to strings of bounded size first, and these are digested in order.

Defined results: conversations are ordered by turn (null first), ties by the turn's digest; a null
role or text is an empty one; rows with a null ``conv_id`` belong to no conversation; repeated rows
are turns of their own; an empty table gives no rows (not even a root); other columns are not
carried, so clashing names do no harm. ``%`` is Spark's: negative for negative ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlake.llm.common import need, python_on_executors, written

WIDTH = 8
#: Rows of one group whose running totals are taken in one window.
STRETCH = 8192
#: Keys with more than one in so many rows are looked up by broadcast.
HOT = 10_000
#: Bytes of joined ids that are handed on as one row.
CHUNK = 1 << 20
KEY = ["depth", "key1", "key2"]


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes of a digest of role and text, then the text's bytes as 4 bytes."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.octet_length(text)), 8, "0")))


def text_bytes(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, 17, 4)), 16, 10).cast("long")


def positions(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv_id, position (from 0), id of every turn, and conv_id, n_own of every conversation."""
    need(conversations, "conv_id", "turn", "role", "text")
    turns = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        turn_id(F.col("role"), F.col("text")).alias("id"),
        F.monotonically_increasing_id().alias("row"),
    )
    turns = written(turns.filter("conv_id is not null"), "turns")
    # Rows of one conversation may lie in several ranges; `row` lets even equal rows part.
    ordered = turns.repartitionByRange("conv_id", "turn", "id", "row").sortWithinPartitions("conv_id", "turn", "id", "row")
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ordered = written(ordered.select("conv_id", "id", F.spark_partition_id().alias("part"), at.alias("at")), "ordered_turns")
    stretches = written(ordered.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n")), "stretches")
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row for each range
    starts = stretches.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    numbered = ordered.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("at") + F.col("shift")).alias("position"), "id")
    return written(numbered, "numbered_turns"), stretches.groupBy("conv_id").agg(F.sum("n").alias("n_own"))


def lookup(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` left-joined with ``facts`` (unique by ``keys``); hot keys go by broadcast."""
    counts = written(rows.groupBy(*keys).agg(F.count("*").alias("n_rows")), "key_counts")
    total = counts.agg(F.sum("n_rows")).first()[0] or 0
    # At most HOT keys have over total / HOT rows each.
    hot = counts.filter(F.col("n_rows") > max(1000, total // HOT)).select(*keys)
    if hot.isEmpty():
        return rows.join(facts, keys, "left")
    hot = F.broadcast(hot)
    some = rows.join(F.broadcast(facts.join(hot, keys, "left_semi")), keys, "left")
    return some.join(hot, keys, "left_semi").unionByName(rows.join(hot, keys, "left_anti").join(facts, keys, "left"))


def before_it(rows: DataFrame, group: str, order: str, totals: dict[str, Column], combine: Column | None = None) -> DataFrame:
    """``rows`` with running totals, over the rows of their group that come before; in two levels,
    stretches of ``STRETCH`` values of ``order`` and rows within them."""
    step = F.expr(f"{order} div {STRETCH}")
    rows = rows.withColumn("stretch", step)
    inner = W.partitionBy(group, "stretch").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    outer = W.partitionBy(group).orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    whole = rows.groupBy(group, "stretch").agg(*[c.alias(n) for n, c in totals.items()])
    fold = F.bit_xor if combine is not None else F.sum
    earlier = whole.select(group, "stretch", *[F.coalesce(fold(n).over(outer), F.lit(0)).alias(f"{n}_earlier") for n in totals])
    near = rows.select("*", *[F.coalesce(c.over(inner), F.lit(0)).alias(f"{n}_near") for n, c in totals.items()])
    joined = near.join(earlier.filter("stretch > 0"), [group, "stretch"], "left")

    def both(n: str) -> Column:
        a, b = F.col(f"{n}_near"), F.coalesce(F.col(f"{n}_earlier"), F.lit(0))
        return (a.bitwiseXOR(b) if combine is not None else a + b).alias(n)

    return joined.select(*[c for c in rows.columns if c != "stretch"], *[both(n) for n in totals])


def rebuilt(conversations: DataFrame, every: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like another: the first h turns of conversation c - c % ``every``,
    then c's own turns after its first h, where h is c's checksum modulo ``heads``.

    Returns conv_id, position, id of every turn, and conv_id of every conversation, turnless ones
    included.
    """
    turns, own = positions(conversations)
    first = turns.filter(F.col("position") < heads - 1).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("position", "id"))).alias("head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    plan = own.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
    plan = plan.join(first.withColumnRenamed("conv_id", "base"), "base", "left").select("conv_id", "h", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int")).alias("head"))
    plan = written(plan, "rebuilding")
    begun = plan.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.position", "t.id")
    later = lookup(turns, plan.select("conv_id", "h", F.size("head").alias("taken")), ["conv_id"])
    later = later.filter("position >= h").select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "id")
    return begun.unionByName(later), own.select("conv_id")


def _hashes(position: Column, turn: Column) -> tuple[Column, Column]:
    return F.xxhash64(position, turn), F.xxhash64(turn, position, F.lit("second"))


def blocks(turns: DataFrame, conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per conversation and block: conv_id, block, the node before it (before1, before2),
    t1 ... of its turns. A turnless conversation has one row without turns."""
    slot, block = F.col("position") % width, F.expr(f"position div {width}").alias("block")
    one, two = _hashes(F.col("position").cast("long"), F.col("id"))
    columns = [F.max(F.when(slot == j, F.col("id"))).alias(f"t{j + 1}") for j in range(width)]
    dealt = turns.groupBy("conv_id", block).agg(*columns, F.bit_xor(one).alias("own1"), F.bit_xor(two).alias("own2"))
    dealt = written(dealt, "blocks")
    running = before_it(dealt, "conv_id", "block", {"before1": F.bit_xor("own1"), "before2": F.bit_xor("own2")}, F.bit_xor("own1"))
    turnless = conversations.join(dealt.filter("block = 0").select("conv_id"), "conv_id", "left_anti")
    empty = turnless.select("conv_id", F.lit(0).cast("long").alias("block"), *[F.lit(None).cast("binary").alias(f"t{j + 1}") for j in range(width)], *[F.lit(0).cast("long").alias(c) for c in ("own1", "own2", "before1", "before2")])
    return written(running.unionByName(empty), "trie_blocks")


def _rolled(rows: DataFrame, aggregates: str, width: int) -> DataFrame:
    """Aggregates of every node: depth, key1, key2 of the node and of its parent, last turn."""
    names = ", ".join(f"t{j + 1}" for j in range(width))
    rolled = rows.sparkSession.sql(
        f"""SELECT block, before1, before2, {names}, {width} - bit_count(grouping_id() & {(1 << width) - 1}) AS level, {aggregates}
            FROM {{rows}} GROUP BY block, before1, before2, ROLLUP ({names})""",
        rows=rows,
    )
    ids = F.array(*[f"t{j + 1}" for j in range(width)])
    last = F.when(F.col("level") > 0, F.element_at(ids, F.greatest(F.col("level"), F.lit(1)).cast("int")))
    # A level beyond a conversation's last turn repeats its prefix; the block's own start is the
    # last level of the block before.
    rolled = rolled.withColumn("last", last).filter("last is not null or (block = 0 and level = 0)")
    depth = (F.col("block") * width + F.col("level")).cast("long")
    keys, parents = [], []
    for k in range(2):
        key = F.col(f"before{k + 1}")
        for j in range(width):
            own = _hashes((F.col("block") * width + j).cast("long"), F.col(f"t{j + 1}"))[k]
            key = key.bitwiseXOR(F.when(F.col(f"t{j + 1}").isNotNull(), own).otherwise(F.lit(0)))
        parent = key.bitwiseXOR(F.when(F.col("level") > 0, _hashes(depth - 1, F.col("last"))[k]).otherwise(F.lit(0)))
        keys.append(key.alias(f"key{k + 1}"))
        parents.append(parent.alias(f"parent{k + 1}"))
    measures = [c for c in rolled.columns if c not in ("block", "before1", "before2", "level", "last", *[f"t{j + 1}" for j in range(width)])]
    return rolled.select(depth.alias("depth"), *keys, *parents, "last", *measures)


def _ends(rows: DataFrame, width: int) -> DataFrame:
    """The node that each conversation ends in, and the digest of the ids that end there: depth,
    key1, key2, ends_sha256."""
    taken = sum((F.col(f"t{j + 1}").isNotNull().cast("int") for j in range(width)), F.lit(0))
    last = rows.groupBy("conv_id").agg(F.max_by(F.struct((F.col("block") * width + taken).alias("depth"), F.col("before1").bitwiseXOR(F.col("own1")).alias("key1"), F.col("before2").bitwiseXOR(F.col("own2")).alias("key2")), "block").alias("node"))
    ends = written(last.select(F.col("node.depth").cast("long").alias("depth"), "node.key1", "node.key2", "conv_id"), "ends")
    python_on_executors(rows.sparkSession)
    joined = pa.schema([*((c, pa.int64()) for c in (*KEY, "first_id")), ("ids", pa.string())])
    digest = pa.schema([*((c, pa.int64()) for c in KEY), ("ends_sha256", pa.string())])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size = None, [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{**dict(zip(KEY, node, strict=True)), "first_id": int(ids[0]), "ids": ",".join(ids)}], schema=joined)

        for batch in batches:
            done = []
            for *key, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ids and (key != node or size > CHUNK):
                    done.append(row())
                    ids, size = [], 0
                node = key
                ids.append(str(conv_id))
                size += len(ids[-1]) + 1
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        if ids:
            yield row()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            done = []
            for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key == node:
                    running.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, running.hexdigest()))
                node, running = key, sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), digest, strict=True)], schema=digest)
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*node, running.hexdigest()), digest, strict=True)], schema=digest)

    order = [*KEY, "conv_id"]
    chunks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "depth long, key1 long, key2 long, first_id long, ids string")
    by_node = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first_id")
    return by_node.mapInArrow(digested, "depth long, key1 long, key2 long, ends_sha256 string")


def trie(turns: DataFrame, conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """Every node of the trie of ``turns`` (conv_id, position from 0 without gaps, id) of the
    ``conversations`` (conv_id, turnless ones included).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and the node's key (key1, key2).
    """
    rows = blocks(turns, conversations, width)
    nodes = _rolled(rows, "count(*) AS n_convs, min(conv_id) AS conv_id", width)
    saved = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * text_bytes(F.col("last"))).otherwise(F.lit(0).cast("long"))
    nodes = written(nodes.withColumn("saved", saved).drop("last"), "nodes")
    under = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent1").alias("key1"), F.col("parent2").alias("key2")).agg(F.count("*").alias("n_children"))
    grown = nodes.join(under, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    grown = written(grown.withColumn("leaf", (F.col("n_children") == 0).cast("long")), "nodes")
    # What each conversation stands for as smallest member, and what it does above each such node.
    stands = written(grown.groupBy("conv_id").agg(F.sum("saved").alias("stands_saved"), F.sum("leaf").alias("stands_leaves")).filter("stands_saved > 0 or stands_leaves > 0"), "stands")
    members = lookup(rows, stands, ["conv_id"])
    totals = _rolled(members, "sum(coalesce(stands_saved, 0)) AS all_saved, sum(coalesce(stands_leaves, 0)) AS n_leaves", width).select(*KEY, "all_saved", "n_leaves")
    above = before_it(grown, "conv_id", "depth", {"above": F.sum("saved")})
    parents = grown.select((F.col("depth") + 1).alias("depth"), F.col("key1").alias("parent1"), F.col("key2").alias("parent2"), F.col("conv_id").alias("parent_conv_id"))
    above = lookup(written(above, "nodes"), parents, ["depth", "parent1", "parent2"])
    joined = above.join(totals, KEY).join(_ends(rows, width), KEY, "left")
    return joined.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("all_saved") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
        "key1",
        "key2",
    )
