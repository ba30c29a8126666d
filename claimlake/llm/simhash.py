"""SimHash near-duplicates with pigeonring filtering.

A document's fingerprint has a bit set where over half of its word shingles' hashes have it.
Fingerprints within ``distance`` bits of each other are linked; a component is what links reach.

1. Equal fingerprints are one node (their smallest ``doc_id`` stands for them), so exact copies
   never meet in a join.
2. The 64 bits are a ring of segments. Two fingerprints within ``distance`` bits agree on at least
   ``segments - distance`` segments, so each node goes to one bucket per choice of that many.
3. A bucket is read as a sorted stream. Its pairs must pass the pigeonring test, a chain of
   consecutive segments from some start whose differences, summed along the chain, never exceed
   the proportional share of ``distance``; only then are all bits compared. A bucket gives a link
   from each member to the first of its part of the bucket, never all pairs.
4. A bucket of more than ``BUCKET`` nodes is dealt again by a finer choice: the bits that the
   bucket leaves open are cut into smaller blocks, all but ``distance`` of which must agree, so
   few bits stay open and no bucket can be larger than those allow. No pair is lost, none sampled.
5. Components come from alternating large-star and small-star steps over written tables.

Defined results: a null text is an empty text; texts without words have fingerprint 0 and are
linked like any other; a null ``doc_id`` gets a component but never names one (a component whose
ids are all null has a null id); repeated rows are exact copies; an empty table gives no rows;
other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import need, python_on_executors, text_or_empty, written

SHINGLE, DISTANCE, SEGMENTS = 3, 3, 6
#: Nodes of a bucket that are compared in memory; larger buckets are dealt by finer blocks.
BUCKET = 8192
SEED = 42


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """SimHash of a text: words between ASCII white space, A-Z lower-cased, XXH64 of shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if n > 1 or len(words) == shingle else [b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (as a signed long) of each row."""
    need(docs, "doc_id", "text")
    python_on_executors(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, fingerprint long")


class Ring:
    """The 64 bits as a ring of segments, and the pigeonring test on pairs."""

    def __init__(self, segments: int = SEGMENTS, distance: int = DISTANCE):
        self.distance = distance
        edges = [round(i * 64 / segments) for i in range(segments + 1)]
        self.spans = list(zip(edges[:-1], edges[1:], strict=True))
        self.shares = [(k + 1) * distance // segments for k in range(segments)]
        self.choices = list(combinations(range(segments), segments - distance))

    def linked(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs (broadcast against each other) are within the distance."""
        differ = a ^ b
        parts = [np.bitwise_count((differ >> np.uint64(s)) & np.uint64((1 << e - s) - 1)) for s, e in self.spans]
        out = np.zeros(differ.shape, bool)
        for start in range(len(parts)):
            viable, total = parts[start] <= self.shares[0], parts[start]
            for k in range(1, len(parts)):
                total = total + parts[(start + k) % len(parts)]
                viable &= total <= self.shares[k]
            out |= viable
        out[out] = np.bitwise_count(differ[out]) <= self.distance
        return out

    def masks(self) -> list[int]:
        """For each choice of segments, the bits that its buckets agree on."""
        return [sum((1 << e) - (1 << s) for i, (s, e) in enumerate(self.spans) if i in c) for c in self.choices]

    def finer_masks(self, mask: int, blocks: int) -> list[int]:
        """The same for a bucket of ``mask``: its open bits in ``blocks`` blocks, ``distance`` of them open."""
        free = [i for i in range(64) if not mask >> i & 1]
        cut = [free[round(i * len(free) / blocks) : round((i + 1) * len(free) / blocks)] for i in range(blocks)]
        return [(1 << 64) - 1 - sum(1 << i for i in chain(*c)) for c in combinations(cut, self.distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucket_rows(nodes: DataFrame, masks: Column) -> DataFrame:
    """A row for each node and mask: which mask, what the node has under it, the node."""
    return nodes.select(F.posexplode(masks).alias("choice", "mask"), "node").select("choice", F.col("mask").bitwiseAND(F.col("node")).alias("kept"), "node")


def _stars(nodes: np.ndarray, ring: Ring) -> Iterator[tuple[int, int]]:
    """Links from each node to the first of its component within the bucket."""
    waiting = nodes
    while len(waiting) > 1:
        root, waiting, frontier = waiting[0], waiting[1:], waiting[:1]
        while len(frontier) and len(waiting):
            near = np.zeros(len(waiting), bool)
            for at in range(0, len(frontier), 64):
                near |= ring.linked(frontier[at : at + 64, None], waiting[None, :]).any(0)
            frontier, waiting = waiting[near], waiting[~near]
            yield from ((int(x), int(root)) for x in frontier)


def _links(rows: DataFrame, ring: Ring, bucket: int) -> DataFrame:
    """Links within buckets (choice, kept); buckets over ``bucket`` nodes come back as rows with
    their choice, for a finer deal (choice is -1 in a link)."""
    schema = pa.schema([("choice", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, large = [], None, False  # the bucket that the last batch left open

        def batch_of(choice, a, b):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((choice, a, b), schema, strict=True)], schema=schema)

        def closed(nodes: np.ndarray) -> Iterator[pa.RecordBatch]:
            if pairs := list(_stars(np.unique(nodes.view(np.uint64)), ring)):
                a, b = np.array(pairs, np.uint64).view(np.int64).T
                yield batch_of(np.full(len(a), -1), a, b)

        for batch in batches:
            choice, kept, node = (batch.column(c).to_numpy() for c in range(3))
            if not len(node):
                continue
            first = np.flatnonzero(np.r_[True, (choice[1:] != choice[:-1]) | (kept[1:] != kept[:-1])])
            end = np.r_[first[1:], len(node)]
            pair = np.flatnonzero((end - first == 2) & (first > 0) & (end < len(node)))  # most buckets that have any pair
            a, b = node[first[pair]], node[first[pair] + 1]
            near = ring.linked(a.view(np.uint64), b.view(np.uint64)) & (a != b)
            if near.any():
                yield batch_of(np.full(near.sum(), -1), a[near], b[near])
            for k in np.flatnonzero((end - first > 2) | (first == 0) | (end == len(node))):
                s, e = first[k], end[k]
                if key != (choice[s], kept[s]):
                    if held and not large:
                        yield from closed(np.concatenate(held))
                    held, key, large = [], (choice[s], kept[s]), False
                held.append(node[s:e])
                if large or sum(map(len, held)) > bucket:
                    large, rest = True, np.concatenate(held)
                    held = []
                    yield batch_of(np.full(len(rest), key[0]), rest, rest)
        if held and not large:
            yield from closed(np.concatenate(held))

    ordered = rows.repartition("choice", "kept").sortWithinPartitions("choice", "kept", "node")
    return ordered.mapInArrow(run, "choice int, a long, b long")


def links(nodes: DataFrame, ring: Ring | None = None, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``node`` that connect all within the distance."""
    ring = ring or Ring()
    python_on_executors(nodes.sparkSession)
    every = F.array(*[F.lit(_signed(m)) for m in ring.masks()])
    found = written(_links(_bucket_rows(nodes, every), ring, bucket), "simhash_links")
    result = found.filter("choice < 0").select("a", "b")
    large = found.filter("choice >= 0").select("choice", F.col("a").alias("node"))
    if not large.isEmpty():
        free = max(64 - m.bit_count() for m in ring.masks())
        blocks = next(n for n in range(ring.distance + 1, free + 1) if 1 << ring.distance * -(-free // n) <= bucket or n == free)
        finer = [F.array(*[F.lit(_signed(x)) for x in ring.finer_masks(m, blocks)]) for m in ring.masks()]
        parts = [_bucket_rows(large.filter(F.col("choice") == i).distinct(), m) for i, m in enumerate(finer)]
        # the numbers of finer choices are made distinct for each coarse one
        dealt = [p.withColumn("choice", F.col("choice") + F.lit(i * 1_000_000)) for i, p in enumerate(parts)]
        rows = dealt[0]
        for more in dealt[1:]:
            rows = rows.unionByName(more)
        result = result.unionByName(_links(rows, ring, 1 << 64).select("a", "b"))
    return result.distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for each node that has a link: the smallest node that its links reach."""
    small = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    current, last = written(small, "stars"), None
    while not current.isEmpty():
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large_star = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        current = written(large_star, "stars")
        least = current.groupBy("u").agg(F.min("v").alias("m"))
        joined = current.join(least, "u")
        small_star = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        current = written(small_star, "stars")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(current.select("v", "v").distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, segments: int = SEGMENTS, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (long), component_id per row of ``docs``."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    nodes = written(prints.groupBy(F.col("fingerprint").alias("node")).agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = components(links(nodes.select("node"), Ring(segments, distance), bucket))
    rooted = nodes.join(roots, "node", "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = written(rooted.join(named, "root").select(F.col("node").alias("fingerprint"), "root", "component_id"), "named")
    return prints.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id", "root")


def keep_one(docs: DataFrame, **parameters: int) -> DataFrame:
    """The rows of ``docs`` that stand for their component, one each: the smallest ``doc_id``.

    Rows that share that id within one component are told apart by their columns' hash. Where all
    ids of a component are null, one of its rows stays likewise.
    """
    found = written(near_duplicates(docs, **parameters), "components")
    heads = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    # Roots that a plain choice by id can't settle: with several heads, or whose head's id also
    # stands on another row.
    twice = found.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    crowded = heads.groupBy("root").agg(F.count("*").alias("n")).filter("n > 1").select("root")
    several = crowded.union(heads.join(twice, "doc_id", "left_semi").select("root")).distinct()
    plain = heads.join(several, "root", "left_anti").select("doc_id").filter("doc_id is not null")
    shared = heads.join(several, "root", "left_semi")
    nameless = heads.filter("doc_id is null")
    if shared.isEmpty() and nameless.isEmpty():
        return docs.join(plain, docs["doc_id"] == plain["doc_id"], "left_semi")
    # Rare: ids that repeat or are null. Their rows are fingerprinted again with all their columns.
    ids = plain.withColumnRenamed("doc_id", "plain_id").join(shared.select(F.col("doc_id").alias("plain_id")), "plain_id", "left_anti")
    simple = docs.join(ids, docs["doc_id"] == ids["plain_id"], "left_semi")
    odd_ids = heads.select("doc_id").filter("doc_id is not null").join(ids, F.col("doc_id") == F.col("plain_id"), "left_anti").distinct()
    odd = docs.filter("doc_id is null").unionByName(docs.join(odd_ids, "doc_id", "left_semi").select(docs.columns))
    packed = odd.select(F.struct(*odd.columns).alias("row"), F.xxhash64(*odd.columns).alias("order"), F.col("doc_id"), F.col("text"))
    roots = _with_fingerprint(packed, parameters.get("shingle", SHINGLE)).join(found.select("fingerprint", "root", "component_id").distinct(), "fingerprint")
    one = roots.filter(F.col("row.doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min_by("row", F.struct("order", "row")).alias("row"))
    return simple.unionByName(one.select("row.*"))


def _with_fingerprint(packed: DataFrame, shingle: int) -> DataFrame:
    """The packed rows with their fingerprint, by way of a row number that Spark gives them."""
    stored = written(packed.withColumn("at", F.monotonically_increasing_id()), "odd_rows")
    marks = fingerprints(stored.select(F.col("at").alias("doc_id"), "text"), shingle).withColumnRenamed("doc_id", "at")
    return stored.join(marks, "at").select("row", "order", "fingerprint")
