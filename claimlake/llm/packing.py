"""Packing token sequences into fixed windows by best-fit decreasing.

``cut_documents`` tokenizes whole texts and cuts each id list into full windows and a rest.
``place_pieces`` gives every piece its window and its offset there. Pieces of one length are
interchangeable, so best-fit decreasing needs only how many there are of each length, a table of
at most ``capacity`` rows whatever the input: a segment tree over the remaining capacities finds
the tightest open window for the next length, and the resulting runs (a length, a range of ranks,
a range of windows) are broadcast. Ranks within a length are counted by the tasks that cut the
pieces and made global by a running sum over tasks, so that no length, however common, meets in
one task.

Defined results: a null text is an empty text, whose document is the end id alone; repeated rows
and ids are packed one by one; an empty table gives no pieces; other columns are not carried, so
clashing names do no harm. Pieces of equal length are placed in the order of their input tasks; of
equally tight windows the one of smallest number is taken.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlake.llm.common import need, python_on_executors, slices, text_or_empty, written
from claimlake.llm.tokens import definition, encoder
from claimlake.session import sql_conf

CAPACITY = 1024
#: Bytes of an Arrow batch of texts (at least one row).
BATCH_BYTES = 4_000_000
PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, part int, nth long"


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, with_ids: bool = True, remember: int = 500_000) -> DataFrame:
    """One row per piece: ``ids`` (little-endian unsigned 32-bit; null unless ``with_ids``) and
    their checksum, its place in its document, and ``part``/``nth``: the task that cut it and its
    number there among pieces of its length.

    The result is a written table, as later steps read it more than once. Texts reach Python in
    batches of ``BATCH_BYTES``: those of 10,000 rows, each held on both sides of the pipe and again
    as strings, took more memory than the words that an encoder remembers.
    """
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    python_on_executors(spark)
    tokens = spark.sparkContext.broadcast(definition(tokenizer))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())])
    end, step = end_id.to_bytes(4, "little"), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        encode = encoder(tokens.value, remember).encode
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(map(len, texts), 4_000_000):
                rows = []
                for doc_id, ids in zip(doc_ids[a:b], encode(texts[a:b]), strict=True):
                    ids += end
                    for at in range(0, len(ids), step):
                        piece = ids[at : at + step]
                        length = len(piece) // 4
                        rows.append((doc_id, at // 4, length, piece if with_ids else None, crc32(piece), len(ids) // 4, part, seen[length]))
                        seen[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    cut = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, PIECE_SCHEMA)
    with sql_conf(spark, spark__sql__execution__arrow__maxBytesPerBatch=str(BATCH_BYTES)):
        return written(cut if with_ids else cut.drop("ids"), "pieces", "zstd")


class Tightest:
    """Segment tree over remaining capacities: the smallest one, at least as large as asked for,
    at which a window is open."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, at: int, is_open: bool) -> None:
        at += self.leaves
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def find(self, least: int) -> int | None:
        at = least + self.leaves
        if self.open[at]:
            return at - self.leaves
        while at > 1:  # up to the first ancestor whose right neighbour has an open window
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                break
            at //= 2
        else:
            return None
        while at < self.leaves:  # down to its leftmost
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of ``counts[length]`` pieces: runs (length, first rank, end rank, first
    window, pieces a window, offset). Piece ``i`` of a run lies in window ``first + i // each`` at
    ``offset + i % each * length``.

    The tightest window of remaining capacity r takes ``r // length`` pieces of that length before
    any other is touched, as it stays the tightest; so windows of one capacity are filled together.
    Spans of windows with equal room lie in a heap by their first window.
    """
    tree, spans, runs, windows = Tightest(capacity), {}, [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            heapq.heappush(spans.setdefault(room, []), (first, n))
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.find(length)
            if room is None:
                room, each = capacity, capacity // length
                first, n = windows, -(-left // each)
                windows += n
            else:
                first, n = heapq.heappop(spans[room])
                if not spans[room]:
                    tree.set(room, False)
                each = room // length
            full = min(n, left // each)
            odd = left - full * each if full < n else 0
            taken = full * each + odd
            runs.append((length, rank, rank + taken, first, each, capacity - room))
            put(room - each * length, first, full)
            if odd:
                put(room - odd * length, first + full, 1)
            put(room, first + full + bool(odd), n - full - bool(odd))
            rank, left = rank + taken, left - taken
    return runs


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` (from 0, gapless) and ``offset`` (in its window, gapless)."""
    need(pieces, "length", "part", "nth")
    spark: SparkSession = pieces.sparkSession
    by_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    totals = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs = spark.createDataFrame(
        best_fit_runs(totals, capacity),
        "length long, first_rank long, end_rank long, first_window long, each long, room_from long",
    )
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_nth"))
    ranked = pieces.join(starts, ["part", "length"]).withColumn("rank", F.col("first_nth") + F.col("nth"))
    i: Column = F.col("rank") - F.col("first_rank")
    placed = ranked.alias("p").join(
        F.broadcast(runs).alias("r"),
        (F.col("p.length") == F.col("r.length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")),
    )
    return placed.select(
        *[F.col(f"p.{c}") for c in pieces.columns if c not in ("part", "nth")],
        (F.col("first_window") + F.expr("(rank - first_rank) div each")).alias("sequence_id"),
        (F.col("room_from") + i % F.col("each") * F.col("p.length")).alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with their ids and places: doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset."""
    return place_pieces(cut_documents(docs, tokenizer, end_id, capacity), capacity)


def packed_rows(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, remember: int = 500_000) -> DataFrame:
    """Pieces with a checksum of their ids instead of the ids, so that only small rows are written and shuffled.

    A worker's encoder knows the ids of up to twice ``remember`` words; fewer take less memory and more time."""
    return place_pieces(cut_documents(docs, tokenizer, end_id, capacity, with_ids=False, remember=remember), capacity)


def sequences(placed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """One row per window: its ids (binary, as in the pieces), padded with ``pad_id`` to
    ``capacity`` unless the window's length is a power of two. A window has at most ``capacity``
    pieces, so each group is bounded."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (F.lit(capacity) - F.col("length")).cast("int")))
    power = F.bit_count("length") == 1
    filled = placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p))
    return filled.select("sequence_id", "length", F.when(power, joined).otherwise(F.concat(joined, pad)).alias("ids"))
