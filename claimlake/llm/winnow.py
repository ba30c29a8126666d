"""Document fingerprints by winnowing, in DataFrame functions only.

Words (runs of letters and digits; each Han, kana, Hangul or Thai character by itself) are hashed,
a rolling polynomial over ``K`` of them modulo a prime gives the k-gram hashes, and each window of
``W`` consecutive k-grams contributes its smallest hash, the rightmost one on ties, with its
position. So two texts that share ``K + W - 1`` consecutive words share a fingerprint, and no
match shorter than ``K`` words is ever reported.

The rolling hash comes from prefix doubling (hash of two words, of four), the window minimum from
doubling too (least of two, of four), both as ``zip_with`` over shifted arrays: a constant number
of passes over a text, however long.

Defined results: a null text is an empty text; a text without words is one gram of its whole text;
one of fewer than ``K`` words is one gram of all of them, one of fewer than ``W`` k-grams is one
window; an empty text has an empty fingerprint, like any other only to itself. Rows that repeat an
id follow each other by their text's hash; a null id comes last in descending order. However many
rows repeat an id, or have none, they are parted by that hash among tasks. An empty table gives no
rows, other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlake.llm.common import need, text_or_empty, written

GRAM, WINDOW = 4, 4
PRIME, BASE = 2147483647, 1000003
#: Positions fit below this; packed values are hash * SHIFT + (SHIFT - 1 - position).
SHIFT = 1 << 31
#: Rows with consecutive ids that one group of the ordered pass holds.
ROWS = 500
#: The group of rows without an id, below all others; the most rows of a table that is broadcast.
NO_ID, BROADCAST_ROWS = -(1 << 62), 500_000
#: A group of more than so many times its rows is parted; equal rows that one task writes out.
HOT, PORTION = 4, 10_000
#: Scripts without spaces between words: Thai, kana, Han, Hangul.
_SINGLE = r"\u0e00-\u0e7f\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af"
WORDS = rf"[\p{{L}}\p{{N}}&&[^{_SINGLE}]]+|[{_SINGLE}]"


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.greatest(F.size(values) - by, F.lit(0)))


def _pairs(values: Column, by: int, combine) -> Column:
    """``combine(v[i], v[i + by])`` for every i that has both."""
    n = F.greatest(F.size(values) - by, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), _shifted(values, by), combine)


def _roll(by: int):
    power = pow(BASE, by, PRIME)
    return lambda a, b: (a * power + b) % PRIME


def add_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: array of (hash, position) packed into longs, in order of position.

    Each step is a column of its own, so that no array is computed twice.
    """
    h, g, p, m = (f"__{out}_{x}" for x in ("h", "g", "p", "m"))
    steps = df.withColumn(h, F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0)), lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME))))
    # Few words: one gram of all of them; none: one of the whole text.
    short = F.pmod(F.xxhash64(F.when(F.size(h) == 0, F.col(text)).otherwise(F.array_join(F.transform(F.col(h), lambda x: x.cast("string")), " "))), F.lit(PRIME))
    two = f"__{out}_two"
    steps = steps.withColumn(two, _pairs(F.col(h), 1, _roll(1)))
    steps = steps.withColumn(g, F.when(F.length(text) == 0, F.array().cast("array<bigint>")).when(F.size(h) < GRAM, F.array(short)).otherwise(_pairs(F.col(two), 2, _roll(2)))).drop(h, two)
    steps = steps.withColumn(p, F.transform(g, lambda x, i: x * SHIFT + (SHIFT - 1 - i))).drop(g)
    steps = steps.withColumn(two, _pairs(F.col(p), 1, lambda a, b: F.least(a, b)))
    chosen = F.when(F.size(p) < WINDOW, F.slice(F.array(F.array_min(p)), 1, F.least(F.size(p), F.lit(1)))).otherwise(F.array_distinct(_pairs(F.col(two), 2, lambda a, b: F.least(a, b))))
    return steps.withColumn(out, chosen).drop(p, two)


def hashes(packed: Column | str) -> Column:
    return F.transform(packed, lambda x: F.shiftright(x, 31))


def as_string(packed: Column | str) -> Column:
    """``hash@position`` in hexadecimal, comma-joined, in order of position."""
    return F.array_join(F.transform(packed, lambda x: F.concat(F.lower(F.hex(F.shiftright(x, 31))), F.lit("@"), F.lower(F.hex(F.lit(SHIFT - 1) - x.bitwiseAND(F.lit(SHIFT - 1)))))), ",")


def likeness(a: str, b: str) -> Column:
    """Share of common hashes among all distinct hashes of two ``hashes`` columns; 1 for two empty ones."""
    common, every = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (string), packed (array) of every row."""
    need(docs, "doc_id", "text")
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return add_fingerprint(rows, "text", "packed").select("doc_id", as_string("packed").alias("fingerprint"), "packed")


def _bounded(df: DataFrame) -> tuple[DataFrame, int]:
    """``df``, broadcast if it has few rows, and its number of rows; ``df`` is a written table."""
    n = df.count()
    return (F.broadcast(df) if n <= BROADCAST_ROWS else df), n


def _placed(base: DataFrame, rows: int) -> tuple[DataFrame, bool]:
    """``base`` with ``place`` and ``times``, and whether any row stands for several.

    A place is a group of consecutive ids; larger places come first in descending order. A group
    with more than ``HOT`` times ``rows`` rows (ids that repeat, no ids) is parted by id, and an id
    of more than ``rows`` rows by ranges of the text's hash, which is the order within it. Equal rows of
    such a group are one row, with their number in ``times``: they follow each other.
    """
    place = lambda i, back: F.struct("group", i.cast("long").alias("id"), back.cast("long").alias("back")).alias("place")
    counts = base.groupBy("group").count().filter(F.col("count") > HOT * rows)
    hot, n_hot = _bounded(written(counts.select("group"), "hot_groups"))
    calm = base if n_hot == 0 else base.join(hot, "group", "left_anti")
    calm = calm.select("doc_id", "text", "order", place(F.lit(0), F.lit(0)), F.lit(1).cast("long").alias("times"))
    if n_hot == 0:
        return calm, False
    inside = base.join(hot, "group", "left_semi")
    many = inside.groupBy("doc_id").count().filter(F.col("count") > rows)
    many = many.select(F.col("doc_id").alias("many_id"), (F.lit(1) + F.expr(f"count div {int(rows)}")).alias("parts"))
    many, _ = _bounded(written(many, "hot_ids"))
    classes = inside.groupBy("group", "doc_id", "order", "text").agg(F.count(F.lit(1)).alias("times"))
    classes = classes.join(many, F.col("doc_id").eqNullSafe(F.col("many_id")), "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    # Hashes spread evenly: this part of their range, from the least on.
    part = F.least(F.floor((F.col("order") / F.lit(2.0**64) + 0.5) * F.col("parts")), F.col("parts") - 1)
    parted = classes.select("doc_id", "text", "order", place(F.coalesce("doc_id", F.lit(0)), -part), "times")
    return calm.unionByName(written(parted, "hot_rows")), True


def in_order(docs: DataFrame, rows: int = ROWS) -> tuple[DataFrame, bool]:
    """doc_id, text, place, copy, order, times: rows in places of consecutive ids, each place closed
    by a copy (``copy`` = 1) of the row that follows it in descending ``doc_id``, cyclically; and
    whether a row may stand for several equal ones.

    Which place hands its first row to which comes from the places alone, a table of one row a
    place, range-partitioned. The texts are shuffled once, by place.
    """
    need(docs, "doc_id", "text")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    group = F.coalesce(F.floor(F.col("doc_id") / rows).cast("long"), F.lit(NO_ID))
    base, repeated = _placed(base.select("doc_id", "text", group.alias("group"), F.xxhash64("text").alias("order")), rows)
    # The first row of a place: the largest id, then the smallest text hash.
    firsts = base.groupBy("place").agg(F.max(F.struct("doc_id", (-F.col("order").cast("decimal(20,0)")).alias("down"))).alias("first"))
    firsts = firsts.select("place", F.col("first.doc_id").alias("first_id"), (-F.col("first.down")).cast("long").alias("first_order"))
    sent, _ = _bounded(written(firsts.join(_receivers(written(firsts.select("place"), "places")), "place"), "handed_on"))
    is_first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("order") == F.col("first_order"))
    copies = base.join(sent.withColumnRenamed("place", "from_place"), (F.col("place") == F.col("from_place")) & is_first)
    copies = copies.select("doc_id", "text", F.col("to").alias("place"), "order", F.lit(1).alias("copy"), "times")
    return base.withColumn("copy", F.lit(0)).unionByName(copies), repeated


def _receivers(places: DataFrame) -> DataFrame:
    """place, to: the next larger place; for the largest one, the smallest."""
    dealt = written(places.repartitionByRange("place").withColumn("part", F.spark_partition_id()), "place_ranges")
    ends = dealt.groupBy("part").agg(F.min("place").alias("low"))  # a row per partition
    by_part = W.partitionBy(F.lit(0)).orderBy("part")
    after = ends.select("part", F.coalesce(F.lead("low").over(by_part), F.first("low").over(by_part)).alias("low_after"))
    up = F.lead("place").over(W.partitionBy("part").orderBy("place"))
    return dealt.withColumn("up", up).join(after, "part").select("place", F.coalesce("up", "low_after").alias("to"))


def _expanded(found: DataFrame) -> DataFrame:
    """Each row as often as its ``times`` says; rows of many times are dealt to tasks in portions."""
    found = written(found, "classes")
    few = found.filter(F.col("times") <= PORTION)
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {PORTION}")))
    many = found.filter(F.col("times") > PORTION).withColumn("chunk", chunk)
    many = many.withColumn("times", F.least(F.lit(PORTION), F.col("times") - F.col("chunk") * PORTION))
    many = many.repartition("doc_id", "edited_sha256", "chunk").drop("chunk")
    again = F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))).alias("__again")
    return few.unionByName(many).select("*", again).drop("__again", "times")


def compare_edited(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """Each row with its fingerprint, the text whose last third is replaced by the start of the
    next row's, that text's fingerprint, and how alike they are."""
    order = [F.col("copy"), F.desc_nulls_last("doc_id"), F.col("order")]
    placed, repeated = in_order(docs, rows)
    dealt = placed.repartition("place").sortWithinPartitions("place", *order)
    marked = add_fingerprint(dealt, "text", "packed").withColumn("own", hashes("packed"))
    nearby = W.partitionBy("place").orderBy(*order)
    paired = marked.select("*", F.lead("text").over(nearby).alias("next_text"), F.lead("own").over(nearby).alias("next_own")).filter("copy = 0")
    if repeated:
        # Of equal rows all but the last are followed by one like themselves.
        last = F.struct(F.col("next_text").alias("t"), F.col("next_own").alias("o"), F.lit(1).cast("long").alias("n"))
        others = F.struct(F.col("text").alias("t"), F.col("own").alias("o"), (F.col("times") - 1).alias("n"))
        both = F.explode(F.filter(F.array(last, others), lambda x: x["n"] > 0)).alias("next")
        paired = paired.select("*", both).withColumns({"next_text": F.col("next.t"), "next_own": F.col("next.o"), "times": F.col("next.n")})
    n = F.length("text")
    cut = F.expr("length(text) div 3").cast("int")
    edited = paired.withColumn("edited", F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut)))
    edited = add_fingerprint(edited, "edited", "edited_packed").withColumn("edited_own", hashes("edited_packed"))
    found = edited.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string("packed").alias("fingerprint"),
        as_string("edited_packed").alias("edited_fingerprint"),
        likeness("own", "edited_own").alias("near_edited"),
        likeness("own", "next_own").alias("near_next"),
        "times",
    )
    return _expanded(found) if repeated else found.drop("times")
