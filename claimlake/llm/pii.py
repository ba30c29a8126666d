"""Personal data by candidate spans and gradient-boosted trees, in DataFrame functions only.

High-recall patterns propose spans, which may overlap; each gets features of its format and of
the text around it. Boosted trees, fitted on the driver on a bounded sample of texts of each kind,
give a probability as a column expression, and a threshold for each kind, calibrated by counts over
the candidates of all texts that the trees haven't seen, selects what is redacted. The base patterns with their checks (checksum,
octets, numbers of digits) always stay.

The trees learn from the corpus: candidates that are base spans, and the same spans rewritten (no
international prefix, dots in a card number, "(at)" and "(dot)" in an address), are examples of
personal data; all other candidates are not.

Positions come from the pieces between matches (``split``) and the matches themselves, which
alternate; nothing is exploded and no text is shuffled. A text's work grows with its length and its
matches, not with their square: overlaps are settled among spans that overlap in turn, and redacted
texts are put together from their pieces.

Defined results: a null text is an empty text, without spans; equal rows get equal spans; spans
are in code points, the end exclusive; a chosen span never overlaps a base span, and of chosen
spans that overlap the likelier stays (then the earlier, then the longer, then the kind first
listed); without examples of both classes nothing is added; an empty table gives no rows;
clashing columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlake.llm import boosting
from claimlake.llm.common import need, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
# The base patterns: possessive forms and "a match begins where a run begins, or where the last
# match ended" match the same spans, without useless tries and without recursion in long texts.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:[0-9][0-9]++|[0-9][\x20-][0-9]++)(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_DOT = r"(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)"
PROPOSALS = {
    "email": rf"(?:\G|(?<![\p{{L}}0-9._%+-]))[\p{{L}}0-9._%+-]++(?:@|\x20?[\[(](?:at|AT)[\])]\x20?|\x20at\x20)[\p{{L}}0-9-]++(?:{_DOT}[\p{{L}}0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:\x20?\.\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,18}(?![0-9])",
    "phone": r"(?<![0-9])[+(]{0,2}[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}(?![0-9])",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CUES = r"(?i)(?:mail|contact|write|phone|tel|call|fax|mobile|cell|card|visa|pay|ip|host|server|address)[^\p{L}\p{N}]*$"
#: Texts that the trees learn from, at most, and different candidates of each; the precision that a
#: kind's threshold must reach; the steps in which scores are counted.
SAMPLE, EXAMPLES, PRECISION, STEPS = 2000, 100, 0.98, 10_000
NAMES = ["kind", "length", "digits", "letters", "spaces", "dots", "dashes", "parens", "plus", "at", "longest", "groups", "luhn", "octets", "joined_before", "joined_after", "cue"]


def _count(value: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{pattern}]", ""))


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    digits = F.filter(F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), ""), lambda c: c != "")
    each = F.transform(digits, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 % 10 + F.when(c >= "5", 1).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda s, d: s + d) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = _count(value, "0-9")
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: value.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$"),
        "card": lambda: F.when(digits.between(16, 19), luhn(value)).otherwise(False),
        "phone": lambda: digits.between(8, 15),
    }[kind]()


def _might_match(kind: str, text: str) -> Column:
    return F.col(text).rlike(r"@|[\[( ](?:at|AT)[\]) ]" if kind == "email" else "[0-9]")


#: Arrays up to this long are walked with a growing result, whose copies cost the square of it;
#: longer ones block by block.
BLOCK = 128


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def running(numbers: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each number of an array, what zero and the numbers before it combine to."""
    zero = F.lit(0)

    def walk(values: Column, start: Column) -> Column:
        return F.aggregate(
            values,
            F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct(combine(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )

    def by_blocks(values: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(1), F.size(values), F.lit(BLOCK)), lambda i: F.slice(values, i, F.lit(BLOCK)))
        return _bound(blocks, lambda bs: F.flatten(F.zip_with(bs, walk(F.transform(bs, lambda x: F.aggregate(x, zero, combine)), zero), walk)))

    return _bound(numbers, lambda v: F.when(F.size(v) <= BLOCK, walk(v, zero)).otherwise(by_blocks(v)))


def _add(a: Column, b: Column) -> Column:
    return a + b


def _greater(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def matches(text: str, pattern: str, may: Column) -> Column:
    """Array of (start, end, value, before, after, first_byte, end_byte) of all matches, leftmost and
    not overlapping; start and end in code points."""

    def placed(both: Column) -> Column:
        gaps, n = both["gaps"], F.size(both["gaps"])
        pairs = F.zip_with(F.slice(gaps, F.lit(1), n - 1), both["found"], lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
        three = F.zip_with(pairs, F.slice(gaps, F.lit(2), n), lambda p, after: F.struct(p["gap"].alias("gap"), p["value"].alias("value"), after.alias("after")))
        return _bound(three, located)

    def located(pieces: Column) -> Column:
        chars = running(F.transform(pieces, lambda p: F.length(p["gap"]) + F.length(p["value"])), _add)
        octets = running(F.transform(pieces, lambda p: F.octet_length(p["gap"]) + F.octet_length(p["value"])), _add)
        at = F.zip_with(chars, octets, lambda c, o: F.struct(c.alias("char"), o.alias("byte")))
        return F.zip_with(pieces, at, span)

    def span(p: Column, at: Column) -> Column:
        start, first = at["char"] + F.length(p["gap"]), at["byte"] + F.octet_length(p["gap"])
        return F.struct(
            start.alias("start"),
            (start + F.length(p["value"])).alias("end"),
            p["value"].alias("value"),
            F.right(p["gap"], F.lit(24)).alias("before"),
            F.left(p["after"], F.lit(1)).alias("after"),
            first.alias("first_byte"),
            (first + F.octet_length(p["value"])).alias("end_byte"),
        )

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return F.when(may, _bound(both, placed)).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<start:int,end:int,value:string,before:string,after:string,first_byte:int,end_byte:int>>"


def clusters(spans: Column) -> Column:
    """Spans in the order of ``start``, parted wherever one begins at or after all ends before it."""

    def parted(items: Column) -> Column:
        before = running(F.transform(items, lambda x: x["end"]), _greater)
        first = F.zip_with(items, before, lambda x, end: x["start"] >= end)
        at = F.filter(F.transform(first, lambda f, i: F.when(f, i + 1)), lambda i: i.isNotNull())
        cut = _bound(at, lambda a: F.zip_with(a, F.concat(F.slice(a, F.lit(2), F.size(a)), F.array(F.size(items) + 1)), lambda i, j: F.slice(items, i, j - i)))
        return F.when(F.size(items) > 0, cut).otherwise(F.transform(items, lambda x: F.array(x)))

    return _bound(spans, parted)


def features(kind: str, c: Column) -> dict[str, Column]:
    v = c["value"]
    runs = F.filter(F.split(v, "[^0-9]+"), lambda x: F.length(x) > 0)
    values = [
        F.lit(KINDS.index(kind)), F.length(v), _count(v, "0-9"), _count(v, r"\p{L}"), _count(v, r"\x20"), _count(v, "."), _count(v, "-"), _count(v, "()"),
        v.startswith("+"), v.contains("@"), F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0)), F.size(runs), luhn(v), v.rlike(rf"^(?:{OCTET}[\x20.]+){{3}}{OCTET}$"),
        c["before"].rlike(r"[\p{L}\p{N}_=@/#+-]$"), c["after"].rlike(r"^[\p{L}\p{N}_=@/#]"), c["before"].rlike(CUES),
    ]
    return {n: x.cast("double") for n, x in zip(NAMES, values, strict=True)}


def with_candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with base_<kind> and proposed_<kind>: arrays of spans."""
    for kind in KINDS:
        may = F.col(text).contains("@") if kind == "email" else F.col(text).contains("+") if kind == "phone" else _might_match(kind, text)
        df = df.withColumn(f"__all_{kind}", matches(text, BASE[kind], may))
        df = df.withColumn(f"base_{kind}", F.filter(f"__all_{kind}", lambda c: valid(kind, c["value"]))).drop(f"__all_{kind}")
        df = df.withColumn(f"proposed_{kind}", matches(text, PROPOSALS[kind], _might_match(kind, text)))
    return df


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


@dataclass
class Model:
    trees: boosting.Boosted
    thresholds: dict[str, float]


def _plain(value: Column) -> Column:
    """Letters and digits of a value, without spelled-out signs."""
    return F.regexp_replace(F.lower(value), r"[\[(](?:at|dot)[\])]|[^\p{L}\p{N}]", "")


#: Rewritings that keep a span personal, for the trees to learn from (pattern, replacement).
REWRITTEN = (
    (r"\+[0-9]{1,3}[\x20.-]*(?=[(0-9])", ""),
    (r"(?<=[A-Za-z0-9])@(?=[A-Za-z0-9])", " (at) "),
    (r"(?<=(?:at\)\x20|@)[A-Za-z0-9-]{1,40})\.(?=[A-Za-z])", " (dot) "),
    (r"\b([0-9]{4})[\x20-]?([0-9]{4})[\x20-]?([0-9]{4})[\x20-]?([0-9]{4})\b", "$1.$2.$3.$4"),
)


def fit(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION) -> Model:
    """Learn trees from at most ``sample`` texts, drawn for each kind and from those without any
    base span, and calibrate the thresholds on the candidates of all other texts."""
    need(docs, "text")
    trees, thresholds = boosting.fit(NAMES, np.zeros((0, len(NAMES))), np.zeros(0)), dict.fromkeys(KINDS, 2.0)
    every = written(_examples(docs), "candidates")
    # a fifth of the sample for each kind, what remains for texts without; at most `sample` numbers
    chosen: set[int] = set()
    for i in range(len(KINDS) + 1):
        own = F.col("kinds").bitwiseAND(1 << i) != 0 if i < len(KINDS) else F.col("kinds") == 0
        n = sample // (len(KINDS) + 1) if i < len(KINDS) else sample - len(chosen)
        chosen |= {r.h for r in every.filter(own & _for_trees()).select("h").distinct().orderBy("h").limit(n).collect()}
    if not chosen:
        return Model(trees, thresholds)
    numbers = docs.sparkSession.createDataFrame([(h,) for h in sorted(chosen)], "h long")
    seen = every.join(F.broadcast(numbers), "h", "left_semi")
    examples = seen.select("h", *NAMES, "label").distinct()
    nth = F.row_number().over(W.partitionBy("h").orderBy(F.xxhash64(*NAMES, "label"), *NAMES, "label"))
    few = examples.withColumn("nth", nth).filter(F.col("nth") <= EXAMPLES).drop("nth")
    data = np.array(sorted(tuple(r) for r in few.collect()), np.float64)  # at most sample * EXAMPLES rows
    trees = boosting.fit(NAMES, data[:, 1:-1], data[:, -1])
    score = F.floor(trees.probability({n: F.col(n) for n in NAMES}) * STEPS).cast("int")
    unseen = every.join(F.broadcast(numbers), "h", "left_anti").select("kind", score.alias("score"), "label")
    counts = unseen.groupBy("kind", "score").agg(F.count("*").alias("n"), F.sum("label").alias("personal")).collect()  # at most STEPS + 1 scores a kind
    for i, kind in enumerate(KINDS):
        thresholds[kind] = _threshold({r.score: (r.n, r.personal) for r in counts if r.kind == i}, precision)
    return Model(trees, thresholds)


def _for_trees() -> Column:
    """Two thirds of the texts may be in the sample; the rest is never seen by the trees."""
    return F.pmod("h", F.lit(3)) != 0


def _examples(docs: DataFrame) -> DataFrame:
    """A row for each candidate of all texts, and of the texts with base spans rewritten: h (hash of
    the text), kinds (a bit for each kind with a base span in the text), features and label."""
    texts = docs.select(text_or_empty().alias("text")).withColumn("h", F.xxhash64("text"))
    found = with_candidates(texts)
    personal = F.transform(F.concat(*[f"base_{k}" for k in KINDS]), lambda c: _plain(c["value"]))
    kinds = sum((F.when(F.size(f"base_{k}") > 0, 1 << i).otherwise(0) for i, k in enumerate(KINDS)), F.lit(0))
    truth = found.select("h", "text", kinds.alias("kinds"), personal.alias("personal"), *[f"proposed_{k}" for k in KINDS])
    changed = F.col("text")
    for pattern, to in REWRITTEN:
        changed = F.regexp_replace(changed, pattern, to)
    again = with_candidates(truth.filter("kinds > 0").select("h", "kinds", "personal", changed.alias("text")))

    def examples(df: DataFrame) -> DataFrame:
        every = []
        for kind in KINDS:
            every.append(F.transform(f"proposed_{kind}", lambda c: F.struct(*[x.alias(n) for n, x in features(kind, c).items()], F.exists("personal", lambda p: (F.length(_plain(c["value"])) >= 6) & p.endswith(_plain(c["value"]))).cast("double").alias("label"))))
        return df.select("h", "kinds", F.explode(F.concat(*every)).alias("x")).select("h", "kinds", "x.*")

    return examples(truth).unionByName(examples(again))


def _threshold(counts: dict[int, tuple[int, float]], precision: float) -> float:
    """The least score, not below a half, from which on ``precision`` of the unseen candidates are
    personal; ``counts`` has the candidates, and the personal ones, by score in steps."""
    least, total, right = 2.0, 0, 0.0
    for score in sorted(counts, reverse=True):
        total, right = total + counts[score][0], right + counts[score][1]
        if right >= precision * total and score * 2 >= STEPS:
            least = score / STEPS - 1e-9
    return least


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with base_<kind> and added: the spans, as arrays of structs."""
    need(docs, "text")
    df = with_candidates(docs)
    items = []
    for i, kind in enumerate(KINDS):

        def item(c: Column, minus: Column, base: bool) -> Column:
            return F.struct(c["start"].alias("start"), c["end"].alias("end"), minus.alias("minus"), (-c["end"]).alias("back"), F.lit(i).alias("kind"), c["first_byte"].alias("first_byte"), c["end_byte"].alias("end_byte"), F.lit(base).alias("base"))

        items.append(F.transform(f"base_{kind}", lambda c: item(c, F.lit(-2.0), True)))
        if model.thresholds[kind] <= 1:
            scored = F.transform(f"proposed_{kind}", lambda c: item(c, -model.trees.probability(features(kind, c)), False))
            items.append(F.filter(scored, lambda c: -c["minus"] >= model.thresholds[kind]))

    def chosen(cluster: Column) -> Column:
        """Of what overlaps in turn, the likeliest first, whatever overlaps no base span nor one chosen before."""
        sure = F.filter(cluster, lambda c: c["base"])
        maybe = F.filter(cluster, lambda c: ~c["base"] & ~F.exists(sure, lambda b: _overlaps(b, c)))
        ordered = F.array_sort(F.transform(maybe, lambda c: F.struct(*[c[n].alias(n) for n in ("minus", "start", "back", "kind", "end", "first_byte", "end_byte")])))
        return F.aggregate(
            ordered,
            F.array().cast("array<struct<minus:double,start:int,back:int,kind:int,end:int,first_byte:int,end_byte:int>>"),
            lambda done, c: F.when(F.exists(done, lambda d: _overlaps(d, c)), done).otherwise(F.concat(done, F.array(c))),
        )

    df = df.withColumn("__items", F.array_sort(F.concat(*items)))
    kept = F.flatten(F.transform(clusters(F.col("__items")), chosen))
    added = F.transform(kept, lambda c: F.struct(*[c[n].alias(n) for n in ("kind", "start", "end", "first_byte", "end_byte")]))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,first_byte:int,end_byte:int>>")
    df = df.withColumn("added", F.when(F.exists("__items", lambda c: ~c["base"]), added).otherwise(none))
    return df.drop("__items", *[f"proposed_{k}" for k in KINDS])


def _named(kind: str, spans: Column) -> Column:
    return F.transform(F.array_sort(spans), lambda c: F.concat_ws(":", F.lit(kind), c["start"].cast("string"), c["end"].cast("string")))


def _places(column: str | Column) -> Column:
    return F.transform(column, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end")))


def spans(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, the numbers of base spans, base (string) and spans (string) per row."""
    found = find(docs.select("doc_id", text_or_empty().alias("text")), model)
    added = {k: _places(F.filter("added", lambda c: c["kind"] == i)) for i, k in enumerate(KINDS)}
    return found.select(
        "doc_id",
        *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.array_join(F.concat(*[_named(k, _places(f"base_{k}")) for k in KINDS]), ",").alias("base"),
        F.array_join(F.concat(*[_named(k, F.concat(_places(f"base_{k}"), added[k])) for k in KINDS]), ",").alias("spans"),
    )


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with each span (spans that overlap: all that they cover) replaced by its kind in
    brackets, and ``n_chars``, if there is one, counted again. Null texts stay null."""
    columns = docs.columns
    found = find(docs.select(F.struct(*columns).alias("row"), text_or_empty().alias("text")), model)

    def marked(c: Column, kind: Column) -> Column:
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), kind.alias("kind"), c["first_byte"].alias("first_byte"), c["end_byte"].alias("end_byte"))

    names = F.array(*[F.lit(k) for k in KINDS])
    every = F.concat(
        *[F.transform(f"base_{k}", lambda c: marked(c, F.lit(k))) for k in KINDS],
        F.transform("added", lambda c: marked(c, F.element_at(names, c["kind"] + 1))),
    )
    # What lies between the covered stretches, cut out by bytes: each piece is reached at once.
    covered = F.transform(clusters(F.col("__spans")), lambda g: F.struct(g[0]["first_byte"].alias("first"), F.array_max(F.transform(g, lambda c: c["end_byte"])).alias("end"), g[0]["kind"].alias("kind")))

    def rebuilt(x: Column) -> Column:
        octets, gone = x["octets"], x["gone"]
        before = F.concat(F.array(F.lit(0)), F.transform(gone, lambda g: g["end"]))
        kept = F.zip_with(gone, F.slice(before, F.lit(1), F.size(gone)), lambda g, at: F.concat(F.substring(octets, at + 1, g["first"] - at).cast("string"), F.lit("["), F.upper(g["kind"]), F.lit("]")))
        rest = F.element_at(before, F.lit(-1))
        return F.concat(F.array_join(kept, ""), F.substring(octets, rest + 1, F.octet_length(octets)).cast("string"))

    ordered = found.withColumn("__spans", F.array_sort(every))
    built = _bound(F.struct(F.col("text").cast("binary").alias("octets"), covered.alias("gone")), rebuilt)
    text = F.when(F.size("__spans") > 0, built).otherwise(F.col("row.text"))
    out = ordered.select("row", text.alias("redacted"))
    return out.select(*[F.col("redacted").alias(c) if c == "text" else F.when(F.col("redacted").eqNullSafe(F.col("row.text")), F.col("row.n_chars")).otherwise(F.length("redacted").cast("long")).alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in columns])
