"""Tool calls of conversations, linked to their results and put in order.

Calls and results meet in a hash join on (conversation, identifier). A result comes after its
call, a call after the results (or, unanswered, the calls) that it depends on. Messages keep their
place in the conversation unless a dependency comes later than what needs it: then they move right
behind it. Arguments are checked against the tool's JSON schema, and each message is written as
canonical JSON (keys sorted by UTF-16 units, no spaces, whole numbers without a fraction).

The order is (``after_turn``, ``after_nth``, ``depth``, ``kind``, ``turn``, ``nth``) within a
conversation: the latest place among a message and all it depends on, then its distance behind
that. Only conversations with a dependency out of place need rounds: where no message has two
dependencies, the logarithm of their longest chain (pointers are doubled), else one per link of it.
Nothing is gathered by conversation.

Defined results, in ``status``: ``linked``; ``unanswered`` (no result); ``orphan`` (no call);
``duplicate`` (a call or result whose identifier came before, by turn, nth, then input order);
``unidentified`` (null conversation or identifier). Only the first call and first result of an
identifier are linked and ordered by dependencies. ``cyclic`` marks messages in a cycle of
dependencies or behind one, which stay in place. Unknown tools, unknown dependencies, malformed or
null arguments are in ``errors``. A null text of a result is JSON null. Empty tables give no rows;
other columns are not carried.
"""

from __future__ import annotations

import json
import math
import re
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import need, python_on_executors, written

KEY = ["conv_id", "call_id"]


def canonical(value: Any) -> str:
    """Canonical JSON of a parsed value."""
    if isinstance(value, dict):
        keys = sorted(value, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical(k)}:{canonical(value[k])}" for k in keys) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float) and value.is_integer() and abs(value) < 2**53:
        value = int(value)
    return json.dumps(value, ensure_ascii=False, allow_nan=False)


def parse(text: str | None) -> Any:
    """A JSON text, strictly: no repeated keys, no NaN, no number beyond a double."""

    def pairs(items: list[tuple[str, Any]]) -> dict[str, Any]:
        out = dict(items)
        if len(out) < len(items):
            raise ValueError("repeated key")
        return out

    def constant(name: str) -> None:
        raise ValueError(f"{name} is not JSON")

    def number(digits: str) -> float:
        if not math.isfinite(value := float(digits)):
            raise ValueError("number too large")
        return value

    if text is None:
        raise ValueError("no arguments")
    return json.loads(text, object_pairs_hook=pairs, parse_constant=constant, parse_float=number)


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: Any, name: str) -> bool:
    if name in ("number", "integer"):
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        return number and (name == "number" or float(value).is_integer())
    return isinstance(value, _TYPES[name])


def violations(value: Any, schema: dict, path: str = "$") -> list[str]:
    """What of ``schema`` (types, enum, required, properties, items, bounds, pattern) fails."""
    out = []
    if kinds := schema.get("type"):
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any(_is(value, k) for k in kinds):
            return [f"{path}: not {' or '.join(kinds)}"]
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        out.append(f"{path}: not one of the allowed values")
    size = len(value) if isinstance(value, (str, list)) else value
    bounded = {str: ("minLength", "maxLength"), list: ("minItems", "maxItems"), int: ("minimum", "maximum"), float: ("minimum", "maximum")}
    low, high = bounded.get(type(value), (None, None))
    if low in schema and size < schema[low]:
        out.append(f"{path}: below {low}")
    if high in schema and size > schema[high]:
        out.append(f"{path}: above {high}")
    if isinstance(value, str) and "pattern" in schema and not re.search(schema["pattern"], value):
        out.append(f"{path}: does not match the pattern")
    if isinstance(value, list) and "items" in schema:
        out += [e for i, x in enumerate(value) for e in violations(x, schema["items"], f"{path}[{i}]")]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{path}.{k}: not allowed" for k in value if k not in known]
        out += [e for k, s in known.items() if k in value for e in violations(value[k], s, f"{path}.{k}")]
    return out


def _message(kind: str, call_id: str | None, name: str | None, body: str | None, schemas: dict[str, dict]) -> tuple[str, str]:
    """Canonical JSON of a message, and its errors."""
    if kind == "result":
        return canonical({"content": body, "id": call_id, "type": "result"}), ""
    errors = [] if name in schemas else ["$: unknown tool"]
    try:
        arguments = parse(body)
        errors += violations(arguments, schemas.get(name, {}))
        return canonical({"arguments": arguments, "id": call_id, "name": name, "type": "call"}), "; ".join(sorted(errors))
    except (ValueError, RecursionError) as e:
        why = "nested too deep" if isinstance(e, RecursionError) else "malformed JSON" if isinstance(e, json.JSONDecodeError) else str(e)
        return canonical({"arguments": None, "id": call_id, "name": name, "type": "call"}), "; ".join(sorted([*errors, f"$: {why}"]))


def _place(kind: int) -> Column:
    return F.struct(F.col("turn").cast("long").alias("turn"), F.col("nth").cast("long").alias("nth"), F.lit(kind).alias("kind"), F.monotonically_increasing_id().alias("row"))


def _firsts(rows: DataFrame) -> DataFrame:
    """The place of the first row of each identifier; counted before the shuffle, so that no
    identifier, however common, meets in one task."""
    return rows.filter("conv_id is not null and call_id is not null").groupBy(*KEY).agg(F.min("place").alias("first"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """A row for each call (conv_id, call_id, turn, nth, name, arguments, depends_on) and result
    (conv_id, call_id, turn, nth, content) with its status, order, errors and canonical JSON."""
    need(calls, *KEY, "turn", "nth", "name", "arguments", "depends_on")
    need(results, *KEY, "turn", "nth", "content")
    python_on_executors(calls.sparkSession)
    ids = [F.col(c).cast("string").alias(c) if c == "call_id" else F.col(c) for c in KEY]
    asked = written(calls.select(*ids, _place(0).alias("place"), "name", F.col("arguments").alias("body"), F.col("depends_on").cast("array<string>").alias("depends_on")), "calls")
    given = written(results.select(*ids, _place(1).alias("place"), F.lit(None).cast("string").alias("name"), F.col("content").alias("body")), "results")
    call, result = _firsts(asked).withColumnRenamed("first", "call_first"), _firsts(given).withColumnRenamed("first", "result_first")
    known = written(call.join(result, KEY, "full"), "identifiers")
    identified = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()

    def with_status(rows: DataFrame, own: str, other: str, alone: str) -> DataFrame:
        status = F.when(~identified, "unidentified").when(F.col("place") != F.col(own), "duplicate").when(F.col(other).isNull(), alone).otherwise("linked")
        return rows.join(known, KEY, "left").withColumn("status", status).drop("call_first", "result_first")

    every = with_status(asked, "call_first", "result_first", "unanswered").unionByName(with_status(given, "result_first", "call_first", "orphan"), allowMissingColumns=True)
    places = _ordered(asked, known)
    needs = asked.select(*KEY, "place", F.explode(F.array_distinct("depends_on")).alias("needed"))
    exists = known.filter("call_first is not null").select("conv_id", F.col("call_id").alias("needed"), F.lit(True).alias("there"))
    lost = needs.join(exists, ["conv_id", "needed"], "left").filter("there is null").groupBy("place").agg(F.count("*").alias("unknown"))
    kind = F.when(F.col("place.kind") == 0, "call").otherwise("result")

    @F.pandas_udf("canonical string, errors string")
    def message(kinds: pd.Series, call_ids: pd.Series, names: pd.Series, bodies: pd.Series) -> pd.DataFrame:
        whole = [None if x is None or x != x else x for c in (call_ids, names, bodies) for x in c]
        n = len(kinds)
        rows = [_message(k, *x, schemas) for k, x in zip(kinds, zip(whole[:n], whole[n : 2 * n], whole[2 * n :], strict=True), strict=True)]
        return pd.DataFrame(rows, columns=["canonical", "errors"])

    out = every.join(places, "place", "left").join(lost, "place", "left").withColumn("m", message(kind, "call_id", "name", "body"))
    unknown = F.when(F.col("unknown") > 0, F.format_string("%d unknown dependencies", "unknown"))
    return out.select(
        "conv_id", "call_id", kind.alias("kind"), F.col("place.turn").alias("turn"), F.col("place.nth").alias("nth"), "status",
        F.coalesce("after.turn", "place.turn").alias("after_turn"), F.coalesce("after.nth", "place.nth").alias("after_nth"),
        F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        F.concat_ws("; ", F.when(F.col("m.errors") != "", F.col("m.errors")), unknown).alias("errors"), F.col("m.canonical").alias("canonical"),
    )


def _ordered(asked: DataFrame, known: DataFrame) -> DataFrame:
    """place, after, depth, cyclic of the messages that a dependency moves, or that are cyclic."""
    first = asked.join(known, KEY).filter("place = call_first")
    targets = known.filter("call_first is not null").select(
        "conv_id", F.col("call_id").alias("needed"), F.coalesce(F.when(F.col("result_first").isNotNull(), F.col("result_first")), F.col("call_first")).alias("u")
    )
    answered = known.filter("call_first is not null and result_first is not null").select("conv_id", F.col("call_first").alias("u"), F.col("result_first").alias("v"))
    needs = first.select("conv_id", F.col("place").alias("v"), F.explode(F.array_distinct("depends_on")).alias("needed")).join(targets, ["conv_id", "needed"]).select("conv_id", "u", "v")
    edges = written(needs.unionByName(answered).distinct(), "dependencies")
    # A conversation whose dependencies all come first needs no rounds: everything is in place.
    moved = edges.filter("u >= v").select("conv_id").distinct()
    left = written(edges.join(moved, "conv_id", "left_semi"), "out_of_place")
    # Each conversation by the way it needs: chains by pointers, others by a round per link.
    several = written(left.groupBy("conv_id", "v").count().filter("count > 1").select("conv_id").distinct(), "several_needs")
    chains, graphs = left.join(several, "conv_id", "left_anti").select("u", "v"), left.join(several, "conv_id", "left_semi").select("u", "v")
    if several.isEmpty():
        return _jumped(_nodes(chains), chains)
    graphs = written(graphs, "graphs")
    return _jumped(_nodes(chains), chains).unionByName(_by_rounds(_nodes(graphs), graphs))


def _nodes(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("u").alias("place")).union(edges.select("v")).distinct()


def _by_rounds(nodes: DataFrame, left: DataFrame) -> DataFrame:
    """Messages whose dependencies are all ordered are ordered next; as many rounds as the longest
    chain of these conversations has links."""
    waiting = written(nodes.select("place", F.col("place").alias("after"), F.lit(0).alias("depth")), "waiting")
    done = []
    while not waiting.isEmpty():
        ready = written(waiting.join(left.select(F.col("v").alias("place")), "place", "left_anti"), "ready")
        if ready.isEmpty():  # a cycle, and what lies behind it
            done.append(waiting.select("place", F.col("place").alias("after"), F.lit(0).alias("depth"), F.lit(True).alias("cyclic")))
            break
        done.append(ready.withColumn("cyclic", F.lit(False)))
        from_ready = left.join(ready, left["u"] == ready["place"])
        pushed = from_ready.groupBy("v").agg(F.max(F.struct("after", (F.col("depth") + 1).alias("depth"))).alias("push"))
        rest = waiting.join(ready.select("place"), "place", "left_anti")
        best = F.greatest(F.struct("after", "depth"), F.coalesce("push", F.struct("after", "depth")))
        waiting = written(rest.join(pushed, F.col("place") == F.col("v"), "left").select("place", best.alias("b")).select("place", "b.after", "b.depth"), "waiting")
        left = written(left.join(ready.select(F.col("place").alias("u")), "u", "left_anti"), "dependencies")
    if not done:
        return nodes.select("place", F.col("place").alias("after"), F.lit(0).alias("depth"), F.lit(False).alias("cyclic"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _jumped(nodes: DataFrame, left: DataFrame) -> DataFrame:
    """The same where no message has two dependencies: each points to its one, and pointers are
    doubled, so a chain of n links takes log n rounds. ``best`` is the order that the ``steps``
    messages from a node back to its pointer (exclusive) give it. What still points somewhere in
    the end is in a cycle or behind one."""
    own = F.struct(F.col("place").alias("after"), F.lit(0).alias("depth"))
    first = nodes.join(left.select(F.col("v").alias("place"), F.col("u").alias("to")), "place", "left")
    state = written(first.select("place", "to", F.lit(1).alias("steps"), own.alias("best")), "pointers")
    for _ in range(state.count().bit_length() + 1):
        if state.filter("to is not null").isEmpty():
            break
        at = state.select(F.col("place").alias("p"), F.col("to").alias("p_to"), F.col("steps").alias("p_steps"), F.col("best").alias("p_best"))
        pushed = F.struct(F.col("p_best.after").alias("after"), (F.col("p_best.depth") + F.col("steps")).alias("depth"))
        best = F.when(F.col("p").isNull(), F.col("best")).otherwise(F.greatest("best", pushed))
        steps = (F.col("steps") + F.coalesce("p_steps", F.lit(0))).cast("int")
        state = written(state.join(at, F.col("to") == F.col("p"), "left").select("place", F.col("p_to").alias("to"), steps.alias("steps"), best.alias("best")), "pointers")
    cyclic = F.col("to").isNotNull()
    return state.select(
        "place", F.when(cyclic, F.col("place")).otherwise(F.col("best.after")).alias("after"), F.when(cyclic, 0).otherwise(F.col("best.depth")).alias("depth"), cyclic.alias("cyclic")
    )


#: Tools of the derived conversations, and what their arguments must look like.
SCHEMAS: dict[str, dict] = {
    "search": {
        "type": "object",
        "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 20}},
        "required": ["query", "limit"],
        "additionalProperties": False,
    },
    "translate": {
        "type": "object",
        "properties": {"query": {"type": "string", "maxLength": 40}, "limit": {"type": "integer", "minimum": 0}},
        "required": ["query", "target"],
    },
    "summarise": {"type": "object", "properties": {"limit": {"type": "integer", "enum": [1, 2, 3, 5, 8, 13, 21]}}, "required": ["limit"]},
}


def derive(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from plain turns: an assistant's turn calls a tool that its length picks,
    with its whole text; the user's turn behind it is the result. A call depends on the one two
    turns before, in every tenth conversation on the one two turns later. System turns neither call
    nor answer and give no messages.

    ``query`` is the whole text, except for "translate", whose query is at most 40 characters: there
    it is the whole text or the first 20 to 60 characters of it, with the whole one in ``text``.
    Some calls lack ``limit``, have one out of bounds, lack ``target`` or have one too many."""
    need(conversations, "conv_id", "turn", "role", "text")
    text, ident = F.coalesce("text", F.lit("")), lambda t: F.concat_ws("_", F.lit("call"), F.col("conv_id").cast("string"), t.cast("string"))
    size, turn = F.length(text), F.col("turn")
    translates = size % 4 == 1
    query = F.when(translates & (size % 5 > 0), F.substring(text, F.lit(1), (20 + size % 41).cast("int"))).otherwise(text)
    limit = F.when(size % 11 > 0, F.when(translates, size % 25 - 2).otherwise(size % 25))
    target = F.when(F.when(translates, size % 3 > 0).otherwise(size % 7 == 0), F.element_at(F.array(*map(F.lit, ("de", "en", "fr"))), (size % 3 + 1).cast("int")))
    calls = conversations.filter("role = 'assistant'").select(
        "conv_id", ident(turn).alias("call_id"), "turn", F.lit(0).alias("nth"),
        F.element_at(F.array(*map(F.lit, ("search", "translate", "summarise", "compute"))), (size % 4 + 1).cast("int")).alias("name"),
        F.to_json(F.struct(query.alias("query"), F.when(translates & (size % 5 > 0), text).alias("text"), limit.alias("limit"), target.alias("target")), {"ignoreNullFields": "true"}).alias("arguments"),
        F.when(F.col("conv_id") % 10 == 0, F.array(ident(turn + 2))).when(turn > 1, F.array(ident(turn - 2))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
    )
    results = conversations.filter("role = 'user'").select("conv_id", ident(turn - 1).alias("call_id"), "turn", F.lit(0).alias("nth"), F.col("text").alias("content"))
    return calls, results
