import json

import pytest
from helpers import rows
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from claimlake.llm import toolcalls as t

CALLS = "conv_id long, call_id string, turn long, nth int, name string, arguments string, depends_on array<string>"
RESULTS = "conv_id long, call_id string, turn long, nth int, content string"
ORDER = ("after_turn", "after_nth", "depth", "kind", "turn", "nth")


def run(spark, calls, results, schemas=t.SCHEMAS, clash=False):
    from pyspark.sql import functions as F

    a, b = spark.createDataFrame(calls, CALLS).coalesce(1), spark.createDataFrame(results, RESULTS).coalesce(1)
    if clash:
        names = ("place", "row", "status", "first", "u", "v", "depth", "canonical", "body", "needed")
        a, b = a.withColumns({c: F.lit("mine") for c in names}), b.withColumns({c: F.lit("mine") for c in names})
    return rows(t.link(a, b, schemas))


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(), x, max_size=3), max_leaves=8))
def test_canonical_json_round_trips(value):
    text = t.canonical(value)
    assert json.loads(text) == value and t.canonical(json.loads(text)) == text


def test_schema_rules():
    s = {"type": "object", "properties": {"a": {"type": ["integer", "null"], "minimum": 2, "maximum": 4}, "b": {"type": "array", "items": {"type": "string", "pattern": "^x"}, "maxItems": 1}}, "required": ["a"], "additionalProperties": False}
    assert t.violations({"a": 3.0, "b": ["xy"]}, s) == [] and t.violations({"a": None}, s) == []
    assert t.violations({"a": True}, s) == ["$.a: not integer or null"]
    assert sorted(t.violations({"b": ["y", "x"], "c": 1}, s)) == ["$.a: missing", "$.b: above maxItems", "$.b[0]: does not match the pattern", "$.c: not allowed"]
    assert t.canonical({"b": 1.0, "a": [-0.0, 1e20, 0.5]}) == '{"a":[0,1e+20,0.5],"b":1}'


@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, clash):
    ok = '{"query": "x", "limit": 3}'
    calls = [
        (1, "a", 0, 0, "search", ok, []), (1, "a", 4, 0, "search", ok, []), (1, "b", 2, 0, "search", '{"limit": 99}', ["a", "zz"]),
        (1, "c", 6, 0, "nope", "{", None), (2, "a", 0, 0, "search", None, []), (None, "a", 0, 0, "search", ok, []), (3, None, 0, 0, "search", ok, []),
        (4, "x", 0, 0, "search", ok, ["y"]), (4, "y", 0, 1, "search", ok, ["x"]), (4, "z", 1, 0, "search", ok, ["x"]), (4, "w", 2, 0, "search", ok, []),
        (5, "p", 0, 0, "search", ok, ["q"]), (5, "q", 2, 0, "search", ok, ["r"]), (5, "r", 4, 0, "search", ok, []), (5, "s", 5, 0, "search", "[" * 100000, []),
        (6, "dup", 0, 0, "search", ok, []), (6, "dup", 0, 0, "search", ok, []),
    ]
    results = [(1, "a", 1, 0, "é\n"), (1, "a", 3, 0, "again"), (1, "q", 5, 0, None), (2, "b", 1, 0, ""), (5, "p", 1, 0, "x" * 50_000), (5, "q", 3, 0, "2"), (5, "r", 9, 0, "3"), (4, "w", 0, 5, "early")]
    got = run(spark, calls, results, clash=clash)
    assert len(got) == len(calls) + len(results)
    by = {(r["conv_id"], r["kind"], r["call_id"], r["turn"], r["nth"]): r for r in got}
    status = lambda *k: by[k]["status"]
    assert status(1, "call", "a", 0, 0) == "linked" and status(1, "call", "a", 4, 0) == "duplicate"
    assert status(1, "result", "a", 1, 0) == "linked" and status(1, "result", "a", 3, 0) == "duplicate"
    assert status(1, "result", "q", 5, 0) == "orphan" and status(2, "call", "a", 0, 0) == "unanswered" and status(2, "result", "b", 1, 0) == "orphan"
    assert status(None, "call", "a", 0, 0) == status(3, "call", None, 0, 0) == "unidentified"
    assert by[1, "call", "b", 2, 0]["errors"] == "$.limit: above maximum; $.query: missing; 1 unknown dependencies"
    assert by[1, "call", "c", 6, 0]["errors"] == "$: malformed JSON; $: unknown tool" and by[2, "call", "a", 0, 0]["errors"] == "$: no arguments"
    assert by[5, "call", "s", 5, 0]["errors"] == "$: nested too deep"
    assert by[1, "result", "a", 1, 0]["canonical"] == '{"content":"é\\n","id":"a","type":"result"}'
    assert by[1, "call", "a", 0, 0]["canonical"] == '{"arguments":{"limit":3,"query":"x"},"id":"a","name":"search","type":"call"}'
    assert [by[4, "call", c, *k]["cyclic"] for c, k in (("x", (0, 0)), ("y", (0, 1)), ("z", (1, 0)), ("w", (2, 0)))] == [True, True, True, False]
    five = [(r["kind"], r["call_id"]) for r in sorted((r for r in got if r["conv_id"] == 5), key=lambda r: [r[c] for c in ORDER])]
    seen = [x for x in five if x[1] != "s"]
    assert seen == [("call", "r"), ("result", "r"), ("call", "q"), ("result", "q"), ("call", "p"), ("result", "p")]
    four = [(r["kind"]) for r in sorted((r for r in got if r["call_id"] == "w"), key=lambda r: [r[c] for c in ORDER])]
    assert four == ["call", "result"]
    assert sorted(r["status"] for r in got if r["conv_id"] == 6) == ["duplicate", "unanswered"]


def test_empty(spark):
    assert run(spark, [], []) == []


def test_query_orders_every_dependency_and_links_all(spark):
    sf = "/root/testdata/sf0.01"
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    got = rows(entry.queries()["op2_toolcalls"](spark, sf))
    assert len(got) == turns.filter("role in ('assistant', 'user')").count()
    calls, results = (rows(x) for x in t.derive(turns))
    at = {(r["kind"], r["call_id"]): [r[c] for c in ORDER] for r in got}
    answered = {r["call_id"] for r in results}
    ids = {r["call_id"] for r in calls}
    for c in calls:
        for d in c["depends_on"]:
            if d in ids:
                assert at["result" if d in answered else "call", d] < at["call", c["call_id"]]
        if c["call_id"] in answered:
            assert at["call", c["call_id"]] < at["result", c["call_id"]]
    status = {(r["kind"], r["call_id"]): r["status"] for r in got}
    assert all(status["call", c] == ("linked" if c in answered else "unanswered") for c in ids)
    assert all(status["result", c] == ("linked" if c in ids else "orphan") for c in answered)


def _expected(calls, results):
    """after, depth and cyclic of each message, walked one by one; ids are unique here."""
    place = {("call", c, i): (turn, nth, 0) for c, i, turn, nth, *_ in calls} | {("result", c, i): (turn, nth, 1) for c, i, turn, nth, _ in results}
    needs = {m: [] for m in place}
    for c, i, *_, depends_on in calls:
        for x in dict.fromkeys(depends_on):
            target = next((m for m in (("result", c, x), ("call", c, x)) if m in place), None)
            if target:
                needs["call", c, i].append(target)
    for c, i, *_ in results:
        if ("call", c, i) in place:
            needs["result", c, i].append(("call", c, i))
    waiting, order = set(place), {}
    while ready := [m for m in waiting if all(x in order for x in needs[m])]:
        for m in ready:
            order[m] = max([(place[m], 0), *[(order[x][0], order[x][1] + 1) for x in needs[m]]])
        waiting -= set(ready)
    return {m: (*(order[m] if m in order else (place[m], 0)), m in waiting) for m in place}


def test_random_graphs_equal_brute_force(spark, monkeypatch):
    import random

    pick, calls, results = random.Random(8), [], []
    for c in range(60):
        n = pick.randint(1, 9)
        for i in range(n):
            depends_on = [f"k{pick.randrange(n + 1)}" for _ in range(pick.choice([0, 1, 1, 2] if c % 3 else [0, 1]))]
            calls.append((c, f"k{i}", pick.randrange(12), i, "search", "{}", depends_on))
            if pick.random() < 0.6:
                results.append((c, f"k{i}", pick.randrange(12), i + 20, "x"))
    # a chain of 1000 calls, each needing the next one: ordered by pointers though others need rounds
    calls += [(1000, f"k{i}", i, 0, "search", "{}", [f"k{i + 1}"]) for i in range(1000)]
    tables, written = [], t.written
    monkeypatch.setattr(t, "written", lambda df, name: tables.append(name) or written(df, name))
    got = {(r["kind"], r["conv_id"], r["call_id"]): (r["after_turn"], r["after_nth"], r["depth"], r["cyclic"]) for r in run(spark, calls, results)}
    want = {m: (after[0], after[1], depth, cyclic) for m, (after, depth, cyclic) in _expected(calls, results).items()}
    assert got == want
    assert any(w[3] for w in want.values()) and max(w[2] for w in want.values()) == 999
    assert tables.count("ready") <= 20 and tables.count("pointers") <= 13
