"""The derived calls carry whole turns, and each rule of the tools' schemas passes and fails."""

import json

from helpers import rows

from claimlake.llm import toolcalls as t


def test_arguments_hold_the_whole_turn(spark):
    long = "é\"\\\n" + "word " * 50_000 + "end"
    turns = [(1, 0, "system", "be kind"), (1, 1, "assistant", long), (1, 2, "user", long), (2, 1, "assistant", None)]
    turns += [(3, i, "assistant", "x" * 100 + "y" * i) for i in range(100)]
    calls, results = t.derive(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {(c["conv_id"], c["turn"]): json.loads(c["arguments"]) for c in rows(calls)}
    assert got.keys() == {(c, n) for c, n, role, _ in turns if role == "assistant"}
    for c, n, role, text in turns:
        if role == "assistant":
            assert (text or "") in (got[c, n].get("text"), got[c, n]["query"])
    assert [r["content"] for r in rows(results)] == [long]


def test_each_rule_passes_and_fails(spark):
    turns = spark.read.parquet("/root/testdata/sf0.1/conversations.parquet")
    errors = {name: [] for name in t.SCHEMAS}
    texts = {(r.conv_id, r.turn): r.text for r in turns.collect()}
    for c in rows(t.derive(turns)[0]):
        value = json.loads(c["arguments"])
        assert texts[c["conv_id"], c["turn"]] in (value["query"], value.get("text"))
        if c["name"] in errors:
            errors[c["name"]].append(t.violations(value, t.SCHEMAS[c["name"]]))
    for name, rules in {
        "search": ["$.limit: missing", "$.limit: above maximum", "$.limit: below minimum", "$.target: not allowed"],
        "translate": ["$.query: above maxLength", "$.target: missing", "$.limit: below minimum"],
        "summarise": ["$.limit: missing", "$.limit: not one of the allowed values"],
    }.items():
        for rule in rules:
            assert any(rule in e for e in errors[name]), (name, rule)
            assert any(rule not in e for e in errors[name]), (name, rule)
        assert [] in errors[name]
