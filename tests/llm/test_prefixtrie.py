import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest

from claimlake.llm import prefixtrie as p
from claimlake.llm import queries
from claimlake.llm.oracle import OP13

from helpers import SF01, clashing, rows

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def expected(table, rebuild=True):
    """The whole trie in memory, from (conv_id, turn, role, text) rows without ties."""
    own = defaultdict(list)
    for c, turn, role, text in table:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:]) if rebuild else tuple(own[c])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(whole):
        t = whole[c]
        ends[t].append(str(c))
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
            if d:
                children[t[: d - 1]].add(t[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, m in members.items():
        value = (len(m) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += value
            leaves[node[:d]] += not children[node]
    digest = lambda node: hashlib.sha256(",".join(ends[node]).encode()).hexdigest()
    return sorted((m[0], len(n), members[n[:-1]][0] if n else -1, len(m), len(children[n]), leaves[n], saved[n], digest(n)) for n, m in members.items())


def found(df):
    return sorted(tuple(-1 if c == "parent_conv_id" and r[c] is None else r[c] for c in COLUMNS) for r in rows(df))


def built(df, **options):
    return found(p.trie(*p.rebuilt(df), **options))


def test_query_equals_brute_force_and_sql(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SF01}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = found(queries.op13_prefix_trie(spark, SF01))
    assert got == expected(table)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF01}/conversations.parquet'")
    sql = con.execute(OP13)
    names = [x[0] for x in sql.description]
    assert sorted(tuple(-1 if v is None else v for v in map(dict(zip(names, r, strict=True)).get, COLUMNS)) for r in sql.fetchall()) == got


def _odd():
    rows = [(c, t, "user" if t % 2 else "system", f"turn {t % 3}") for c in range(0, 40) for t in range(c % 7)]
    rows += [(100 + c, t, "user", "all the same ✓") for c in range(12) for t in range(6)]
    rows += [(200, None, "user", "first"), (200, 0, None, None), (200, 1, "", ""), (201, None, None, "x"), (203, 5, "a", "bc"), (204, 5, "ab", "c")]
    rows += [(300, t, "user", f"long {t}") for t in range(70)] + [(301, t, "user", f"long {t}") for t in range(50)]
    return rows


@pytest.mark.parametrize("width", [1, 3, 8])
@pytest.mark.parametrize("clash", [False, True])
def test_odd_rows(spark, width, clash):
    df = spark.createDataFrame([*_odd(), (None, 0, "user", "nobody's")], SCHEMA)
    df = clashing(df).selectExpr("*", "'mine' as depth", "'mine' as key1", "'mine' as block", "'mine' as id", "'mine' as position") if clash else df
    assert built(df, width=width) == expected(_odd())


def test_repeated_rows_are_turns(spark):
    table = [(5, 0, "user", "hi")] * 3 + [(5, 1, "user", "yo")]
    turns, convs = p.positions(spark.createDataFrame(table, SCHEMA).repartition(3))
    got = found(p.trie(turns, convs.select("conv_id")))
    assert got == expected([(5, i, "user", t) for i, t in enumerate(["hi", "hi", "hi", "yo"])], rebuild=False)


def test_no_rows(spark):
    assert built(spark.createDataFrame([], SCHEMA)) == []


def test_one_conversation_and_one_group_hold_a_third_of_the_rows(spark, monkeypatch):
    """Lookups by broadcast, running sums over several stretches, ids in several chunks."""
    monkeypatch.setattr(p, "STRETCH", 50)
    monkeypatch.setattr(p, "HOT", 20)
    monkeypatch.setattr(p, "CHUNK", 100)
    monkeypatch.setattr(p, "max", lambda a, b: b, raising=False)
    table = [(7, t, "user", f"t{t}") for t in range(900)] + [(1000 + c, t, "user", "same") for c in range(450) for t in range(2)]
    table += [(5000 + c, t, "user", f"{c % 11} {t}") for c in range(300) for t in range(3)]
    assert built(spark.createDataFrame(table, SCHEMA).repartition(7)) == expected(table)


def test_turn_ids_tell_role_from_text_and_count_bytes(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("", "é" * 300), (None, None)], "role string, text string")
    got = df.select(p.turn_id(df.role, df.text).alias("id"), p.text_bytes(p.turn_id(df.role, df.text)).alias("n")).collect()
    assert len({bytes(r.id) for r in got}) == 4 and [r.n for r in got] == [2, 1, 600, 0]
