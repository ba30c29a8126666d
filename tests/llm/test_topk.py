import math

import numpy as np
import pytest
from helpers import clashing, rows
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from claimlake.llm import topk as t

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, queries, k, scale=64):
    def whole(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return tuple(math.floor(scale * float(np.float32(x))) for x in v)

    kept = [(i, whole(v)) for i, v in vectors if i is not None and whole(v)]
    asked = sorted({(i, whole(v)) for i, v in queries if i is not None and whole(v)})
    out = []
    for qi, q in asked:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in kept if i != qi and len(v) == len(q))[:k]
        out += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def got(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows(df))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(-5, 5), st.integers(0, 2)), min_size=1, max_size=40), st.tuples(*[st.integers(-4, 4)] * 3), st.integers(1, 6))
def test_threshold_stop_equals_all_scores(vectors, query, k):
    ids = np.arange(len(vectors)) * 3 % 41
    lists = t.Lists(ids, np.array(vectors, float))
    found, scores = lists.top(int(ids[0]), np.array(query, float), k, step=1)
    every = sorted((-sum(a * b for a, b in zip(query, v, strict=True)), int(i)) for i, v in zip(ids, vectors, strict=True) if i != ids[0])[:k]
    assert [(-s, i) for i, s in zip(found.tolist(), scores.tolist(), strict=True)] == every


@pytest.mark.parametrize("clash", [False, True])
@pytest.mark.parametrize("sizes", [{}, {"candidates": 7, "query_rows": 3}])
def test_odd_rows(spark, clash, sizes):
    rng = np.random.default_rng(1)
    data = [(i, [float(x) for x in rng.integers(-3, 4, 5) / 7]) for i in range(60)]
    data += [(i, [0.5] * 5) for i in range(60, 90)] + [(20, [0.25] * 5), (60, [0.5] * 5), (None, [1.0] * 5), (100, None), (120, [])]
    data += [(140, [1.0, None, 1.0, 1.0, 1.0]), (160, [math.nan] * 5), (180, [math.inf] + [0.0] * 4), (200, [1.0, 2.0]), (220, [0.0] * 5), (240, [1e9, -1e9, 1e9, 3.0, 0.1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in data], SCHEMA)
    df = clashing(df) if clash else df
    queries = df.filter("vec_id % 20 = 0")
    want = brute(data, [(i, v) for i, v in data if i is not None and i % 20 == 0], 20)
    if sizes:  # a repeated id's two vectors are answered side by side
        assert got(t.top_k(df, queries, 20, **sizes)) == want
    else:
        assert got(t.top_k(df, queries, 20)) == want


def test_empty_and_too_large(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert got(t.top_k(none, none, 3)) == []
    lists = t.Lists(np.array([1, 2]), np.array([[1e18, 1e18], [0, 0]]))
    with pytest.raises(OverflowError):
        lists.top(9, np.array([1e18, 1e18]), 1)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(entry.queries()["op9_topk"](spark, sf)) == brute(data, [x for x in data if x[0] % 20 == 0], 20)
