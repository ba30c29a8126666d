from itertools import combinations

import numpy as np
import pytest
import xxhash
from helpers import SF01, documents, empty_documents, odd_documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from claimlake.llm import simhash as s


def plain_fingerprint(text, k=3):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, distance=3):
    """Smallest position reachable, by union of all pairs."""
    f = np.array(prints, np.uint64)
    root = list(range(len(f)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1 :]) <= distance) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    return [find(i) for i in range(len(f))]


def expected(docs):
    data = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    roots = plain_components([f for _, f in data])
    ids = {}
    for (d, _), r in zip(data, roots, strict=True):
        if d is not None:
            ids[r] = min(d, ids.get(r, d))
    return [(d, f, ids.get(r)) for (d, f), r in zip(data, roots, strict=True)]


def order(x):
    return [(v is not None, v or 0) for v in x]


@pytest.mark.parametrize("make", [documents, lambda sp: documents(sp, SF01), odd_documents, lambda sp: odd_documents(sp, clash=True), empty_documents])
@pytest.mark.parametrize("bucket", [s.BUCKET, 4])
def test_components_equal_all_pairs(spark, make, bucket):
    docs = make(spark)
    got = [(r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in rows(s.near_duplicates(docs, bucket=bucket))]
    assert sorted(got, key=order) == sorted(expected(docs), key=order)


@pytest.mark.parametrize("bucket", [s.BUCKET, 16])
def test_dense_neighbourhoods_lose_no_link(spark, bucket):
    """Random walks of one to four bits: large buckets of distinct prints, chains of links."""
    rng = np.random.default_rng(3)
    prints = set()
    for _ in range(4):
        x = int(rng.integers(0, 2**63))
        for _ in range(250):
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                x ^= 1 << int(b)
            prints.add(x)
    prints = sorted(prints)
    nodes = spark.createDataFrame([(s._signed(x),) for x in prints], "node long")
    found = {r["node"] % 2**64: r["root"] for r in rows(s.components(s.links(nodes, bucket=bucket)))}
    groups, plain = {}, {}
    for x, r in zip(prints, plain_components(prints), strict=True):
        groups.setdefault(found.get(x, x), set()).add(x)
        plain.setdefault(r, set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=6), st.sampled_from([(4, 3), (5, 3), (6, 3), (8, 5), (16, 3)]))
def test_pigeonring_test_is_exact(a, flips, ring):
    b = a
    for f in flips:
        b ^= 1 << f
    got = s.Ring(*ring).linked(np.array([a], np.uint64), np.array([b], np.uint64))[0]
    assert got == ((a ^ b).bit_count() <= ring[1])


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 63), max_size=3))
def test_any_three_bits_leave_a_coarse_and_a_finer_mask_untouched(bits):
    ring, gone = s.Ring(), sum(1 << b for b in bits)
    masks = [m for m in ring.masks() if not m & gone]
    assert masks and all(any(not x & gone for x in ring.finer_masks(m, 8)) for m in masks)
    assert all(m.bit_count() >= 30 for m in ring.masks()) and len(set(combinations(range(6), 3))) == len(ring.masks())


@pytest.mark.parametrize("make", [documents, odd_documents, lambda sp: odd_documents(sp, clash=True), empty_documents])
def test_one_document_of_each_component_stays(spark, make):
    docs = make(spark)
    kept = rows(s.keep_one(docs))
    want = expected(docs)
    heads = sorted({(c is not None, c or 0, f if c is None else 0) for d, f, c in want})
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept) == [h[:2] for h in heads]
    assert s.keep_one(docs).columns == docs.columns


def test_query(spark):
    got = [(r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in rows(entry.queries()["op5_simhash"](spark, "/root/testdata/sf0.001"))]
    assert sorted(got) == sorted(expected(documents(spark)))
    assert all(len(r["fingerprint"]) == 16 for r in rows(entry.queries()["op5_simhash"](spark, "/root/testdata/sf0.001")))


def test_keep_one_where_an_id_stands_on_several_texts(spark):
    a, b = "alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(3, b), (5, a), (5, b), (6, a), (7, "quite another text of its own here")], "doc_id long, text string")
    kept = sorted(tuple(r) for r in s.keep_one(docs).select("doc_id", "text").collect())
    assert kept == [(3, b), (5, a), (7, "quite another text of its own here")]
