import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from claimlake.llm import queries
from claimlake.llm import runs as r

from helpers import SF001, documents, empty_documents, odd_documents, rows


def brute(words, times=3):
    """Every period by itself: maximal stretches of words that equal the word a period further."""
    out = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= times * q:
                out.setdefault((s, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


def _sequence(pick):
    n, kinds = pick.randint(0, 300), pick.randint(1, 6)
    words = [pick.randint(0, kinds) for _ in range(n)]
    for _ in range(pick.randint(0, 4)):
        if n > 3:
            a, times = pick.randrange(n), pick.randint(2, 9)
            p = pick.randint(1, max(1, (n - a) // 3))
            for i in range(a + p, min(n, a + p * times)):
                words[i] = words[i - p]
    return words


def test_runs_equal_brute_force():
    pick = random.Random(11)
    for _ in range(60):
        several = [_sequence(pick) for _ in range(20)]
        assert r.find_runs([np.array(s, np.int64) for s in several]) == [brute(s) for s in several]


def test_regular_words():
    fibonacci, longer = [0], [0, 1]
    for _ in range(11):
        fibonacci, longer = longer, longer + fibonacci
    nested = ([1] * 9 + [2]) * 5 + ([1] * 9 + [3]) * 5
    thue = [bin(i).count("1") % 2 for i in range(512)]
    for words in (longer, nested * 4, thue, [0] * 700, list(range(500)) * 3, sorted(range(300)) + [7] * 40):
        assert r.find_runs([np.array(words, np.int64)]) == [brute(words)]


def test_a_misleading_hash_starts_anew(monkeypatch):
    mixed, held, attempts = r._mixed, r._all_hold, []
    monkeypatch.setattr(r, "_mixed", lambda x: mixed(x) if attempts else x % np.uint64(2))
    monkeypatch.setattr(r, "_all_hold", lambda *a: held(*a) or attempts.append("again"))
    words = _sequence(random.Random(4)) + list(range(60)) * 4
    assert r.find_runs([np.array(words, np.int64)]) == [brute(words)]
    assert attempts


def expected(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = [x for x in brute(words) if x[1] >= 24]
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = (None,) * 4
    if found:
        s, m, q = min(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
        best = s, m, q, 1000 * m // q
    listed = "".join("%d,%d,%d\n" % x for x in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_brute_force_on_short_documents(spark):
    texts = {x.doc_id: x.text for x in documents(spark).collect()}
    got = {x["doc_id"]: tuple(x.values()) for x in rows(queries.op12_runs(spark, SF001))}
    assert got.keys() == texts.keys()
    short = [i for i, t in texts.items() if len(t or "") < 8000]
    assert [got[i] for i in short] == [expected(i, texts[i]) for i in short]
    assert any(got[i][1] for i in short)


@pytest.mark.parametrize("make", [odd_documents, lambda s: odd_documents(s, clash=True), empty_documents])
def test_odd_rows(spark, make):
    docs = make(spark)
    got = [(x["doc_id"], x["n_runs"], x["start"], x["length"], x["period"], x["exponent_milli"], x["runs_sha256"], x["collapsed_sha256"]) for x in rows(r.periodic_runs(docs, folded=True))]
    texts = [x for x in docs.select("doc_id", "text").collect() if len(x.text or "") < 100_000]
    key = lambda x: str(x)
    want = [expected(x.doc_id, x.text) for x in texts]
    long = [g for g in got if g[3] == 30_000]
    assert sorted([g for g in got if g not in long], key=key) == sorted(want, key=key)
    assert len(long) == (len(texts) < docs.count()) and all(g[1:6] == (1, 0, 30_000, 1, 30_000_000) for g in long)


def test_whole_texts_are_returned(spark):
    docs = spark.createDataFrame([(1, "x " + "a b c " * 9 + "y")], "doc_id long, text string")
    got = rows(r.periodic_runs(docs))[0]
    assert (got["runs"], got["collapsed"]) == ("1,27,3\n", "x a b c y")
