import hashlib
import re

import pytest
import xxhash
from helpers import clashing, documents, empty_documents, odd_documents, rows

import __spark_entry__ as entry
from claimlake.llm import winnow as w

SINGLE = "฀-๿぀-ヿ㐀-鿿가-힯"


def words(text):
    import regex

    return regex.findall(rf"[[\p{{L}}\p{{N}}]--[{SINGLE}]]+|[{SINGLE}]", text.lower(), regex.V1)


def h(x):
    v = xxhash.xxh64_intdigest(x.encode(), 42)
    return (v - (1 << 64) if v >> 63 else v) % w.PRIME


def plain(text, k=w.GRAM, win=w.WINDOW):
    """(hash, position) by the definition: rightmost least hash of every window."""
    if not text:
        return []
    hs = [h(x) for x in words(text)]
    if not hs:
        grams = [h(text)]
    elif len(hs) < k:
        grams = [h(" ".join(map(str, hs)))]
    else:
        grams = []
        for i in range(len(hs) - k + 1):
            v = 0
            for x in hs[i : i + k]:
                v = (v * w.BASE + x) % w.PRIME
            grams.append(v)
    out = []
    for s in range(max(1, len(grams) - win + 1)):
        window = grams[s : s + win]
        best = max(i for i, x in enumerate(window) if x == min(window)) + s
        if not out or out[-1][1] != best:
            out.append((grams[best], best))
    return out


def shown(prints):
    return ",".join(f"{a:x}@{b:x}" for a, b in prints)


def likeness(a, b):
    a, b = {x for x, _ in a}, {x for x, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(docs):
    data = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    signed = lambda t: (v := xxhash.xxh64_intdigest(t.encode(), 42)) - ((v >> 63) << 64)
    data.sort(key=lambda x: (x[0] is None, -(x[0] or 0), signed(x[1])))
    out = []
    for (d, t), (_, nxt) in zip(data, data[1:] + data[:1], strict=True):
        cut = len(t) // 3
        edited = t[: len(t) - cut] + nxt[:cut]
        a, b, c = plain(t), plain(edited), plain(nxt)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), shown(a), shown(b), likeness(a, b), likeness(a, c)))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows(df)), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def small(make):
    """Without the texts of one word repeated 20,000 times, which the plain version takes long for."""
    return lambda spark: make(spark).filter("length(text) < 50000 or text is null")


@pytest.mark.parametrize("make", [small(odd_documents), small(lambda s: clashing(odd_documents(s))), empty_documents, lambda s: documents(s).limit(1)])
@pytest.mark.parametrize("size", [3, 500])
def test_odd_rows_equal_the_plain_version(spark, make, size):
    docs = make(spark)
    assert got(w.compare_edited(docs, size)) == expected(docs)


def test_query_equals_the_plain_version(spark):
    df = entry.queries()["op3_winnowing"](spark, "/root/testdata/sf0.001")
    assert got(df) == expected(documents(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_sparse_and_negative_ids_follow_each_other(spark):
    ids = [5, -3, 10**15, -(10**15), 499, 500, 501, 7_000_000]
    docs = spark.createDataFrame([(i, f"text number {i} of some words here and there again") for i in ids], "doc_id long, text string")
    assert got(w.compare_edited(docs)) == expected(docs)


def test_hot_ids_are_parted_and_lose_no_row(spark, monkeypatch):
    monkeypatch.setattr(w, "PORTION", 40)
    text = lambda i: f"line {i} of words that go on and on" if i % 7 else ""
    data = [(None, text(i % 90)) for i in range(200)] + [(1234, text(i)) for i in range(200)] + [(1235, "the same words in each of these rows")] * 150
    data += [(i, text(i)) for i in range(1200, 1260)] + [(-5, None), (10**12, "a b c d e f g h i")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    placed, repeated = w.in_order(docs, 10)
    sizes = placed.filter("copy = 0").groupBy("place").count().collect()
    assert repeated and max(r["count"] for r in sizes) <= 40
    assert got(w.compare_edited(docs, 10)) == expected(docs)


def test_one_id_on_every_row(spark):
    docs = spark.createDataFrame([(None, f"text {i % 50} of some words here") for i in range(300)], "doc_id long, text string")
    assert got(w.compare_edited(docs, 5)) == expected(docs)
    same = spark.createDataFrame([(7, "one text of some words here")] * 100, "doc_id long, text string")
    assert got(w.compare_edited(same, 5)) == expected(same)


def test_shared_runs_share_a_fingerprint(spark):
    run = " ".join(f"w{i}" for i in range(w.GRAM + w.WINDOW - 1))
    docs = spark.createDataFrame([(1, f"a b c {run} d"), (2, f"x {run} y z q r"), (3, "")], "doc_id long, text string")
    prints = {r["doc_id"]: {x >> 31 for x in r["packed"]} for r in rows(w.fingerprints(docs))}
    assert prints[1] & prints[2] and not prints[3]
