import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, documents, empty_documents, odd_documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimlake.llm import packing as p

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(texts):
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def one_by_one(lengths, capacity):
    """Plain best-fit decreasing: the fill of each window."""
    rooms, fills = [], []
    for length in sorted(lengths, reverse=True):
        fit = [(r, i) for i, r in enumerate(rooms) if r >= length]
        if fit:
            i = min(fit)[1]
        else:
            i = len(rooms)
            rooms.append(capacity)
            fills.append([])
        rooms[i] -= length
        fills[i].append(length)
    return sorted(map(sorted, fills))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=60))
def test_runs_equal_best_fit_one_piece_at_a_time(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    windows, seen = defaultdict(dict), defaultdict(int)
    for length, first, end, window, each, offset in p.best_fit_runs(counts, 16):
        assert first == seen[length]
        seen[length] = end
        for i in range(end - first):
            at = offset + i % each * length
            assert at not in windows[window + i // each]
            windows[window + i // each][at] = length
    assert seen == counts
    assert sorted(windows) == list(range(len(windows)))
    for pieces in windows.values():
        at = 0
        for offset in sorted(pieces):
            assert offset == at
            at += pieces[offset]
        assert at <= 16
    assert sorted(sorted(w.values()) for w in windows.values()) == one_by_one(lengths, 16)


@pytest.mark.parametrize("make", [documents, odd_documents, lambda s: odd_documents(s, clash=True)])
def test_pieces_hold_every_id_once_and_windows_have_no_gaps(spark, make):
    docs = make(spark)
    got = rows(p.pack(docs, PATH))
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted((d is None, d or 0, np.array(i, "<u4").tobytes()) for (d, _), i in zip(texts, library_ids(t for _, t in texts), strict=True))
    whole = defaultdict(list)
    for r in got:
        whole[r["doc_id"]].append(r)
    for d, pieces in whole.items():
        ids = [w[2] for w in want if (w[0], w[1]) == (d is None, d or 0)]
        if len(ids) == 1:
            assert b"".join(x["ids"] for x in sorted(pieces, key=lambda x: x["start"])) == ids[0]
        assert sum(x["length"] for x in pieces) * 4 == sum(map(len, ids))
    by_window = defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"]
        by_window[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sorted(by_window) == list(range(len(by_window)))
    for pieces in by_window.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024


def test_empty_table_and_checksums(spark):
    assert rows(p.pack(empty_documents(spark), PATH)) == []
    docs = clashing(odd_documents(spark))
    sums = sorted((r["length"], r["ids_crc32"]) for r in rows(p.packed_rows(docs, PATH)))
    assert sums == sorted((r["length"], zlib.crc32(r["ids"])) for r in rows(p.pack(docs, PATH)))


def test_sequences_are_padded_unless_a_power_of_two(spark):
    for r in rows(p.sequences(p.pack(documents(spark), PATH), pad_id=7)):
        n = len(r["ids"]) // 4
        assert n == (r["length"] if r["length"] & (r["length"] - 1) == 0 else 1024)
        assert set(np.frombuffer(r["ids"], "<u4")[r["length"] :]) <= {7}


def test_texts_reach_python_in_small_batches(spark, monkeypatch):
    def strict(sizes, limit, slices=p.slices, most=p.BATCH_BYTES):
        sizes = list(sizes)
        assert len(sizes) == 1 or sum(sizes) <= most + max(sizes), (len(sizes), sum(sizes))
        return slices(sizes, limit)

    monkeypatch.setattr(p, "slices", strict)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    texts = spark.range(0, 1500, 1, 1).selectExpr("id AS doc_id", "repeat('word ', if(id = 7, 1000000, 2000)) AS text")
    totals = {r.doc_id: r.n for r in p.cut_documents(texts, PATH, 0, with_ids=False).groupBy("doc_id").sum("length").withColumnRenamed("sum(length)", "n").collect()}
    words = {n: len(library_ids(["word " * n])[0]) for n in (2000, 1_000_000)}
    assert totals == {i: words[1_000_000 if i == 7 else 2000] for i in range(1500)}
    assert spark.conf.get(name) == before
