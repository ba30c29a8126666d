import zlib

import numpy as np
import pytest
from helpers import clashing, documents, empty_documents, odd_documents, rows

import __spark_entry__ as entry
from claimlake.llm import quality as q

SF = "/root/testdata/sf0.1"


def labels(spark, sf=SF):
    return spark.read.parquet(f"{sf}/labels.parquet")


def test_held_out_accuracy_and_every_row(spark):
    got = {r["doc_id"]: r for r in rows(entry.queries()["op10_quality"](spark, SF))}
    assert len(got) == documents(spark, SF).count()
    held = [(r.doc_id, r.quality) for r in labels(spark).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(got[d]["held_out"] for d, _ in held)
    right = np.mean([got[d]["predicted"] == y for d, y in held])
    good = np.array([got[d]["score"] for d, y in held if y])
    bad = np.array([got[d]["score"] for d, y in held if not y])
    area = (good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean()
    assert right > 0.97 and area > 0.99 and (good >= 0.3).mean() > 0.99
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_scores_equal_votes_one_document_at_a_time(spark):
    docs = documents(spark)
    model = q.fit(docs, labels(spark, "/root/testdata/sf0.001"), sample=50)
    assert len(model.labels) <= 50
    for r in docs.limit(40).collect():
        v = model.latent(q.counts(r.text)[None])[0]
        near = [float(v @ n) for n in model.vectors]
        last = sorted(near)[-q.NEIGHBOURS]
        votes = [(max(s, 1e-6) ** q.POWER, y) for s, y in zip(near, model.labels, strict=True) if s >= last - 1e-5]
        want = sum(w * y for w, y in votes) / sum(w for w, _ in votes)
        assert abs(model.score([r.text])[0] - want) < 2e-3


@pytest.mark.parametrize("make", [odd_documents, lambda s: odd_documents(s, clash=True), empty_documents])
def test_odd_rows(spark, make):
    docs = make(spark)
    marks = clashing(spark.createDataFrame([(1, 0, 0), (3, 1, 0), (3, 0, 0), (5, 7, 0), (7, None, 0), (99, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"))
    got = rows(q.classify(docs, marks))
    assert len(got) == docs.count()
    kept = q.keep_good(docs, marks)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in got)
    none = rows(q.classify(docs, marks.filter("false")))
    assert all(r["score"] == 0.5 and r["predicted"] == 1 for r in none)
