"""A kind that few texts hold, among many that hold digits, is learned and calibrated all the same."""

import numpy as np
from helpers import rows

from claimlake.llm import pii as p


def luhn_card(rng):
    digits = [4, *rng.integers(0, 10, 14).tolist()]
    total = sum(d if i % 2 else (d * 2 - 9 * (d > 4)) for i, d in enumerate(digits))
    return "".join(map(str, [*digits, -total % 10]))


def test_rare_kinds_are_added(spark):
    rng = np.random.default_rng(1)
    texts = [f"item {i} of {rng.integers(100, 10**6)} in {rng.integers(1900, 2030)}, part {rng.integers(10**11, 10**12)}" for i in range(20_000)]
    texts += [f"thing and ered {luhn_card(rng)} in {i}" for i in range(60)]
    texts += [f"thing and ered some.name{i}@mail{i % 9}.example.com in {i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = p.fit(docs, sample=200)
    assert model.thresholds["card"] < 1 and model.thresholds["email"] < 1
    cases = {1: "thing and ered 4041.8949.7460.8795 in 4", 2: "thing and ered bosbt.42 (at) mail8.example (dot) com in 5", 3: "item 4 of 5555 in 1999, part 123456789012"}
    got = {r["doc_id"]: r["spans"] for r in rows(p.spans(spark.createDataFrame(list(cases.items()), "doc_id long, text string"), model))}
    assert "card:15:34" in got[1] and got[2].startswith("email:15:") and got[3] == ""


def test_thresholds_from_counts():
    assert p._threshold({}, 0.98) == 2.0 and p._threshold({9000: (100, 90.0)}, 0.98) == 2.0
    assert abs(p._threshold({9900: (100, 100.0), 9000: (2, 1.0), 8000: (200, 0.0)}, 0.98) - 0.9) < 1e-6
    assert p._threshold({4000: (10, 10.0)}, 0.98) == 2.0
