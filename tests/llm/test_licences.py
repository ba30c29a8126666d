import re

import pytest
from helpers import clashing, documents, empty_documents, odd_documents, rows

import __spark_entry__ as entry
from claimlake.llm import licences as lic

MODEL = lic.train(["plain prose of the day", "a thing in the way of this work and that"])


@pytest.mark.parametrize("family", lic.TEMPLATES)
def test_templates_are_found_and_confirmed(family):
    for notice in lic.TEMPLATES[family]:
        assert MODEL.judge(notice)[0] == family and MODEL.judge(notice)[3]


def test_unseen_wordings_unknown_licences_and_prose():
    assert MODEL.judge("It is licensed under the Apache License, Version 2.0 as of today")[0] == "apache-2.0"
    assert MODEL.judge("Licensed under the Quux Source License 9.")[0] == lic.UNKNOWN
    for text in ("the version of the work", "He was a general in the public eye", "", "one two three"):
        assert MODEL.judge(text) is None


def test_lines_without_a_feature_are_ordinary_and_all_others_are_scored():
    assert MODEL.judge("zzz qqq") is None and MODEL.probabilities("zzz").tolist() == MODEL.probabilities("").tolist()
    text = "\n\nzzz\nReleased under the MIT License.\n \nİ qq License\nzz\n" + "w " * 5000 + "Licensed under CC BY-NC 4.0. " + "w " * 5000
    lines = [x for x in text.split("\n") if x.strip()]
    every = [(i, x) for i, x in enumerate(lines) if any(g in MODEL.features for g in lic.grams(x))]
    assert list(MODEL.paragraphs(text)) == every
    assert [n for n, x in every if MODEL.judge(x) and MODEL.judge(x)[3]] == [1, 4]


@pytest.mark.parametrize("make", [odd_documents, lambda s: odd_documents(s, clash=True), empty_documents])
def test_odd_rows_equal_line_by_line(spark, make):
    docs = make(spark)
    want = []
    for r in docs.select("doc_id", "text").collect():
        lines = [x for x in (r.text or "").split("\n") if x.strip()]
        judged = [(i, *MODEL.judge(x)) for i, x in enumerate(lines) if MODEL.judge(x)]
        want.append((r.doc_id, len(lines), judged))
    got = [(r["doc_id"], r["n_paragraphs"], [tuple(f.values()) for f in r["findings"]]) for r in rows(lic.scan(docs, MODEL))]
    assert sorted(got, key=str) == sorted(want, key=str)
    lic.fit(clashing(docs) if "part" not in docs.columns else docs)


def test_query_finds_every_notice(spark):
    sf = "/root/testdata/sf0.1"
    notices = {"apache-2.0": "Apache License, Version 2.0", "mit": "under the MIT License", "gpl-3.0": "General Public License, version 3", "cc-by-nc": "CC BY-NC 4.0"}
    texts = {r.doc_id: r.text for r in documents(spark, sf).collect()}
    for r in rows(entry.queries()["op1_licences"](spark, sf)):
        want = sorted(k for k, v in notices.items() if v in texts[r["doc_id"]])
        assert [f for f in r["families"].split(",") if f in notices] == want, r
        if not re.search(lic.CUE, texts[r["doc_id"]]):
            assert r["n_findings"] == 0, r
