import re

import corpus_pipeline as c
from helpers import documents, empty_documents, odd_documents, rows

from claimlake.llm import packing, pii, quality, simhash

SF = "/root/testdata/sf0.001"


def key(r):
    return str(sorted((k, str(v)) for k, v in r.items()))


def test_stages_keep_columns_and_decide(spark):
    docs = documents(spark)
    good = c.quality_classifier(spark, docs, SF)
    assert good.columns == docs.columns
    scores = {r["doc_id"]: r["predicted"] for r in rows(quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")))}
    assert sorted(r["doc_id"] for r in rows(good)) == sorted(d for d, p in scores.items() if p)
    one = c.near_duplicates(spark, good, SF)
    assert one.columns == docs.columns
    heads = {r["component_id"] for r in rows(simhash.near_duplicates(good))}
    assert sorted(r["doc_id"] for r in rows(one)) == sorted(heads)
    clean = c.personal_data(spark, one, SF)
    assert clean.columns == docs.columns and clean.count() == one.count()
    assert not any(re.search(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.", r["text"]) for r in rows(clean))
    assert all(r["n_chars"] == len(r["text"]) for r in rows(clean) if "[" in r["text"])
    want = rows(c.pack_sequences(spark, clean, SF))
    got = rows(c.run(spark, SF))
    assert sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in got) == sorted((r["doc_id"], r["start"], r["ids_crc32"]) for r in want)
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in rows(clean)}


def test_odd_and_empty_tables_pass_all_stages(spark):
    for make in (odd_documents, lambda s: odd_documents(s, clash=True), empty_documents):
        docs = make(spark)
        columns = docs.columns
        before = rows(docs)
        scores = rows(quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")))
        good = c.quality_classifier(spark, docs, SF)
        assert good.columns == columns
        kept = rows(good)
        assert all(r in before for r in kept)
        assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(r["doc_id"]) for r in scores if r["predicted"])
        # all rows again, so that each stage meets every odd text whatever the vote is
        one = c.near_duplicates(spark, docs, SF)
        assert one.columns == columns
        found = rows(simhash.near_duplicates(docs))
        singles = rows(one)
        assert len(singles) == len({r["root"] for r in found}) and all(r in before for r in singles)
        assert {r["doc_id"] for r in singles} == {r["component_id"] for r in found}
        clean = c.personal_data(spark, docs, SF)
        assert clean.columns == columns
        assert sorted(map(key, rows(clean))) == sorted(map(key, before))  # these texts hold no personal data
        packed = rows(c.pack_sequences(spark, docs, SF))
        whole = {}
        for r in packed:
            whole.setdefault(str(r["doc_id"]), []).append((r["doc_tokens"], r["start"], r["length"]))
        assert sorted(whole) == sorted({str(r["doc_id"]) for r in before})
        for r in before:
            same = [x for x in before if x["doc_id"] == r["doc_id"]]
            assert sum(n for _, _, n in whole[str(r["doc_id"])]) == sum(t for t, s, _ in whole[str(r["doc_id"])] if s == 0)
            assert sum(s == 0 for _, s, _ in whole[str(r["doc_id"])]) == len(same)
        for _, stage in c.STAGES:
            docs = stage(spark, docs, SF)
        assert {"sequence_id", "offset"} <= set(docs.columns) and docs.count() <= len(packed)


def test_the_stages_call_the_operators():
    assert [n for n, _ in c.STAGES] == ["quality_classifier", "near_duplicates", "personal_data", "packing"]
    assert all(m for m in (packing, pii, quality, simhash))
