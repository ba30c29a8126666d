import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import documents, empty_documents, odd_documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimlake.llm import tokenfile as f
from claimlake.llm.tokens import TextEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=70))
def test_bits_round_trip(bits, ids):
    ids = np.array([i >> (32 - bits) for i in ids], np.uint32)
    data = np.frombuffer(f.pack_bits(ids, bits), np.uint8)
    assert len(data) == -(-len(ids) * bits // 8)
    assert f.unpack_bits(data, len(ids), bits).tolist() == ids.tolist()


def test_random_access_within_and_across_blocks():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 2**11, n).astype("<u4") for n in (0, 1, 17, 40, 3)]
    file = f.TokenFile(f.file_image([5, None, 7, 7, 9], [d.tobytes() for d in docs], 11, block=16))
    assert file.doc_ids == [5, None, 7, 7, 9]
    for k, d in enumerate(docs):
        assert file.document(k).tolist() == d.tolist()
    every = np.concatenate(docs)
    for a, b in ((0, 61), (15, 17), (16, 32), (60, 61), (8, 8)):
        assert file.ids(a, b).tolist() == every[a:b].tolist()
    with pytest.raises(ValueError):
        f.pack_bits(np.array([8], np.uint32), 3)


@pytest.mark.parametrize("make", [documents, odd_documents, lambda s: odd_documents(s, clash=True), empty_documents])
def test_files_hold_the_library_ids_in_order(spark, make):
    docs = make(spark)
    got = rows(f.document_starts(f.write_token_files(docs, PATH, 49408, 2, tasks=3)))
    t = Tokenizer.from_file(PATH)
    texts = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    at, want = 0, []
    for d, text in texts:
        ids = t.encode(text, add_special_tokens=False).ids + [2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=lambda x: x[1]) == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=" \n\t\x1c aZ.'s1é́日İΣ", max_size=40))
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_remembered_parts_give_the_library_ids(name, text):
    own = _ENCODERS.setdefault(name, TextEncoder(open(public_tokenizers.path(name), encoding="utf-8").read(), remember=50))
    want = own.library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == want


_ENCODERS: dict = {}


def test_one_id_with_a_third_of_the_rows_is_parted(spark):
    docs = spark.createDataFrame([(7 if i % 3 == 0 else None if i % 3 == 1 else i, f"text {i % 50} of many") for i in range(1500)], "doc_id long, text string").repartition(5)
    files = f.write_token_files(docs, PATH, 49408, 2, tasks=10)
    got = sorted(rows(f.document_starts(files)), key=lambda r: r["start"])
    per_task = {}
    for r in got:
        per_task[r["part"]] = per_task.get(r["part"], 0) + 1
    assert max(per_task.values()) <= 450
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert len(got) == 1500 and ids == sorted(ids)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
