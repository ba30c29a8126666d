from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from helpers import documents, empty_documents, odd_documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from claimlake.llm import piecebpe as p

PATH = public_tokenizers.path("piece_bpe_32k.model")
OWN = p.Vocabulary(open(PATH, "rb").read(), remember=200)


def expected(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    out = []
    for r in docs.select("doc_id", "text").collect():
        ids = sp.encode(r.text or "")
        joined = ",".join(map(str, ids))
        text = sp.decode(ids)
        out.append((r.doc_id, len(ids), joined, sha256(joined.encode()).hexdigest(), text, sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="▁ \n\tabthe.İé日<s>0x1\x00👩", max_size=40) | st.text(max_size=30))
def test_any_text_equals_the_library(text):
    ids = ",".join(p[0] for p in OWN.encode([text])[0])
    assert ids == ",".join(map(str, OWN.library.encode(text)))


@pytest.mark.parametrize("make", [documents, odd_documents, lambda s: odd_documents(s, clash=True), empty_documents])
def test_documents_equal_the_library(spark, make):
    docs = make(spark)
    got = [(r["doc_id"], r["n_tokens"], r["ids"], r["ids_sha256"], r["decoded"], r["decoded_sha256"]) for r in rows(p.encode_documents(docs, PATH))]
    assert sorted(got, key=str) == expected(docs)


def test_query(spark):
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows(entry.queries()["op4_sentencepiece"](spark, "/root/testdata/sf0.001"))), key=str)
    assert got == sorted(((d, n, i, t) for d, n, _, i, _, t in expected(documents(spark))), key=str)
