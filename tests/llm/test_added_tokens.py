"""Texts that hold the markers of a tokenizer file get the ids of the library's defaults."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import DOCUMENTS, rows
from tokenizers import Tokenizer

from claimlake.llm import packing, tokenfile
from claimlake.llm.tokens import TextEncoder

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
MARKED = [
    "see <|endoftext|> here",
    "see <|startoftext|> here",
    "<|endoftext|>",
    "<|startoftext|><|endoftext|>",
    "a<|endoftext|>b 日本 <|startoftext|>\n",
    "<|ENDOFTEXT|> <|endoftext |> <|endoftext|",
    "word " * 20_000 + "<|endoftext|>",
    "no marker",
]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_markers_get_the_ids_of_the_library(path):
    own = TextEncoder(open(path, encoding="utf-8").read(), remember=50)
    library = Tokenizer.from_file(path)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(MARKED)] == [library.encode(t, add_special_tokens=False).ids for t in MARKED]


def test_markers_have_ids_of_their_own():
    byte, word = (TextEncoder(open(p, encoding="utf-8").read()) for p in (BYTE, WORD))
    assert np.frombuffer(byte.encode(MARKED[:1])[0], "<u4").tolist() == [3826, 220, 50256, 994]
    assert np.frombuffer(word.encode(["<|startoftext|><|endoftext|>"])[0], "<u4").tolist() == [49406, 49407]


def test_packing_and_token_files_of_marked_texts(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(MARKED)], DOCUMENTS)
    byte, word = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    pieces = rows(packing.pack(docs, BYTE))
    for i, t in enumerate(MARKED):
        ids = b"".join(x["ids"] for x in sorted((x for x in pieces if x["doc_id"] == i), key=lambda x: x["start"]))
        assert np.frombuffer(ids, "<u4").tolist() == [*byte.encode(t, add_special_tokens=False).ids, 0]
    at = 0
    for r in sorted(rows(tokenfile.document_starts(tokenfile.write_token_files(docs, WORD, 49408, 2, tasks=1))), key=lambda r: r["start"]):
        ids = [*word.encode(MARKED[r["doc_id"]], add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
