import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from claimlake.llm import bytebpe as b

from helpers import documents, empty_documents, odd_documents, rows

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = open(PATH, "rb").read()
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=b.parse_ranks(RANKS), special_tokens={})
CODEC = b.Codec(RANKS, public_tokenizers.PATTERN)


@pytest.mark.parametrize("make", [documents, odd_documents, lambda s: odd_documents(s, clash=True), empty_documents])
def test_documents_have_the_library_ids_and_come_back(spark, make):
    docs = make(spark)
    got = rows(b.encode_documents(docs, PATH, public_tokenizers.PATTERN))
    want = []
    for r in docs.select("doc_id", "text").collect():
        text = r.text or ""
        ids = np.array(LIBRARY.encode_ordinary(text), "<u4").tobytes()
        want.append((r.doc_id, len(ids) // 4, ids, hashlib.sha256(ids).hexdigest(), text, hashlib.sha256(text.encode()).hexdigest()))
    key = lambda x: (x[0] is not None, x[0] or 0, x[2])
    assert sorted(map(lambda r: tuple(r.values()), got), key=key) == sorted(want, key=key)
    back = rows(b.decode_ids(b.encode_documents(docs, PATH, public_tokenizers.PATTERN), PATH))
    assert sorted((r["doc_id"] or -1, r["decoded"]) for r in back) == sorted((w[0] or -1, w[4]) for w in want)


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=60))
def test_any_bytes_have_the_library_ids(word):
    assert CODEC.transducer.encode(word) == LIBRARY._encode_single_piece(word)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    ids = CODEC.encode(text)
    assert list(ids) == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(ids) == text


def test_long_words_and_few_states():
    tight = b.Transducer(CODEC.merges, max_states=50, max_followings=50)
    pick = random.Random(3)
    words = [b"a" * 9000, b" " * 5000, b"ab" * 2000, pick.randbytes(3000)] + [bytes(pick.choices(b"etaoin shr\xc3\xa9", k=12)) for _ in range(500)]
    for w in words:
        assert tight.encode(w) == LIBRARY._encode_single_piece(w)


def _naive(ranks, word):
    if word in ranks:
        return [ranks[word]]
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1))
        if rank == 1 << 62:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 400)), max_size=25), st.lists(st.sampled_from([b"abab", b"aba", b"bb"]), unique=True), st.lists(st.text("ab", max_size=14), max_size=6))
def test_any_vocabulary(merges, unmade, words):
    """Trained vocabularies of any kind, also with tokens that no merge makes."""
    tokens = [bytes([i]) for i in range(256)]
    for x, y in merges:
        small = [b"a", b"b", *tokens[256:]]
        joint = small[x % len(small)] + small[y % len(small)]
        if joint not in tokens and len(joint) < 12:
            tokens.append(joint)
    tokens += [t for t in unmade if t not in tokens]
    ranks = {t: i for i, t in enumerate(tokens)}
    content = b"\n".join(base64.b64encode(t) + b" %d" % i for t, i in ranks.items())
    own = b.Transducer(b.Merges(b.parse_ranks(content)))
    for w in words:
        assert own.encode(w.encode()) == _naive(ranks, w.encode())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.binary(max_size=4), max_size=8))
def test_streaming_decode_replaces_like_python(parts):
    stream = b.StreamDecoder(dict(enumerate(parts)))
    text = "".join(stream.feed([i]) for i in range(len(parts))) + stream.finish()
    assert text == b"".join(parts).decode("utf-8", "replace")


def test_characters_are_held_back_until_whole():
    stream = b.StreamDecoder({0: "né".encode()[:2], 1: "é".encode()[1:] + b"!"})
    assert (stream.feed([0]), stream.feed([1]), stream.finish()) == ("n", "é!", "")


def test_missing_bytes_are_an_error():
    with pytest.raises(ValueError, match="no token for byte"):
        b.Merges({b"a": 0})
