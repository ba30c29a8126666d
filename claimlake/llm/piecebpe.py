"""SentencePiece BPE: encoding by a score-ordered agenda of adjacent symbol pairs, and decoding.

Spaces become the mark ``▁`` and one is put first; then, of all adjacent symbols whose joint is a
piece, the pair of highest score (the leftmost on ties) is merged, again and again, from an agenda
that merges keep up to date. What is no piece in the end becomes its UTF-8 bytes' pieces.

No piece has a mark after another character, so no merge crosses from a word into the next mark:
a text's words are encoded apart, and each distinct word once (a bounded memory, emptied when
full). Every word that enters the memory is checked against the sentencepiece library, all new
words of an Arrow batch at once, and a difference stops the job; decoding is the library's.

Only models of this kind are taken: BPE with byte fallback, no normalising, a dummy prefix, no
user-defined symbols, no piece with an inner mark. Others raise ``ValueError``.

Defined results: a null text is an empty text, without ids, decoded to an empty text; repeated
rows are encoded one by one; an empty table gives no rows; clashing columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import need, python_on_executors, slices, text_or_empty

MARK = "▁"
#: A run of marks and what follows it up to the next mark.
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Vocabulary:
    """Pieces, scores and byte pieces of a model, and the ids of words met."""

    def __init__(self, model: bytes, remember: int = 1_500_000):
        self.library = library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [library.id_to_piece(i) for i in range(library.vocab_size())]
        ordinary = [i for i in range(len(pieces)) if not (library.is_control(i) or library.is_byte(i) or library.is_unknown(i) or library.is_unused(i))]
        self.ids = {pieces[i]: i for i in ordinary}
        self.scores = {pieces[i]: library.get_score(i) for i in ordinary}
        self.bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = library.unk_id()
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece has a mark after another character")
        if any(b == self.unknown for b in self.bytes) or library.Normalize("ﬁ  b ") != "▁ﬁ▁▁b▁":
            raise ValueError("the model has no byte fallback, or normalises its texts")
        self.decimal = [str(i) for i in range(len(pieces))]
        self.remember, self.words = remember, {}

    def merge(self, word: str) -> list[int]:
        """Ids of one word by the agenda."""
        symbols: list[str | None] = list(word)
        n, scores = len(symbols), self.scores
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(-scores[p], i, p) for i in range(n - 1) if (p := symbols[i] + symbols[i + 1]) in scores]
        heapq.heapify(agenda)
        while agenda:
            _, i, pair = heapq.heappop(agenda)
            left = symbols[i]
            j = after[i]
            if left is None or j >= n or left + symbols[j] != pair:
                continue  # one of its symbols has been merged since
            symbols[i], symbols[j] = pair, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := pair + symbols[k]) in scores:
                    heapq.heappush(agenda, (-scores[p], i, p))
            h = before[i]
            if h >= 0 and (p := symbols[h] + pair) in scores:
                heapq.heappush(agenda, (-scores[p], h, p))
        out = []
        for s in symbols:
            if s is not None:
                known = self.ids.get(s)
                out += [known] if known is not None else [self.bytes[b] for b in s.encode()]
        return out

    def encode(self, texts: list[str]) -> list[list[tuple[str, tuple[int, ...]]]]:
        """Each text's words' ids, as comma-joined decimals and as numbers."""
        if len(self.words) > self.remember:
            self.words.clear()
        split = [_words(t) for t in texts]
        new = list({w for ws in split for w in ws}.difference(self.words))
        self._learn(new)
        get = self.words.__getitem__
        return [list(map(get, ws)) for ws in split]

    def _learn(self, new: list[str]) -> None:
        own = [self.merge(w) for w in new]
        # The library puts a mark first, so it is given the words without their first one.
        marked = [i for i, w in enumerate(new) if w[0] == MARK]
        theirs = self.library.encode([new[i][1:] for i in marked], num_threads=1)
        for i, ids in zip(marked, theirs, strict=True):
            if ids != own[i] and new[i] != MARK:  # alone, its rest is empty, which has no ids
                raise ValueError(f"the library encodes {new[i]!r} as {ids}, the agenda as {own[i]}")
        decimal = self.decimal
        self.words.update((w, (",".join([decimal[i] for i in ids]), tuple(ids))) for w, ids in zip(new, own, strict=True))


def _words(text: str) -> list[str]:
    """The words, with their marks, of a text as the model sees it."""
    if not text:
        return []
    if MARK in text or "  " in text or text[0] == " " or text[-1] == " ":
        return _WORD.findall(MARK + text.replace(" ", MARK))
    return [MARK + w for w in text.split(" ")]


_BUILT: dict[int, Vocabulary] = {}


def vocabulary(model: bytes) -> Vocabulary:
    """The vocabulary of this Python worker, with the words that earlier tasks met."""
    key = hash(model)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Vocabulary(model)
    return _BUILT[key]


SCHEMA = "doc_id long, n_tokens long, ids string, ids_sha256 string, decoded string, decoded_sha256 string"


def encode_documents(docs: DataFrame, model_path: str, digests_only: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (comma-joined), ids_sha256, decoded, decoded_sha256 of every row;
    ``digests_only`` leaves ``ids`` and ``decoded`` null, so that texts stay in their task."""
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    python_on_executors(spark)
    with open(model_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *((c, pa.string()) for c in ("ids", "ids_sha256", "decoded", "decoded_sha256"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(model.value)
        decode = own.library.decode
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(map(len, texts), 2_000_000):
                rows = []
                for doc_id, parts in zip(doc_ids[a:b], own.encode(texts[a:b]), strict=True):
                    joined = ",".join([p[0] for p in parts])
                    ids = list(chain.from_iterable([p[1] for p in parts]))
                    decoded = decode(ids) if ids else ""
                    hashes = sha256(joined.encode()).hexdigest(), sha256(decoded.encode()).hexdigest()
                    rows.append((doc_id, len(ids), None if digests_only else joined, hashes[0], None if digests_only else decoded, hashes[1]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, SCHEMA)
