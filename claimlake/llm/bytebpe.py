"""Byte-level BPE as a finite-state transducer, and streaming decoding.

Which tokens BPE gives is a local matter: a sequence of tokens is the encoding of its bytes exactly
if no merge ever crosses one of its boundaries, and that is seen from the two tokens at the
boundary alone (``Branch.after``). So the merges compile into a transducer that reads bytes, walks
the trie of tokens, and at any token that goes with the one before it may also close it there.

The transducer is made deterministic lazily, a transition when it is first taken. A state holds
every way that can still go on: its closed tokens not yet written and its place in the trie; ways
that no further token can close are left out. Tokens that all ways share are written at once, so a
token is known after a lookahead bounded by the longest token. States are shared by all words (a
bounded number, emptied when full), and a word of any length takes time in proportion to it. Ids of
words met are remembered, in bounded memory.

Decoding feeds ids to ``StreamDecoder``, whose UTF-8 state machine holds back the bytes of an
unfinished character and gives U+FFFD for bytes that are none, as Python's ``replace`` does.

Texts are split by a pattern first, its matches are encoded apart; what it doesn't match has no
ids. A match that is itself a token is that token, also if no merge makes it.

Defined results: a null text is an empty text, without ids, decoded to an empty text; repeated
rows are encoded one by one; an empty table gives no rows; clashing columns are not read.
"""

from __future__ import annotations

import sys
from array import array
from base64 import b64decode
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import Remembered, need, python_on_executors, slices, text_or_empty

ROOT = 0
NEVER = 1 << 62
#: Words of one generation whose ids a worker remembers.
REMEMBERED = 100_000


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a file of lines ``base64 rank``."""
    lines = (line.split() for line in content.splitlines() if line.strip())
    return {b64decode(token): int(rank) for token, rank in lines}


class Merges:
    """The merges that the ranks stand for: adjacent parts whose joint has the least rank are
    joined first, the leftmost on ties."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"no token for byte(s) {missing}")
        #: The two parts that a token is made of; single bytes and tokens that no merge makes lack them.
        self.halves = {rank: parts for token, rank in ranks.items() if len(token) > 1 and (parts := self._halves(token, rank))}
        self.unmade = {token for token, rank in ranks.items() if len(token) > 1 and rank not in self.halves}

    def _halves(self, token: bytes, rank: int) -> tuple[int, int] | None:
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            least, at = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if least >= rank:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def spine(self, token: int, side: int) -> list[int]:
        """The parts that a token begins (side 0) or ends in (1), from a byte to the token itself."""
        parts = [token]
        while parts[-1] in self.halves:
            parts.append(self.halves[parts[-1]][side])
        return parts[::-1]


class Branch:
    """The trie below one first byte: its tokens, in the order of their bytes, and the parts that
    each begins with, as a table of columns from the byte up."""

    def __init__(self, merges: Merges, first: int, end: int, tokens: list[int], nodes: list[int], ends: list[int]):
        self.merges, self.first, self.nodes = merges, first, np.array(nodes) - first
        #: For every node of the branch, the range of its tokens that lie strictly below it.
        at = np.arange(end - first)
        self.below = np.searchsorted(self.nodes, at, "right"), np.searchsorted(self.nodes, np.array(ends[first:end]) - first)
        self.index = {token: i for i, token in enumerate(tokens)}
        spines = [merges.spine(t, 0) for t in tokens]
        height, n = max(map(len, spines)), len(tokens)
        self.part = np.full((height, n), n)
        self.made, self.taken = np.full((height, n), NEVER), np.full((height, n), NEVER)
        for i, parts in enumerate(spines):
            k = len(parts)
            self.part[:k, i] = [self.index[p] for p in parts]
            self.made[:k, i] = [-1, *parts[1:]]
            self.taken[: k - 1, i] = parts[1:]

    def after(self, token: int, joints: Callable[[int], dict[int, int] | None]) -> np.ndarray:
        """Which of the tokens may stand after ``token``: no merge crosses the boundary between.

        Left of the boundary stand, one after the other, the parts that ``token`` ends in; right of
        it those that the next token begins with. Two that stand there together are joined, which
        forbids the next token, if their joint's rank comes before the merge that takes up the
        left one, and not after that which takes up the right one (of equal ranks, the leftmost
        merge is first). ``joints(part)`` has the ranks of the joints of a left part by right part.
        """
        n, lefts = len(self.nodes), self.merges.spine(token, 1)
        allowed = np.ones(n, bool)
        for k, left in enumerate(lefts):
            if found := joints(left):
                joint = np.full(n + 1, NEVER)
                joint[list(found)] = list(found.values())
                joint = joint[self.part]
                made, taken = left if k else -1, lefts[k + 1] if k + 1 < len(lefts) else NEVER
                together = (made <= self.taken) & (taken > self.made)
                allowed &= ~(together & (joint < taken) & (joint <= self.taken)).any(0)
        return allowed

    def flags(self, allowed: np.ndarray) -> bytes:
        """For each node: 1 if its token is allowed, plus 2 if one below it is."""
        out = np.zeros(len(self.below[0]), np.uint8)
        out[self.nodes[allowed]] = 1
        total = np.r_[0, np.cumsum(allowed)]
        out[total[self.below[1]] > total[self.below[0]]] |= 2
        return out.tobytes()


class Following:
    """What may follow a token in one branch of the trie: flags of the nodes from ``first`` on."""

    __slots__ = ("first", "flags")

    def __init__(self, first: int, flags: bytes):
        self.first, self.flags = first, flags


class State(dict):
    """A state of the deterministic transducer: next states by byte, made when first asked for."""

    __slots__ = ("last", "made_by", "out", "rest", "ways")

    def __init__(self, made_by: Transducer, last: int, ways: tuple, out: tuple):
        super().__init__()
        self.made_by, self.last, self.ways = made_by, last, ways
        #: Tokens written on entering the state, and those still to write if the word ends here.
        self.out, self.rest = out, ways[-1][0]

    def __missing__(self, byte: int) -> State:
        state = self[byte] = self.made_by.step(self, byte)
        return state


class Transducer:
    """Encodes byte strings to token ids."""

    def __init__(self, merges: Merges, max_states: int = 200_000, max_followings: int = 50_000):
        self.merges, self.max_states, self.max_followings = merges, max_states, max_followings
        # Tokens enter the trie in the order of their bytes, so that what lies below a node has the
        # numbers after it.
        none: dict[int, int] = {}
        self.children, self.end, nodes = [{}], [0], []
        self.token = [-1]
        made = sorted(set(merges.ranks) - merges.unmade)
        for token in made:
            at, path = ROOT, [ROOT]
            for byte in token:
                if self.children[at] is none:
                    self.children[at] = {}
                down = self.children[at].get(byte)
                if down is None:
                    down = self.children[at][byte] = len(self.token)
                    self.children.append(none)
                    self.token.append(-1)
                    self.end.append(0)
                at = down
                path.append(at)
            self.token[at] = merges.ranks[token]
            nodes.append(at)
            for node in path:
                self.end[node] = len(self.token)
        self.place = dict(zip(made, nodes, strict=True))
        self.branches: dict[int, Branch] = {}
        self._clear()

    def _clear(self) -> None:
        self.states: dict[tuple, State] = {}
        self.followings: dict[tuple[int, int], Following] = {}
        self._equal: dict[tuple[int, bytes], Following] = {}
        self._joints: dict[tuple[int, int], dict[int, int] | None] = {}
        self.start = State(self, -1, (((), ROOT, None),), ())

    def encode(self, word: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        if word in self.merges.unmade:
            return [self.merges.ranks[word]]
        if len(self.states) > self.max_states or len(self.followings) > self.max_followings:
            self._clear()
        state, ids = self.start, []
        for byte in word:
            state = state[byte]
            if state.out:
                ids += state.out
        ids += state.rest
        return ids

    def step(self, state: State, byte: int) -> State:
        """The state after one more byte. The last way is the one that ends in a closed token:
        every byte string has one encoding, so there is one such way."""
        ways, closed = [], None
        for pending, node, allowed in state.ways:
            down = self.children[node].get(byte)
            if down is None:
                continue
            if node == ROOT:
                allowed = self.following(pending[-1] if pending else state.last, byte)
            flag = allowed.flags[down - allowed.first]
            if flag & 1:
                closed = (*pending, self.token[down])
            if flag & 2:
                ways.append((pending, down, allowed))
        ways.append((closed, ROOT, None))
        shared = 0
        first, least = ways[0][0], min(len(w[0]) for w in ways)
        while shared < least and all(w[0][shared] == first[shared] for w in ways):
            shared += 1
        out = first[:shared]
        kept = tuple((p[shared:], node, allowed) for p, node, allowed in ways)
        last = -1 if kept[-1][0] else out[-1] if out else state.last  # the closed way alone asks for it
        key = (last, kept, out)
        known = self.states.get(key)
        if known is None:
            known = self.states[key] = State(self, last, kept, out)
        return known

    def following(self, before: int, byte: int) -> Following:
        """What may follow (-1: nothing before); one object for all tokens that allow the same."""
        known = self.followings.get((before, byte))
        if known is None:
            branch = self._branch(byte)
            allowed = np.ones(len(branch.nodes), bool) if before < 0 else branch.after(before, lambda part: self._joint(part, byte))
            key = byte, branch.flags(allowed)
            known = self._equal.setdefault(key, Following(branch.first, key[1]))
            self.followings[before, byte] = known
        return known

    def _branch(self, byte: int) -> Branch:
        if byte not in self.branches:
            first = self.children[ROOT][byte]
            nodes = [n for n in range(first, self.end[first]) if self.token[n] >= 0]
            self.branches[byte] = Branch(self.merges, first, self.end[first], [self.token[n] for n in nodes], nodes, self.end)
        return self.branches[byte]

    def _joint(self, part: int, byte: int) -> dict[int, int] | None:
        """Ranks of the joints of ``part`` with tokens of a first byte, by their index in the branch."""
        key = part, byte
        if key not in self._joints:
            token, index, ranks = self.merges.bytes[part], self.branches[byte].index, self.merges.ranks
            down = self.children[self.place[token]].get(byte)
            longer = range(down, self.end[down]) if down is not None else ()
            joints = ((ranks.get(self.merges.bytes[t][len(token) :]), t) for n in longer if (t := self.token[n]) >= 0)
            self._joints[key] = {index[rest]: t for rest, t in joints if rest in index} or None
        return self._joints[key]


def _utf8_states() -> list[list[int]]:
    """Next state by state and byte of well-formed UTF-8; -1 where no character goes on so.

    0 between characters; 1, 2, 3 that many bytes to come; 4 to 7 the same after a first byte that
    narrows the second one's range."""
    table = [[-1] * 256 for _ in range(8)]

    def set_range(state: int, first: int, last: int, to: int) -> None:
        table[state][first : last + 1] = [to] * (last + 1 - first)

    for state, first, last, to in (
        # The byte ranges of well-formed UTF-8.
        (0, 0x00, 0x7F, 0), (0, 0xC2, 0xDF, 1), (0, 0xE0, 0xE0, 4), (0, 0xE1, 0xEC, 2), (0, 0xED, 0xED, 5), (0, 0xEE, 0xEF, 2),
        (0, 0xF0, 0xF0, 6), (0, 0xF1, 0xF3, 3), (0, 0xF4, 0xF4, 7), (1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1), (3, 0x80, 0xBF, 2),
        (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1), (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2),
    ):
        set_range(state, first, last, to)
    return table


UTF8 = _utf8_states()
REPLACEMENT = "�"


class StreamDecoder:
    """Ids in, text out; a character whose bytes aren't all there yet is held back."""

    def __init__(self, tokens: dict[int, bytes], known: dict[int, str] | None = None):
        self.tokens, self.state, self.held = tokens, 0, b""
        #: Texts of tokens that are whole characters; may be shared by decoders of one vocabulary.
        self.known = {} if known is None else known

    def feed(self, ids: Iterable[int]) -> str:
        out, known = [], self.known
        for i in ids:
            if self.state == 0:
                text = known.get(i)
                if text is not None:
                    out.append(text)
                    continue
                text = self._bytes(self.tokens[i])
                if self.state == 0:
                    known[i] = text
                out.append(text)
            else:
                out.append(self._bytes(self.tokens[i]))
        return "".join(out)

    def _bytes(self, more: bytes) -> str:
        out, whole, state, data = [], 0, self.state, self.held + more
        at = len(self.held)
        while at < len(data):
            to = UTF8[state][data[at]]
            if to >= 0:
                at += 1
                state = to
                continue
            # What stands is no character: its good part, if any, and the byte if it can't begin one.
            begun = at
            while state and begun > whole and data[begun - 1] & 0xC0 == 0x80:
                begun -= 1
            begun -= bool(state)
            out.append(data[whole:begun].decode() + REPLACEMENT)
            at += not state
            whole, state = at, 0
        begun = at
        if state:
            while data[begun - 1] & 0xC0 == 0x80:
                begun -= 1
            begun -= 1
        out.append(data[whole:begun].decode())
        self.state, self.held = state, data[begun:]
        return "".join(out)

    def finish(self) -> str:
        """What is left at the end of the stream: U+FFFD for an unfinished character."""
        rest, self.state, self.held = REPLACEMENT if self.state else "", 0, b""
        return rest


class Codec:
    """Texts to ids and back with one vocabulary."""

    def __init__(self, ranks: bytes, pattern: str):
        self.merges = Merges(parse_ranks(ranks))
        self.transducer = Transducer(self.merges)
        self.split = regex.compile(pattern)
        self.words = Remembered(lambda word: array("I", self.transducer.encode(word.encode())).tobytes(), REMEMBERED)
        self.known: dict[int, str] = {}

    def encode(self, text: str) -> array:
        """Ids as unsigned 32-bit integers, in a compact array however long the text."""
        matches, word = (m.group() for m in self.split.finditer(text)), self.words.__getitem__
        ids = array("I")
        while part := b"".join(map(word, islice(matches, 100_000))):
            ids.frombytes(part)
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        stream = StreamDecoder(self.merges.bytes, self.known)
        return stream.feed(ids) + stream.finish()


_BUILT: dict[int, Codec] = {}


def codec(ranks: bytes, pattern: str) -> Codec:
    """The codec of this Python worker, with the states that earlier tasks made."""
    key = hash((ranks, pattern))
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Codec(ranks, pattern)
    return _BUILT[key]


def little_endian(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids = array("I", ids)
        ids.byteswap()
    return ids.tobytes()


SCHEMA = "doc_id long, n_tokens long, ids binary, ids_sha256 string, decoded string, decoded_sha256 string"


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, digests_only: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit), ids_sha256, decoded, decoded_sha256 of
    every row; ``digests_only`` leaves ``ids`` and ``decoded`` null, so that texts stay in their task."""
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    python_on_executors(spark)
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary(), "ids_sha256": pa.string(), "decoded": pa.string(), "decoded_sha256": pa.string()}
    schema = pa.schema(list(kinds.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks.value, pattern)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(map(len, texts), 2_000_000):
                rows = []
                for doc_id, text in zip(doc_ids[a:b], texts[a:b], strict=True):
                    ids = own.encode(text)
                    packed, decoded = little_endian(ids), own.decode(ids)
                    hashes = sha256(packed).hexdigest(), sha256(decoded.encode()).hexdigest()
                    rows.append((doc_id, len(ids), None if digests_only else packed, hashes[0], None if digests_only else decoded, hashes[1]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, SCHEMA)


def decode_ids(coded: DataFrame, ranks_path: str) -> DataFrame:
    """``decoded`` for each row's ``ids`` (little-endian unsigned 32-bit; null: empty), beside doc_id."""
    need(coded, "doc_id", "ids")
    spark = coded.sparkSession
    python_on_executors(spark)
    with open(ranks_path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in parse_ranks(ranks.value).items()}
        known: dict[int, str] = {}
        for batch in batches:
            texts = []
            for packed in batch.column(1).to_pylist():
                stream = StreamDecoder(tokens, known)
                ids = (int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed or b""), 4))
                texts.append(stream.feed(ids) + stream.finish())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema=schema)

    return coded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, decoded string")
