"""Runs: stretches of words that repeat with a period at least three times, by string
synchronising sets.

Texts are dealt with many at a time, as one sequence of word numbers with a number of its own after
each text, so that nothing reaches from one text into the next.

* **Small periods** (below 4) are detected directly: words that equal the word 1, 2 or 3 further.
* **Scale** ``tau`` = 2, 4, 8, ... stands for the periods from 2 tau to 4 tau. A position belongs
  to its synchronising set if the least hash of the tau-word windows that start at it or at one of
  the next tau positions is the first's or the last's. Whether it does depends on the 2 tau words
  from it alone, so equal surroundings hold equal positions of the set, and a run of such a period
  has one in each period. Windows that lie in a run of period tau / 3 or less have no hash: those
  highly periodic regions were detected separately, at smaller scales, and would fill the set.
* **Pairs** of a set's positions with equal contexts (2 tau words), 2 tau to 4 tau apart, propose
  that distance as a period. Each proposal is extended to both sides, as far as the words stay
  equal that distance apart, by comparing hashes of halving lengths.
* Of proposals for one stretch the smallest period is its period. At last every run is compared
  word by word; should a hash have misled, all is done again with another seed.

A text of n words takes about ``16 log2(n)`` bytes of memory a word while it is worked on, and time
in proportion to n log n. All texts are whole; each is one task's work.

Defined results: a null or empty text, or one without words, has no run and collapses to an empty
text; repeated rows are taken one by one; a null ``doc_id`` (of ``folded``) leaves its words as they
are; an empty table gives no rows; other columns are not carried, so clashing names do no harm.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from hashlib import sha256
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import need, python_on_executors, slices, text_or_empty

LEAST_LENGTH, TIMES = 24, 3
#: Scale of the first synchronising set; smaller periods than twice it are detected directly.
FIRST_SCALE = 2
#: Bytes of text that are worked on together.
TOGETHER = 2_000_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def find_runs(sequences: list[np.ndarray], times: int = TIMES, seed: int = 0) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each sequence of numbers (0 to 2**31), in the order of
    start and period: a maximal stretch with that smallest period and ``times`` (3 or more) of it."""
    if times < 3:
        raise ValueError("runs of fewer than three periods aren't proposed by every scale")
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))  # long ones first: large scales see a prefix
    sizes = np.array([len(sequences[i]) for i in order], np.int64)
    starts = np.r_[0, np.cumsum(sizes + 1)]
    words = np.empty(starts[-1], np.int64)
    words[starts[1:] - 1] = -1 - np.arange(len(order))
    for i, at in zip(order, starts[:-1], strict=True):
        words[at : at + len(sequences[i])] = sequences[i]
    for attempt in count(seed):
        found = _Search(words, sizes, starts, times, attempt).runs()
        if _all_hold(words, *found):
            break
    out: list[list[tuple[int, int, int]]] = [[] for _ in sequences]
    start, end, period = found
    owner = np.searchsorted(starts, start, "right") - 1
    for k in np.lexsort((period, start)):
        out[order[owner[k]]].append((int(start[k] - starts[owner[k]]), int(end[k] - start[k]), int(period[k])))
    return out


def _all_hold(words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> bool:
    return all(np.array_equal(words[s : e - q], words[s + q : e]) for s, e, q in zip(start.tolist(), end.tolist(), period.tolist(), strict=True))


class _Search:
    def __init__(self, words: np.ndarray, sizes: np.ndarray, starts: np.ndarray, times: int, seed: int):
        self.words, self.sizes, self.starts, self.times = words, sizes, starts, times
        #: Hashes of the windows of 1, 2, 4, ... words by start; longer windows only where texts are as long.
        self.windows = [_mixed(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) % (1 << 64)))]
        while 1 << len(self.windows) <= (sizes[0] if len(sizes) else 0):
            half, size = self.windows[-1], 1 << len(self.windows) - 1
            n = max(0, min(self._extent(2 * size), len(half)) - size)
            self.windows.append(_mixed(half[:n] * np.uint64(3) + _mixed(half[size : size + n])))
        self.start, self.end, self.period = (np.zeros(0, np.int64) for _ in range(3))

    def _extent(self, least: int) -> int:
        """Where the texts of at least so many words end."""
        return int(self.starts[np.searchsorted(-self.sizes, -least, "right")])

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        for period in range(1, 2 * FIRST_SCALE):
            self._detect(period)
        tau = FIRST_SCALE
        while (n := self._extent(2 * tau * self.times)) > 0:
            self._propose(tau, n)
            tau *= 2
        return self.start, self.end, self.period

    def _detect(self, period: int) -> None:
        n = self._extent(period * self.times)
        same = np.zeros(n + 2, np.int8)
        same[1 : n + 1 - period] = self.words[: n - period] == self.words[period:n] if n > period else 0
        edge = np.flatnonzero(np.diff(same))
        self._keep(edge[::2], edge[1::2] + period, np.full(len(edge) // 2, period))

    def _keep(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """Add runs; of one stretch the smallest period is its own, its multiples go."""
        long = end - start >= self.times * period
        start, end, period = (np.r_[old, new[long]] for old, new in ((self.start, start), (self.end, end), (self.period, period)))
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        first = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])][: len(start)]
        self.start, self.end, self.period = start[first], end[first], period[first]

    def _synchronising(self, tau: int, n: int) -> np.ndarray:
        """The positions of the set of one scale whose contexts lie within the first ``n`` words."""
        level = tau.bit_length() - 1
        hashes = self.windows[level][: max(0, n - tau)].copy()
        none = np.uint64(0xFFFFFFFFFFFFFFFF)
        region = (3 * self.period <= tau) & (self.end - self.start >= tau)
        marks = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(marks, np.minimum(self.start[region], len(hashes)), 1)
        np.add.at(marks, np.minimum(self.end[region] - tau + 1, len(hashes)), -1)
        hashes[np.cumsum(marks[:-1]) > 0] = none
        least, size = hashes, 1
        while size < tau:  # the least of `tau` windows in a row
            least = np.minimum(least[:-size], least[size:]) if len(least) > size else least[:0]
            size *= 2
        least = np.minimum(least[:-1], least[1:])  # of `tau` + 1
        k = len(least)
        return np.flatnonzero((least != none) & ((hashes[:k] == least) | (hashes[tau : tau + k] == least)))

    def _propose(self, tau: int, n: int) -> None:
        at = self._synchronising(tau, n)
        contexts = self.windows[tau.bit_length()]
        at = at[at < min(len(contexts), n)]
        context = contexts[at]
        order = np.argsort(context, kind="stable")  # equal contexts side by side, in the order of position
        at, context = at[order], context[order]
        firsts, periods = [], []
        live = np.arange(len(at) - 1)
        for further in count(1):
            live = live[live + further < len(at)]
            apart = at[live + further] - at[live]
            near = (context[live + further] == context[live]) & (apart < 4 * tau)
            live, apart = live[near], apart[near]
            if not len(live):
                break
            fit = apart >= 2 * tau
            firsts.append(at[live[fit]])
            periods.append(apart[fit])
        if firsts:
            self._extend(np.concatenate(firsts), np.concatenate(periods))

    def _extend(self, at: np.ndarray, period: np.ndarray) -> None:
        left, right = at.copy(), at.copy()
        for level in reversed(range(len(self.windows))):
            window, size = self.windows[level], 1 << level
            ok = right + period < len(window)
            ok[ok] = window[right[ok]] == window[right[ok] + period[ok]]
            right[ok] += size
            ok = (left >= size) & (left - size + period < len(window))
            ok[ok] = window[left[ok] - size] == window[left[ok] - size + period[ok]]
            left[ok] -= size
        self._keep(left, right + period, period)


def fold(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document's words with a repeated stretch planted, as its id's checksum says."""
    h = crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, runs string, collapsed_sha256 string, collapsed string"


def periodic_runs(docs: DataFrame, folded: bool = False, least_length: int = LEAST_LENGTH, digests_only: bool = False) -> DataFrame:
    """The runs of every whole text, at least ``least_length`` words long.

    doc_id, n_runs; start, length, period, exponent_milli of the run of greatest length / period
    (ties: smallest start, then period; nulls without a run); ``runs``, every run's
    ``start,length,period`` and a line feed by start, then period; ``collapsed``, the text without
    what any run holds after its first period, its words joined by one space; the digests of both.
    ``folded`` plants repeats first (``fold``). ``digests_only`` leaves both texts null.
    """
    need(docs, "doc_id", "text")
    python_on_executors(docs.sparkSession)
    kinds = [(f.split()[0], pa.int64() if f.endswith("long") else pa.string()) for f in SCHEMA.split(", ")]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(map(len, texts), TOGETHER):
                split = [text.encode().split() for text in texts[a:b]]
                if folded:
                    split = [fold(i, words) for i, words in zip(doc_ids[a:b], split, strict=True)]
                rows = [_row(*x, least_length, digests_only) for x in zip(doc_ids[a:b], split, find_runs(_numbered(split)), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, SCHEMA)


def _numbered(split: list[list[bytes]]) -> list[np.ndarray]:
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    return [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in split]


def _row(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]], least_length: int, digests_only: bool) -> tuple:
    runs = [r for r in runs if r[1] >= least_length]
    best: tuple = (None,) * 4
    if runs:
        start, length, period = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
        best = start, length, period, 1000 * length // period
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, [s + q for s, _, q in runs], 1)
        np.add.at(edges, [s + n for s, n, _ in runs], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]
    listed, collapsed = "".join(f"{s},{n},{q}\n" for s, n, q in runs), b" ".join(words)
    texts = (None, None) if digests_only else (listed, collapsed.decode())
    return (doc_id, len(runs), *best, sha256(listed.encode()).hexdigest(), texts[0], sha256(collapsed).hexdigest(), texts[1])
