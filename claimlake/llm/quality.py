"""Document quality by votes of the nearest labelled documents in a latent semantic space.

A text's terms are its hashed byte trigrams and a few bins of its style (shares of upper case,
punctuation, digits, spaces; repeated and distinct words; length). Weighted by rarity and
projected on the main singular directions of the labelled sample, texts become short latent
vectors. The labelled vectors, at most ``sample`` of them, are broadcast; each document's cosines
with all of them are computed exactly, a block of documents at a time, and its nearest neighbours
vote with a power of their similarity. Only the text enters a score.

The labelled sample is the ``sample`` labelled documents of smallest id hash (a documented bound);
every document is scored on its whole text.

Defined results: a null text is an empty text and is scored like any other; neighbours that tie
with the last one all vote; a document with several labels counts once, with the smallest; of rows
that repeat a labelled id one is learned from; labels other than 0 and 1 are ignored; without any
labelled row every score is 0.5; an empty table gives no rows; clashing columns are not read.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import need, python_on_executors, slices, text_or_empty

BUCKETS = 4096
EDGES = (0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8)
STYLES = 7
TERMS = BUCKETS + STYLES * (len(EDGES) + 1)
SAMPLE, LATENT, NEIGHBOURS, POWER = 4000, 32, 9, 8
THRESHOLD = 0.3


def counts(text: str) -> np.ndarray:
    """Trigram counts (hashed) and style bins of a whole text."""
    data = text.encode()
    b = np.frombuffer(data, np.uint8)
    out = np.zeros(TERMS, np.float32)
    if len(b) > 2:
        w = b.astype(np.uint32)
        mixed = w[:-2] * np.uint32(0x9E3779B1) ^ w[1:-1] * np.uint32(0x85EBCA6B) ^ w[2:] * np.uint32(0xC2B2AE35)
        out[:BUCKETS] = np.bincount(mixed * np.uint32(2654435761) >> np.uint32(20), minlength=BUCKETS)
    n = max(1, len(b))
    kinds = np.bincount(_KIND[b], minlength=6) / n
    words = data.lower().split()
    repeated = sum(map(operator.eq, words, words[1:])) / max(1, len(words) - 1)
    distinct = len(set(words)) / max(1, len(words))
    style = (kinds[0], kinds[2], kinds[3], kinds[4], repeated, distinct, min(1.0, len(words) / 50))
    out[BUCKETS + np.arange(STYLES) * (len(EDGES) + 1) + np.digitize(style, EDGES)] = 1
    return out


_KIND = np.full(256, 5, np.int64)  # 0 upper, 1 lower, 2 punctuation, 3 digit, 4 space, 5 beyond ASCII
_KIND[:128] = 2
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[32] = 0, 1, 3, 4


@dataclass
class Model:
    rarity: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: int

    def latent(self, terms: np.ndarray) -> np.ndarray:
        return _unit(_weighted(terms, self.rarity) @ self.directions)

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        near = self.latent(np.stack([counts(t) for t in texts])) @ self.vectors.T
        k = min(self.neighbours, near.shape[1])
        last = np.partition(near, -k, axis=1)[:, -k]
        row, column = np.nonzero(near >= last[:, None] - 1e-5)
        weight = np.maximum(near[row, column].astype(np.float64), 1e-6) ** self.power
        votes = np.bincount(row, weight * self.labels[column], len(texts))
        return np.round(votes / np.bincount(row, weight, len(texts)), 4)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _weighted(terms: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Trigrams and style, each of unit length, side by side."""
    w = np.log1p(terms) * rarity
    return np.concatenate([_unit(w[:, :BUCKETS]), _unit(w[:, BUCKETS:])], axis=1)


def learnable(doc_id: Column | str) -> Column:
    """Rows whose labels may be learned: crc32 of the id as text, mod 5, is not 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, latent: int = LATENT, neighbours: int = NEIGHBOURS, power: int = POWER) -> Model:
    """Learn from the labelled rows of ``docs`` (bounded by ``sample``)."""
    need(docs, "doc_id", "text")
    need(labels, "doc_id", "quality")
    python_on_executors(docs.sparkSession)
    usable = labels.filter(learnable("doc_id") & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    present = docs.select("doc_id").distinct()
    chosen = usable.join(present, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    wanted = {r.doc_id: r.quality for r in chosen.collect()}  # at most `sample` ids
    ids = docs.sparkSession.createDataFrame([(i,) for i in wanted], "wanted long")

    @F.pandas_udf("binary")
    def terms(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: zlib.compress(counts(t).astype("<f4").tobytes(), 1))  # mostly zeros

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("wanted"))
    learned = rows.select("doc_id", terms("text").alias("terms")).groupBy("doc_id").agg(F.min("terms").alias("terms"))
    found = sorted(learned.collect(), key=lambda r: r.doc_id)
    if not found:
        empty = np.zeros((0, latent), np.float32)
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, latent), np.float32), empty, np.zeros(0), neighbours, power)
    x = np.empty((len(found), TERMS), np.float32)  # the only array of this size that the driver holds
    seen = np.zeros(TERMS, np.int64)
    for i, r in enumerate(found):
        x[i] = np.frombuffer(zlib.decompress(r.terms), "<f4")
        seen += x[i] > 0
    rarity = (np.log((1 + len(x)) / (1 + seen)) + 0.1).astype(np.float32)
    for a in range(0, len(x), 256):
        x[a : a + 256] = _weighted(x[a : a + 256], rarity)
    directions = _directions(x, latent)
    marks = np.array([wanted[r.doc_id] for r in found], np.float64)
    return Model(rarity, directions, _unit(x @ directions).astype(np.float32), marks, neighbours, power)


def _directions(x: np.ndarray, n: int) -> np.ndarray:
    """The first right singular vectors of ``x``, by subspace iteration from a fixed start."""
    q = np.random.default_rng(0).standard_normal((x.shape[1], n + 8)).astype(np.float32)
    for _ in range(6):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    return (q @ np.linalg.svd(x @ q, full_matrices=False)[2].T[:, :n]).astype(np.float32)


def scorer(docs: DataFrame, model: Model):
    """A function of a text column that scores it under the broadcast model."""
    spark = docs.sparkSession
    python_on_executors(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = texts.to_list()
            parts = [shared.value.score(texts[a:b]) for a, b in slices((16_000 + len(t) for t in texts), 8_000_000)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **parameters: int) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    score = scorer(docs, fit(docs, labels, **parameters))
    scored = docs.select("doc_id", F.coalesce(~learnable("doc_id"), F.lit(False)).alias("held_out"), score(text_or_empty()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **parameters: int) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with their columns."""
    score = scorer(docs, fit(docs, labels, **parameters))
    marked = docs.select(F.struct(*docs.columns).alias("row"), score(text_or_empty()).alias("score"))
    return marked.filter(F.col("score") >= threshold).select("row.*")
