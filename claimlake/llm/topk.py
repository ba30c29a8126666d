"""Exact top-k by inner product with Fagin's threshold algorithm.

Candidates are dealt into blocks of bounded size; a block keeps, for each dimension, its rows
sorted by their component, sorted once for all queries of a large query block. The lists are read
in rounds of growing depth, from both ends, for a batch of queries together: the rows met get their
whole scores by one product with the batch. The bound of a query is the score of a row that had the
last value read in every list. Once it is below the kth best score known, no unread row can enter,
and the query leaves the batch. The first block answers first: its kth scores are where every
other block starts from, so that these stop as early as they can. Each block answers with at most k
rows a query, and the k best of those are the result.

Scores are inner products of ``floor(scale * x)``, as integers. They are computed in floats only
where these hold every partial sum (below 2**24 in single, 2**53 in double precision), else in
Python integers, so they are exact.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part;
ties go to the smaller id; candidates with the query's id are its own rows and are left out; query
rows that repeat an id with an equal vector are answered once (with another vector: each, under
the same id); repeated candidate rows each count; rows with a null id take no part; only vectors of
equal length are compared; an empty table gives no rows; a score beyond a long is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlake.llm.common import need, python_on_executors, written
from claimlake.session import default_parallelism

#: Rows of a candidate block and, at most, queries of a query block: bounds on one task's memory.
CANDIDATES, QUERIES = 65536, 16384
#: Queries that are answered together, and rows of one product.
BATCH, ROWS = 512, 8192
EXACT, EXACT_SINGLE = 2**53, 2**24


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, v: the scaled integer components (as doubles, which hold them exactly)."""
    need(vectors, id_col, vector_col)
    usable = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
        .filter("id is not null and size(x) > 0")
        .filter(usable)
        .select("id", F.transform("x", lambda c: _floor(c * scale)).alias("v"))
    )


def _floor(c):
    """floor as a double: whole doubles beyond 2**53 are their own floor."""
    return F.when(F.abs(c) < float(EXACT), F.floor(c).cast("double")).otherwise(c)


class Lists:
    """A block's rows and their order by each component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")  # then ties go to the first
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        self.single = self.vectors.astype(np.float32)
        self.order = np.argsort(self.vectors, axis=0, kind="stable").astype(np.int32)
        self.largest = float(np.abs(self.vectors).max(initial=0))
        #: Scores that were computed, of how many there are.
        self.scored = 0

    def top(self, query_id: int, query: np.ndarray, k: int, step: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows of one query, best first."""
        _, ids, scores = self.top_many(np.array([query_id]), query[None, :], k, step=step)
        return ids, scores

    def top_many(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray | None = None, step: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the query, id and score of the k best rows of each, best first. Rows whose score
        is below a query's floor may be left out. ``step``: rows of each list in the first round."""
        floors = np.full(len(queries), -np.inf) if floors is None else floors
        limit = self.largest * np.abs(queries).max(axis=1, initial=0) * queries.shape[1]
        parts = [self._exact(i, query_ids[i], queries[i], k) for i in np.flatnonzero(limit >= EXACT)]
        for single in (True, False):
            mine = np.flatnonzero((limit < EXACT_SINGLE) if single else (limit >= EXACT_SINGLE) & (limit < EXACT))
            for at in range(0, len(mine), BATCH):
                some = mine[at : at + BATCH]
                which, rows, scores = self._batch(query_ids[some], queries[some], floors[some], k, step, self.single if single else self.vectors)
                parts.append((some[which], rows, scores))
        which, rows, scores = (np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in range(3))
        return which, self.ids[rows.astype(np.int64)], scores.astype(np.int64)

    def _exact(self, which: int, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q = [int(x) for x in query]
        rows = np.flatnonzero(self.ids != query_id)
        scores = np.array([sum(int(a) * b for a, b in zip(v, q, strict=True)) for v in self.vectors[rows]], np.int64)  # OverflowError beyond a long
        self.scored += len(rows)
        best = np.lexsort((rows, -scores))[:k]
        return np.full(len(best), which), rows[best], scores[best]

    def _batch(self, query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, k: int, step: int, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, dims = len(self.ids), np.arange(queries.shape[1])
        narrow = queries.astype(vectors.dtype)
        # A query's own rows are no candidates: (query, row) pairs, rows ascending for each query.
        first, end = np.searchsorted(self.ids, query_ids, "left"), np.searchsorted(self.ids, query_ids, "right")
        own_query = np.repeat(np.arange(len(queries)), end - first)
        own_row = np.concatenate([np.arange(a, b) for a, b in zip(first, end, strict=True)]) if len(queries) else first
        which = rows = np.zeros(0, np.int64)
        scores, kth = np.zeros(0), floors.astype(np.float64)
        active, met, depth = np.arange(len(queries)), np.zeros(n, bool), 0
        while depth < n and len(active):
            until = min(n, depth + step)
            seen = np.zeros(n, bool)
            seen[self.order[n - until : n - depth].ravel()] = True
            seen[self.order[depth:until].ravel()] = True
            fresh = np.flatnonzero(seen & ~met)
            met |= seen
            for at in range(0, len(fresh), ROWS):
                some = fresh[at : at + ROWS]
                got = narrow[active] @ vectors[some].T
                self.scored += got.size
                place = np.full(len(queries), -1)
                place[active] = np.arange(len(active))
                col = np.minimum(np.searchsorted(some, own_row), len(some) - 1)
                hit = (some[col] == own_row) & (place[own_query] >= 0)
                got[place[own_query[hit]], col[hit]] = -np.inf
                least = kth[active]
                if len(some) > k and np.isneginf(least).any():
                    least = np.maximum(least, np.partition(got, len(some) - k, axis=1)[:, len(some) - k])
                r, c = np.nonzero((got >= least[:, None]) & (got > -np.inf))
                which, rows, scores = np.r_[which, active[r]], np.r_[rows, some[c]], np.r_[scores, got[r, c].astype(np.float64)]
                best = np.lexsort((rows, -scores, which))
                which, rows, scores = which[best], rows[best], scores[best]
                begins = np.searchsorted(which, np.arange(len(queries)))
                few = np.arange(len(which)) - begins[which] < k
                which, rows, scores = which[few], rows[few], scores[few]
                ends = np.searchsorted(which, np.arange(len(queries)), "right")
                begins = np.searchsorted(which, np.arange(len(queries)))
                full = ends - begins == k
                kth[full] = np.maximum(kth[full], scores[ends[full] - 1])
            depth = until
            high, low = self.vectors[self.order[n - depth], dims], self.vectors[self.order[depth - 1], dims]
            bound = np.maximum(queries[active], 0) @ high + np.minimum(queries[active], 0) @ low
            active = active[bound >= kth[active]]
            step *= 2
        return which, rows, scores


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 64,
    candidates: int = CANDIDATES,
    query_rows: int = QUERIES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows of ``vectors`` for each query."""
    spark = vectors.sparkSession
    python_on_executors(spark)
    rows = written(whole_vectors(vectors, id_col, vector_col, scale).withColumn("at", F.monotonically_increasing_id()), "topk_rows")
    asked = written(whole_vectors(queries, id_col, vector_col, scale).distinct().withColumn("at", F.monotonically_increasing_id()), "topk_queries")
    blocks = max(1, -(-rows.count() // candidates))
    n = asked.count()
    query_blocks = max(1, -(-n // query_rows), min(default_parallelism(spark), n // BATCH))
    # Blocks of about equal size whatever the ids are: dealt by a hash of the row, not of its id.
    deal = lambda n: F.pmod(F.xxhash64("at"), F.lit(n))
    every = lambda first, n: F.explode(F.sequence(F.lit(first).cast("long"), F.lit(n - 1).cast("long")))
    own = rows.select("id", "v", deal(blocks).alias("block"), F.lit(None).cast("long").alias("floor"))
    own = own.select("*", every(0, query_blocks).alias("query_block"), F.lit(False).alias("asks"))
    ask = asked.select("id", "v", deal(query_blocks).alias("query_block"), "at")

    def answer(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        sizes = frame["v"].map(len)
        for size in sizes.unique():
            part = frame[sizes == size]
            own, ask = part[~part["asks"]], part[part["asks"]]
            if own.empty or ask.empty:
                continue
            lists = Lists(own["id"].to_numpy(np.int64), np.stack(own["v"].to_list()).astype(np.float64))
            floors = ask["floor"].to_numpy(np.float64, na_value=-np.inf)
            which, ids, scores = lists.top_many(ask["id"].to_numpy(np.int64), np.stack(ask["v"].to_list()).astype(np.float64), k, floors)
            yield pd.DataFrame({"at": ask["at"].to_numpy(np.int64)[which], "query_id": ask["id"].to_numpy(np.int64)[which], "vec_id": ids, "score": scores})

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        parts = list(answer(frame))
        return pd.concat(parts) if parts else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("at", "query_id", "vec_id", "score")})

    def answered(own: DataFrame, ask: DataFrame) -> DataFrame:
        both = own.withColumn("at", F.lit(None).cast("long")).unionByName(ask.withColumn("asks", F.lit(True)))
        return both.groupBy("block", "query_block").applyInPandas(run, "at long, query_id long, vec_id long, score long")

    best = W.partitionBy("at").orderBy(F.desc("score"), "vec_id")
    part = answered(own.filter("block = 0"), ask.select("*", F.lit(0).cast("long").alias("block"), F.lit(None).cast("long").alias("floor")))
    if blocks > 1:
        part = written(part, "topk_first")
        kth = part.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select("at", F.col("score").alias("floor"))
        part = part.unionByName(answered(own.filter("block > 0"), ask.join(kth, "at", "left").select("*", every(1, blocks).alias("block"))))
    ranked = part.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
