"""Facts about groups of rows, joined back to the rows without sending a hot group to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.session import fresh_dir

BROADCAST_BYTES = 64 * 1024 * 1024
#: A key with more than one in so many of the counted rows is hot: there are fewer such keys than that.
HOT_SHARE = 10_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder: computed once, and read again when an executor is lost."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_facts(df: DataFrame, facts: DataFrame, key: str, n_rows: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` left-joined with ``facts``, one row per value of ``key``; ``n_rows`` is the column of
    ``facts`` with how many rows of ``df`` have it. NULL keys match nothing.

    Facts of measured size within ``broadcast_bytes`` are broadcast. Beyond that only the hot keys'
    facts are (fewer than ``HOT_SHARE``), and the rows of all others are shuffled.
    """
    width = F.octet_length(F.col(key).cast("string")) + 64
    stats = facts.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes"), F.coalesce(F.sum(n_rows), F.lit(0)).alias("total")).first()
    if stats["bytes"] <= broadcast_bytes:
        return df.join(F.broadcast(facts), key, "left")
    hot = facts.filter(F.col(n_rows) > stats["total"] // HOT_SHARE)
    keys = F.broadcast(hot.select(key))
    no_fact = [F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema if f.name != key]
    keyed = df.filter(F.col(key).isNotNull())
    parts = (
        keyed.join(F.broadcast(hot), key),
        keyed.join(keys, key, "left_anti").join(facts, key, "left"),
        df.filter(F.col(key).isNull()).select("*", *no_fact),
    )
    first, *rest = [p.select(*df.columns, *[f for f in facts.columns if f != key]) for p in parts]
    for more in rest:
        first = first.unionByName(more)
    return first
