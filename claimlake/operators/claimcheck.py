"""Claim-check: move a text column into an object store table, and resolve pointers back.

Offload is set-based: the payload is an ordinary projection written as a table, and the
pointer is a pure ``concat`` expression; nothing is written from inside a UDF, so retries,
speculation and re-planning cannot repeat a side effect.

Resolve is a left join of the pointers with the store plus a status ``CASE``. A row problem
never fails the query: each row gets a ``status``, the text (``full_text``) when ``ok``, a
readable ``message`` otherwise, and the object size ``n_bytes`` when the object exists.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.functions import text as T
from claimlake.plans.tables import TARGET_FILE_BYTES, TableWriter, bucket_count
from claimlake.session import default_parallelism, shared_root, sql_conf

STORE_COLUMNS = ("bucket", "key", "content", "n_bytes")

# The inline guardrails, for callers that ask for them (nothing is limited by default),
# and the status codes.
MAX_ROWS = 100
MAX_BYTES = 60000
OK = "ok"
TOO_MANY = "too_many"
MISSING_POINTER = "missing_pointer"
MALFORMED = "malformed"
NO_STORE = "no_store"
NOT_FOUND = "not_found"
TOO_LARGE = "too_large"
UNDECODABLE = "undecodable"
ACCESS_DENIED = "access_denied"
NO_CONTENT = "no_content"

# Bulk resolve: a key whose pointers exceed this many times the mean of a join partition is hot.
HOT_TIMES = 4
HOT_BROADCAST_BYTES = 64 * 1024 * 1024


# ---------------------------------------------------------------------------------------------
# offload
# ---------------------------------------------------------------------------------------------


def payload(
    df: DataFrame,
    *,
    bucket: str,
    prefix: str = T.DEFAULT_PREFIX,
    id_col: str = "id",
    text_col: str = "terms",
    keep: tuple[str, ...] = (),
    size_col: str | None = None,
) -> DataFrame:
    """Store rows ``(bucket, key, content, n_bytes)`` for every row with both id and text.

    ``size_col`` names a precomputed UTF-8 byte length of the text (NULL when the text is);
    with it, jobs that only need keys and sizes never read the text column.
    """
    size = T.byte_length(text_col) if size_col is None else F.col(size_col).cast("bigint")
    present = F.col(text_col) if size_col is None else F.col(size_col)
    return df.filter(F.col(id_col).isNotNull() & present.isNotNull()).select(
        F.lit(bucket).alias("bucket"),
        T.object_key(id_col, prefix).alias("key"),
        F.encode(F.col(text_col), "UTF-8").alias("content"),
        size.alias("n_bytes"),
        *keep,
    )


IDENTITY = ["bucket", "key"]
# Per-row overhead added to the measured width of a de-dup winner row (identity + order values).
WINNER_ROW_OVERHEAD = 64


def keep_latest(
    rows: DataFrame,
    order: list[str],
    identity: list[str] | None = None,
    winner_bytes: int | None = None,
    broadcast_bytes: int = HOT_BROADCAST_BYTES,
) -> DataFrame:
    """One row per object (``identity``: bucket and key): the one with the greatest ``order`` tuple
    ("the last write wins"; NULL is the smallest value, and among equal tuples the content of
    greatest hash wins).

    The winners of repeated objects come from a partial (map-side) aggregate over narrow columns.
    Each row is joined with them and kept if it is the winner, whichever way Spark joins: by
    broadcast when ``winner_bytes`` is known and within ``broadcast_bytes``, else by a shuffle
    whose skewed partitions AQE splits. Copies that agree in every respect are then reduced to one.
    """
    identity = identity or IDENTITY
    tie = F.xxhash64("content") if "content" in rows.columns else F.lit(0)
    mine = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], tie.alias("tie"))
    marked = rows.withColumn("__mine", mine)
    winners = marked.groupBy(*identity).agg(F.max("__mine").alias("__best"), F.count(F.lit(1)).alias("__n"))
    winners = winners.filter(F.col("__n") > 1).select(*identity, "__best")
    if winner_bytes is not None and winner_bytes <= broadcast_bytes:
        winners = F.broadcast(winners)
    joined = marked.join(winners, identity, "left")
    kept = joined.filter(F.col("__best").isNull() | F.col("__mine").eqNullSafe(F.col("__best")))
    single = kept.filter(F.col("__best").isNull()).select(*rows.columns)
    equal = kept.filter(F.col("__best").isNotNull()).select(*rows.columns).dropDuplicates(identity)
    return single.unionByName(equal)


def unique_objects(rows: DataFrame, order: list[str] | None, size_col: str = "n_bytes") -> tuple[DataFrame, dict]:
    """``rows`` made unique on bucket and key (greatest ``order`` wins) plus stats (keys, bytes, copies).

    One small aggregate over the identity and the size column tells whether any object repeats and
    how many do; the de-dup (:func:`keep_latest`) only runs when one does.
    """
    width = F.octet_length("key") + F.octet_length("bucket")
    for c in order or []:
        width = width + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    stats = (
        rows.groupBy(*IDENTITY)
        .agg(F.count(F.lit(1)).alias("c"), F.max(size_col).alias("b"), F.max(width).alias("w"))
        .agg(
            F.max("c").alias("max_copies"),
            F.sum("b").alias("bytes"),
            F.count(F.lit(1)).alias("keys"),
            F.count(F.when(F.col("c") > 1, 1)).alias("repeated_keys"),
            F.max(F.when(F.col("c") > 1, F.col("w"))).alias("row_bytes"),
        )
        .first()
    )
    info = {k: int(stats[k] or 0) for k in ("keys", "bytes", "max_copies", "repeated_keys", "row_bytes")}
    if info["max_copies"] > 1:
        if not order:
            raise ValueError("store rows repeat an object; pass `order` to choose the copy to keep")
        winner_bytes = info["repeated_keys"] * (info["row_bytes"] + WINNER_ROW_OVERHEAD)
        rows = keep_latest(rows, order, winner_bytes=winner_bytes)
    return rows, info


def write_store(
    rows: DataFrame,
    table: str,
    *,
    order: list[str] | None = None,
    size_col: str = "n_bytes",
    target_file_bytes: int = TARGET_FILE_BYTES,
    num_buckets: int | None = None,
    writer: TableWriter | None = None,
) -> dict:
    """Write store rows as a table bucketed and sorted by ``key``; one row per bucket and key.

    One small aggregate (over the identity and the size column) tells whether any object repeats
    and how many bytes the store holds; the number of hash buckets follows from the bytes. Sizes
    are measured again from the content as it is written, so a caller's ``n_bytes`` is never trusted.
    """
    rows, info = unique_objects(rows, order, size_col)
    writer = writer or TableWriter(target_file_bytes)
    floor = min(default_parallelism(rows.sparkSession), max(info["keys"], 1))
    n = num_buckets or max(floor, bucket_count(info["bytes"], writer.target_file_bytes))
    rows = rows.withColumn("n_bytes", F.octet_length("content").cast("bigint"))
    writer.replace_bucketed(rows.select(*STORE_COLUMNS), table, "key", n)
    return dict(info, buckets=n)


def replace_with_pointer(
    df: DataFrame,
    *,
    bucket: str,
    prefix: str = T.DEFAULT_PREFIX,
    id_col: str = "id",
    text_col: str = "terms",
    present_col: str | None = None,
) -> DataFrame:
    """The text column replaced, in place, by its pointer (NULL when id or text is NULL)."""
    return df.withColumn(text_col, T.pointer(id_col, text_col, bucket, prefix, present=present_col))


def offload_text(
    df: DataFrame,
    store_table: str,
    *,
    bucket: str,
    prefix: str = T.DEFAULT_PREFIX,
    id_col: str = "id",
    text_col: str = "terms",
    order: list[str] | None = None,
    target_file_bytes: int = TARGET_FILE_BYTES,
    writer: TableWriter | None = None,
) -> DataFrame:
    """Write the texts of ``df`` to ``store_table`` and return ``df`` with pointers instead.

    ``df`` should be materialised (a table or staged files): it is read once for the store
    and once more, without the text column, by whoever consumes the result. The store is
    written before the result is returned, so no pointer can exist without its object.
    """
    rows = payload(df, bucket=bucket, prefix=prefix, id_col=id_col, text_col=text_col, keep=tuple(order or ()))
    write_store(rows, store_table, order=order, target_file_bytes=target_file_bytes, writer=writer)
    return replace_with_pointer(df, bucket=bucket, prefix=prefix, id_col=id_col, text_col=text_col)


# ---------------------------------------------------------------------------------------------
# resolve
# ---------------------------------------------------------------------------------------------


def too_many_message(max_rows: int) -> str:
    return f"More than {max_rows} rows asked for inline text - resolve at most {max_rows} rows, or use the bulk path."


# The messages shown in place of a text (our own wording).
MSG_MISSING = "No pointer in this row - there is no text to fetch."
MSG_NOT_FOUND = "The store holds nothing under this key."
MSG_UNDECODABLE = "The stored object is not UTF-8 text."
MSG_MALFORMED = ("Pointer '", "' is not of the form s3://bucket/key.")
MSG_NO_STORE = ("Bucket '", "' is not a known text store.")
MSG_TOO_LARGE = ("Text too large to return inline (", " bytes, limit {limit} bytes).")
MSG_ACCESS_DENIED = "The store refused to hand out this object."
MSG_NO_CONTENT = "The stored row has no content."
MSG_ERROR = ("Could not read the stored object (", ").")


def _messages(u: Column, b: Column, n: Column, max_bytes: int | None) -> dict[str, Column]:
    limit = f"{max_bytes:,}" if max_bytes is not None else ""
    return {
        MISSING_POINTER: F.lit(MSG_MISSING),
        MALFORMED: F.concat(F.lit(MSG_MALFORMED[0]), u, F.lit(MSG_MALFORMED[1])),
        NO_STORE: F.concat(F.lit(MSG_NO_STORE[0]), b, F.lit(MSG_NO_STORE[1])),
        NOT_FOUND: F.lit(MSG_NOT_FOUND),
        TOO_LARGE: F.concat(
            F.lit(MSG_TOO_LARGE[0]), T.with_thousands(n), F.lit(MSG_TOO_LARGE[1].format(limit=limit))
        ),
        UNDECODABLE: F.lit(MSG_UNDECODABLE),
        NO_CONTENT: F.lit(MSG_NO_CONTENT),
    }


def resolve_text(
    df: DataFrame,
    pointer_col: str,
    store: DataFrame,
    *,
    bucket: str | Collection[str],
    max_rows: int | None = None,
    max_bytes: int | None = None,
    text_col: str = "full_text",
    hot_times: float | None = HOT_TIMES,
    hot_broadcast_bytes: int = HOT_BROADCAST_BYTES,
) -> DataFrame:
    """``df`` plus ``status``, ``text_col``, ``message`` and ``n_bytes`` for each pointer.

    ``bucket`` names the bucket, or buckets, that the store holds; a pointer to any other one is
    ``no_store``. By default nothing is limited: a left join on bucket and key; with the store
    bucketed on ``key`` only the pointer side is shuffled. Keys with over ``hot_times`` the
    pointers of a mean join partition are split off and joined with a broadcast of just their
    objects, or, if those exceed ``hot_broadcast_bytes``, in parts, as many for each key as it has
    times the pointers of a mean partition, so no task receives all rows of a hot key.

    * ``max_rows`` (guardrail for inline use): the input is counted up to ``max_rows + 1``; over
      the cap every row gets ``too_many`` and nothing is read. Under it the keys go into the
      store scan as an ``IN`` filter (hash-bucket pruning, then row-group filtering).
    * ``max_bytes``: objects over it report ``too_large`` with their size; their bytes are
      never returned.
    """
    known = sorted({bucket} if isinstance(bucket, str) else bucket)
    _no_clash(df, text_col)
    u = F.col(pointer_col)
    parsed = df.withColumns({"__b": T.pointer_bucket(u), "__k": T.pointer_key(u)})
    parsed = parsed.withColumn("__jk", F.when(F.col("__b").isin(known) & (F.col("__k") != ""), F.col("__k")))
    size = F.coalesce(F.octet_length("content").cast("bigint"), F.col("n_bytes"))  # as stored, not as declared
    body = F.col("content") if max_bytes is None else F.when(F.octet_length("content") <= max_bytes, F.col("content"))
    held = F.col("bucket") if "bucket" in store.columns else F.lit(known[0])
    objects = store.select(F.col("key").alias("__sk"), held.alias("__sb"), size.alias("__sn"), body.alias("__sc"))
    # The bucket is compared beside the join key (not as one), so that a store hashed by key alone
    # is still read in place.
    same_bucket = F.least("__b", "__sb") == F.greatest("__b", "__sb")
    on = (F.col("__jk") == F.col("__sk")) & same_bucket
    if max_rows is not None:
        # One bounded job answers both questions: more than max_rows rows? which keys?
        sample = [r[0] for r in parsed.select("__jk").limit(max_rows + 1).collect()]
        if len(sample) > max_rows:
            return _too_many(df, max_rows, text_col)
        keys = sorted({k for k in sample if k is not None})
        hits = objects.filter(F.col("__sk").isin(keys))
        if _bounded(store, keys, max_bytes, hot_broadcast_bytes):
            hits = F.broadcast(_fetch_hits(hits))
        joined = parsed.join(hits, on, "left")
    else:
        # Rows without a lookup key (missing, malformed, other bucket) skip the join: kept in
        # an outer join they would all hash to one partition.
        keyless = parsed.filter(F.col("__jk").isNull()).withColumns(_no_match())
        keyed = parsed.filter(F.col("__jk").isNotNull())
        n_parts = _partitions(store)
        counts, total = hot_key_counts(keyed, "__jk", min(0.5, hot_times / n_parts)) if hot_times else ({}, 0)
        hot = sorted(counts)
        is_hot = F.col("__jk").isin(hot)
        joined = (keyed.filter(~is_hot) if hot else keyed).join(objects, on, "left").unionByName(keyless)
        if hot:
            wanted = objects.filter(F.col("__sk").isin(hot))
            if _bounded(store, hot, max_bytes, hot_broadcast_bytes):
                hot_rows = keyed.filter(is_hot).join(F.broadcast(wanted), on, "left")
            else:  # the rows of a key in parts, each with its copy of the object
                shares = [(k, max(1, math.ceil(n * n_parts / total))) for k, n in counts.items()]
                cut = F.broadcast(df.sparkSession.createDataFrame(shares, "__hk string, __parts long"))
                rows = keyed.filter(is_hot).join(cut, F.col("__jk") == F.col("__hk"))
                parts = rows.withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.col("__parts"))).drop("__hk", "__parts")
                each = wanted.join(cut, F.col("__sk") == F.col("__hk"))
                copies = each.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1))).drop("__hk", "__parts")
                hot_rows = parts.join(copies, on & (F.col("__part") == F.col("__copy")), "left").drop("__part", "__copy")
            joined = hot_rows.unionByName(joined)

    return _finish(joined, u, known, max_bytes, text_col)


def _no_clash(df: DataFrame, text_col: str) -> None:
    """Columns that a resolve adds must not hide the caller's own."""
    clash = [c for c in ("status", text_col, "message", "n_bytes") if c in df.columns]
    if clash:
        raise ValueError(f"the input already has column(s) {', '.join(clash)}; rename them first")


def _partitions(store: DataFrame) -> int:
    """Partitions that a join with ``store`` is spread over, at least."""
    spark = store.sparkSession
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")), default_parallelism(spark))


def _no_match() -> dict[str, Column]:
    """Store-side columns of a row that has no lookup key."""
    return {
        "__sk": F.lit(None).cast("string"),
        "__sb": F.lit(None).cast("string"),
        "__sn": F.lit(None).cast("bigint"),
        "__sc": F.lit(None).cast("binary"),
    }


def _finish(
    joined: DataFrame, u: Column, known: list[str] | None, max_bytes: int | None, text_col: str, with_errors: bool = False
) -> DataFrame:
    """Status, text, message and size from the joined ``__b/__sk/__sn/__sc`` (+ ``__err``)."""
    b, n, c = F.col("__b"), F.col("__sn"), F.col("__sc")
    status = F.when(u.isNull() | (u == ""), F.lit(MISSING_POINTER)).when(b == "", F.lit(MALFORMED))
    if known is not None:
        status = status.when(~b.isin(known), F.lit(NO_STORE))
    if with_errors:
        err = F.col("__err")
        status = status.when(err.isNotNull() & (err != NOT_FOUND), err).when(err == NOT_FOUND, F.lit(NOT_FOUND))
    status = status.when(F.col("__sk").isNull(), F.lit(NOT_FOUND))
    if max_bytes is not None:
        status = status.when(n > max_bytes, F.lit(TOO_LARGE))
    status = status.when(c.isNull(), F.lit(NO_CONTENT)).when(~T.is_utf8(c), F.lit(UNDECODABLE)).otherwise(F.lit(OK))

    msgs = _messages(u, b, n, max_bytes)
    s = F.col("status")
    message = F.when(s == MISSING_POINTER, msgs[MISSING_POINTER])
    for code in (MALFORMED, NO_STORE, NOT_FOUND, TOO_LARGE, UNDECODABLE, NO_CONTENT):
        message = message.when(s == code, msgs[code])
    if with_errors:
        message = message.when(s == ACCESS_DENIED, F.lit(MSG_ACCESS_DENIED)).when(
            s.startswith("error:"), F.concat(F.lit(MSG_ERROR[0]), F.regexp_replace(s, "^error:", ""), F.lit(MSG_ERROR[1]))
        )

    return (
        joined.withColumn("status", status)
        .withColumns(
            {
                text_col: F.when(s == OK, T.utf8_text(c)),
                "message": message,
                "n_bytes": n,
            }
        )
        .drop("__b", "__k", "__jk", "__sk", "__sb", "__sn", "__sc", "__err")
    )


def _too_many(df: DataFrame, max_rows: int, text_col: str) -> DataFrame:
    return df.withColumns(
        {
            "status": F.lit(TOO_MANY),
            text_col: F.lit(None).cast("string"),
            "message": F.lit(too_many_message(max_rows)),
            "n_bytes": F.lit(None).cast("bigint"),
        }
    )


def resolve_files(
    df: DataFrame,
    pointer_col: str,
    root: str,
    *,
    max_rows: int | None = None,
    max_bytes: int | None = None,
    text_col: str = "full_text",
    wrap: Callable | None = None,
) -> DataFrame:
    """:func:`resolve_text` against object files under ``root`` (``root/<bucket>/<key>``).

    Any bucket folder under ``root`` is a store; a missing folder gives ``no_store``. Read
    problems become ``access_denied`` or ``error:<code>`` for that row (``wrap``: see
    :func:`claimlake.sources.objects.fetch_objects`). Each distinct pointer
    is fetched once (partial aggregation collapses repeats before the fetch stage); the
    results join back on ``(bucket, key)`` - broadcast under the row cap when
    ``max_rows * max_bytes`` is within the broadcast limit, a shuffle join otherwise.
    """
    from claimlake.sources.objects import fetch_objects

    _no_clash(df, text_col)
    u = F.col(pointer_col)
    parsed = df.withColumns({"__b": T.pointer_bucket(u), "__k": T.pointer_key(u)})
    has_key = F.coalesce(F.col("__b") != "", F.lit(False))
    keyed = parsed.filter(has_key)
    if max_rows is not None:
        # One bounded job: the row cap, and (under it) the at most max_rows keys to fetch.
        sample = parsed.select("__b", "__k").limit(max_rows + 1).collect()
        if len(sample) > max_rows:
            return _too_many(df, max_rows, text_col)
        wanted = sorted({(r[0], r[1]) for r in sample if r[0]})
        keys = df.sparkSession.createDataFrame(wanted, "__b string, __k string")
    else:
        keys = keyed.select("__b", "__k").distinct()
    fetched = fetch_objects(keys, root, max_bytes, wrap).withColumn(
        "__sk", F.when(F.col("__err").isNull(), F.col("__k"))
    ).withColumnsRenamed({"__b": "__fb", "__k": "__fk"})
    if max_rows is not None and max_bytes is not None and max_rows * max_bytes <= HOT_BROADCAST_BYTES:
        fetched = F.broadcast(fetched)  # at most max_rows objects of at most max_bytes each
    on = (F.col("__b") == F.col("__fb")) & (F.col("__k") == F.col("__fk"))
    # Pointers that cannot name an object skip the join (they would share one partition).
    keyless = parsed.filter(~has_key).withColumns(dict(_no_match(), __err=F.lit(None).cast("string")))
    joined = keyed.join(fetched, on, "left").drop("__fb", "__fk").unionByName(keyless.drop("__sb"))
    return _finish(joined, u, None, max_bytes, text_col, with_errors=True)


def hot_key_counts(df: DataFrame, key: str, fraction: float) -> tuple[dict[str, int], int]:
    """Rows of each key that holds at least ``fraction`` of the non-NULL ``key`` rows (at most
    1/fraction keys), and how many such rows there are in all.

    Two map-side passes, no shuffle of keys: ``freqItems`` proposes at most 1/fraction candidates
    (it never misses a key above the support, but may propose a few that are not); then the rows
    are joined with a broadcast of the candidates and counted by candidate, all others together.
    """
    keyed = df.filter(F.col(key).isNotNull()).select(key)
    candidates = [(c,) for c in (keyed.freqItems([key], support=fraction).first()[0] or []) if c is not None]
    if not candidates:
        return {}, 0
    proposed = df.sparkSession.createDataFrame(candidates, "__candidate string")
    counted = keyed.join(F.broadcast(proposed), F.col(key) == F.col("__candidate"), "left").groupBy("__candidate").agg(F.count(F.lit(1)).alias("n"))
    rows = {r["__candidate"]: r["n"] for r in counted.collect()}  # at most one for each candidate, and the rest
    total = sum(rows.values())
    threshold = max(2, math.ceil(total * fraction))
    return {k: n for k, n in rows.items() if k is not None and n >= threshold}, total


def hot_keys(df: DataFrame, key: str, fraction: float) -> list[str]:
    """The keys of :func:`hot_key_counts`."""
    return sorted(hot_key_counts(df, key, fraction)[0])


def _fetch_hits(hits: DataFrame) -> DataFrame:
    """Read the (at most ``max_rows``) wanted objects now, with the bucketed scan kept on so the
    ``key IN`` list prunes the store to the buckets that hold those keys (Spark would otherwise
    drop the bucketed scan for a broadcast join and open every bucket file). The few rows are
    kept with a reliable ``checkpoint`` in the shared checkpoint folder."""
    spark = hits.sparkSession
    shared_root(spark)  # makes sure a checkpoint folder is set (local mode only)
    with sql_conf(spark, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
        return hits.checkpoint(eager=True)


def _bounded(store: DataFrame, keys: list, max_bytes: int | None, limit: int) -> bool:
    """Whether the objects of ``keys`` may be broadcast: proven by ``len(keys) * max_bytes``
    (bodies over ``max_bytes`` are never selected), else checked by summing their sizes with a
    scan that reads only ``key`` and ``n_bytes`` and pushes the key list into the store."""
    if max_bytes is not None and len(keys) * max_bytes <= limit:
        return True
    total = store.filter(F.col("key").isin(keys)).agg(F.sum("n_bytes")).first()[0]
    return (total or 0) <= limit


def parse_pointers(df: DataFrame, pointer_col: str) -> DataFrame:
    """``df`` plus ``bucket`` and ``key`` of each pointer ('' when it does not match)."""
    u = F.col(pointer_col)
    return df.withColumns({"bucket": T.pointer_bucket(u), "key": T.pointer_key(u)})
