"""The three layers as Spark jobs: landing CSV -> bronze (+ store) -> silver / quarantine -> gold."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.operators import claimcheck as cc
from claimlake.operators import quality as q
from claimlake.plans.tables import Lake, part_column, part_of
from claimlake.session import remove_folder, sql_conf
from claimlake.sources.landing import RAGGED, SOURCE_FILE, read_landing_csv
from claimlake.sources.rules import load_rules, parse_rules

INGESTED_AT = "_ingestion_timestamp"
SILVER_AT = "_silver_processed_at"
_ORD = "_row_ord"
_BYTES = "_text_bytes"


def utc_now() -> str:
    """Run time, taken once on the driver, as ISO-8601 UTC text."""
    return datetime.now(timezone.utc).isoformat()


def stage(df: DataFrame, path: str, text_col: str = "terms") -> DataFrame:
    """Write ``df`` with a stable row ordinal and the text's byte length to ``path`` (shared
    storage) and read it back.

    The landing CSV is parsed once; the store stats and bronze are then column-pruned scans of
    the staged files that never touch the text, and a lost executor re-reads Parquet instead
    of re-parsing CSV.
    """
    staged = df.withColumns({_ORD: F.monotonically_increasing_id(), _BYTES: F.octet_length(text_col).cast("bigint")})
    staged.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def bronze_frame(staged: DataFrame, lake: Lake, run_ts: str) -> DataFrame:
    """Pointer in place of the text, then the two bronze stamps at the end."""
    landing_cols = [c for c in staged.columns if c not in (SOURCE_FILE, _ORD, _BYTES)]
    present = _BYTES if _BYTES in staged.columns else None
    out = cc.replace_with_pointer(staged, bucket=lake.terms_bucket, prefix=lake.terms_prefix, present_col=present)
    return out.select(*landing_cols, F.lit(run_ts).alias(INGESTED_AT), F.col(SOURCE_FILE))


def to_bronze(
    spark: SparkSession,
    landing: str | DataFrame,
    lake: Lake,
    *,
    run_ts: str | None = None,
) -> DataFrame:
    """Landing rows -> text store + bronze table. Returns the bronze table.

    ``landing`` is a landing root folder or an already scanned landing DataFrame (with
    ``_source_file``). The store is written first, so every pointer in bronze has its object.
    Duplicate ids keep the copy from the greatest source path, last row in that file.

    Files are read by their own headers. Lines with more or fewer fields than their header go to
    the landing quarantine, whole, and the other rows of their file go on. A run that dies midway
    is simply run again; no staged text outlives a finished one.
    """
    lake.create(spark)
    run_ts = run_ts or utc_now()
    raw = read_landing_csv(spark, landing, keep_ragged=True, by_name=True) if isinstance(landing, str) else landing
    # One staging folder per lake: a run that died left at most one staged copy, which this one
    # replaces and, once all tables are committed, removes.
    staging = f"{lake.root}/_staging/landing"
    staged = stage(raw, staging)
    whole = staged
    if RAGGED in staged.columns:
        whole = staged.filter(F.col(RAGGED).isNull()).drop(RAGGED)
        lake.writer.replace(ragged_frame(staged, run_ts), lake.landing_quarantine_name)
    rows = cc.payload(
        whole, bucket=lake.terms_bucket, prefix=lake.terms_prefix, keep=(SOURCE_FILE, _ORD), size_col=_BYTES
    )
    cc.write_store(rows, lake.store_name, order=[SOURCE_FILE, _ORD], writer=lake.writer)
    lake.writer.replace(bronze_frame(whole, lake, run_ts), lake.bronze_name)
    remove_folder(spark, staging)
    return spark.table(lake.bronze_name)


RAW_LINE = "_raw_line"
REASON_RAGGED = "ragged_row"


def ragged_frame(staged: DataFrame, run_ts: str) -> DataFrame:
    """Quarantine rows for the landed lines that have more or fewer fields than their header."""
    return staged.filter(F.col(RAGGED).isNotNull()).select(
        F.col(RAGGED).alias(RAW_LINE), F.lit(REASON_RAGGED).alias(q.FAILED), F.lit(run_ts).alias(INGESTED_AT), SOURCE_FILE
    )


def all_quarantined(spark: SparkSession, lake: Lake) -> DataFrame:
    """Everything set aside: rows that failed their checks, and landed lines that are no rows (their
    columns NULL, the line in ``_raw_line``), with the reason in ``_dq_failed_checks``."""
    return spark.table(lake.quarantine_name).unionByName(spark.table(lake.landing_quarantine_name), allowMissingColumns=True)


LAYER = "_dq_layer"


def layered_frame(bronze: DataFrame, rules: Mapping | str | None, run_ts: str) -> tuple[DataFrame, list]:
    """(bronze rows with their checks, stamp and layer, checks); nothing is written."""
    checks = q.compile_rules(parse_rules(rules))
    annotated = q.annotate(bronze, checks).withColumn(SILVER_AT, F.lit(run_ts))
    return annotated.withColumn(LAYER, F.when(F.col(q.PASSED), F.lit("silver")).otherwise(F.lit("quarantine"))), checks


def silver_frames(bronze: DataFrame, rules: Mapping | str | None, run_ts: str) -> tuple[DataFrame, DataFrame, list]:
    """(clean, quarantined, checks) for a bronze frame; nothing is written."""
    annotated, checks = layered_frame(bronze, rules, run_ts)
    clean, failed = q.split(annotated.drop(LAYER), checks)
    return clean, failed, checks


def to_silver(
    spark: SparkSession,
    lake: Lake,
    *,
    rules: Mapping | str | None = None,
    rules_path: str | None = None,
    run_ts: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Bronze -> silver (clean rows) and quarantine (failed rows with every check column).

    Rules come from ``rules`` (dict or JSON text), else from the document at ``rules_path``,
    else the default (id and terms not NULL). One pass over bronze checks every row once and
    writes both tables (:func:`claimlake.plans.tables.replace_layers`).
    """
    lake.create(spark)
    if rules is None and rules_path is not None:
        rules = load_rules(spark, rules_path)
    layered, checks = layered_frame(spark.table(lake.bronze_name), rules, run_ts or utc_now())
    failed = [c for c in layered.columns if c != LAYER]
    clean = [c for c in failed if c not in (q.PASSED, q.FAILED, *q.check_columns(checks))]
    tables = {"silver": (lake.silver_name, clean), "quarantine": (lake.quarantine_name, failed)}
    lake.writer.replace_layers(layered, LAYER, tables, lake.layer_path(lake.silver))
    return spark.table(lake.silver_name), spark.table(lake.quarantine_name)


def to_gold(spark: SparkSession, lake: Lake) -> DataFrame:
    """Full-refresh copy of silver into the gold database, never missing for a reader."""
    lake.create(spark)
    return lake.writer.publish(spark, lake.silver_name, lake.gold_name)


def run_batch(
    spark: SparkSession,
    landing: str | DataFrame,
    lake: Lake,
    *,
    rules: Mapping | str | None = None,
    rules_path: str | None = None,
    run_ts: str | None = None,
) -> DataFrame:
    """Landing -> bronze -> silver/quarantine -> gold, each step only after the one before."""
    to_bronze(spark, landing, lake, run_ts=run_ts)
    to_silver(spark, lake, rules=rules, rules_path=rules_path, run_ts=run_ts)
    return to_gold(spark, lake)


def resolve_gold(
    spark: SparkSession,
    lake: Lake,
    *,
    ids: list[str] | None = None,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """``SELECT id, terms, <text> AS full_text FROM gold [WHERE id IN ids]`` with statuses."""
    gold = spark.table(lake.gold_name)
    if ids is not None:
        gold = gold.filter(F.col("id").isin(ids))
    return cc.resolve_text(
        gold.select("id", "terms"),
        "terms",
        spark.table(lake.store_name),
        bucket=lake.terms_bucket,
        max_rows=max_rows,
        max_bytes=max_bytes,
    )


def sorted_store_scans(spark: SparkSession):
    """Context in which a join on the store's ``key`` uses the sort order of its bucket files
    (one sorted file per bucket), so the store side of a bulk resolve is not sorted again.
    Spark checks the one-file-per-bucket condition itself and sorts when it does not hold."""
    return sql_conf(spark, spark__sql__legacy__bucketedTableScan__outputOrdering="true")


def resolve_gold_to_table(
    spark: SparkSession,
    lake: Lake,
    table: str,
    *,
    ids: list[str] | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Bulk resolve of gold written to ``table`` (in the lake database): the bulk export.

    The join's partitions follow the store's buckets (sized from the 128 MB target), so they
    are written as they are: no REBALANCE, which would shuffle every text a second time.
    """
    name = lake.name(table)
    with sorted_store_scans(spark):
        resolved = resolve_gold(spark, lake, ids=ids, max_rows=None, max_bytes=max_bytes)
        lake.writer.replace(resolved, name, rebalance=False)
    return spark.table(name)


LAYERS = ("bronze", "silver", "quarantine", "gold")


def layer_table(lake: Lake, layer: str) -> str:
    names = {
        "bronze": lake.bronze_name,
        "silver": lake.silver_name,
        "quarantine": lake.quarantine_name,
        "gold": lake.gold_name,
    }
    return names[layer]


def preview(spark: SparkSession, lake: Lake, layer: str, n: int = 10, order_by: str | None = "id") -> DataFrame:
    """``SELECT * FROM <layer> [ORDER BY id] LIMIT n``; ordering makes the sample repeatable."""
    df = spark.table(layer_table(lake, layer))
    return (df.orderBy(order_by) if order_by else df).limit(n)


def register_resolved_view(
    spark: SparkSession, lake: Lake, view: str = "gold_with_text", *, max_bytes: int | None = None
) -> str:
    """Temp view ``id, terms, status, full_text, message, n_bytes`` over gold for SQL users.

    ``SELECT ... FROM gold_with_text WHERE id IN (...)`` pushes the filter below the join to the
    gold scan. The view is the bulk form (no row cap: a view cannot count the rows of the
    query that will use it); use :func:`resolve_gold` for the capped inline form.
    """
    resolve_gold(spark, lake, max_rows=None, max_bytes=max_bytes).createOrReplaceTempView(view)
    return view


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_text_function(
    spark: SparkSession, lake: Lake, name: str = "get_text_from_s3", *, max_bytes: int | None = None
) -> str:
    """SQL function ``<name>(s3_uri STRING) RETURNS STRING``: the text behind a pointer, or a
    message saying why not (same wording and order of checks as :func:`resolve_text`).

    ``SELECT id, terms, get_text_from_s3(terms) AS full_text FROM gold WHERE id IN (...)``:
    The correlated lookup becomes a left outer join with the store on its key. The key is unique in
    a bucket, so the aggregate that makes the lookup scalar passes one text at a time through, in
    the order of the store's buckets; only the pointers are shuffled. The store's partition column
    is compared too, so that Spark prunes the store, at run time, to the partitions of the pointers
    that the query's own filters leave. ``max_bytes`` is no limit unless given.

    A temporary function of the session. Two settings of the session go with it: the pruning may
    run the pointers' side by itself, and a join may keep the store's partitioning by key alone.
    If the store is written anew with another number of partitions, the function fails by naming
    the old partition column; register it again.
    """
    from claimlake.functions.text import POINTER_WHITESPACE, SPARK_POINTER_PATTERN

    trimmed = f"btrim(s3_uri, {_sql_str(POINTER_WHITESPACE)})"
    part = lambda i: f"regexp_extract({trimmed}, {_sql_str(SPARK_POINTER_PATTERN)}, {i})"
    large = ""
    if max_bytes is not None:
        told = f"concat({_sql_str(cc.MSG_TOO_LARGE[0])}, format_number(n_bytes, 0), {_sql_str(cc.MSG_TOO_LARGE[1].format(limit=f'{max_bytes:,}'))})"
        large = f"WHEN n_bytes > {int(max_bytes)} THEN {told}"
    part_condition = ""
    if lake.catalog is None:
        column = next((c for c in spark.table(lake.store_name).columns if c.startswith(part_column(0)[:-1])), None)
        if column:
            part_condition = f"AND {column} = {part_of(part(2), int(column.rpartition('_')[2]))}"
            spark.conf.set("spark.sql.optimizer.dynamicPartitionPruning.reuseBroadcastOnly", "false")
            spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    body = f"""
      CASE WHEN s3_uri IS NULL OR s3_uri = '' THEN {_sql_str(cc.MSG_MISSING)}
           WHEN {part(1)} = '' THEN concat({_sql_str(cc.MSG_MALFORMED[0])}, s3_uri, {_sql_str(cc.MSG_MALFORMED[1])})
           WHEN {part(1)} <> {_sql_str(lake.terms_bucket)}
             THEN concat({_sql_str(cc.MSG_NO_STORE[0])}, {part(1)}, {_sql_str(cc.MSG_NO_STORE[1])})
           ELSE coalesce(
             (SELECT max(CASE {large} WHEN content IS NULL THEN {_sql_str(cc.MSG_NO_CONTENT)}
                          WHEN NOT is_valid_utf8(CAST(content AS STRING)) THEN {_sql_str(cc.MSG_UNDECODABLE)}
                          ELSE CAST(content AS STRING) END)
              FROM {lake.store_name} WHERE bucket = {_sql_str(lake.terms_bucket)} AND key = {part(2)} {part_condition}),
             {_sql_str(cc.MSG_NOT_FOUND)})
      END"""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s3_uri STRING) RETURNS STRING RETURN {body}")
    return name
