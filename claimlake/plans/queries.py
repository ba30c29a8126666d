"""Registered queries: one per inventory key, each with its DuckDB oracle SQL.

Every query reads the driver's ``documents`` table of ``sf_dir`` (through a FIXTURES
projection), runs the real jobs into a fresh lake under the session's shared folder, and
returns a DataFrame. Fixed run time, stable ``_source_file`` (folder relative to the landing
root) and explicit casts/aliases make the result comparable with the oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.functions import text as T
from claimlake.functions.predicates import not_blank, not_null
from claimlake.operators import claimcheck as cc
from claimlake.operators import quality as q
from claimlake.plans import fixtures as fx
from claimlake.plans import medallion as m
from claimlake.plans.tables import TERMS_BUCKET, Lake
from claimlake.sources import objects as obj
from claimlake.sources.landing import SOURCE_FILE, read_landing_csv
from claimlake.sources.rules import write_rules
from claimlake.streaming import arrivals

Query = Callable[[SparkSession, str], DataFrame]

MEASURES = ["character_length", "utf8_byte_length", "exceeds_redshift_varchar_65535_bytes"]
# The documented inline lookup filters gold to a literal id list; here the filter is the
# feature under test (every other query runs over whole tables).
FEW_IDS = ["1", "2", "3"]


def utf8_max_bytes(column: str, options) -> Column:
    """Sample user-defined check: the value's UTF-8 size is within ``limit``, and its row's column
    ``present`` isn't NULL. NULL, which counts as a failure, for a NULL value."""
    return (F.octet_length(F.col(column)) <= F.lit(int(options["limit"]))) & F.col(options["present"]).isNotNull()


RULES_CUSTOM = {"checks": [{"type": "utf8_max_bytes", "column": "terms", "limit": fx.STORE_MAX_BYTES, "present": "id"}]}


# ---------------------------------------------------------------------------------------------
# building blocks
# ---------------------------------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.landing_rows(fx.documents(spark, sf_dir))


def _landing(spark: SparkSession, sf_dir: str, tag: str) -> tuple[Lake, str]:
    lake = Lake.fresh(spark, tag).create(spark)
    root = f"{lake.root}/landing"
    fx.write_landing_area(spark, fx.documents(spark, sf_dir), root)
    return lake, root


def _bronze(spark: SparkSession, sf_dir: str, tag: str) -> Lake:
    lake, root = _landing(spark, sf_dir, tag)
    m.to_bronze(spark, root, lake, run_ts=fx.RUN_TS)
    return lake


def _silver(spark: SparkSession, sf_dir: str, tag: str, rules=fx.RULES_DEFAULT) -> Lake:
    lake = _bronze(spark, sf_dir, tag)
    m.to_silver(spark, lake, rules=rules, run_ts=fx.RUN_TS)
    return lake


def _gold(spark: SparkSession, sf_dir: str, tag: str) -> Lake:
    lake = _silver(spark, sf_dir, tag)
    m.to_gold(spark, lake)
    return lake


def _stable(df: DataFrame) -> DataFrame:
    """``_source_file`` reduced to the folder under the landing root."""
    return df.withColumn(SOURCE_FILE, fx.relative_dir(F.col(SOURCE_FILE))) if SOURCE_FILE in df.columns else df


def _store_fixture(spark: SparkSession, sf_dir: str, tag: str) -> tuple[Lake, DataFrame]:
    lake = Lake.fresh(spark, tag).create(spark)
    cc.write_store(fx.store_rows(fx.documents(spark, sf_dir)), lake.store_name)
    return lake, spark.table(lake.store_name)


def _resolve_fixture(spark: SparkSession, sf_dir: str, tag: str, **kw) -> DataFrame:
    lake, store = _store_fixture(spark, sf_dir, tag)
    ptrs = fx.pointer_rows(fx.documents(spark, sf_dir))
    return cc.resolve_text(ptrs, "u", store, bucket=TERMS_BUCKET, **kw)


def _store_text(store: DataFrame) -> DataFrame:
    return store.select("bucket", "key", T.utf8_text("content").alias("text"), "n_bytes")


# ---------------------------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------------------------


def scan_landing_csv(spark, sf_dir):
    _, root = _landing(spark, sf_dir, "scan")
    return read_landing_csv(spark, root).select("id", "terms", *MEASURES)


def scan_landing_recursive(spark, sf_dir):
    _, root = _landing(spark, sf_dir, "scanrec")
    df = read_landing_csv(spark, root)
    return df.select("id", "terms", fx.relative_dir(F.col(SOURCE_FILE)).alias("_source_dir"))


def scan_landing_suffix(spark, sf_dir):
    _, root = _landing(spark, sf_dir, "scansfx")
    df = read_landing_csv(spark, root)
    return df.select("id", "terms", F.regexp_extract(SOURCE_FILE, r"\.([^./]+)$", 1).alias("_source_suffix"))


def scan_landing_headers(spark, sf_dir):
    """Files that order their columns differently, lack some or have one more, read by name."""
    lake = Lake.fresh(spark, "headers").create(spark)
    root = fx.write_landing_by_headers(fx.documents(spark, sf_dir), f"{lake.root}/landing")
    df = read_landing_csv(spark, root, glob="*.txt", by_name=True)
    return df.select("id", "terms", *MEASURES, "note")


def scan_landing_ragged(spark, sf_dir):
    """Lines with too few or too many fields go to quarantine, with the others of their file in bronze."""
    lake = Lake.fresh(spark, "ragged").create(spark)
    root = fx.write_ragged_landing(fx.documents(spark, sf_dir), f"{lake.root}/landing")
    landed = read_landing_csv(spark, root, glob="*.txt", by_name=True, keep_ragged=True)
    bronze = m.to_bronze(spark, landed, lake, run_ts=fx.RUN_TS).select("id", "terms", *MEASURES, "_ingestion_timestamp")
    return bronze.unionByName(spark.table(lake.landing_quarantine_name).drop(SOURCE_FILE), allowMissingColumns=True)


def scan_bronze_table(spark, sf_dir):
    lake = _bronze(spark, sf_dir, "scanbronze")
    return _stable(spark.table(lake.bronze_name))


def write_bronze(spark, sf_dir):
    lake = _bronze(spark, sf_dir, "wbronze")
    return _stable(spark.read.parquet(lake.table_path(lake.bronze)))


def source_to_bronze(spark, sf_dir):
    lake, root = _landing(spark, sf_dir, "s2b")
    return _stable(m.to_bronze(spark, root, lake, run_ts=fx.RUN_TS))


def offload_text(spark, sf_dir):
    lake = _bronze(spark, sf_dir, "offload")
    return _store_text(spark.table(lake.store_name))


def scan_text_objects(spark, sf_dir):
    lake = _bronze(spark, sf_dir, "objects")
    root = f"{lake.root}/objects"
    manifest = obj.write_object_files(spark.table(lake.store_name), root, lake.scratch("manifest"))
    return _store_text(obj.read_object_files(spark, root, manifest=manifest))


def replace_with_pointer(spark, sf_dir):
    return cc.replace_with_pointer(_raw(spark, sf_dir), bucket=TERMS_BUCKET).select("id", "terms")


def measure_text(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", "terms", *MEASURES)


def stamp_ingestion(spark, sf_dir):
    lake = _bronze(spark, sf_dir, "stampi")
    return spark.table(lake.bronze_name).select("id", "_ingestion_timestamp")


def stamp_source_file(spark, sf_dir):
    lake = _bronze(spark, sf_dir, "stampf")
    return _stable(spark.table(lake.bronze_name)).select("id", SOURCE_FILE)


def write_silver(spark, sf_dir):
    lake = _silver(spark, sf_dir, "wsilver")
    return _stable(spark.table(lake.silver_name))


def write_quarantine(spark, sf_dir):
    lake = _silver(spark, sf_dir, "wquar")
    return _stable(spark.table(lake.quarantine_name))


def stamp_silver(spark, sf_dir):
    lake = _silver(spark, sf_dir, "stamps")
    return spark.table(lake.silver_name).select("id", "_silver_processed_at")


def drop_check_columns(spark, sf_dir):
    lake = _silver(spark, sf_dir, "dropchk", rules=fx.RULES_THREE)
    return _stable(spark.table(lake.silver_name))


def bronze_to_silver(spark, sf_dir):
    lake = _silver(spark, sf_dir, "b2s", rules=fx.RULES_THREE)
    silver = spark.table(lake.silver_name).select(
        "id", "terms", F.lit("silver").alias("_layer"), F.lit(None).cast("string").alias("_dq_failed_checks")
    )
    quarantine = spark.table(lake.quarantine_name).select(
        "id", "terms", F.lit("quarantine").alias("_layer"), "_dq_failed_checks"
    )
    return silver.unionByName(quarantine)


def publish_gold(spark, sf_dir):
    lake = _gold(spark, sf_dir, "gold")
    return _stable(spark.table(lake.gold_name))


def medallion_end_to_end(spark, sf_dir):
    lake, root = _landing(spark, sf_dir, "e2e")
    return _stable(m.run_batch(spark, root, lake, rules=fx.RULES_DEFAULT, run_ts=fx.RUN_TS))


def filter_id_in(spark, sf_dir):
    lake = _gold(spark, sf_dir, "idin")
    return _stable(spark.table(lake.gold_name).filter(F.col("id").isin(FEW_IDS)))


def preview_limit(spark, sf_dir):
    # ``LIMIT 10`` is the feature (the layer previews); ordered so the ten rows are repeatable.
    lake = _gold(spark, sf_dir, "preview")
    return _stable(spark.table(lake.gold_name).orderBy("id").limit(10))


def split_complete(spark, sf_dir):
    lake = _silver(spark, sf_dir, "split")
    layer = lambda name, tag: spark.table(name).select(F.lit(tag).alias("_layer"))
    rows = layer(lake.bronze_name, "bronze").unionByName(layer(lake.silver_name, "silver")).unionByName(
        layer(lake.quarantine_name, "quarantine")
    )
    return rows.agg(
        *[F.count(F.when(F.col("_layer") == t, 1)).alias(f"n_{t}") for t in ("bronze", "silver", "quarantine")]
    )


def quarantine_summary(spark, sf_dir):
    lake = _silver(spark, sf_dir, "qsum", rules=fx.RULES_THREE)
    return q.quarantine_summary(spark.table(lake.quarantine_name))


def predicate_not_null(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select("id", "terms", not_null("id").alias("id_not_null"), not_null("terms").alias("terms_not_null"))


def predicate_not_blank(spark, sf_dir):
    return _raw(spark, sf_dir).select("id", "terms", not_blank("terms").alias("terms_not_blank"))


def _annotated(spark, sf_dir, rules) -> DataFrame:
    raw = _raw(spark, sf_dir).select("id", "terms")
    return q.annotate(raw, q.compile_rules(rules))


def check_not_null(spark, sf_dir):
    lake = _bronze(spark, sf_dir, "chknn")
    checks = q.compile_rules(fx.RULES_DEFAULT)
    return q.annotate(spark.table(lake.bronze_name).select("id", "terms"), checks).drop(q.PASSED, q.FAILED)


def check_not_empty(spark, sf_dir):
    checks = q.compile_rules({"checks": [{"type": "not_empty_string", "column": "terms"}]})
    return q.annotate(_raw(spark, sf_dir).select("id", "terms"), checks).drop(q.PASSED, q.FAILED)


def check_extension(spark, sf_dir):
    q.add_kind("utf8_max_bytes", "max_bytes", utf8_max_bytes)
    return _annotated(spark, sf_dir, RULES_CUSTOM)


def check_unique(spark, sf_dir):
    """A check over the whole frame; one id holds a third of the rows."""
    rows = fx.repeated_ids(fx.documents(spark, sf_dir))
    return q.annotate(rows, q.compile_rules({"checks": [{"type": "unique", "column": "id"}, {"type": "not_null", "column": "id"}]}))


def silver_rules_path(spark, sf_dir):
    """Silver and quarantine by the rule document that lies at a path."""
    lake = _bronze(spark, sf_dir, "rpath")
    path = write_rules(spark, fx.RULES_THREE, lake.scratch("rules"))
    silver, quarantine = m.to_silver(spark, lake, rules_path=path, run_ts=fx.RUN_TS)
    rows = silver.select("id", "terms", F.lit("silver").alias("_layer"), F.lit(None).cast("string").alias("_dq_failed_checks"))
    return rows.unionByName(quarantine.select("id", "terms", F.lit("quarantine").alias("_layer"), "_dq_failed_checks"))


def annotate_checks(spark, sf_dir):
    return _annotated(spark, sf_dir, fx.RULES_THREE)


def dq_passed(spark, sf_dir):
    return _annotated(spark, sf_dir, fx.RULES_THREE).select("id", "terms", q.PASSED)


def dq_failed_names(spark, sf_dir):
    return _annotated(spark, sf_dir, fx.RULES_THREE).select("id", "terms", q.FAILED)


def dq_no_checks(spark, sf_dir):
    return _annotated(spark, sf_dir, fx.RULES_EMPTY)


def filter_passed(spark, sf_dir):
    checks = q.compile_rules(fx.RULES_THREE)
    return q.passed_rows(q.annotate(_raw(spark, sf_dir).select("id", "terms"), checks), checks)


def filter_failed(spark, sf_dir):
    return q.failed_rows(_annotated(spark, sf_dir, fx.RULES_THREE)).select("id", "terms", q.FAILED)


def parse_uri(spark, sf_dir):
    return cc.parse_pointers(fx.pointer_rows(fx.documents(spark, sf_dir)), "u")


def resolve_text(spark, sf_dir):
    return _resolve_fixture(spark, sf_dir, "restext")


def resolve_status(spark, sf_dir):
    # The size guardrail is part of what this query shows.
    res = _resolve_fixture(spark, sf_dir, "resstat", max_bytes=fx.STORE_MAX_BYTES)
    return res.groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))


def resolve_row_cap(spark, sf_dir):
    # All pointers against a cap of 100 rows: the guardrail must answer too_many.
    return _resolve_fixture(spark, sf_dir, "rescap", max_rows=cc.MAX_ROWS).select("doc_id", "u", "status", "full_text", "message")


def resolve_few(spark, sf_dir):
    lake = _gold(spark, sf_dir, "resfew")
    return m.resolve_gold(spark, lake, ids=FEW_IDS, max_rows=cc.MAX_ROWS)


def resolve_bulk(spark, sf_dir):
    lake = _gold(spark, sf_dir, "resbulk")
    return m.resolve_gold(spark, lake)


def resolve_files(spark, sf_dir):
    """F3 pointers resolved against F4 written as object files (the file mode of the store)."""
    lake = Lake.fresh(spark, "resfiles").create(spark)
    root = f"{lake.root}/objects"
    obj.write_object_files(fx.store_rows(fx.documents(spark, sf_dir)), root, lake.scratch("manifest"))
    ptrs = fx.pointer_rows(fx.documents(spark, sf_dir))
    return cc.resolve_files(ptrs, "u", root)


def resolve_file_errors(spark, sf_dir):
    """As ``resolve_files``, from a store that refuses some objects and fails on others."""
    lake = Lake.fresh(spark, "reserr").create(spark)
    root = f"{lake.root}/objects"
    obj.write_object_files(fx.store_rows(fx.documents(spark, sf_dir)), root, lake.scratch("manifest"))
    return cc.resolve_files(fx.pointer_rows(fx.documents(spark, sf_dir)), "u", root, wrap=fx.FaultyFiles)


def resolve_hot(spark, sf_dir):
    """Pointers of which a third name one object: what each pointer's rows get, and how many they are."""
    lake = Lake.fresh(spark, "reshot").create(spark)
    docs = fx.documents(spark, sf_dir)
    cc.write_store(fx.repeated_rows(docs), lake.store_name, order=["version"])
    out = cc.resolve_text(fx.folded_pointers(docs), "u", spark.table(lake.store_name), bucket=TERMS_BUCKET)
    return out.groupBy("u").agg(F.count(F.lit(1)).alias("n_rows"), F.min("status").alias("status"), F.min("full_text").alias("full_text"), F.max("n_bytes").alias("n_bytes"))


def get_text_sql(spark, sf_dir):
    """``SELECT id, terms, get_text_from_s3(terms) AS full_text FROM gold`` through the SQL function."""
    lake = _gold(spark, sf_dir, "sqlfn")
    fn = m.register_text_function(spark, lake, f"get_text_{lake.database}")
    return spark.sql(f"SELECT id, terms, {fn}(terms) AS full_text FROM {lake.gold_name}")


def get_text_sql_few(spark, sf_dir):
    """The SQL function under ``WHERE id IN (...)``."""
    lake = _gold(spark, sf_dir, "sqlfew")
    fn = m.register_text_function(spark, lake, f"get_text_{lake.database}")
    ids = ", ".join(f"'{i}'" for i in FEW_IDS)
    return spark.sql(f"SELECT id, terms, {fn}(terms) AS full_text FROM {lake.gold_name} WHERE id IN ({ids})")


def offload_duplicates(spark, sf_dir):
    """Objects that repeat, in two buckets, with NULL and tied order values, one with a third of all
    rows: one copy of each stays."""
    lake = Lake.fresh(spark, "dups").create(spark)
    cc.write_store(fx.repeated_rows(fx.documents(spark, sf_dir)), lake.store_name, order=["version"])
    return _store_text(spark.table(lake.store_name))


def resolve_two_buckets(spark, sf_dir):
    """Pointers to either of two registered buckets that hold the same keys."""
    lake = Lake.fresh(spark, "twob").create(spark)
    cc.write_store(fx.repeated_rows(fx.documents(spark, sf_dir)), lake.store_name, order=["version"])
    store = spark.table(lake.store_name)
    ptrs = store.select(F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key").alias("u"))
    out = cc.resolve_text(ptrs, "u", store, bucket=fx.TWO_BUCKETS)
    return out.select("u", "status", "full_text", "n_bytes")


def stream_arrivals(spark, sf_dir):
    lake, root = _landing(spark, sf_dir, "arrive")
    df = arrivals.stream_to_folder(spark, root, lake.scratch("arrivals"), max_files_per_trigger=1)
    return df.select("id", "terms", *MEASURES, fx.relative_dir(F.col(SOURCE_FILE)).alias("_source_dir"))


def stream_pipeline(spark, sf_dir):
    lake, root = _landing(spark, sf_dir, "stream")
    layout = arrivals.run_stream(spark, root, lake, rules=fx.RULES_DEFAULT, run_ts=fx.RUN_TS)
    return _stable(layout.table(spark, "gold"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        scan_landing_csv,
        scan_landing_recursive,
        scan_landing_suffix,
        scan_landing_headers,
        scan_landing_ragged,
        scan_bronze_table,
        scan_text_objects,
        offload_text,
        write_bronze,
        write_silver,
        write_quarantine,
        publish_gold,
        replace_with_pointer,
        stamp_ingestion,
        stamp_source_file,
        stamp_silver,
        drop_check_columns,
        measure_text,
        filter_passed,
        filter_failed,
        filter_id_in,
        predicate_not_null,
        predicate_not_blank,
        resolve_text,
        quarantine_summary,
        preview_limit,
        split_complete,
        parse_uri,
        check_not_null,
        check_not_empty,
        check_extension,
        check_unique,
        silver_rules_path,
        annotate_checks,
        dq_passed,
        dq_failed_names,
        dq_no_checks,
        bronze_to_silver,
        resolve_row_cap,
        resolve_status,
        resolve_few,
        resolve_bulk,
        stream_arrivals,
        stream_pipeline,
        resolve_files,
        resolve_file_errors,
        resolve_hot,
        get_text_sql,
        get_text_sql_few,
        offload_duplicates,
        resolve_two_buckets,
        source_to_bronze,
        medallion_end_to_end,
    )
}
