"""Lake namespaces and table writes: replace a table with right-sized files, publish by versions."""

from __future__ import annotations

import math
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import col, expr
from pyspark.sql.types import StructType

from claimlake.session import fresh_dir, list_folder, remove_folder, sql_conf

# Default table names, claim-check bucket and prefix, and the target file size.
BRONZE_TABLE = "raw_data_with_pointers"
SILVER_TABLE = "silver_data"
QUARANTINE_TABLE = "silver_data_quarantine"
GOLD_TABLE = "gold_data"
STORE_TABLE = "text_objects"
LANDING_QUARANTINE_TABLE = "landing_quarantine"
TERMS_BUCKET = "terms-bucket"
TERMS_PREFIX = "terms/"
TARGET_FILE_BYTES = 134217728
# Spark's default ceiling on the number of buckets of a table; the most partitions they lie in.
MAX_BUCKETS = 100000
MAX_PARTS = 4096


@dataclass(frozen=True)
class Lake:
    """Where the layers live: a shared root folder and two databases (lake and gold)."""

    root: str
    database: str = "lake"
    gold_database: str = "gold"
    bronze: str = BRONZE_TABLE
    silver: str = SILVER_TABLE
    quarantine: str = QUARANTINE_TABLE
    gold: str = GOLD_TABLE
    store: str = STORE_TABLE
    landing_quarantine: str = LANDING_QUARANTINE_TABLE
    terms_bucket: str = TERMS_BUCKET
    terms_prefix: str = TERMS_PREFIX
    target_file_bytes: int = TARGET_FILE_BYTES
    # None: Parquet tables in the session catalog. Otherwise the name of a configured
    # table catalog (e.g. an Iceberg SparkCatalog); tables are then written with
    # ``writeTo(...).using(table_format).createOrReplace()``.
    catalog: str | None = None
    table_format: str = "iceberg"

    @classmethod
    def fresh(cls, spark: SparkSession, tag: str = "lake", **kw) -> Lake:
        """A lake with its own folder and database names (for tests and one-off runs)."""
        suffix = uuid.uuid4().hex[:10]
        return cls(
            root=fresh_dir(spark, tag),
            database=f"{tag}_{suffix}",
            gold_database=f"{tag}_gold_{suffix}",
            **kw,
        )

    def name(self, table: str, gold: bool = False) -> str:
        db = f"`{self.gold_database if gold else self.database}`"
        return f"`{self.catalog}`.{db}.`{table}`" if self.catalog else f"{db}.`{table}`"

    @property
    def writer(self) -> TableWriter:
        return TableWriter(self.target_file_bytes, self.table_format if self.catalog else None)

    @property
    def bronze_name(self) -> str:
        return self.name(self.bronze)

    @property
    def silver_name(self) -> str:
        return self.name(self.silver)

    @property
    def quarantine_name(self) -> str:
        return self.name(self.quarantine)

    @property
    def landing_quarantine_name(self) -> str:
        return self.name(self.landing_quarantine)

    @property
    def store_name(self) -> str:
        return self.name(self.store)

    @property
    def gold_name(self) -> str:
        return self.name(self.gold, gold=True)

    def table_path(self, table: str, gold: bool = False) -> str:
        """Folder of a managed table (database location + table name)."""
        return f"{self.root}/{self.gold_database if gold else self.database}.db/{table.lower()}"

    def layer_path(self, table: str) -> str:
        """Folder of the versions of tables that one pass writes together."""
        return f"{self.root}/_layers/{self.database}/{table.lower()}"

    def scratch(self, name: str) -> str:
        return f"{self.root}/_scratch/{name}-{uuid.uuid4().hex[:12]}"

    def create(self, spark: SparkSession) -> Lake:
        for db in (self.database, self.gold_database):
            if self.catalog:
                spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{self.catalog}`.`{db}`")
            else:
                spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}` LOCATION '{self.root}/{db}.db'")
        return self


@dataclass(frozen=True)
class TableWriter:
    """How layer tables are replaced: Parquet in the session catalog, or a v2 table format."""

    target_file_bytes: int = TARGET_FILE_BYTES
    table_format: str | None = None

    def replace(self, df: DataFrame, name: str, rebalance: bool = True) -> None:
        if self.table_format is None:
            replace_table(df, name, target_file_bytes=self.target_file_bytes, rebalance=rebalance)
            return
        (
            df.writeTo(name)
            .using(self.table_format)
            .tableProperty("write.format.default", "parquet")
            .tableProperty("write.target-file-size-bytes", str(self.target_file_bytes))
            .createOrReplace()
        )

    def replace_layers(self, df: DataFrame, layer: str, tables: Mapping[str, tuple[str, list[str]]], folder: str) -> None:
        if self.table_format is None:
            replace_layers(df, layer, tables, folder, target_file_bytes=self.target_file_bytes)
            return
        for value, (name, columns) in tables.items():
            self.replace(df.filter(col(layer) == value).select(*columns), name)

    def replace_bucketed(self, df: DataFrame, name: str, key: str, num_buckets: int) -> None:
        if self.table_format is None:
            replace_bucketed_table(df, name, key, num_buckets)
            return
        from pyspark.sql.functions import partitioning

        (
            df.repartition(num_buckets, key)
            .sortWithinPartitions(key)
            .writeTo(name)
            .using(self.table_format)
            .partitionedBy(partitioning.bucket(num_buckets, key))
            .tableProperty("write.format.default", "parquet")
            .tableProperty("write.distribution-mode", "hash")
            .createOrReplace()
        )

    def publish(self, spark: SparkSession, source: str, target: str) -> DataFrame:
        if self.table_format is None:
            return publish(spark, source, target)
        # One atomic commit: readers see the old gold until the new one is complete.
        self.replace(spark.table(source), target)
        return spark.table(target)


def replace_table(df: DataFrame, name: str, *, target_file_bytes: int = TARGET_FILE_BYTES, rebalance: bool = True) -> None:
    """Create or replace a Parquet table with files near ``target_file_bytes``.

    A REBALANCE lets AQE cut the output into partitions of the advisory size (merging small
    ones, splitting large ones), so a table of narrow rows does not end up as thousands of
    small files. ``parallelismFirst`` is off for the write: with it on, AQE ignores the
    advisory size and only keeps partitions above 1 MB. ``rebalance=False`` writes the
    partitions as they come (for output that is already in large partitions, e.g. the result
    of a join with the bucketed store, where a REBALANCE would shuffle all the text again).
    """
    if not rebalance:
        _swap_in(df.sparkSession, name, lambda staging: df.write.format("parquet").saveAsTable(staging))
        return
    with sql_conf(
        df.sparkSession,
        spark__sql__adaptive__advisoryPartitionSizeInBytes=str(target_file_bytes),
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    ):
        _swap_in(df.sparkSession, name, lambda staging: df.hint("rebalance").write.format("parquet").saveAsTable(staging))


def _swap_in(spark: SparkSession, name: str, write: Callable[[str], object]) -> None:
    """Replace table ``name`` by what ``write`` writes under a staging name of its own.

    The old table stays whole and readable until the new one is complete, and for good if the
    write fails. Dropping the old and renaming the new table are two steps of the catalog: a
    reader can find no table for that moment, and if the job ends exactly there, the new table
    remains under its staging name.
    """
    db, _, table = name.rpartition(".")
    staging = ".".join(x for x in (db, f"`{table.strip('`')}__{uuid.uuid4().hex[:8]}`") if x)
    try:
        write(staging)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {name}")


def replace_layers(
    df: DataFrame, layer: str, tables: Mapping[str, tuple[str, list[str]]], folder: str, *, target_file_bytes: int = TARGET_FILE_BYTES, keep: int = 2
) -> None:
    """Create or replace several Parquet tables by one pass over ``df``.

    ``tables`` names, for each value of the column ``layer``, a table and its columns. All rows are
    written once, into a new version under ``folder``, partitioned by ``layer``; each table is an
    external one over its partition, and reads its own columns alone. Rows are rebalanced by
    layer, so that no task writes a small file for each; AQE splits a layer larger than a file.

    A write that fails leaves all tables as they were. A table whose columns stay the same is moved
    to the new version by one change of its catalog entry, never missing for a reader; else it is
    dropped and created. The ``keep`` newest versions stay, for readers that are still at an old one.
    """
    spark = df.sparkSession
    version = f"{folder}/{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    with sql_conf(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes=str(target_file_bytes),
        spark__sql__adaptive__coalescePartitions__parallelismFirst="false",
    ):
        try:
            df.hint("rebalance", layer).write.partitionBy(layer).parquet(version)
        except BaseException:
            remove_folder(spark, version)
            raise
    for value, (name, columns) in tables.items():
        _point(spark, name, f"{version}/{layer}={value}", df.select(*columns).schema)
    for old in list_folder(spark, folder)[:-keep]:
        remove_folder(spark, old)


def _point(spark: SparkSession, name: str, path: str, schema: StructType) -> None:
    """Make ``name`` an external Parquet table over ``path``, which need not hold any file."""
    shape = lambda s: [(f.name, f.dataType) for f in s.fields]
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType == "EXTERNAL" and shape(spark.table(name).schema) == shape(schema):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def bucket_count(total_bytes: int, target_file_bytes: int = TARGET_FILE_BYTES) -> int:
    return max(1, min(MAX_BUCKETS, math.ceil(max(0, total_bytes) / target_file_bytes)))


def store_parts(num_buckets: int) -> int:
    """Partitions of a bucketed table: a power of two, so that whole buckets lie in one partition."""
    return 1 << min(num_buckets, MAX_PARTS).bit_length() - 1


def part_column(parts: int) -> str:
    """Name of the partition column; a table of another number of partitions has another one."""
    return f"part_of_{parts}"


def part_of(key: str, parts: int) -> str:
    """SQL for the partition that ``key`` lies in."""
    return f"pmod(hash({key}), {parts})"


def replace_bucketed_table(df: DataFrame, name: str, key: str, num_buckets: int) -> None:
    """Create or replace a Parquet table bucketed and sorted by ``key``, in partitions of buckets.

    The hash repartition uses the same function as bucketing, so each task writes exactly one
    file for one bucket. Later joins on ``key`` shuffle only the other side, and ``key IN``
    filters prune buckets and row groups. The partition column (``part_column``) is the same hash
    modulo a divisor of the number of buckets (which is rounded up to a multiple of it), so it
    adds no files; a join that also compares it can prune partitions by the keys that the other
    side turns out to hold.
    """
    parts = store_parts(num_buckets)
    n = min(-(-num_buckets // parts) * parts, MAX_BUCKETS // parts * parts)
    dealt = df.repartition(n, key).withColumn(part_column(parts), expr(part_of(f"`{key}`", parts)))
    # Partitions are found by their folders, not listed in the catalog: a renamed table keeps them.
    with sql_conf(df.sparkSession, spark__sql__hive__manageFilesourcePartitions="false"):
        _swap_in(
            df.sparkSession,
            name,
            lambda staging: dealt.write.format("parquet").partitionBy(part_column(parts)).bucketBy(n, key).sortBy(key).saveAsTable(staging),
        )


VERSION_MARK = "__v"


def versions_database(target: str) -> str:
    """The database that holds the versions of a published table."""
    return f"`{target.rpartition('.')[0].strip('`')}_versions`"


def published_versions(spark: SparkSession, target: str) -> list[str]:
    """The versions that exist of a published table, oldest first."""
    database, table = versions_database(target), target.rpartition(".")[2].strip("`").lower()
    if not spark.catalog.databaseExists(database.strip("`")):
        return []
    names = sorted(r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect())
    return [f"{database}.`{n}`" for n in names if n.startswith(table + VERSION_MARK)]


def publish(spark: SparkSession, source: str, target: str, keep: int = 2) -> DataFrame:
    """Full-refresh copy of ``source`` into ``target``, without a moment in which it is missing.

    ``target`` is a view of its newest version, a table of its own in ``<database>_versions``. A new
    version is written whole, then the view is pointed at it: one change of one catalog entry, so
    every reader finds the old rows or the new ones. Readers that are still at the old version
    finish, as the ``keep`` newest versions stay; older ones are dropped. A write that fails leaves
    the view as it was. (Where ``target`` still is a plain table, the first publish replaces it.)

    It is a plain copy: the source files already have the target size (written with REBALANCE),
    and the scan splits at ``maxPartitionBytes``, so no shuffle is needed to keep it.
    """
    gold, _, table = target.rpartition(".")
    database = versions_database(target)
    location = spark.catalog.getDatabase(gold.strip("`")).locationUri
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location.rstrip('/')}_versions'")
    version = f"{database}.`{table.strip('`').lower()}{VERSION_MARK}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}`"
    try:
        spark.sql(f"CREATE TABLE {version} USING parquet AS SELECT * FROM {source}")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    kind = spark.catalog.getTable(target).tableType if spark.catalog.tableExists(target) else None
    if kind == "VIEW":
        spark.sql(f"ALTER VIEW {target} AS SELECT * FROM {version}")
    else:
        if kind:
            spark.sql(f"DROP TABLE {target}")
        spark.sql(f"CREATE VIEW {target} AS SELECT * FROM {version}")
    existing = published_versions(spark, target)
    for old in existing[: max(0, existing.index(version) + 1 - max(1, keep))]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(target)
