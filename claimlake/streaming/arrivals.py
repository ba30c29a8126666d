"""Arrivals as a stream: each new ``*.csv`` under the landing root goes through all layers.

``foreachBatch`` runs the batch layer logic on every micro-batch, in order: store, bronze,
silver / quarantine, gold. Each batch writes one Parquet folder a layer. A manifest lists the live
folders of every layer; it alone says what a layer holds, so a batch counts as a whole or not at
all, and a batch replayed after a failure replaces what it wrote before instead of appending twice.

Folders are merged in size tiers: when a layer has ``fan_in`` folders of one tier, the next batch
first writes them as one folder of the tier above. A row is written again once a tier, so
logarithmically often, and a layer never has more than ``fan_in`` folders in each of logarithmically
many tiers. Only folders of earlier batches are merged: those are committed and can't be replayed.
What a merge replaces stays for one more batch, for readers that are still at it.

A repeated id keeps its last copy: within a batch as in the batch job (greatest file, last
row), across batches the later batch wins. The streamed store keeps one object per key per
batch; :meth:`StreamLake.current_store` is the view with only the latest copy of each key,
which is what resolve should read. Landed lines with more or fewer fields than the header go to the
layer ``landing_quarantine``.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimlake.operators import claimcheck as cc
from claimlake.plans.medallion import _BYTES, _ORD, bronze_frame, ragged_frame, silver_frames, utc_now
from claimlake.plans.tables import Lake
from claimlake.session import remove_folder
from claimlake.sources.landing import LANDING_COLUMNS, RAGGED, SOURCE_FILE, stream_landing_csv

BATCH = "_batch_id"
LAYERS = ("store", "bronze", "silver", "quarantine", "gold", "landing_quarantine")  # under lake.root/stream
FAN_IN = 8
MANIFEST_SCHEMA = "version long, live boolean, layer string, tier long, first_batch long, last_batch long"


@dataclass(frozen=True, order=True)
class Folder:
    """A folder with the rows of one layer from a range of batches."""

    layer: str
    tier: int
    first_batch: int
    last_batch: int

    @property
    def name(self) -> str:
        return f"{self.layer}/tier{self.tier}-{self.first_batch}-{self.last_batch}"


@dataclass(frozen=True)
class StreamLake:
    """Folder layout of the streamed layers, under ``lake.root/stream``."""

    lake: Lake
    fan_in: int = FAN_IN

    def path(self, folder: Folder) -> str:
        return f"{self.lake.root}/stream/{folder.name}"

    @property
    def checkpoint(self) -> str:
        return f"{self.lake.root}/stream/_checkpoint"

    def _slot(self, version: int) -> str:
        """Manifests are written in turn to two places, so that the one before is always whole."""
        return f"{self.lake.root}/stream/manifest/slot{version % 2}"

    def _manifest(self, spark: SparkSession) -> tuple[list[Folder], list[Folder]]:
        """The live folders, and those that the last merges replaced."""
        rows: list = []
        for slot in (0, 1):
            for attempt in range(5):
                try:
                    found = spark.read.schema(MANIFEST_SCHEMA).parquet(self._slot(slot)).collect()  # some ten rows a layer
                    rows += found
                    break
                except AnalysisException:
                    break  # not written yet, or just being replaced: the other one counts
                except Exception:  # noqa: BLE001 - replaced while it was read
                    if attempt == 4:
                        raise
                    time.sleep(0.2)
        version = max((r["version"] for r in rows), default=None)
        last = [r for r in rows if r["version"] == version]
        folder = lambda r: Folder(r["layer"], r["tier"], r["first_batch"], r["last_batch"])
        return sorted(folder(r) for r in last if r["live"]), sorted(folder(r) for r in last if not r["live"])

    def folders(self, spark: SparkSession, layer: str | None = None) -> list[Folder]:
        """The live folders of one layer, or of all."""
        return [f for f in self._manifest(spark)[0] if layer in (None, f.layer)]

    def commit(self, spark: SparkSession, version: int, live: list[Folder], replaced: list[Folder]) -> None:
        rows = [(version, on, f.layer, f.tier, f.first_batch, f.last_batch) for on, fs in ((True, live), (False, replaced)) for f in fs]
        spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(self._slot(version))

    def table(self, spark: SparkSession, layer: str, keep_batch: bool = False) -> DataFrame:
        paths = [self.path(f) for f in self.folders(spark, layer)]
        if not paths:
            raise ValueError(f"no batch has written the layer {layer!r}")
        df = spark.read.parquet(*paths)
        return df if keep_batch else df.drop(BATCH)

    def merged(self, spark: SparkSession, live: list[Folder]) -> tuple[list[Folder], list[Folder]]:
        """``live`` after merging every tier that is full, and the folders that this replaced.

        Scans pack small files to the split size, so a merge is a plain copy into larger files.
        """
        replaced: list[Folder] = []
        for layer in LAYERS:
            tier = 0
            while of_layer := [f for f in live if f.layer == layer and f.tier >= tier]:
                full = [f for f in of_layer if f.tier == tier]
                if len(full) >= self.fan_in:
                    one = Folder(layer, tier + 1, min(f.first_batch for f in full), max(f.last_batch for f in full))
                    spark.read.parquet(*[self.path(f) for f in full]).write.mode("overwrite").parquet(self.path(one))
                    live = [f for f in live if f not in full] + [one]
                    replaced += full
                tier += 1
        return live, replaced

    def current_store(self, spark: SparkSession) -> DataFrame:
        """Store rows ``(bucket, key, content, n_bytes)``, latest batch's copy of each key.

        Winners come from a partial aggregate on narrow columns; a ``key`` filter on the
        result is pushed below it into the scan, so a capped resolve still reads few rows.
        """
        store = self.table(spark, "store", keep_batch=True)
        return cc.keep_latest(store, [BATCH]).select(*cc.STORE_COLUMNS)

    def compact(self, spark: SparkSession) -> Lake:
        """Rewrite the streamed layers into the batch layout of ``lake``: bronze, silver and
        quarantine tables with right-sized files, the store as a bucketed table holding the
        latest copy of each key, and gold published from silver. Afterwards
        ``medallion.resolve_gold`` and the SQL function work on the streamed data."""
        lake = self.lake.create(spark)
        cc.write_store(self.current_store(spark), lake.store_name, writer=lake.writer)
        layers = (("bronze", lake.bronze_name), ("silver", lake.silver_name), ("quarantine", lake.quarantine_name))
        for layer, name in layers:
            lake.writer.replace(self.table(spark, layer), name)
        lake.writer.publish(spark, lake.silver_name, lake.gold_name)
        return lake


def process_batch(
    batch: DataFrame,
    batch_id: int,
    layout: StreamLake,
    *,
    rules: Mapping | str | None,
    run_ts: str | None,
) -> None:
    """All layers for one micro-batch, after merging full tiers of the batches before it; then the
    manifest names the new folders, and what an earlier batch's merges replaced goes."""
    spark = batch.sparkSession
    lake = layout.lake
    ts = run_ts or utc_now()
    known, outdated = layout._manifest(spark)
    earlier = [f for f in known if f.last_batch < batch_id]  # a replay drops its first attempt
    live, replaced = layout.merged(spark, earlier)
    new: list[Folder] = []

    def put(df: DataFrame, layer: str) -> DataFrame:
        folder = Folder(layer, 0, batch_id, batch_id)
        df.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(layout.path(folder))
        new.append(folder)
        return spark.read.schema(df.schema).parquet(layout.path(folder))

    # The batch is one or a few files: keep it for the batch's jobs instead of staging a copy.
    # A lost block is recomputed from those files, with the same ordinals.
    staged = batch.withColumns(
        {_ORD: F.monotonically_increasing_id(), _BYTES: F.octet_length("terms").cast("bigint")}
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _layers(staged, put, lake, rules, ts)
    finally:
        staged.unpersist()
    # A replay meets its own first attempt's merges as live folders: what those replaced stays listed.
    still = [f for f in outdated if known and max(k.last_batch for k in known) >= batch_id]
    layout.commit(spark, batch_id, live + new, replaced + still)
    for folder in outdated:
        if folder not in still:
            remove_folder(spark, layout.path(folder))


def _layers(staged: DataFrame, put, lake: Lake, rules, ts: str) -> None:
    whole = staged
    if RAGGED in staged.columns:
        whole = staged.filter(F.col(RAGGED).isNull()).drop(RAGGED)
        put(ragged_frame(staged, ts), "landing_quarantine")
    rows = cc.payload(
        whole, bucket=lake.terms_bucket, prefix=lake.terms_prefix, keep=(SOURCE_FILE, _ORD), size_col=_BYTES
    )
    # Last copy of each object within the batch: winners from narrow columns, texts stay in place.
    latest, _ = cc.unique_objects(rows, [SOURCE_FILE, _ORD])
    put(latest.select(*cc.STORE_COLUMNS), "store")
    bronze = put(bronze_frame(whole, lake, ts), "bronze")
    clean, failed, _ = silver_frames(bronze, rules, ts)
    silver = put(clean, "silver")
    put(failed, "quarantine")
    put(silver, "gold")


def start_stream(
    spark: SparkSession,
    landing_root: str,
    lake: Lake,
    *,
    rules: Mapping | str | None = None,
    run_ts: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    columns: tuple[str, ...] = LANDING_COLUMNS,
) -> tuple[StreamingQuery, StreamLake]:
    """Start the stream. ``available_now`` drains what has landed and stops; otherwise it
    polls every ``processing_time``. A micro-batch takes all files that have landed, or at most
    ``max_files_per_trigger`` of them. ``columns`` is the landing header (file streams need a
    schema up front; every file's header is checked against it)."""
    layout = StreamLake(lake)
    source = stream_landing_csv(
        spark, landing_root, columns=columns, max_files_per_trigger=max_files_per_trigger, keep_ragged=True
    )
    writer = (
        source.writeStream.foreachBatch(lambda df, k: process_batch(df, k, layout, rules=rules, run_ts=run_ts))
        .option("checkpointLocation", layout.checkpoint)
        .queryName(f"arrivals_{lake.database}")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(), layout


def run_stream(
    spark: SparkSession,
    landing_root: str,
    lake: Lake,
    *,
    rules: Mapping | str | None = None,
    run_ts: str | None = None,
    max_files_per_trigger: int | None = None,
    columns: tuple[str, ...] = LANDING_COLUMNS,
) -> StreamLake:
    """Drain every arrival now (``availableNow``), wait for the end, return the layout."""
    query, layout = start_stream(
        spark, landing_root, lake, rules=rules, run_ts=run_ts, max_files_per_trigger=max_files_per_trigger, columns=columns
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return layout


def stream_to_folder(
    spark: SparkSession,
    landing_root: str,
    sink: str,
    *,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Arrivals only: drain the landing stream into a Parquet folder and read it back."""
    source = stream_landing_csv(spark, landing_root, max_files_per_trigger=max_files_per_trigger)
    query = (
        source.writeStream.format("parquet")
        .option("path", f"{sink}/data")
        .option("checkpointLocation", f"{sink}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{sink}/data")
