"""Claim-check objects as files: one file per object at ``<root>/<bucket>/<key>``.

This is the second storage mode of the text store (the first is the store table written by
``operators.claimcheck.write_store``). Writing is one explicit ``mapInPandas`` stage whose
file names depend only on the row (bucket, key), so a retried or speculative task rewrites
the same files with the same bytes. Reading uses Spark's ``binaryFile`` source: bodies come
from a scan whose ``length <= max_bytes`` filter is pushed into the source, sizes of larger
files from a scan that never selects ``content`` (file listing only), so oversized files are
never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.session import ship_package

MANIFEST_SCHEMA = "bucket string, key string, n_bytes bigint, path string"


def arrow_uri(root: str) -> str:
    """Hadoop URI -> Arrow file-system URI (Hadoop's ``s3a://`` / ``s3n://`` are Arrow's ``s3://``)."""
    return re.sub(r"^s3[an]://", "s3://", root)


def _write_partition(root: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs

        filesystem, base = pafs.FileSystem.from_uri(arrow_uri(root))
        made: set[str] = set()
        for pdf in batches:
            paths, sizes = [], []
            for bucket, key, content in zip(pdf["bucket"], pdf["key"], pdf["content"]):
                if any(part in ("", ".", "..") for part in f"{bucket}/{key}".split("/")):
                    raise ValueError(f"key {key!r} of bucket {bucket!r} does not name a file under the root")
                path = f"{base}/{bucket}/{key}"
                parent = path.rsplit("/", 1)[0]
                if parent not in made:
                    filesystem.create_dir(parent, recursive=True)
                    made.add(parent)
                data = bytes(content)
                with filesystem.open_output_stream(path) as out:
                    out.write(data)
                paths.append(path)
                sizes.append(len(data))
            yield pd.DataFrame(
                {"bucket": pdf["bucket"], "key": pdf["key"], "n_bytes": pd.Series(sizes, dtype="int64"), "path": paths}
            )

    return write


def write_object_files(rows: DataFrame, root: str, manifest: str) -> DataFrame:
    """Write ``content`` of each ``(bucket, key, content)`` row to ``root/bucket/key``.

    The stage runs once, when the manifest (bucket, key, n_bytes, path) is written to
    ``manifest``; the manifest is returned.
    """
    ship_package(rows.sparkSession)
    written = rows.select("bucket", "key", "content").mapInPandas(_write_partition(root.rstrip("/")), MANIFEST_SCHEMA)
    written.write.mode("overwrite").parquet(manifest)
    return rows.sparkSession.read.parquet(manifest)


def _split_path(root: str) -> tuple:
    # binaryFile reports paths as URIs (file:/..., s3a://...); match the part after the root.
    tail = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    rel = F.regexp_extract(F.col("path"), "^.*?" + re.escape(tail) + "/(.*)$", 1)
    return F.regexp_extract(rel, "^([^/]+)/", 1), F.regexp_extract(rel, "^[^/]+/(.+)$", 1)


def list_object_files(spark: SparkSession, root: str) -> DataFrame:
    """(bucket, key, n_bytes, path) of every non-empty object; the bodies are not read.

    Spark's file sources skip zero-length files, so empty objects are only visible through the
    manifest written by :func:`write_object_files`.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    bucket, key = _split_path(root)
    return files.select(bucket.alias("bucket"), key.alias("key"), F.col("length").alias("n_bytes"), "path")


def read_object_files(
    spark: SparkSession, root: str, *, manifest: DataFrame | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Store rows (bucket, key, content, n_bytes) from object files, without any shuffle.

    With a ``manifest`` (from :func:`write_object_files`) exactly its objects are read, each by
    its key, whatever its name or size: nothing is listed. Without one, the folders are scanned,
    and Spark's file listing leaves out empty files and names that begin with ``_`` or ``.``.
    Objects over ``max_bytes`` have a NULL ``content`` and their true size.
    """
    if manifest is not None:
        keys = manifest.select(F.col("bucket").alias("__b"), F.col("key").alias("__k"))
        got = fetch_objects(keys, root, max_bytes)
        lost = F.raise_error(F.concat(F.lit("object of the manifest not read: "), "__b", F.lit("/"), "__k", F.lit(" "), "__err"))
        return got.select(
            F.when(F.col("__err").isNull(), F.col("__b")).otherwise(lost.cast("string")).alias("bucket"),
            F.col("__k").alias("key"),
            F.col("__sc").alias("content"),
            F.col("__sn").alias("n_bytes"),
        )
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    bucket, key = _split_path(root)
    cols = [bucket.alias("bucket"), key.alias("key")]
    if max_bytes is None:
        out = files.select(*cols, "content", F.col("length").alias("n_bytes"))
    else:
        small = files.filter(F.col("length") <= max_bytes).select(*cols, "content", F.col("length").alias("n_bytes"))
        large = files.filter(F.col("length") > max_bytes).select(
            *cols, F.lit(None).cast("binary").alias("content"), F.col("length").alias("n_bytes")
        )
        out = small.unionByName(large)
    return out


# Bytes of object bodies after which a frame is handed on.
FETCH_BYTES = 16 * 1024 * 1024
FETCH_SCHEMA = "__b string, __k string, __err string, __sn bigint, __sc binary"


def classify_error(exc: BaseException) -> str:
    """Per-object read failure -> status: ``access_denied`` or ``error:<code>``."""
    import errno as _errno

    if isinstance(exc, PermissionError):
        return "access_denied"
    code = _errno.errorcode.get(getattr(exc, "errno", None) or -1) or type(exc).__name__
    return f"error:{code}"


def _fetch_partition(root: str, max_bytes: int | None, wrap: Callable | None = None):
    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs

        filesystem, base = pafs.FileSystem.from_uri(arrow_uri(root))
        filesystem = wrap(filesystem) if wrap else filesystem
        buckets: dict[str, bool] = {}
        rows, held = [], 0

        def frame() -> pd.DataFrame:
            columns = ("__b", "__k", "__err", "__sn", "__sc")
            return pd.DataFrame(rows, columns=columns).astype({"__sn": "Int64"})

        for pdf in batches:
            for b, k in zip(pdf["__b"], pdf["__k"]):
                err, size, body = None, None, None
                try:
                    if b not in buckets:
                        buckets[b] = filesystem.get_file_info(f"{base}/{b}").type == pafs.FileType.Directory
                    if not buckets[b]:
                        err = "no_store"
                    else:
                        info = filesystem.get_file_info(f"{base}/{b}/{k}")
                        if info.type != pafs.FileType.File:
                            err = "not_found"
                        else:
                            size = info.size
                            if max_bytes is None or size <= max_bytes:
                                with filesystem.open_input_stream(f"{base}/{b}/{k}") as f:
                                    body = f.read()
                except Exception as exc:  # noqa: BLE001 - a read problem is a row status, never a failed job
                    err = classify_error(exc)
                rows.append((b, k, err, size, body))
                held += len(body or b"")
                if held >= FETCH_BYTES:  # bodies in one frame are bounded, however many keys come
                    yield frame()
                    rows, held = [], 0
        if rows:
            yield frame()

    return fetch


def fetch_objects(keys: DataFrame, root: str, max_bytes: int | None = None, wrap: Callable | None = None) -> DataFrame:
    """For distinct ``(__b, __k)`` rows: ``__err`` (NULL, no_store, not_found, access_denied,
    error:<code>), size ``__sn`` and, when within ``max_bytes``, body ``__sc``.

    A small per-object helper inside ``mapInPandas``: Spark spreads the keys over tasks; each
    object is stat-ed, and read only when it is under the size cap. ``wrap`` makes of each task's
    file system the one to read through (``get_file_info``, ``open_input_stream``), to add
    retries, say, or faults.
    """
    ship_package(keys.sparkSession)
    return keys.select("__b", "__k").mapInPandas(_fetch_partition(root.rstrip("/"), max_bytes, wrap), FETCH_SCHEMA)
