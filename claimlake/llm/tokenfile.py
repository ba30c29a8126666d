"""Token ids in fixed-width bit-packed files.

A file image holds whole documents: every id takes the least number of bits that the vocabulary
needs, ids lie in blocks whose byte offsets are listed, and a table has each document's id and
first position. So a reader unpacks a block, or the blocks that a document touches, with a few
numpy operations and without reading the rest.

``write_token_files`` tokenizes documents in ascending ``doc_id`` order and writes the images as
binary rows of a Parquet table, which any store that Spark can write accepts.
``read_token_files`` unpacks them again.

Defined results: a null text is an empty text, whose document is the end id alone; rows with equal
ids stand one after another, ordered by their texts' first 32 characters, then as they lie in the
input; a null ``doc_id`` comes first and is kept as null; an empty table gives no files and no rows;
other columns are not carried.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from claimlake.llm.common import need, python_on_executors, slices, text_or_empty, written
from claimlake.llm.tokens import definition, encoder

MAGIC = b"PKID0001"
BLOCK = 4096
#: Ids after which a file is closed; a document is never split, so one can be larger.
FILE_IDS = 2_000_000
HEADER = np.dtype([("magic", "S8"), ("bits", "<u4"), ("block", "<u4"), ("ids", "<u8"), ("documents", "<u8")])
FILE_SCHEMA = "part int, file int, n_ids long, content binary"


def width(vocabulary: int) -> int:
    """Bits for ids 0 .. vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` side by side in ``bits`` bits each, lowest bit first."""
    if ids.size and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(each.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of packed bytes."""
    if bits in (8, 16, 32):
        return data[: n * bits // 8].view(f"<u{bits // 8}").astype(np.uint32)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at = np.arange(n, dtype=np.int64) * bits
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[at >> 3].copy().view("<u8").ravel()
    return ((words >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def file_image(doc_ids: list[int | None], documents: list[bytes], bits: int, block: int = BLOCK) -> bytes:
    """Documents (ids as little-endian unsigned 32-bit) as one file."""
    ids = np.frombuffer(b"".join(documents), "<u4")
    starts = np.cumsum([0, *(len(d) // 4 for d in documents)], dtype="<u8")
    packed = [pack_bits(ids[a : a + block], bits) for a in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, packed)], dtype="<u8")
    header = np.array([(MAGIC, bits, block, len(ids), len(documents))], HEADER)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    names = np.array([d or 0 for d in doc_ids], "<i8")
    return b"".join([header.tobytes(), known.tobytes(), names.tobytes(), starts.tobytes(), offsets.tobytes(), *packed])


@dataclass
class TokenFile:
    """Random access to a file image."""

    content: bytes

    def __post_init__(self) -> None:
        head = np.frombuffer(self.content, HEADER, 1)[0]
        if head["magic"] != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block, self.n_ids, n = int(head["bits"]), int(head["block"]), int(head["ids"]), int(head["documents"])
        at = HEADER.itemsize
        known = np.frombuffer(self.content, np.uint8, n, at)
        names = np.frombuffer(self.content, "<i8", n, at + n)
        self.doc_ids = [int(x) if k else None for x, k in zip(names, known, strict=True)]
        self.starts = np.frombuffer(self.content, "<u8", n + 1, at + 9 * n).astype(np.int64)
        blocks = -(-self.n_ids // self.block)
        at += 9 * n + 8 * (n + 1)
        self.offsets = np.frombuffer(self.content, "<u8", blocks + 1, at).astype(np.int64)
        self.data = np.frombuffer(self.content, np.uint8, offset=at + 8 * (blocks + 1))

    def ids(self, first: int, end: int) -> np.ndarray:
        """Ids ``first`` to ``end`` (exclusive), unpacked from the blocks that hold them."""
        if first >= end:
            return np.zeros(0, np.uint32)
        out = []
        for k in range(first // self.block, -(-end // self.block)):
            n = min(self.block, self.n_ids - k * self.block)
            out.append(unpack_bits(self.data[self.offsets[k] : self.offsets[k + 1]], n, self.bits))
        skip = first // self.block * self.block
        return np.concatenate(out)[first - skip : end - skip]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


#: Characters of a text that order the rows of one id.
HEAD = 32


def write_token_files(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int, tasks: int | None = None) -> DataFrame:
    """Files over all documents in ascending ``doc_id`` order: ``part`` and ``file`` number them in
    that order. ``tasks`` range-partitions the rows; by default as the session shuffles."""
    need(docs, "doc_id", "text")
    spark = docs.sparkSession
    python_on_executors(spark)
    tokens = spark.sparkContext.broadcast(definition(tokenizer))
    end, bits = end_id.to_bytes(4, "little"), width(max(vocabulary, end_id + 1))
    schema = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("n_ids", pa.int64()), ("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file, names, waiting, size = TaskContext.get().partitionId(), 0, [], [], 0
        encode = encoder(tokens.value).encode

        def close() -> pa.RecordBatch:
            image = file_image(names, waiting, bits)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((part, file, size, image), schema, strict=True)], schema=schema)

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices(map(len, texts), 4_000_000):
                for doc_id, ids in zip(doc_ids[a:b], encode(texts[a:b]), strict=True):
                    names.append(doc_id)
                    waiting.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= FILE_IDS:
                        yield close()
                        file, names, waiting, size = file + 1, [], [], 0
        if names:
            yield close()

    # Rows of one id go by their texts' first characters, then as they lie in the input, so that an
    # id (or null) with any share of the rows is parted like any other.
    row = F.monotonically_increasing_id().alias("row")
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"), F.left(text_or_empty(), F.lit(HEAD)).alias("head"), row)
    order = ("doc_id", "head", "row")
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("doc_id", "text")
    return written(ordered.mapInArrow(run, FILE_SCHEMA), "token_files", "uncompressed")


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document, in its file's words: part, file, nth (there), doc_id, first (position there),
    n_tokens, ids_crc32."""
    python_on_executors(files.sparkSession)
    schema = pa.schema([("part", pa.int32()), ("file", pa.int32()), ("nth", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, number, content = (batch.column(c)[row].as_py() for c in range(3))
                file = TokenFile(content)
                every = file.ids(0, file.n_ids).astype("<u4").tobytes()
                n = len(file.doc_ids)
                sums = [zlib.crc32(every[4 * a : 4 * b]) for a, b in zip(file.starts[:-1], file.starts[1:], strict=True)]
                columns = ([part] * n, [number] * n, range(n), file.doc_ids, file.starts[:-1], np.diff(file.starts), sums)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return files.select("part", "file", "content").mapInArrow(run, "part int, file int, nth int, doc_id long, first long, n_tokens long, ids_crc32 long")


def document_starts(files: DataFrame) -> DataFrame:
    """``read_token_files`` with ``start``: the ids of all documents before. Running sums go over
    the files of a task and over tasks, never over all rows at once."""
    sizes = files.select("part", "file", "n_ids")
    tasks = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row per task
    before = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    task_start = tasks.select("part", before(W.partitionBy(F.lit(0)).orderBy("part"), "n").alias("task_start"))
    in_task = sizes.select("part", "file", before(W.partitionBy("part").orderBy("file"), "n_ids").alias("file_start"))
    base = in_task.join(task_start, "part").select("part", "file", (F.col("task_start") + F.col("file_start")).alias("base"))
    return read_token_files(files).join(base, ["part", "file"]).withColumn("start", F.col("base") + F.col("first"))
