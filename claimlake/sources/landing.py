"""Landing CSV files: batch scan, file-stream scan, and a writer that round-trips exactly.

Every column is read as a string (an id like ``007`` must stay ``007``); the three measure
columns are cast explicitly afterwards. Only files named ``*.csv`` count, at any depth under
the root. The path of the file each row came from is taken from the scan's ``_metadata``
column, before any other stage can lose it.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimlake.session import sql_conf

# The landing columns named by the pipeline and their types after the cast.
LANDING_COLUMNS = ("id", "terms", "character_length", "utf8_byte_length", "exceeds_redshift_varchar_65535_bytes")
MEASURE_TYPES = {
    "character_length": "bigint",
    "utf8_byte_length": "bigint",
    "exceeds_redshift_varchar_65535_bytes": "boolean",
}
SOURCE_FILE = "_source_file"
# Token written for NULL so that NULL, '' and blank strings all survive a round trip; no text of
# a landing file looks like it (a text ``\\N`` stays a text).
NULL_TOKEN = "\u2400NULL\u2400"
# Column of a row's raw line where it has more or fewer fields than the header.
RAGGED = "_ragged_line"
CSV_GLOB = "*.csv"

_PARSE = {"header": "true", "sep": ",", "quote": '"', "escape": '"'}


def read_options(null_value: str = NULL_TOKEN, glob: str | None = CSV_GLOB, multi_line: bool = True) -> dict[str, str]:
    """Reader options. ``multi_line=False`` lets Spark split large files across tasks; use it
    only when no value contains a line break (a quoted newline would then split a row)."""
    opts = dict(
        _PARSE,
        multiLine=str(multi_line).lower(),
        nullValue=null_value,
        recursiveFileLookup="true",
        inferSchema="false",
        # Check every file's header against the schema instead of trusting column positions.
        enforceSchema="false",
    )
    if glob:
        opts["pathGlobFilter"] = glob
    return opts


def landing_schema(columns: Sequence[str] = LANDING_COLUMNS) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def cast_measures(df: DataFrame) -> DataFrame:
    """Cast the measure columns that are present; leave every other column as read.

    ``try_cast``: a malformed value becomes NULL instead of failing the whole ingest (ANSI
    mode raises on a bad cast); rule checks can then catch it in silver.
    """
    casts = {c: F.col(c).try_cast(t) for c, t in MEASURE_TYPES.items() if c in df.columns}
    return df.withColumns(casts) if casts else df


def with_source_file(df: DataFrame) -> DataFrame:
    return df.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def read_landing_csv(
    spark: SparkSession,
    root: str,
    *,
    schema: StructType | None = None,
    null_value: str = NULL_TOKEN,
    glob: str | None = CSV_GLOB,
    source_file: bool = True,
    multi_line: bool = True,
    keep_ragged: bool = False,
    by_name: bool = False,
) -> DataFrame:
    """All ``*.csv`` files under ``root`` (recursively), header row, all columns strings.

    ``multiLine`` is needed because texts hold newlines; it makes each file one split, so the
    scan parallelises across files (land many files, not one huge one). When the landing data
    has no line breaks inside values, ``multi_line=False`` makes big files splittable.

    A row with more or fewer fields than the header stops the read; with ``keep_ragged`` its raw
    line is kept in ``_ragged_line`` (NULL in whole rows) instead, for a quarantine.

    Files whose header differs from the schema's stop the read too; with ``by_name`` each file is
    read by its own header (:func:`header_layouts`) and columns meet by name: files may order them
    differently, and a column that a file lacks is NULL in its rows. An explicit ``schema`` then
    says which columns come out, in which order.
    """
    reader = spark.read.options(**read_options(null_value, glob, multi_line))
    if by_name:
        layouts = header_layouts(spark, root, glob)
        parts = [_read(reader.option("enforceSchema", "true"), files, landing_schema(header), keep_ragged, source_file) for header, files in layouts]
        met = {c.lower(): c for header, _ in reversed(layouts) for c in reversed(header)}  # the first spelling
        order = dict.fromkeys(c.lower() for header, _ in layouts for c in header)
        wanted = schema.names if schema else [met[c] for c in order] or list(LANDING_COLUMNS)
        extra = [c for c, on in ((RAGGED, keep_ragged), (SOURCE_FILE, source_file)) if on]
        empty = spark.createDataFrame([], landing_schema([*wanted, *extra]))
        df = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts or [empty])
        known = {c.lower() for c in df.columns}
        df = df.select(*[F.col(f"`{c}`") if c.lower() in known else F.lit(None).cast("string").alias(c) for c in wanted], *extra)
        return cast_measures(df)
    if keep_ragged:
        schema = schema or reader.csv(root).schema
    return cast_measures(_read(reader, root, schema, keep_ragged, source_file))


def _read(reader: DataFrameReader, files: str | list[str], schema: StructType | None, keep_ragged: bool, source_file: bool) -> DataFrame:
    if keep_ragged:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAGGED)
        schema = StructType([*schema.fields, StructField(RAGGED, StringType(), True)])
    else:
        reader = reader.option("mode", "FAILFAST")
    df = (reader if schema is None else reader.schema(schema)).csv(files)
    return with_source_file(df) if source_file else df


def _first_of_each(batches):
    """The first row of each file; a task reads its files one after the other."""
    before = None
    for batch in batches:
        files = batch.column(0).to_pylist()
        starts = [i for i, f in enumerate(files) if f != (files[i - 1] if i else before)]
        if files:
            before = files[-1]
        yield batch.take(starts)


def header_layouts(spark: SparkSession, root: str, glob: str | None = CSV_GLOB) -> list[tuple[tuple[str, ...], list[str]]]:
    """The headers that occur among the files under ``root``, each with its files: the header of
    most files first (ties: the smallest path).

    One task a file scans it as lines, of which the first alone passes a filter (Spark has no way to
    leave a partition early, so files are read twice in all, but the first time without parsing,
    Python or a shuffle); file names and headers alone come to the driver, as the file listing does. A header's names may be quoted but hold no line
    break. Blank and repeated names get their position added. Files without a line are left out.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    lines = (reader.option("pathGlobFilter", glob) if glob else reader).text(root).select(F.col("_metadata.file_path").alias("file"), "value", F.col("_metadata.file_block_start").alias("at"))
    whole = str(1 << 50)
    # One file a task: its first line is the row of its partition that is numbered 0.
    with sql_conf(spark, spark__sql__files__maxPartitionBytes=whole, spark__sql__files__openCostInBytes=whole):
        if all(spark.conf.get(f"spark.sql.files.{x}") == whole for x in ("maxPartitionBytes", "openCostInBytes")):
            place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
            first = lines.drop("at").withColumn("place", place).filter("place = 0").drop("place").collect()
        else:  # a session that holds its settings: files are split, or share a task
            first = lines.filter("at = 0").drop("at").mapInArrow(_first_of_each, "file string, value string").collect()
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted((r["file"], r["value"]) for r in first):
        by_header.setdefault(_header_names(line), []).append(unquote(file))
    return sorted(by_header.items(), key=lambda x: (-len(x[1]), x[1][0]))


def _header_names(line: str) -> tuple[str, ...]:
    names = next(csv.reader([line.removeprefix("\ufeff").rstrip("\r")]), [])
    lower = [n.lower() for n in names]
    return tuple(n if n and lower.count(n.lower()) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names))


def stream_landing_csv(
    spark: SparkSession,
    root: str,
    *,
    columns: Sequence[str] = LANDING_COLUMNS,
    null_value: str = NULL_TOKEN,
    glob: str | None = CSV_GLOB,
    max_files_per_trigger: int | None = None,
    multi_line: bool = True,
    keep_ragged: bool = False,
) -> DataFrame:
    """File-stream form of :func:`read_landing_csv`; a schema is mandatory for file streams.

    ``max_files_per_trigger=1`` processes one arrival per micro-batch. ``keep_ragged`` adds
    ``_ragged_line`` as the batch read does; without it a ragged row stops the stream.
    """
    reader = spark.readStream.options(**read_options(null_value, glob, multi_line))
    if keep_ragged:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAGGED).schema(landing_schema([*columns, RAGGED]))
    else:
        reader = reader.option("mode", "FAILFAST").schema(landing_schema(columns))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return cast_measures(with_source_file(reader.csv(root)))


def write_landing_csv(df: DataFrame, path: str, *, mode: str = "overwrite", files: int | None = None) -> str:
    """Write CSV that :func:`read_landing_csv` reads back unchanged (NULL, '' and blanks kept)."""
    if files:
        df = df.repartition(files)
    (
        df.write.mode(mode)
        .options(
            header="true",
            sep=",",
            quote='"',
            escape='"',
            quoteAll="true",
            nullValue=NULL_TOKEN,
            ignoreLeadingWhiteSpace="false",
            ignoreTrailingWhiteSpace="false",
        )
        .csv(path)
    )
    return path
