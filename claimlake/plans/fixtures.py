"""Deterministic "dirty" projections of the driver's ``documents`` table (see FIXTURES.md).

Each fixture exists twice: as a DataFrame built by Spark, and as SQL that DuckDB runs on the
same parquet, so the two engines can be compared. No row is dropped: the modulo rules only
decide which rows get which defect.
"""

from __future__ import annotations

import errno
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.functions import text as T
from claimlake.operators.quality import DEFAULT_RULES
from claimlake.plans.tables import TERMS_BUCKET
from claimlake.sources.landing import NULL_TOKEN, write_landing_csv

# Run time used by every test and query, and the rule documents of FIXTURES F5.
RUN_TS = "2026-01-01T00:00:00+00:00"
RULES_DEFAULT = DEFAULT_RULES
RULES_THREE = {
    "checks": [
        {"type": "not_null", "columns": ["id", "terms"]},
        {"type": "not_empty_string", "column": "terms"},
    ]
}
RULES_EMPTY: dict = {"checks": []}
STORE_MAX_BYTES = 5000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _id(d: Column) -> Column:
    return F.when(d % 17 == 0, F.lit(None).cast("string")).otherwise(d.cast("string"))


def _terms(d: Column, text: Column) -> Column:
    return (
        F.when(d % 13 == 0, F.lit(None).cast("string"))
        .when(d % 11 == 0, F.lit(""))
        .when(d % 7 == 0, F.lit("   "))
        .otherwise(text)
    )


def landing_rows(docs: DataFrame, keep_doc_id: bool = False) -> DataFrame:
    """id, terms and the three measures of that terms value."""
    d = F.col("doc_id")
    base = docs.select(d, _id(d).alias("id"), _terms(d, F.col("text")).alias("terms"))
    out = base.withColumns(T.measure_columns("terms"))
    return out if keep_doc_id else out.drop("doc_id")


def landing_dir(doc_id: Column) -> Column:
    """Sub-folder of the landing area a row is written to."""
    return F.when(doc_id % 2 == 0, F.lit("even")).otherwise(F.lit("odd/nested"))


def write_landing_area(spark: SparkSession, docs: DataFrame, root: str, files_per_dir: int = 4) -> str:
    """F1 as CSV under ``root/even`` and ``root/odd/nested``, plus stray ``.txt`` files in
    ``root/notes`` that a correct scan must ignore."""
    rows = landing_rows(docs, keep_doc_id=True)
    for sub in ("even", "odd/nested"):
        part = rows.filter(landing_dir(F.col("doc_id")) == sub).drop("doc_id")
        write_landing_csv(part, f"{root}/{sub}", files=files_per_dir)
    docs.select(F.concat_ws(",", "doc_id", "lang", "source", "n_chars").alias("value")).write.mode("overwrite").text(
        f"{root}/notes"
    )
    return root


def relative_dir(path: Column, marker: str = "/landing/") -> Column:
    """Folder of a landed file relative to the landing root (stable across runs)."""
    return F.regexp_extract(path, "^.*" + marker + "(.*)/[^/]+$", 1)


def pointer_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, u) - one pointer per document, first matching defect rule wins."""
    d = F.col("doc_id")
    ds = d.cast("string")
    u = (
        F.when(d % 23 == 0, F.lit(None).cast("string"))
        .when(d % 19 == 0, F.lit(""))
        .when(d % 17 == 0, F.lit("   "))
        .when(d % 13 == 0, F.concat(F.lit("bad-"), ds))
        .when(d % 11 == 0, F.concat(F.lit("s3://nowhere/terms/"), ds, F.lit(".txt")))
        .when(d % 7 == 0, F.concat(F.lit(f"s3://{TERMS_BUCKET}/terms/x"), ds, F.lit(".txt")))
        .when(d % 5 == 0, F.concat(F.lit(f" s3://{TERMS_BUCKET}/terms/"), ds, F.lit(".txt ")))
        .otherwise(F.concat(F.lit(f"s3://{TERMS_BUCKET}/terms/"), ds, F.lit(".txt")))
    )
    return docs.select(d, u.alias("u"))


def store_rows(docs: DataFrame) -> DataFrame:
    """(bucket, key, content, n_bytes); every 29th object holds bytes that are not UTF-8."""
    d = F.col("doc_id")
    content = F.when(d % 29 == 0, F.unhex(F.lit("C328"))).otherwise(F.encode(F.col("text"), "UTF-8"))
    return docs.select(
        F.lit(TERMS_BUCKET).alias("bucket"),
        F.concat(F.lit("terms/"), d.cast("string"), F.lit(".txt")).alias("key"),
        content.alias("content"),
    ).withColumn("n_bytes", F.octet_length("content").cast("bigint"))


TWO_BUCKETS = (TERMS_BUCKET, "more-terms")


def folded_key(d: Column) -> Column:
    """A third of all ids share one key; of the others, seven ids share each."""
    return F.concat(F.lit("terms/"), F.when(d % 3 == 0, F.lit(0)).otherwise(F.floor(d / 7)).cast("string"), F.lit(".txt"))


def repeated_rows(docs: DataFrame) -> DataFrame:
    """Repeats: (bucket, key, content, version) - whole texts under folded keys, in two buckets, each
    row twice; versions are NULL or the id, so the last document of a key wins."""
    d = F.col("doc_id")
    version = F.when(d % 7 != 0, d)
    both = docs.withColumn("bucket", F.explode(F.array(*[F.lit(b) for b in TWO_BUCKETS for _ in range(2)])))
    content = F.encode(F.concat("bucket", F.lit(" "), F.coalesce("text", F.lit(""))), "UTF-8")
    return both.select("bucket", folded_key(d).alias("key"), content.alias("content"), version.alias("version")).withColumn(
        "n_bytes", F.octet_length("content").cast("bigint")
    )


def folded_pointers(docs: DataFrame) -> DataFrame:
    """One pointer per document to its folded key: a third of the rows point to one object."""
    return docs.select(F.concat(F.lit(f"s3://{TERMS_BUCKET}/"), folded_key(F.col("doc_id"))).alias("u"))


def _cell(value: Column) -> Column:
    quoted = F.regexp_replace(F.coalesce(value.cast("string"), F.lit(NULL_TOKEN)), '"', '""')
    return F.concat(F.lit('"'), quoted, F.lit('"'))


def _kind(d: Column) -> Column:
    """The kind of landing file that a row goes to; a row without an id has no measures, as in the SQL."""
    return F.when(d.isNull(), 2).when(d % 4 > 0, d % 4).otherwise(0).cast("long")


def _write_lines(lines: DataFrame, headers: list[str], root: str) -> str:
    """(part, nth, value) lines as text files, each under the header of its part.

    Each task writes the lines that it reads, as one file a part, so a file is no larger than what a
    task takes of the input, however large that is. A task's first line brings the headers along; a
    file of each header alone is there for tables without rows.
    """
    row = lambda part, is_line, nth, value: F.struct(part.alias("part"), F.lit(is_line).alias("is_line"), nth.cast("long").alias("nth"), value.alias("value"))
    heads = [row(F.lit(k).cast("long"), False, F.lit(None), F.lit(h)) for k, h in enumerate(headers)]
    line = row(F.col("part"), True, F.col("nth"), F.col("value"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    led = lines.withColumn("place", place).select(F.inline(F.when(F.col("place") == 0, F.array(*heads, line)).otherwise(F.array(line))))
    alone = lines.sparkSession.range(0, 1, 1, 1).select(F.inline(F.array(*heads)))
    ordered = led.unionByName(alone).sortWithinPartitions("part", "is_line", "nth")
    ordered.select("part", "value").write.partitionBy("part").text(root)
    return root


# The headers of the four kinds of landing files; the last has a column of its own.
HEADERS = [
    ["id", "terms", "character_length", "utf8_byte_length", "exceeds_redshift_varchar_65535_bytes"],
    ["exceeds_redshift_varchar_65535_bytes", "terms", "utf8_byte_length", "id", "character_length"],
    ["terms", "id"],
    ["note", "id", "terms", "character_length", "utf8_byte_length", "exceeds_redshift_varchar_65535_bytes"],
]


def write_landing_by_headers(docs: DataFrame, root: str) -> str:
    """F1 as text files whose headers order the columns differently, lack some or have one more."""
    rows = landing_rows(docs, keep_doc_id=True).withColumn("note", F.lit("n"))
    d, kind = F.col("doc_id"), _kind(F.col("doc_id"))
    line = F.concat_ws(",", *[_cell(F.col(c)) for c in HEADERS[0]])
    for k, header in enumerate(HEADERS):
        line = F.when(kind == k, F.concat_ws(",", *[_cell(F.col(c)) for c in header])).otherwise(line)
    return _write_lines(rows.select(kind.alias("part"), d.alias("nth"), line.alias("value")), [",".join(h) for h in HEADERS], root)


def write_ragged_landing(docs: DataFrame, root: str) -> str:
    """F1 as text files in which every tenth line ends after its first field and every tenth has a
    field too many."""
    rows = landing_rows(docs, keep_doc_id=True)
    d, cells = F.col("doc_id"), [_cell(F.col(c)) for c in HEADERS[0]]
    line = F.when(d % 10 == 3, cells[0]).when(d % 10 == 7, F.concat_ws(",", *cells, F.lit('"more"'))).otherwise(F.concat_ws(",", *cells))
    return _write_lines(rows.select(_kind(d).alias("part"), d.alias("nth"), line.alias("value")), [",".join(HEADERS[0])] * 4, root)


def repeated_ids(docs: DataFrame) -> DataFrame:
    """F1's id and terms, a third of the rows with one id, others with an id of two rows."""
    d = F.col("doc_id")
    id_ = F.when(d % 3 == 0, F.lit("hot")).when(d % 17 == 0, F.lit(None).cast("string")).when(d % 5 == 1, F.floor(d / 10).cast("string"))
    return docs.select(id_.otherwise(F.concat(F.lit("d"), d.cast("string"))).alias("id"), _terms(d, F.col("text")).alias("terms"))


class FaultyFiles:
    """Object files of which some can't be read: the store refuses every third object, and the
    reading of every fifth fails."""

    def __init__(self, files):
        self.files = files

    def get_file_info(self, path):
        return self.files.get_file_info(path)

    def open_input_stream(self, path):
        number = int(re.sub(r"\D", "", path.rpartition("/")[2]) or 1)
        if number % 3 == 0:
            raise PermissionError(errno.EACCES, "refused")
        if number % 5 == 0:
            raise OSError(errno.EIO, "input/output error")
        return self.files.open_input_stream(path)


# ---------------------------------------------------------------------------------------------
# The same fixtures as DuckDB SQL (used by oracle_sql()).
# ---------------------------------------------------------------------------------------------

SQL_LANDING = """
SELECT doc_id,
       CASE WHEN doc_id % 17 = 0 THEN NULL ELSE CAST(doc_id AS VARCHAR) END AS id,
       CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN ''
            WHEN doc_id % 7 = 0 THEN '   ' ELSE text END AS terms
FROM documents
"""

SQL_F1 = f"""
SELECT doc_id, id, terms,
       CAST(length(terms) AS BIGINT) AS character_length,
       CAST(strlen(terms) AS BIGINT) AS utf8_byte_length,
       strlen(terms) > 65535 AS exceeds_redshift_varchar_65535_bytes,
       CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd/nested' END AS _dir
FROM ({SQL_LANDING}) l
"""

SQL_BRONZE = f"""
SELECT doc_id, id,
       CASE WHEN id IS NOT NULL AND terms IS NOT NULL
            THEN 's3://{TERMS_BUCKET}/terms/' || id || '.txt' END AS terms,
       character_length, utf8_byte_length, exceeds_redshift_varchar_65535_bytes,
       '{RUN_TS}' AS _ingestion_timestamp, _dir AS _source_file,
       terms AS _raw_terms
FROM ({SQL_F1}) f
"""

SQL_POINTERS = f"""
SELECT doc_id,
       CASE WHEN doc_id % 23 = 0 THEN NULL
            WHEN doc_id % 19 = 0 THEN ''
            WHEN doc_id % 17 = 0 THEN '   '
            WHEN doc_id % 13 = 0 THEN 'bad-' || CAST(doc_id AS VARCHAR)
            WHEN doc_id % 11 = 0 THEN 's3://nowhere/terms/' || CAST(doc_id AS VARCHAR) || '.txt'
            WHEN doc_id % 7 = 0 THEN 's3://{TERMS_BUCKET}/terms/x' || CAST(doc_id AS VARCHAR) || '.txt'
            WHEN doc_id % 5 = 0 THEN ' s3://{TERMS_BUCKET}/terms/' || CAST(doc_id AS VARCHAR) || '.txt '
            ELSE 's3://{TERMS_BUCKET}/terms/' || CAST(doc_id AS VARCHAR) || '.txt' END AS u
FROM documents
"""

SQL_STORE = f"""
SELECT '{TERMS_BUCKET}' AS bucket, 'terms/' || CAST(doc_id AS VARCHAR) || '.txt' AS key, text,
       CASE WHEN doc_id % 29 = 0 THEN 2 ELSE strlen(text) END AS n_bytes,
       doc_id % 29 = 0 AS bad
FROM documents
"""

SQL_FOLDED_KEY = "'terms/' || CAST(CASE WHEN doc_id % 3 = 0 THEN 0 ELSE doc_id // 7 END AS VARCHAR) || '.txt'"

SQL_REPEATED = f"""
SELECT b.bucket, key, b.bucket || ' ' || text AS text
FROM (SELECT {SQL_FOLDED_KEY} AS key, max_by(coalesce(text, ''), CASE WHEN doc_id % 7 <> 0 THEN doc_id ELSE -1 END) AS text
      FROM documents GROUP BY 1) f, (VALUES {", ".join(f"('{b}')" for b in TWO_BUCKETS)}) b(bucket)
"""


def sql_cell(value: str) -> str:
    return f"""'"' || replace(coalesce(CAST({value} AS VARCHAR), '{NULL_TOKEN}'), '"', '""') || '"'"""


SQL_REPEATED_IDS = """
SELECT CASE WHEN doc_id % 3 = 0 THEN 'hot' WHEN doc_id % 17 = 0 THEN NULL
            WHEN doc_id % 5 = 1 THEN CAST(doc_id // 10 AS VARCHAR) ELSE 'd' || CAST(doc_id AS VARCHAR) END AS id,
       CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN ''
            WHEN doc_id % 7 = 0 THEN '   ' ELSE text END AS terms
FROM documents
"""
