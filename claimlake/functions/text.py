"""Column expressions for the claim-check text column: measures, pointers, URI parsing, UTF-8.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``, so it stays inside
whole-stage codegen; nothing runs in Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the pointer format and the text-size contract.
POINTER_SCHEME = "s3://"
POINTER_PATTERN = r"^s3://([^/]+)/(.+)$"
OBJECT_SUFFIX = ".txt"
DEFAULT_PREFIX = "terms/"
VARCHAR_LIMIT_BYTES = 65535
# Whitespace removed around a pointer before matching: every character Python's str.strip()
# removes (str.isspace), built from that rule; all of them lie below U+3001.
POINTER_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
# Java regex treats \r, U+0085, U+2028 and U+2029 as line ends for "."; (?d) keeps only \n,
# as in Python, so a key holding such a character parses the same way.
SPARK_POINTER_PATTERN = "(?d)" + POINTER_PATTERN


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def char_length(text: Column | str) -> Column:
    """Number of characters, as BIGINT."""
    return F.char_length(_c(text)).cast("bigint")


def byte_length(text: Column | str) -> Column:
    """Number of UTF-8 bytes, as BIGINT."""
    return F.octet_length(_c(text)).cast("bigint")


def exceeds_bytes(text: Column | str, limit: int = VARCHAR_LIMIT_BYTES) -> Column:
    """TRUE when the UTF-8 size is over ``limit`` bytes (NULL for a NULL text)."""
    return F.octet_length(_c(text)) > F.lit(limit)


def measure_columns(text: Column | str = "terms") -> dict[str, Column]:
    """The three measure columns that describe the original text, in landing order."""
    return {
        "character_length": char_length(text),
        "utf8_byte_length": byte_length(text),
        "exceeds_redshift_varchar_65535_bytes": exceeds_bytes(text),
    }


def object_key(row_id: Column | str, prefix: str = DEFAULT_PREFIX) -> Column:
    """Object key ``<prefix><id>.txt``; the id is used verbatim."""
    return F.concat(F.lit(prefix), _c(row_id), F.lit(OBJECT_SUFFIX))


def pointer(
    row_id: Column | str, text: Column | str, bucket: str, prefix: str = DEFAULT_PREFIX, present: Column | str | None = None
) -> Column:
    """``s3://<bucket>/<prefix><id>.txt`` when both id and text are present, else NULL.

    ``present`` may name a column that is NULL exactly when the text is (e.g. its byte length
    computed earlier), so the text itself need not be read.
    """
    return F.when(
        _c(row_id).isNotNull() & _c(text if present is None else present).isNotNull(),
        F.concat(F.lit(f"{POINTER_SCHEME}{bucket}/"), object_key(row_id, prefix)),
    )


def strip_pointer(uri: Column | str) -> Column:
    return F.btrim(_c(uri), F.lit(POINTER_WHITESPACE))


def pointer_bucket(uri: Column | str) -> Column:
    """Bucket part of a pointer after stripping whitespace; '' when the pattern does not match."""
    return F.regexp_extract(strip_pointer(uri), SPARK_POINTER_PATTERN, 1)


def pointer_key(uri: Column | str) -> Column:
    """Key part of a pointer after stripping whitespace; '' when the pattern does not match."""
    return F.regexp_extract(strip_pointer(uri), SPARK_POINTER_PATTERN, 2)


def is_utf8(content: Column | str) -> Column:
    """TRUE when the bytes are valid UTF-8 (never raises, unlike ``decode``)."""
    return F.is_valid_utf8(_c(content).cast("string"))


def utf8_text(content: Column | str) -> Column:
    """Bytes as text when they are valid UTF-8, else NULL."""
    return F.try_validate_utf8(_c(content).cast("string"))


def with_thousands(n: Column | str) -> Column:
    """Integer with thousands separators, e.g. 61,234."""
    return F.format_number(_c(n).cast("bigint"), 0)
