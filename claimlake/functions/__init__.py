"""Column expressions (all JVM-side built-ins)."""

from claimlake.functions.predicates import not_blank, not_null
from claimlake.functions.text import (
    byte_length,
    char_length,
    exceeds_bytes,
    is_utf8,
    measure_columns,
    object_key,
    pointer,
    pointer_bucket,
    pointer_key,
    utf8_text,
    with_thousands,
)

__all__ = [
    "byte_length",
    "char_length",
    "exceeds_bytes",
    "is_utf8",
    "measure_columns",
    "not_blank",
    "not_null",
    "object_key",
    "pointer",
    "pointer_bucket",
    "pointer_key",
    "utf8_text",
    "with_thousands",
]
