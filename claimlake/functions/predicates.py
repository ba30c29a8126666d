"""Row predicates used by the quality checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters treated as blank when ``whitespace=True`` (space, tab, newline, CR, form feed, VT).
BLANK_CHARS = " \t\n\r\f\u000b"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def not_null(col: Column | str) -> Column:
    return _c(col).isNotNull()


def not_blank(col: Column | str, whitespace: bool = False) -> Column:
    """Not NULL and non-empty after trimming.

    By default only spaces are trimmed (``trim``), so a tab-only value passes; with
    ``whitespace=True`` every ASCII whitespace character counts as blank. The result is never
    NULL: a NULL value gives FALSE.
    """
    c = _c(col)
    trimmed = F.btrim(c, F.lit(BLANK_CHARS)) if whitespace else F.trim(c)
    return c.isNotNull() & (F.length(trimmed) > 0)
