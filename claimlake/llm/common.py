"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.session import fresh_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = fresh_dir(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def python_on_executors(spark: SparkSession) -> None:
    """Executors must be able to import this package (no-op after the first call)."""
    ship_package(spark)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def slices(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to about ``limit`` (at least one item each)."""
    start = total = end = 0
    for size in sizes:
        if total and total + size > limit:
            yield start, end
            start, total = end, 0
        total += max(1, size)
        end += 1
    if end > start:
        yield start, end


def need(df: DataFrame, *columns: str) -> None:
    """Fail early, by name, when an input lacks a column that the operator reads."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")


class Remembered(dict):
    """Results of ``make`` by string, in bounded memory: two generations of ``limit`` entries.

    When the current generation is full it becomes the previous one, from which what is asked for
    again moves over; so frequent strings stay known however many rare ones pass by. Strings over
    ``longest`` characters aren't kept.
    """

    def __init__(self, make: Callable[[str], Any], limit: int = 500_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.previous = make, limit, longest, {}

    def __missing__(self, word: str) -> Any:
        value = self.previous.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.previous = dict(self)
                self.clear()
            self[word] = value
        return value
