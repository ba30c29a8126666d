"""Landing files of several kinds: no file, and so no task, takes a fixed share of the table."""

import os

from pyspark.sql import functions as F

from claimlake.plans import fixtures as fx
from claimlake.sources.landing import read_landing_csv

TASKS = 6
MEASURES = ["character_length", "utf8_byte_length", "exceeds_redshift_varchar_65535_bytes"]


def _docs(spark):
    """Ids that repeat, are NULL or below zero; texts with quotes, line breaks and none."""
    texts = ['a "b", c', "two\nlines", "", None, "ä€", "\\", "x" * 300]
    rows = [(None if i % 9 == 4 else i % 150 - 10, texts[i % len(texts)]) for i in range(400)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(TASKS)


def _files(root):
    return [os.path.join(d, f) for d, _, names in os.walk(root.removeprefix("file:")) for f in names if f.endswith(".txt")]


def _sorted(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_files_by_headers_grow_in_number(spark, lake):
    docs = _docs(spark).cache()
    root = fx.write_landing_by_headers(docs, f"{lake.root}/landing")
    files = _files(root)
    assert len(files) > 4 * (TASKS - 1)
    assert max(map(os.path.getsize, files)) < sum(map(os.path.getsize, files)) / TASKS
    d = F.col("doc_id")
    kind = F.when(d.isNull(), 2).otherwise(d % 4)
    want = fx.landing_rows(docs, keep_doc_id=True).select(
        "id", "terms", *[F.when(kind != 2, F.col(c)).alias(c) for c in MEASURES], F.when(kind == 3, F.lit("n")).alias("note")
    )
    got = read_landing_csv(spark, root, glob="*.txt", by_name=True).select(*want.columns)
    assert _sorted(got) == _sorted(want)


def test_no_rows_by_headers(spark, lake):
    root = fx.write_landing_by_headers(_docs(spark).filter("false"), f"{lake.root}/landing")
    got = read_landing_csv(spark, root, glob="*.txt", by_name=True)
    assert {"id", "terms", "note", *MEASURES} <= set(got.columns) and got.count() == 0


def test_ragged_files_grow_in_number(spark, lake):
    docs = _docs(spark).cache()
    root = fx.write_ragged_landing(docs, f"{lake.root}/landing")
    files = _files(root)
    assert len(files) > 4 * (TASKS - 1)
    assert max(map(os.path.getsize, files)) < sum(map(os.path.getsize, files)) / TASKS
    got = read_landing_csv(spark, root, glob="*.txt", by_name=True, keep_ragged=True)
    d = F.col("doc_id")
    ragged = F.coalesce((d % 10).isin(3, 7), F.lit(False))
    want = fx.landing_rows(docs.filter(~ragged))
    assert _sorted(got.filter("_ragged_line is null").select(*want.columns)) == _sorted(want)
    assert len(got.filter("_ragged_line is not null").collect()) == docs.filter(ragged).count()
