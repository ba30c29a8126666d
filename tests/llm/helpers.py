"""Rows that every operator must take: nulls, empty and very long texts, ties, repeats."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

ODD_TEXTS = [
    None,
    "",
    " ",
    "  two  spaces  and\ttabs \n new lines \n\n end ",
    "one",
    "The MIT License. Don't we'll I'VE 's 12345 x² ½  nbsp\u0085nel Ünïcode ﬁ Ａ́ J̌ İ ΑΣ Σ",
    "日本語のテキスト with mixed 漢字 and emoji 👩‍👩‍👧 ​ zero",
    "<|endoftext|> <s> </s> ▁x ▁▁ y",
    "%%% &&& ### $$$",
    "word " * 30_000,
    "a" * 20_000,
    "same text here for a tie",
    "same text here for a tie",
]


def odd_documents(spark, clash=False):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, ODD_TEXTS[3], "en", "s", 1), (None, "no id", None, None, None)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    return clashing(df) if clash else df


def clashing(df):
    """Extra columns named like those that operators add."""
    from pyspark.sql import functions as F

    names = ("part", "nth", "ids", "start", "length", "rank", "n", "fingerprint", "component_id", "score", "predicted", "bucket", "words", "spans", "key", "file", "content", "node")
    return df.withColumns({c: F.lit("mine") for c in names})


def empty_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def documents(spark, sf_dir=SF001):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
