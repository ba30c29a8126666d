"""Corpus pipeline: stages that each apply one operator to all that the stage before kept.

Rejected documents go, one document of each near-duplicate group stays, personal data is replaced
by its kind in brackets, and what remains is packed into token windows.

Every stage takes all rows of the one before, whatever they hold, and carries all columns but the
last one. An empty table passes all stages as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimlake.llm import packing, pii, quality, simhash
from claimlake.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOKENIZER = "byte_bpe_50k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled ones vote good.

    A null text is judged as an empty one; rows with a null id are judged, but never learned from;
    repeated rows get the same vote and stay or go together; a score at the cut stays.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each SimHash component.

    Null and empty texts have fingerprint 0 and are one group with whatever is near it. Rows that
    share the smallest id of a component are told apart by their columns' hash, and one stays; a
    component whose ids are all null keeps one row likewise. Repeated rows are copies.
    """
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the personal data found in them; no row goes.

    A null text stays null; ``n_chars`` is counted again where the text changes; where spans
    overlap, all that they cover goes, under the kind of the first (ties: the longer's end counts).
    """
    return pii.redact(docs, pii.fit(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in windows of 1024 tokens: a row for each piece.

    A null text is an empty one, whose piece is the end id alone; repeated rows and ids are packed one
    by one; of equally tight windows the one of smallest number takes a piece. Encoders remember
    fewer words than usual, as executors also hold what the stages before have left.
    """
    return packing.packed_rows(docs, public_tokenizers.path(TOKENIZER), end_id=0, remember=200_000)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack_sequences),
]

#: SQL can express neither the learned stages nor the tokenizer; the tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage_{name}")
    return docs
