"""Rule documents: read one small JSON file through Spark and parse it on the driver."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession

from claimlake.operators.quality import DEFAULT_RULES


def parse_rules(doc: str | bytes | Mapping | None) -> dict:
    """JSON text or an already parsed mapping -> dict. ``None`` gives the default rules."""
    if doc is None:
        return json.loads(json.dumps(DEFAULT_RULES))
    if isinstance(doc, Mapping):
        return dict(doc)
    return json.loads(doc)


def load_rules(spark: SparkSession, path: str) -> dict:
    """Read the rule document at ``path`` (any Hadoop path) as one whole-text row."""
    row = spark.read.text(path, wholetext=True).first()
    if row is None:
        raise FileNotFoundError(f"rule document {path!r} is empty or missing")
    return parse_rules(row[0])


def write_rules(spark: SparkSession, rules: Mapping, path: str) -> str:
    """Write a rule document as a single text file under ``path``; returns the folder."""
    spark.createDataFrame([(json.dumps(rules),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path
