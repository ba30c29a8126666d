"""Command line for the layer jobs, for ``spark-submit``.

    spark-submit claimlake/cli.py bronze  --root s3a://lake --landing s3a://landing/
    spark-submit claimlake/cli.py silver  --root s3a://lake --rules s3a://cfg/rules.json
    spark-submit claimlake/cli.py gold    --root s3a://lake
    spark-submit claimlake/cli.py run     --root s3a://lake --landing s3a://landing/ [--rules ...]
    spark-submit claimlake/cli.py stream  --root s3a://lake --landing s3a://landing/ [--rules ...] [--compact]

Each job is one application; a failing step exits non-zero, so a scheduler that chains them
only starts the next one after success.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from claimlake.plans import medallion as m  # noqa: E402
from claimlake.plans.tables import Lake  # noqa: E402
from claimlake.streaming import arrivals  # noqa: E402


def _lake(a: argparse.Namespace) -> Lake:
    return Lake(
        root=a.root,
        database=a.database,
        gold_database=a.gold_database,
        terms_bucket=a.terms_bucket,
        catalog=a.catalog,
    )


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="claimlake")
    p.add_argument("job", choices=["bronze", "silver", "gold", "run", "stream"])
    p.add_argument("--root", required=True, help="shared folder for the lake databases")
    p.add_argument("--landing", help="landing root (CSV files at any depth)")
    p.add_argument("--rules", help="path of the JSON rule document (default: id and terms not NULL)")
    p.add_argument("--database", default="lake")
    p.add_argument("--gold-database", default="gold")
    p.add_argument("--terms-bucket", default="terms-bucket")
    p.add_argument("--catalog", default=None, help="v2 table catalog (e.g. an Iceberg catalog) instead of Parquet")
    p.add_argument("--compact", action="store_true", help="stream: rewrite the drained layers into the batch layout")
    a = p.parse_args(argv)
    if a.job in ("bronze", "run", "stream") and not a.landing:
        p.error("--landing is required for this job")

    spark = SparkSession.builder.appName(f"claimlake-{a.job}").getOrCreate()
    lake = _lake(a).create(spark)
    if a.job == "bronze":
        m.to_bronze(spark, a.landing, lake)
    elif a.job == "silver":
        m.to_silver(spark, lake, rules_path=a.rules)
    elif a.job == "gold":
        m.to_gold(spark, lake)
    elif a.job == "run":
        m.run_batch(spark, a.landing, lake, rules_path=a.rules)
    else:
        from claimlake.sources.rules import load_rules

        rules = load_rules(spark, a.rules) if a.rules else None
        layout = arrivals.run_stream(spark, a.landing, lake, rules=rules)
        if a.compact:
            layout.compact(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
