"""Print the physical-plan facts of each headline job (what `explain("formatted")` shows).

    python tools/show_plans.py [sf_dir] > PLANS.md

Automatic broadcast is turned off so that every table is planned as if it were large; the
explicit, size-checked broadcasts of the library stay. For each job: the exchanges
(shuffles), joins, and every scan with its read schema, pushed filters and bucketing.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")


def facts(title: str, df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    tree = text.split("\n\n")[0]
    lines = [f"### {title}", "", "```", tree.strip(), "```", ""]
    for block in text.split("\n\n")[1:]:
        head = block.strip().split("\n")[0]
        if head.startswith("(") and any(w in head for w in ("Scan", "Exchange", "Join", "Sort ")):
            keep = [head]
            for line in block.strip().split("\n")[1:]:
                if re.match(r"^(ReadSchema|PushedFilters|PartitionFilters|Bucketed|Arguments|Left keys|Right keys|Join type|SelectedBucketsCount)", line):
                    keep.append("  " + line[:300])
            lines.append("\n".join(keep))
            lines.append("")
    return "\n".join(lines)


def main() -> None:
    from pyspark.sql import functions as F

    from claimlake.operators import claimcheck as cc
    from claimlake.operators import quality as q
    from claimlake.plans import fixtures as fx
    from claimlake.plans import medallion as m
    from claimlake.plans.tables import Lake
    from claimlake.session import local_session
    from claimlake.sources.landing import SOURCE_FILE, read_landing_csv

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    lake = Lake.fresh(spark, "plans").create(spark)
    root = f"{lake.root}/landing"
    fx.write_landing_area(spark, fx.documents(spark, sf), root)
    m.run_batch(spark, root, lake, rules=fx.RULES_THREE, run_ts=fx.RUN_TS)

    out = [f"# Physical plans ({sf}, automatic broadcast off)", ""]
    raw = read_landing_csv(spark, root)
    out.append(facts("CSV scan -> staging", raw.withColumn(m._BYTES, F.octet_length("terms"))))
    staged = m.stage(raw, lake.scratch("plans"))  # a run removes its own
    rows = cc.payload(staged, bucket=lake.terms_bucket, keep=(SOURCE_FILE, m._ORD), size_col=m._BYTES)
    stats = rows.groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("c"), F.max("n_bytes").alias("b")).agg(F.max("c"), F.sum("b"))
    out.append(facts("store stats (never reads the text)", stats))
    out.append(facts("store de-dup, broadcast winners (when a key repeats)", cc.keep_latest(rows, [SOURCE_FILE, m._ORD], winner_bytes=2000)))
    out.append(facts("store write (one text shuffle, bucket hash)", rows.select(*cc.STORE_COLUMNS).repartition(8, "key")))
    out.append(facts("bronze (pointers only, text not read)", m.bronze_frame(staged, lake, fx.RUN_TS).hint("rebalance")))
    layered, _ = m.layered_frame(spark.table(lake.bronze_name), fx.RULES_THREE, fx.RUN_TS)
    out.append(facts("silver and quarantine (one pass, partitioned by layer)", layered.hint("rebalance", m.LAYER)))
    out.append(facts("quarantine summary", q.quarantine_summary(spark.table(lake.quarantine_name))))
    bulk = m.resolve_gold(spark, lake, max_rows=None)
    out.append(facts("bulk resolve (store bucketed on key: only pointers shuffled)", bulk))
    with m.sorted_store_scans(spark):
        fresh = m.resolve_gold(spark, lake, max_rows=None)  # planned inside the context
        sorted_bulk = facts("bulk export (sorted bucket files: the store side is not re-sorted)", fresh)
    out.append(sorted_bulk)
    few = m.resolve_gold(spark, lake, ids=["1", "2", "3"], max_rows=100)
    out.append(facts("capped resolve (hits fetched with bucket pruning, then broadcast)", few))
    store = spark.table(lake.store_name)
    hits = store.filter(F.col("key").isin(["terms/1.txt", "terms/2.txt", "terms/3.txt"]))
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    out.append(facts("capped resolve: the hit fetch itself", hits))
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    fn = m.register_text_function(spark, lake)
    out.append(facts("SQL text function over all rows (only pointers shuffled)", spark.sql(f"SELECT id, {fn}(terms) AS t FROM {lake.gold_name}")))
    some = spark.sql(f"SELECT id, {fn}(terms) AS t FROM {lake.gold_name} WHERE id IN ('1', '2', '3')")
    out.append(facts("SQL text function over few rows (store partitions pruned at run time)", some))
    print("\n".join(out))


if __name__ == "__main__":
    main()
