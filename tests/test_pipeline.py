import pytest
from pyspark.sql import functions as F

from claimlake.plans import fixtures as fx
from claimlake.plans import medallion as m
from claimlake.sources.landing import read_landing_csv
from claimlake.streaming import arrivals
from conftest import SF001, SF01


def _landing(spark, lake, sf):
    root = f"{lake.root}/landing"
    fx.write_landing_area(spark, fx.documents(spark, sf), root)
    return root


def test_csv_round_trip_exact(spark, lake):
    root = _landing(spark, lake, SF01)
    back = read_landing_csv(spark, root).drop("_source_file")
    want = fx.landing_rows(fx.documents(spark, SF01))
    assert back.schema == want.schema
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_stray_files_ignored_and_subfolders_read(spark, lake):
    root = _landing(spark, lake, SF001)
    df = read_landing_csv(spark, root)
    dirs = {r[0] for r in df.select(fx.relative_dir(F.col("_source_file"))).distinct().collect()}
    assert dirs == {"even", "odd/nested"}
    assert df.count() == fx.documents(spark, SF001).count()


def test_layers_invariants(spark, lake):
    root = _landing(spark, lake, SF001)
    gold = m.run_batch(spark, root, lake, rules=fx.RULES_THREE, run_ts=fx.RUN_TS)
    bronze = spark.table(lake.bronze_name)
    silver = spark.table(lake.silver_name)
    quarantine = spark.table(lake.quarantine_name)
    store = spark.table(lake.store_name)
    assert silver.count() + quarantine.count() == bronze.count()
    assert gold.exceptAll(silver).count() == 0 and silver.exceptAll(gold).count() == 0
    # every pointer has its object
    ptr_keys = bronze.filter(F.col("terms").isNotNull()).select(F.regexp_extract("terms", "^s3://[^/]+/(.+)$", 1).alias("key"))
    assert ptr_keys.join(store, "key", "left_anti").count() == 0
    # resolve of offload is the identity on rows with an id and a text
    res = m.resolve_gold(spark, lake, max_rows=None)
    raw = fx.landing_rows(fx.documents(spark, SF001)).select("id", F.col("terms").alias("orig"))
    joined = res.join(raw, "id")
    assert joined.filter((F.col("status") != "ok") | (F.col("full_text") != F.col("orig"))).count() == 0
    assert silver.columns == bronze.columns + ["_silver_processed_at"]
    assert quarantine.columns[-3:] == ["_dq_passed", "_dq_failed_checks", "_silver_processed_at"]


def test_publish_twice_keeps_one_table(spark, lake):
    root = _landing(spark, lake, SF001)
    m.run_batch(spark, root, lake, run_ts=fx.RUN_TS)
    n = m.to_gold(spark, lake).count()
    tables = [t.name for t in spark.catalog.listTables(lake.gold_database)]
    assert tables == [lake.gold] and n == spark.table(lake.silver_name).count()


def test_stream_end_state_equals_batch(spark, lake):
    root = _landing(spark, lake, SF001)
    layout = arrivals.run_stream(spark, root, lake, rules=fx.RULES_THREE, run_ts=fx.RUN_TS)
    m.run_batch(spark, root, lake, rules=fx.RULES_THREE, run_ts=fx.RUN_TS)
    for layer, table in (("gold", lake.gold_name), ("quarantine", lake.quarantine_name)):
        s, b = layout.table(spark, layer), spark.table(table)
        assert s.columns == b.columns
        assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0, layer
    s_store = layout.table(spark, "store")
    assert s_store.exceptAll(spark.table(lake.store_name).select(*s_store.columns)).count() == 0


def test_stream_later_arrival_wins(spark, lake):
    from claimlake.sources.landing import write_landing_csv

    root = f"{lake.root}/landing"
    first = spark.createDataFrame([("1", "old one"), ("2", "two")], "id string, terms string")
    write_landing_csv(first, f"{root}/a", files=1)
    layout = arrivals.run_stream(spark, root, lake, run_ts=fx.RUN_TS, columns=("id", "terms"))
    second = spark.createDataFrame([("1", "new one")], "id string, terms string")
    write_landing_csv(second, f"{root}/b", files=1)
    arrivals.run_stream(spark, root, lake, run_ts=fx.RUN_TS, columns=("id", "terms"))
    store = layout.current_store(spark)
    got = {r["key"]: bytes(r["content"]).decode() for r in store.collect()}
    assert got == {"terms/1.txt": "new one", "terms/2.txt": "two"}
    assert layout.table(spark, "bronze").count() == 3
    from claimlake.operators import claimcheck as cc

    res = cc.resolve_text(layout.table(spark, "gold").select("id", "terms"), "terms", store, bucket=lake.terms_bucket)
    assert sorted((r["id"], r["full_text"]) for r in res.collect()) == [("1", "new one"), ("1", "new one"), ("2", "two")]


def test_single_line_csv_is_splittable(spark, lake):
    from claimlake.sources.landing import write_landing_csv

    root = f"{lake.root}/landing"
    df = spark.range(2000).selectExpr("CAST(id AS STRING) AS id", "repeat('word ', 50) AS terms")
    write_landing_csv(df, root, files=1)
    with_split = read_landing_csv(spark, root, multi_line=False)
    whole = read_landing_csv(spark, root)
    assert with_split.drop("_source_file").exceptAll(whole.drop("_source_file")).count() == 0
    assert whole.count() == 2000


def test_rules_path_preview_and_sql_view(spark, lake):
    from claimlake.sources.rules import write_rules

    root = _landing(spark, lake, SF001)
    path = write_rules(spark, fx.RULES_THREE, lake.scratch("rules"))
    m.run_batch(spark, root, lake, rules_path=path, run_ts=fx.RUN_TS)
    assert "_dq_not_empty_terms" in spark.table(lake.quarantine_name).columns
    for layer in m.LAYERS:
        rows = m.preview(spark, lake, layer).collect()
        assert len(rows) == 10
    ids = [r["id"] for r in m.preview(spark, lake, "gold").collect()]
    assert ids == sorted(ids)
    view = m.register_resolved_view(spark, lake)
    got = spark.sql(f"SELECT id, status, full_text FROM {view} WHERE id IN ('1', '2', '3')")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "In(id," in plan.replace(" ", "") or "EqualTo(id," in plan
    raw = {r["id"]: r["terms"] for r in fx.landing_rows(fx.documents(spark, SF001)).collect()}
    for r in got.collect():
        assert r["status"] == "ok" and r["full_text"] == raw[r["id"]]


def test_v2_catalog_names_and_writer():
    from claimlake.plans.tables import Lake

    lake = Lake(root="/x", catalog="ice", database="lake", gold_database="gold")
    assert lake.gold_name == "`ice`.`gold`.`gold_data`"
    assert lake.writer.table_format == "iceberg"
    assert Lake(root="/x").writer.table_format is None


def test_mismatched_header_fails_loudly(spark, lake):
    import pytest
    from claimlake.sources.landing import write_landing_csv

    root = f"{lake.root}/landing"
    write_landing_csv(spark.createDataFrame([("1", "a")], "id string, terms string"), f"{root}/a", files=1)
    write_landing_csv(spark.createDataFrame([("b", "2")], "terms string, id string"), f"{root}/b", files=1)
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_landing_csv(spark, root).collect()


def test_sql_text_function_matches_resolve(spark, lake):
    root = _landing(spark, lake, SF001)
    m.run_batch(spark, root, lake, run_ts=fx.RUN_TS)
    fn = m.register_text_function(spark, lake, max_bytes=2000)
    got = spark.sql(f"SELECT id, terms, {fn}(terms) AS full_text FROM {lake.gold_name}")
    want = m.resolve_gold(spark, lake, max_rows=None, max_bytes=2000).select(
        "id", "terms", F.coalesce("full_text", "message").alias("full_text")
    )
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    odd = spark.createDataFrame([(None,), ("",), ("  nope  ",), ("s3://other/k",), ("s3://terms-bucket/terms/x.txt",)], "u string")
    odd.createOrReplaceTempView("odd_ptrs")
    msgs = [r[0] for r in spark.sql(f"SELECT {fn}(u) FROM odd_ptrs").collect()]
    from claimlake.operators import claimcheck as cc

    res = cc.resolve_text(odd, "u", spark.table(lake.store_name), bucket=lake.terms_bucket, max_bytes=2000)
    assert sorted(msgs, key=str) == sorted((r["message"] for r in res.collect()), key=str)


def test_replayed_micro_batch_replaces_itself(spark, lake):
    from claimlake.sources.landing import stream_landing_csv  # noqa: F401 (schema of the stream)

    layout = arrivals.StreamLake(lake)
    batch = fx.landing_rows(fx.documents(spark, SF001)).withColumn("_source_file", F.lit("file:/x/landing/a/f.csv"))
    arrivals.process_batch(batch, 0, layout, rules=None, run_ts=fx.RUN_TS)
    first = {layer: layout.table(spark, layer).count() for layer in ("bronze", "silver", "quarantine", "gold", "store")}
    arrivals.process_batch(batch, 0, layout, rules=None, run_ts=fx.RUN_TS)  # replay after a failure
    again = {layer: layout.table(spark, layer).count() for layer in ("bronze", "silver", "quarantine", "gold", "store")}
    assert first == again and first["bronze"] == batch.count()


def test_target_file_size_steers_file_count(spark, lake):
    from claimlake.plans.tables import replace_table

    df = fx.landing_rows(fx.documents(spark, SF01))
    # the whole sf0.01 shuffle is below AQE's 1 MB minimum partition size; lower it so the
    # effect of the target is visible at this scale
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1024")
    try:
        replace_table(df, lake.name("big_files"))
        replace_table(df, lake.name("small_files"), target_file_bytes=64 * 1024)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    big = len(spark.table(lake.name("big_files")).inputFiles())
    small = len(spark.table(lake.name("small_files")).inputFiles())
    assert big == 1 and small >= 4


def test_stream_compacts_into_batch_layout(spark, lake):
    root = _landing(spark, lake, SF001)
    layout = arrivals.run_stream(spark, root, lake, run_ts=fx.RUN_TS)
    layout.compact(spark)
    res = m.resolve_gold(spark, lake, ids=["1", "2", "3"])
    raw = {r["id"]: r["terms"] for r in fx.landing_rows(fx.documents(spark, SF001)).collect()}
    got = {r["id"]: r["full_text"] for r in res.collect()}
    assert got and all(got[i] == raw[i] for i in got)
    assert spark.table(lake.gold_name).count() == layout.table(spark, "gold").count()
    assert "_batch_id" not in spark.table(lake.bronze_name).columns


def test_cli_jobs_in_order(spark, lake):
    from claimlake import cli
    from claimlake.sources.rules import write_rules

    root = _landing(spark, lake, SF001)
    rules = write_rules(spark, fx.RULES_THREE, lake.scratch("rules"))
    base = ["--root", lake.root, "--database", lake.database, "--gold-database", lake.gold_database]
    assert cli.main(["bronze", "--landing", root, *base]) == 0
    assert cli.main(["silver", "--rules", rules, *base]) == 0
    assert cli.main(["gold", *base]) == 0
    assert spark.table(lake.gold_name).count() == spark.table(lake.silver_name).count() > 0
    assert "_dq_not_empty_terms" in spark.table(lake.quarantine_name).columns


def test_bulk_export_uses_sorted_buckets(spark, lake):
    root = _landing(spark, lake, SF001)
    m.run_batch(spark, root, lake, run_ts=fx.RUN_TS)
    out = m.resolve_gold_to_table(spark, lake, "gold_text")
    want = m.resolve_gold(spark, lake, max_rows=None)
    assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with m.sorted_store_scans(spark):
            plan = m.resolve_gold(spark, lake, max_rows=None, max_bytes=None)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.count("Sort [") == 1  # only the pointer side is sorted


def test_stream_batch_keeps_last_copy_of_repeated_id(spark, lake):
    layout = arrivals.StreamLake(lake)
    batch = spark.createDataFrame(
        [("1", "first"), ("2", "two"), ("1", "second")], "id string, terms string"
    ).coalesce(1).withColumn("_source_file", F.lit("file:/x/landing/a/f.csv"))
    arrivals.process_batch(batch, 0, layout, rules=None, run_ts=fx.RUN_TS)
    got = {r["key"]: bytes(r["content"]).decode() for r in layout.table(spark, "store").collect()}
    assert got == {"terms/1.txt": "second", "terms/2.txt": "two"}
    assert layout.table(spark, "bronze").count() == 3


def test_batch_duplicate_ids_keep_copy_from_last_file(spark, lake):
    from claimlake.sources.landing import write_landing_csv

    root = f"{lake.root}/landing"
    write_landing_csv(spark.createDataFrame([("1", "from a"), ("2", "two")], "id string, terms string"), f"{root}/a", files=1)
    write_landing_csv(spark.createDataFrame([("1", "from b")], "id string, terms string"), f"{root}/b", files=1)
    bronze = m.to_bronze(spark, root, lake, run_ts=fx.RUN_TS)
    ptrs = sorted(r["terms"] for r in bronze.filter(F.col("id") == "1").collect())
    assert ptrs == ["s3://terms-bucket/terms/1.txt"] * 2
    store = {r["key"]: bytes(r["content"]).decode() for r in spark.table(lake.store_name).collect()}
    assert store == {"terms/1.txt": "from b", "terms/2.txt": "two"}


def test_landing_without_any_text(spark, lake):
    from claimlake.sources.landing import write_landing_csv

    root = f"{lake.root}/landing"
    write_landing_csv(spark.createDataFrame([("1", None), (None, None)], "id string, terms string"), f"{root}/a", files=1)
    gold = m.run_batch(spark, root, lake, run_ts=fx.RUN_TS)
    assert spark.table(lake.store_name).count() == 0
    assert spark.table(lake.bronze_name).count() == 2 and gold.count() == 0
    assert spark.table(lake.quarantine_name).count() == 2
    res = m.resolve_gold(spark, lake, max_rows=None)
    assert res.count() == 0


def test_malformed_measure_does_not_fail_ingest(spark, lake):
    from claimlake.sources.landing import write_landing_csv

    root = f"{lake.root}/landing"
    rows = spark.createDataFrame(
        [("1", "a", "1", "1", "false"), ("2", "b", "lots", "1", "maybe")],
        "id string, terms string, character_length string, utf8_byte_length string, "
        "exceeds_redshift_varchar_65535_bytes string",
    )
    write_landing_csv(rows, f"{root}/a", files=1)
    got = {r["id"]: (r["character_length"], r["exceeds_redshift_varchar_65535_bytes"]) for r in read_landing_csv(spark, root).collect()}
    assert got == {"1": (1, False), "2": (None, None)}


class _Recorder:
    """Stands in for DataFrameWriterV2 / DataFrame and records the calls made on it."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kw):
            self.calls.append((name, args))
            return self

        return call


def test_v2_writer_call_chain(spark):
    from claimlake.plans.tables import TableWriter

    w = TableWriter(134217728, "iceberg")
    df = _Recorder()
    w.replace(df, "`ice`.`lake`.`t`")
    names = [c[0] for c in df.calls]
    assert names == ["writeTo", "using", "tableProperty", "tableProperty", "createOrReplace"]
    assert ("tableProperty", ("write.target-file-size-bytes", "134217728")) in df.calls
    df2 = _Recorder()
    w.replace_bucketed(df2, "`ice`.`lake`.`store`", "key", 16)
    names2 = [c[0] for c in df2.calls]
    assert names2[:4] == ["repartition", "sortWithinPartitions", "writeTo", "using"]
    assert "partitionedBy" in names2 and names2[-1] == "createOrReplace"


def test_a_failed_replace_leaves_the_old_table(spark, lake):
    from claimlake.plans.tables import replace_bucketed_table, replace_table

    good = spark.range(10).select(F.col("id"), F.lit("x").alias("v"))
    broken = spark.range(10).select(F.col("id"), F.when(F.col("id") == 7, F.raise_error(F.lit("boom")).cast("string")).otherwise("y").alias("v"))
    for write in (replace_table, lambda df, n: replace_bucketed_table(df, n, "id", 2), lambda df, n: replace_table(df, n, rebalance=False)):
        name = lake.name(f"t{abs(hash(write)) % 10**6}")
        write(good, name)
        with pytest.raises(Exception, match="boom"):
            write(broken, name)
        assert [r["v"] for r in spark.table(name).collect()] == ["x"] * 10
        write(good.filter("id < 3"), name)
        assert spark.table(name).count() == 3
    assert not [t for t in spark.catalog.listTables(lake.database) if "__" in t.name]


def test_ragged_rows_stop_the_read_or_are_kept(spark, lake):
    root = lake.scratch("ragged")
    spark.createDataFrame([("id,terms\n1,a\n2,b,EXTRA\n3\n4,\\N\n",)], "value string").coalesce(1).write.option("lineSep", "\n").text(f"{root}/t")
    import glob
    import os

    os.makedirs(path := root.removeprefix("file:") + "/csv")
    part = glob.glob(root.removeprefix("file:") + "/t/part-*")[0]
    with open(part) as f, open(f"{path}/a.csv", "w") as out:
        out.write(f.read().rstrip("\n") + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_landing_csv(spark, path).collect()
    got = {r["id"]: (r["terms"], r["_ragged_line"]) for r in read_landing_csv(spark, path, keep_ragged=True).collect()}
    assert got["1"] == ("a", None) and got["4"] == ("\\N", None)
    assert got["2"][1] == "2,b,EXTRA" and got["3"][1] == "3"


def test_objects_of_any_name_are_read_by_manifest(spark, lake):
    from claimlake.sources import objects as obj

    rows = spark.createDataFrame([("b", k, bytearray(k.encode())) for k in ("_x.txt", ".y.txt", "t/_z/1.txt")] + [("b", "empty", bytearray(b""))], "bucket string, key string, content binary")
    manifest = obj.write_object_files(rows, f"{lake.root}/objects", lake.scratch("manifest"))
    got = {r["key"]: bytes(r["content"]) for r in obj.read_object_files(spark, f"{lake.root}/objects", manifest=manifest).collect()}
    assert got == {"_x.txt": b"_x.txt", ".y.txt": b".y.txt", "t/_z/1.txt": b"t/_z/1.txt", "empty": b""}
    bad = spark.createDataFrame([("b", "t/../../out.txt", bytearray(b"x"))], "bucket string, key string, content binary")
    with pytest.raises(Exception, match="does not name a file"):
        obj.write_object_files(bad, f"{lake.root}/objects", lake.scratch("manifest2"))


def _landing_files(lake, tag, files):
    import os

    root = f"{lake.root}/{tag}".removeprefix("file:")
    for name, content in files.items():
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w", newline="") as f:
            f.write(content)
    return root


def test_files_are_read_by_their_own_headers(spark, lake):
    from claimlake.sources.landing import header_layouts

    root = _landing_files(lake, "own", {
        "a b/1.csv": 'id,terms\n1,"x, ""y""\nz"\n2,␀NULL␀\n',
        "2.csv": '﻿"terms",id,extra\r\nfoo,3,m\r\n',
        "3.csv": "ID\n4\n",
        "4.csv": "",
        "5.csv": "id,terms\n",
        "6.txt": "id,terms\n9,no\n",
    })
    layouts = header_layouts(spark, root)
    assert [(h, len(f)) for h, f in layouts] == [(("id", "terms"), 2), (("terms", "id", "extra"), 1), (("ID",), 1)]
    got = read_landing_csv(spark, root, by_name=True, keep_ragged=True)
    assert got.columns == ["id", "terms", "extra", "_ragged_line", "_source_file"]
    rows = sorted((r["id"], r["terms"], r["extra"]) for r in got.select("id", "terms", "extra").fillna("-").collect())
    assert rows == [("1", 'x, "y"\nz', "-"), ("2", "-", "-"), ("3", "foo", "m"), ("4", "-", "-")]
    assert read_landing_csv(spark, _landing_files(lake, "none", {"x/1.csv": ""}), by_name=True).count() == 0


def test_ragged_rows_go_to_quarantine_and_the_rest_goes_on(spark, lake):
    root = _landing_files(lake, "landing", {"a/1.csv": "id,terms\n1,one\n2,two,EXTRA\n3\n4,four\n", "b/2.csv": "terms,id\nfive,5\n6\n"})
    gold = m.run_batch(spark, root, lake, run_ts=fx.RUN_TS)
    assert sorted(r["id"] for r in gold.collect()) == ["1", "4", "5"]
    aside = spark.table(lake.landing_quarantine_name).collect()
    assert sorted((r["_raw_line"], r["_dq_failed_checks"], r["_source_file"][-5:]) for r in aside) == [("2,two,EXTRA", "ragged_row", "1.csv"), ("3", "ragged_row", "1.csv"), ("6", "ragged_row", "2.csv")]
    assert m.all_quarantined(spark, lake).count() == 3
    assert [r["full_text"] for r in m.resolve_gold(spark, lake, ids=["5"]).collect()] == ["five"]
    layout = arrivals.run_stream(spark, f"{root}/a", lake, run_ts=fx.RUN_TS, columns=("id", "terms"))
    assert sorted(r["id"] for r in layout.table(spark, "gold").collect()) == ["1", "4"]
    assert sorted(r["_raw_line"] for r in layout.table(spark, "landing_quarantine").collect()) == ["2,two,EXTRA", "3"]


def test_no_staged_text_outlives_a_run_and_a_dead_run_is_run_again(spark, lake, monkeypatch):
    import os

    from claimlake.plans.tables import TableWriter

    root = _landing(spark, lake, SF001)
    staging = f"{lake.root}/_staging/landing".removeprefix("file:")
    replace = TableWriter.replace

    def dies(self, df, name, rebalance=True):
        if name == lake.bronze_name:
            raise RuntimeError("killed between store and bronze")
        return replace(self, df, name, rebalance)

    monkeypatch.setattr(TableWriter, "replace", dies)
    with pytest.raises(RuntimeError, match="killed"):
        m.to_bronze(spark, root, lake, run_ts=fx.RUN_TS)
    assert os.path.isdir(staging) and not spark.catalog.tableExists(lake.bronze_name)
    monkeypatch.setattr(TableWriter, "replace", replace)
    bronze = m.to_bronze(spark, root, lake, run_ts=fx.RUN_TS)
    assert not os.path.exists(staging)
    texts = bronze.filter("terms is not null").count()
    assert spark.table(lake.store_name).count() == texts and bronze.count() == fx.documents(spark, SF001).count()


def test_readers_always_find_gold_while_it_is_replaced(spark, lake):
    import threading

    from claimlake.plans import tables

    root = _landing(spark, lake, SF001)
    n = m.run_batch(spark, root, lake, run_ts=fx.RUN_TS).count()
    open_reader = spark.table(lake.gold_name)  # resolved at the first version
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(spark.table(lake.gold_name).count())
            except Exception as e:  # noqa: BLE001
                seen.append(e)

    readers = [threading.Thread(target=read) for _ in range(2)]
    for r in readers:
        r.start()
    try:
        for k in range(6):
            m.to_gold(spark, lake)
            if k == 0:
                assert open_reader.count() == n  # the version before stays for readers that are at it
    finally:
        done.set()
        for r in readers:
            r.join()
    assert len(seen) > 6 and set(map(str, seen)) == {str(n)}
    assert len(tables.published_versions(spark, lake.gold_name)) == 2
    spark.sql(f"DROP TABLE {lake.silver_name}")
    with pytest.raises(Exception, match="(?i)not.found"):
        m.to_gold(spark, lake)
    assert spark.table(lake.gold_name).count() == n and len(tables.published_versions(spark, lake.gold_name)) == 2


def test_a_plain_gold_table_becomes_versions(spark, lake):
    spark.range(3).write.saveAsTable(lake.gold_name)
    spark.range(5).write.saveAsTable(lake.silver_name)
    assert m.to_gold(spark, lake).count() == 5 and m.to_gold(spark, lake).count() == 5


def test_stream_folders_stay_few_over_many_batches(spark, lake):
    import os

    layout = arrivals.StreamLake(lake, fan_in=3)
    most = 0
    for k in range(28):
        rows = [(f"{k}-{i}", f"text {k} {i}") for i in range(2)] + [("again", f"copy {k}")]
        batch = spark.createDataFrame(rows, "id string, terms string").coalesce(1).withColumn("_source_file", F.lit(f"file:/x/landing/{k}.csv"))
        arrivals.process_batch(batch, k, layout, rules=None, run_ts=fx.RUN_TS)
        if k % 9 == 4:
            arrivals.process_batch(batch, k, layout, rules=None, run_ts=fx.RUN_TS)  # replay
        most = max(most, len(layout.folders(spark, "gold")))
    assert most <= 3 * 4
    on_disk = os.listdir(f"{lake.root}/stream/gold".removeprefix("file:"))
    assert len(on_disk) <= most + 3 * 3
    assert layout.table(spark, "bronze").count() == layout.table(spark, "gold").count() == 28 * 3
    store = {r["key"]: bytes(r["content"]).decode() for r in layout.current_store(spark).collect()}
    assert len(store) == 28 * 2 + 1 and store["terms/again.txt"] == "copy 27"


def test_sql_function_prunes_the_store_at_run_time(spark, lake):
    from claimlake.plans import tables

    rows = spark.range(3000).selectExpr("CAST(id AS STRING) AS id", "repeat(CONCAT('text ', id, ' '), 60) AS terms", "'f' AS _source_file")
    m.to_bronze(spark, rows, lake, run_ts=fx.RUN_TS)
    m.to_silver(spark, lake, run_ts=fx.RUN_TS)
    m.to_gold(spark, lake)
    fn = m.register_text_function(spark, lake)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = spark.sql(f"SELECT id, {fn}(terms) AS t FROM {lake.gold_name} WHERE id IN ('5', '77')")
        got = {r["id"]: r["t"] for r in few.collect()}
        plan = few._jdf.queryExecution().executedPlan().toString()
        whole = spark.sql(f"SELECT id, {fn}(terms) AS t FROM {lake.gold_name}")
        assert whole.filter("t = repeat(CONCAT('text ', id, ' '), 60)").count() == 3000
        bulk = whole._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {i: f"text {i} " * 60 for i in ("5", "77")}
    assert "dynamicpruning" in plan and "SortMergeJoin" in plan and "NestedLoop" not in plan
    assert "NestedLoop" not in bulk and bulk.split("== Initial Plan ==")[0].count("Exchange") == 1  # of the pointers alone
    # A store of another number of partitions is never looked up by a stale function.
    tables.replace_bucketed_table(spark.table(lake.store_name).select("bucket", "key", "content", "n_bytes").limit(2), lake.store_name, "key", 2)
    with pytest.raises(Exception, match="part_of_"):
        spark.sql(f"SELECT {fn}(terms) FROM {lake.gold_name}").collect()


def test_silver_and_quarantine_come_from_one_pass(spark, lake, monkeypatch):
    import os

    from claimlake.plans import tables

    rows = [(str(i) if i % 5 else None, f"text {i}", "f") for i in range(50)]
    m.to_bronze(spark, spark.createDataFrame(rows, "id string, terms string, _source_file string"), lake, run_ts=fx.RUN_TS)
    seen = []
    write = tables.replace_layers
    monkeypatch.setattr(tables, "replace_layers", lambda df, *a, **k: (seen.append(df), write(df, *a, **k)))
    silver, quarantine = m.to_silver(spark, lake, run_ts=fx.RUN_TS)
    assert (silver.count(), quarantine.count()) == (40, 10)
    assert "_dq_passed" not in silver.columns and quarantine.filter("_dq_passed").count() == 0
    assert len(seen) == 1 and seen[0]._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    # Without a failed row there is no such folder: the table is empty, with its columns.
    m.to_bronze(spark, spark.createDataFrame(rows[1:5], "id string, terms string, _source_file string"), lake, run_ts=fx.RUN_TS)
    open_reader = spark.table(lake.silver_name)
    again, none = m.to_silver(spark, lake, run_ts=fx.RUN_TS)
    assert (again.count(), none.count(), open_reader.count()) == (4, 0, 40) and none.columns == quarantine.columns
    # Other rules give other columns.
    _, other = m.to_silver(spark, lake, rules=fx.RULES_THREE, run_ts=fx.RUN_TS)
    assert "_dq_not_empty_terms" in other.columns and other.count() == 0
    # A write that fails leaves both tables, and no version of its own.
    with pytest.raises(Exception, match="(?i)divi"):
        frame = spark.table(lake.bronze_name).selectExpr("*", "1 div (length(id) - length(id)) AS x", "'silver' AS _dq_layer")
        with tables.sql_conf(spark, spark__sql__ansi__enabled="true"):
            write(frame, "_dq_layer", {"silver": (lake.silver_name, frame.columns[:-1])}, lake.layer_path(lake.silver))
    assert spark.table(lake.silver_name).count() == 4
    assert len(os.listdir(lake.layer_path(lake.silver).removeprefix("file:"))) == 2


def test_headers_are_found_where_the_session_holds_its_settings(spark, lake, monkeypatch):
    import contextlib

    from claimlake.sources import landing

    root = f"{lake.root}/held"
    for k in range(4):
        order = ("id", "terms") if k % 2 else ("terms", "id")
        rows = spark.range(300).selectExpr(f"CONCAT('{k}-', id) AS id", "CONCAT('a line of text ', id) AS terms").select(*order)
        rows.coalesce(1).write.option("header", "true").csv(f"{root}/{k}")
    usual = sorted((h, sorted(f)) for h, f in landing.header_layouts(spark, root))
    monkeypatch.setattr(landing, "sql_conf", lambda *a, **k: contextlib.nullcontext())
    for size, cost in (("2k", "0"), ("1m", "0")):  # split files; files that share a task
        with m.sql_conf(spark, spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes=cost):
            assert sorted((h, sorted(f)) for h, f in landing.header_layouts(spark, root)) == usual
    assert [h for h, _ in usual] == [("id", "terms"), ("terms", "id")] and [len(f) for _, f in usual] == [2, 2]
