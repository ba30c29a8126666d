import pytest
from pyspark.sql import functions as F

from claimlake.operators import claimcheck as cc
from claimlake.plans import fixtures as fx
from conftest import SF01

BUCKET = "bucket"


def _store(spark, lake, objs):
    rows = spark.createDataFrame(
        [(BUCKET, k, bytearray(v)) for k, v in objs], "bucket string, key string, content binary"
    ).withColumn("n_bytes", F.octet_length("content").cast("bigint"))
    cc.write_store(rows, lake.store_name)
    return spark.table(lake.store_name)


def test_request_of_four_pointers(spark, lake):
    store = _store(spark, lake, [("terms/1.txt", "one".encode()), ("terms/2.txt", "two".encode())])
    ptrs = spark.createDataFrame(
        [(1, "s3://bucket/terms/1.txt"), (2, "s3://bucket/terms/2.txt"), (3, None), (4, "not-a-valid-uri")],
        "i int, u string",
    )
    got = {r["i"]: (r["status"], r["full_text"], r["message"]) for r in cc.resolve_text(ptrs, "u", store, bucket=BUCKET).collect()}
    assert got[1] == ("ok", "one", None)
    assert got[2] == ("ok", "two", None)
    assert got[3][0] == "missing_pointer" and got[3][2]
    assert got[4][0] == "malformed" and "not-a-valid-uri" in got[4][2]


def test_row_cap_exactly_and_one_over(spark, lake):
    store = _store(spark, lake, [("terms/1.txt", b"x")])
    for n, expect in ((100, "ok"), (101, "too_many")):
        ptrs = spark.range(n).select(F.lit("s3://bucket/terms/1.txt").alias("u"))
        statuses = {r[0] for r in cc.resolve_text(ptrs, "u", store, bucket=BUCKET, max_rows=100).select("status").collect()}
        assert statuses == {expect}, n


def test_size_at_cap_and_one_over(spark, lake):
    store = _store(spark, lake, [("a", b"x" * 10), ("b", b"x" * 11)])
    ptrs = spark.createDataFrame([("s3://bucket/a",), ("s3://bucket/b",)], "u string")
    got = {r["u"]: (r["status"], r["n_bytes"], r["message"]) for r in cc.resolve_text(ptrs, "u", store, bucket=BUCKET, max_bytes=10).collect()}
    assert got["s3://bucket/a"][:2] == ("ok", 10)
    assert got["s3://bucket/b"][:2] == ("too_large", 11)
    assert "11 bytes" in got["s3://bucket/b"][2]


def test_no_store_not_found_undecodable(spark, lake):
    store = _store(spark, lake, [("bad", b"\xc3\x28")])
    ptrs = spark.createDataFrame([("s3://other/x",), ("s3://bucket/missing",), ("s3://bucket/bad",), ("",)], "u string")
    got = {r["u"]: r["status"] for r in cc.resolve_text(ptrs, "u", store, bucket=BUCKET).collect()}
    assert got == {"s3://other/x": "no_store", "s3://bucket/missing": "not_found", "s3://bucket/bad": "undecodable", "": "missing_pointer"}


def test_duplicate_keys_keep_latest(spark, lake):
    rows = spark.createDataFrame(
        [(BUCKET, "k", bytearray(b"old"), 3, "f1", 1), (BUCKET, "k", bytearray(b"new"), 3, "f2", 0), (BUCKET, "j", bytearray(b"j"), 1, "f1", 2)],
        "bucket string, key string, content binary, n_bytes bigint, src string, ord bigint",
    )
    stats = cc.write_store(rows, lake.store_name, order=["src", "ord"])
    assert stats["max_copies"] == 2
    got = {r["key"]: bytes(r["content"]) for r in spark.table(lake.store_name).collect()}
    assert got == {"k": b"new", "j": b"j"}


def test_duplicate_keys_without_order_fail(spark, lake):
    rows = spark.createDataFrame([(BUCKET, "k", bytearray(b"a"), 1)] * 2, "bucket string, key string, content binary, n_bytes bigint")
    with pytest.raises(ValueError):
        cc.write_store(rows, lake.store_name)


@pytest.mark.parametrize("max_rows", [None])
def test_fixture_statuses_sf001(spark, lake, max_rows):
    docs = fx.documents(spark, SF01)
    cc.write_store(fx.store_rows(docs), lake.store_name)
    res = cc.resolve_text(fx.pointer_rows(docs), "u", spark.table(lake.store_name), bucket="terms-bucket", max_rows=max_rows, max_bytes=5000)
    got = {r["status"]: r["count"] for r in res.groupBy("status").count().collect()}
    assert got == {"ok": 533, "malformed": 118, "not_found": 99, "missing_pointer": 94, "no_store": 72, "too_large": 63, "undecodable": 21}


def test_capped_path_broadcasts_and_pushes_keys(spark, lake):
    store = _store(spark, lake, [("terms/1.txt", b"one")])
    ptrs = spark.createDataFrame([("s3://bucket/terms/1.txt",)], "u string")
    res = cc.resolve_text(ptrs, "u", store, bucket=BUCKET)
    assert "BroadcastHashJoin" in res._jdf.queryExecution().executedPlan().toString()
    assert [r["full_text"] for r in res.collect()] == ["one"]


def test_hot_key_split_gives_same_rows(spark, lake):
    store = _store(spark, lake, [(f"k{i}", f"text {i}".encode()) for i in range(50)])
    hot = [("s3://bucket/k0",)] * 300
    cold = [(f"s3://bucket/k{i % 60}",) for i in range(300)]
    ptrs = spark.createDataFrame(hot + cold + [(None,), ("junk",)], "u string")
    split = cc.resolve_text(ptrs, "u", store, bucket=BUCKET, max_rows=None)
    plain = cc.resolve_text(ptrs, "u", store, bucket=BUCKET, max_rows=None, hot_times=None)
    assert split.count() == 602
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "BroadcastHashJoin" in plan
    assert cc.hot_keys(ptrs.select(F.regexp_extract("u", "^s3://[^/]+/(.+)$", 1).alias("k")), "k", 0.25) == ["k0"]


def test_resolve_against_object_files(spark, lake):
    from claimlake.sources import objects as obj

    rows = spark.createDataFrame(
        [(BUCKET, "terms/1.txt", bytearray(b"one")), (BUCKET, "terms/2.txt", bytearray(b"x" * 50)), (BUCKET, "terms/3.txt", bytearray(b""))],
        "bucket string, key string, content binary",
    )
    root = f"{lake.root}/objects"
    manifest = obj.write_object_files(rows, root, lake.scratch("manifest"))
    store = obj.read_object_files(spark, root, manifest=manifest, max_bytes=10)
    ptrs = spark.createDataFrame([("s3://bucket/terms/1.txt",), ("s3://bucket/terms/2.txt",), ("s3://bucket/terms/3.txt",), ("s3://bucket/terms/4.txt",)], "u string")
    got = {r["u"][-5:]: (r["status"], r["full_text"], r["n_bytes"]) for r in cc.resolve_text(ptrs, "u", store, bucket=BUCKET, max_bytes=10).collect()}
    assert got == {"1.txt": ("ok", "one", 3), "2.txt": ("too_large", None, 50), "3.txt": ("ok", "", 0), "4.txt": ("not_found", None, None)}


def test_resolve_files_statuses(spark, lake):
    from claimlake.sources import objects as obj

    rows = spark.createDataFrame(
        [(BUCKET, "terms/1.txt", bytearray(b"one")), (BUCKET, "terms/big.txt", bytearray(b"x" * 50)), (BUCKET, "terms/bad.txt", bytearray(b"\xc3\x28"))],
        "bucket string, key string, content binary",
    )
    root = f"{lake.root}/objects"
    obj.write_object_files(rows, root, lake.scratch("manifest"))
    ptrs = spark.createDataFrame(
        [("s3://bucket/terms/1.txt",), ("s3://bucket/terms/1.txt",), ("s3://bucket/terms/big.txt",), ("s3://bucket/terms/bad.txt",),
         ("s3://bucket/terms/none.txt",), ("s3://bucket/terms",), ("s3://nobucket/terms/1.txt",), ("oops",), (None,)],
        "u string",
    )
    res = cc.resolve_files(ptrs, "u", root, max_bytes=10)
    got = sorted((r["u"] or "", r["status"], r["full_text"], r["n_bytes"]) for r in res.collect())
    assert got == sorted([
        ("s3://bucket/terms/1.txt", "ok", "one", 3), ("s3://bucket/terms/1.txt", "ok", "one", 3),
        ("s3://bucket/terms/big.txt", "too_large", None, 50), ("s3://bucket/terms/bad.txt", "undecodable", None, 2),
        ("s3://bucket/terms/none.txt", "not_found", None, None), ("s3://bucket/terms", "not_found", None, None),
        ("s3://nobucket/terms/1.txt", "no_store", None, None), ("oops", "malformed", None, None), ("", "missing_pointer", None, None),
    ])
    bulk = cc.resolve_files(ptrs, "u", root, max_rows=None, max_bytes=10)
    assert bulk.exceptAll(res).count() == 0


def test_read_errors_become_statuses():
    import errno

    from claimlake.sources.objects import classify_error

    assert classify_error(PermissionError(errno.EACCES, "x")) == "access_denied"
    assert classify_error(IsADirectoryError(errno.EISDIR, "x")) == "error:EISDIR"
    assert classify_error(RuntimeError("boom")) == "error:RuntimeError"


def test_capped_path_without_size_cap_checks_broadcast_size(spark, lake):
    store = _store(spark, lake, [("a", b"x" * 100), ("b", b"y" * 100)])
    ptrs = spark.createDataFrame([("s3://bucket/a",), ("s3://bucket/b",)], "u string")
    small = cc.resolve_text(ptrs, "u", store, bucket=BUCKET, max_bytes=None, hot_broadcast_bytes=1000)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    with_limit = cc.resolve_text(ptrs, "u", store, bucket=BUCKET, max_bytes=None, hot_broadcast_bytes=150)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in with_limit._jdf.queryExecution().executedPlan().toString()
        assert {r["status"] for r in with_limit.collect()} == {"ok"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bulk_plan_shuffles_only_the_pointer_side(spark, lake):
    """The plan used when the store is too big to broadcast: the bucketed store is read in
    place (no Exchange above its scan); only the pointers are shuffled to its buckets."""
    store = _store(spark, lake, [(f"terms/{i}.txt", b"t" * 10) for i in range(64)])
    ptrs = spark.createDataFrame([(f"s3://bucket/terms/{i}.txt",) for i in range(64)], "u string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        res = cc.resolve_text(ptrs, "u", store, bucket=BUCKET, max_rows=None, hot_times=None)
        plan = res._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Bucketed: true" in plan
        store_side = plan[plan.index("SortMergeJoin"):]
        # exactly one Exchange under the join: the pointer side
        assert store_side.count("Exchange hashpartitioning") == 1
        assert {r["status"] for r in res.collect()} == {"ok"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keep_latest_is_the_same_whichever_way_it_joins(spark):
    data = [(b, "k", "f1", i) for i in range(50) for b in "xy"] + [("x", "k", "f2", 3), ("x", "j", "f1", 9), ("x", "i", "f0", 1), ("x", "i", "f0", 2)]
    data += [("x", "n", None, 1), ("x", "n", None, None), ("x", "t", "f", 1), ("x", "t", "f", 1), ("x", "m", None, None), ("x", "m", None, None)]
    rows = spark.createDataFrame(data, "bucket string, key string, src string, ord int")
    small = cc.keep_latest(rows, ["src", "ord"], winner_bytes=10)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    want = {("x", "k", "f2", 3), ("y", "k", "f1", 49), ("x", "j", "f1", 9), ("x", "i", "f0", 2), ("x", "n", None, 1), ("x", "t", "f", 1), ("x", "m", None, None)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = cc.keep_latest(rows, ["src", "ord"], winner_bytes=10, broadcast_bytes=0)
        assert "SortMergeJoin" in big._jdf.queryExecution().executedPlan().toString()
        for got in (small.collect(), big.collect()):
            assert len(got) == len(want) and {tuple(r) for r in got} == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tied_versions_keep_one_copy_in_each_bucket(spark, lake):
    data = [(b, "k", bytearray(t), 1) for b in ("b1", "b2") for t in (b"one", b"two", b"two")]
    rows = spark.createDataFrame(data, "bucket string, key string, content binary, version int").withColumn("n_bytes", F.lit(1).cast("bigint"))
    cc.write_store(rows, lake.store_name, order=["version"])
    got = spark.table(lake.store_name).collect()
    assert sorted(r["bucket"] for r in got) == ["b1", "b2"] and {r["n_bytes"] for r in got} == {3}
    assert len({bytes(r["content"]) for r in got}) == 1


def test_nothing_is_limited_unless_asked(spark, lake):
    store = _store(spark, lake, [("big", b"x" * 70_000)])
    ptrs = spark.range(150).select(F.lit("s3://bucket/big").alias("u"))
    got = cc.resolve_text(ptrs, "u", store, bucket=BUCKET).collect()
    assert len(got) == 150 and all(r["status"] == "ok" and len(r["full_text"]) == 70_000 for r in got)


def test_own_columns_are_not_hidden(spark, lake):
    store = _store(spark, lake, [("a", b"x")])
    with pytest.raises(ValueError, match="status"):
        cc.resolve_text(spark.createDataFrame([("s3://bucket/a", "MINE")], "u string, status string"), "u", store, bucket=BUCKET)


def test_hot_keys_too_large_to_broadcast_are_joined_in_parts(spark, lake):
    store = _store(spark, lake, [(f"k{i}", f"text {i}".encode()) for i in range(50)])
    ptrs = spark.range(4000).select(F.concat(F.lit("s3://bucket/k"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 60).cast("string")).alias("u"))
    parts = cc.resolve_text(ptrs, "u", store, bucket=BUCKET, hot_times=1, hot_broadcast_bytes=0)
    plain = cc.resolve_text(ptrs, "u", store, bucket=BUCKET, hot_times=None)
    assert "__part" in parts._jdf.queryExecution().optimizedPlan().toString()
    assert parts.count() == 4000 and parts.exceptAll(plain).count() == 0 and plain.exceptAll(parts).count() == 0


def test_capped_path_prunes_store_buckets(spark, lake):
    rows = spark.createDataFrame(
        [(BUCKET, f"terms/{i}.txt", bytearray(f"t{i}".encode())) for i in range(400)], "bucket string, key string, content binary"
    ).withColumn("n_bytes", F.octet_length("content").cast("bigint"))
    cc.write_store(rows, lake.store_name, num_buckets=16)
    store = spark.table(lake.store_name)
    hits = store.filter(F.col("key").isin(["terms/1.txt", "terms/7.txt"])).select("key", "content")
    fetched = cc._fetch_hits(hits)
    assert sorted(r["key"] for r in fetched.collect()) == ["terms/1.txt", "terms/7.txt"]
    with cc.sql_conf(spark, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
        plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 2 out of 16" in plan


def test_object_paths_with_special_characters(spark, lake):
    from claimlake.sources import objects as obj

    assert obj.arrow_uri("s3a://b/x") == "s3://b/x" and obj.arrow_uri("/tmp/x") == "/tmp/x"
    rows = spark.createDataFrame([(BUCKET, "terms/1.txt", bytearray(b"one"))], "bucket string, key string, content binary")
    root = f"{lake.root}/obj (v1)+x.y"  # regex-special characters in the root path
    manifest = obj.write_object_files(rows, root, lake.scratch("manifest"))
    got = [(r["bucket"], r["key"], bytes(r["content"])) for r in obj.read_object_files(spark, root, manifest=manifest).collect()]
    assert got == [(BUCKET, "terms/1.txt", b"one")]


def test_bulk_keyless_rows_skip_the_join(spark, lake):
    store = _store(spark, lake, [(f"terms/{i}.txt", b"x") for i in range(20)])
    ptrs = spark.createDataFrame([(None,)] * 30 + [("junk",)] * 30 + [("s3://other/k",)] * 5 + [(f"s3://bucket/terms/{i}.txt",) for i in range(25)], "u string")
    res = cc.resolve_text(ptrs, "u", store, bucket=BUCKET, max_rows=None)
    got = {r["status"]: r["count"] for r in res.groupBy("status").count().collect()}
    assert got == {"missing_pointer": 30, "malformed": 30, "no_store": 5, "ok": 20, "not_found": 5}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cc.resolve_text(ptrs, "u", store, bucket=BUCKET, max_rows=None, hot_times=None)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Union" in plan and "SortMergeJoin" in plan  # keyless rows go around the join


def test_store_with_two_buckets_matches_the_right_one(spark, lake):
    rows = spark.createDataFrame(
        [(BUCKET, "k", bytearray(b"mine")), ("other", "k", bytearray(b"theirs"))], "bucket string, key string, content binary"
    ).withColumn("n_bytes", F.octet_length("content").cast("bigint"))
    rows.write.saveAsTable(lake.name("two_buckets"))
    store = spark.table(lake.name("two_buckets"))
    ptrs = spark.createDataFrame([("s3://bucket/k",)], "u string")
    for max_rows in (100, None):
        got = [r["full_text"] for r in cc.resolve_text(ptrs, "u", store, bucket=BUCKET, max_rows=max_rows).collect()]
        assert got == ["mine"], max_rows


def test_hot_keys_filters_false_candidates(spark):
    uniform = spark.range(5000).select((F.col("id") % 1000).cast("string").alias("k"))
    assert cc.hot_keys(uniform, "k", 0.01) == []
    skewed = uniform.unionByName(spark.range(3000).select(F.lit("hot").alias("k")))
    assert cc.hot_keys(skewed, "k", 0.01) == ["hot"]


def test_ship_package_once_per_application(spark):
    from claimlake import session

    session.ship_package(spark)
    session.ship_package(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED


def test_hot_keys_get_parts_by_their_own_counts(spark, lake):
    """One key with 30 % and some with about 0.1 % of the pointers: whole results, balanced tasks."""
    texts = spark.range(900).selectExpr("'terms-bucket' AS bucket", "concat('k', id) AS key", "CAST(concat('text ', id) AS BINARY) AS content").withColumn("n_bytes", F.octet_length("content").cast("bigint"))
    cc.write_store(texts, lake.store_name)
    u = "concat('s3://terms-bucket/k', CASE WHEN id % 10 < 3 THEN 0 ELSE id % 890 + 1 END)"
    ptrs = spark.range(20000).selectExpr("id", f"{u} AS u")
    store = spark.table(lake.store_name)
    counts, total = cc.hot_key_counts(ptrs.selectExpr("substr(u, 19) AS k"), "k", 0.01)
    assert counts == {"k0": 6000} and total == 20000
    few = cc.resolve_text(ptrs, "u", store, bucket="terms-bucket")
    cut = cc.resolve_text(ptrs, "u", store, bucket="terms-bucket", hot_broadcast_bytes=0)
    for out in (few, cut):
        assert out.filter("status = 'ok' AND full_text = concat('text ', regexp_extract(u, '[0-9]+$', 0))").count() == 20000
    sizes = [r["n"] for r in cut.filter("u like '%/k0'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 6000
