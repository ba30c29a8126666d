from pyspark.sql import functions as F

from claimlake.functions import text as T


def test_pointer_and_measures(spark):
    df = spark.createDataFrame([("1", "héllo"), (None, "x"), ("3", None), ("4", "")], "id string, terms string")
    rows = df.select("id", T.pointer("id", "terms", "b").alias("p"), *[v.alias(k) for k, v in T.measure_columns().items()]).collect()
    got = {r["id"]: tuple(r)[1:] for r in rows}
    assert got["1"] == ("s3://b/terms/1.txt", 5, 6, False)
    assert got[None][0] is None
    assert got["3"] == (None, None, None, None)
    assert got["4"] == ("s3://b/terms/4.txt", 0, 0, False)


def test_parse_uri(spark):
    data = [
        ("s3://bucket/terms/1.txt",),
        ("  s3://bucket/a/b/c.txt \t",),
        ("not-a-valid-uri",),
        ("s3://bucket/",),
        ("s3:///key",),
        ("   ",),
        (None,),
    ]
    df = spark.createDataFrame(data, "u string")
    got = [(r[0], r[1]) for r in df.select(T.pointer_bucket("u"), T.pointer_key("u")).collect()]
    assert got == [
        ("bucket", "terms/1.txt"),
        ("bucket", "a/b/c.txt"),
        ("", ""),
        ("", ""),
        ("", ""),
        ("", ""),
        (None, None),
    ]


def test_utf8_helpers(spark):
    df = spark.createDataFrame([(bytearray(b"\xc3\x28"),), (bytearray("é".encode()),)], "c binary")
    got = [(r[0], r[1]) for r in df.select(T.is_utf8("c"), T.utf8_text("c")).collect()]
    assert got == [(False, None), (True, "é")]


def test_thousands(spark):
    assert spark.range(1).select(T.with_thousands(F.lit(61234))).first()[0] == "61,234"


def test_pointer_strip_and_line_ends_follow_python(spark):
    import re

    cases = [" s3://b/k.txt　", "\x1cs3://b/k x.txt", "s3://b/a\rb", "s3://b/a\nb", "  \t"]
    py = re.compile(T.POINTER_PATTERN)
    want = []
    for c in cases:
        mt = py.match(c.strip())
        want.append((mt.group(1), mt.group(2)) if mt else ("", ""))
    df = spark.createDataFrame([(c,) for c in cases], "u string")
    got = [(r[0], r[1]) for r in df.select(T.pointer_bucket("u"), T.pointer_key("u")).collect()]
    assert got == want
