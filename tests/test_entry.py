import duckdb

import __spark_entry__ as ep
from conftest import SF001

FAST = ["scan_landing_csv", "annotate_checks", "parse_uri", "resolve_text", "resolve_row_cap", "filter_failed"]


def test_entry_runs(spark):
    df = ep.entry(spark)
    assert df.count() > 0
    assert "terms" in df.columns and "_silver_processed_at" in df.columns


def test_every_query_has_oracle_sql():
    own = set(ep.queries()) - set(ep.LLM_QUERIES)
    assert own <= set(ep.oracle_sql()) <= set(ep.queries())
    assert len(own) >= 42


def test_fast_queries_match_oracle(spark):
    con = duckdb.connect()
    for t in ("documents",):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    for key in FAST:
        df = ep.queries()[key](spark, SF001)
        rel = con.sql(ep.oracle_sql()[key])
        cols = sorted(df.columns)
        assert cols == sorted(rel.columns), key
        s = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
        d_rows = rel.fetchall()
        idx = [rel.columns.index(c) for c in cols]
        d = sorted(tuple(str(r[i]) for i in idx) for r in d_rows)
        assert s == d, key
