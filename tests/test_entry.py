"""The driver contract: entry runs, every query has a DataFrame and (nearly) every one an
oracle, and a few queries agree with DuckDB on sf0.001."""
import re
import duckdb

import __spark_entry__ as SE

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    rows = SE.entry(spark).collect()
    assert {r.tier for r in rows} <= {"simple", "complex", "very_complex"}
    assert sum(r.n_references for r in rows) > 0


def test_every_query_has_an_oracle():
    own = {k for k in SE.queries() if not re.match(r"op\d+_|pipeline$", k)}   # training-data queries have tests of their own
    assert own == set(SE.oracle_sql()) & own and set(SE.oracle_sql()) <= set(SE.queries())


def test_some_queries_match_duckdb(spark):
    con = duckdb.connect()
    for t in ("orders", "nation", "region", "part", "supplier", "customer", "lineitem", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("tier_counts", "refs_sql", "mapping_load"):
        got = sorted(tuple(r) for r in SE.queries()[name](spark, SF).collect())
        res = con.execute(SE.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        spark_cols = SE.queries()[name](spark, SF).columns
        want = sorted(tuple(dict(zip(cols, r))[c] for c in spark_cols) for r in res.fetchall())
        assert got == want, name
