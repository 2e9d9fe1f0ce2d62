"""Every oracle statement runs in DuckDB on the smallest driver tables."""

import duckdb

import __spark_entry__ as entry_mod
from helpers import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
          "labels", "conversations"]


def test_all_oracles_run_in_duckdb():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    sqls = entry_mod.oracle_sql()
    assert set(sqls) <= set(entry_mod.queries())
    for name, sql in sqls.items():
        rel = con.sql(sql)
        assert len(rel.columns) == len(set(rel.columns)), name
        rel.fetchall()
