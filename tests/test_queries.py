"""A few registered queries beside their SQL on the smallest tables; check_queries.py runs them all."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FEW = ["s2_calendar", "p1_tolerant_projection", "p3_narrow_types", "p4_label_codes", "j9_calendar_lags", "a13_store_performance", "w10_partition_median"]


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries()) and len(queries()) > 100


def test_entry_reports_every_level(spark):
    assert {r["level"] for r in entry(spark).collect()} >= {"item_store", "store", "total"}


@pytest.mark.parametrize("name", FEW)
def test_query_equals_sql(spark, tables, name):
    con = duckdb.connect()
    for t in ("region", "nation", "supplier", "part", "lineitem", "orders", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet'")
    df = queries()[name](spark, tables)
    cols = sorted(df.columns)
    text = lambda rows: sorted(str([f"{v:.6f}" if isinstance(v, float) else v for v in r]) for r in rows)
    want = con.sql(oracle_sql()[name]).select(*[f'"{c}"' for c in cols]).fetchall()
    assert text([tuple(r) for r in df.select(*cols).collect()]) == text(want)
