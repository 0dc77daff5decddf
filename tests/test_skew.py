"""Reports stay exact when one key holds a third of all rows.

A copy of the smallest data set is skewed: one person owns a third of the
orders, one product and one seller a third of the items, and one order a
third of the line items. The skew-sensitive reports (global ranks, per-person
sequences, top-k per group, fan-out weights, distinct counts) must still
match the DuckDB oracle.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck

KEYS = ["q6_4_orders_per_customer", "q6_7_customer_ltv", "q6_8_top_customers", "q6_10_purchase_sequence",
        "q7_rfm", "q8_4_top_products_qty", "q8_9_top3_per_category", "q9_4_seller_share", "q9_5_seller_lateness",
        "q12_5_score_by_category", "q14_3_value_quartiles", "q15_2_customer_summary_view", "q16_kpi_summary",
        "q16_kpi_order_weighted", "q2_3_dup_order_items", "q10_6_reconcile_totals", "dq_rule_report"]


@pytest.fixture(scope="module")
def skewed_dir():
    import tempfile
    out = tempfile.mkdtemp(prefix="marketlens-skew-", dir="/tmp")
    con = duckdb.connect()
    src = lambda t: f"read_parquet('{SF_SMALL}/{t}.parquet')"
    for t in ("region", "nation", "customer", "supplier", "part"):
        con.execute(f"COPY (SELECT * FROM {src(t)}) TO '{out}/{t}.parquet' (FORMAT parquet)")
    con.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0
                                             THEN (SELECT min(c_custkey) FROM {src('customer')}) ELSE o_custkey END
                                        AS o_custkey)
                  FROM {src('orders')}) TO '{out}/orders.parquet' (FORMAT parquet)""")
    con.execute(f"""COPY (SELECT * REPLACE (
                      CASE WHEN l_orderkey % 3 = 0 THEN (SELECT min(p_partkey) FROM {src('part')}) ELSE l_partkey END
                          AS l_partkey,
                      CASE WHEN l_orderkey % 3 = 1 THEN (SELECT min(s_suppkey) FROM {src('supplier')}) ELSE l_suppkey END
                          AS l_suppkey,
                      CASE WHEN l_linenumber % 3 = 0 THEN (SELECT min(o_orderkey) FROM {src('orders')}) ELSE l_orderkey END
                          AS l_orderkey)
                  FROM {src('lineitem')}) TO '{out}/lineitem.parquet' (FORMAT parquet)""")
    con.execute(f"COPY (SELECT * FROM {src('events')}) TO '{out}/events.parquet' (FORMAT parquet)")
    return out


@pytest.mark.parametrize("key", KEYS)
def test_skewed_matches_oracle(spark, skewed_dir, key):
    got = entry.queries()[key](spark, skewed_dir).toPandas()
    want = duck(skewed_dir).execute(entry.oracle_sql()[key]).df()
    assert compare(got, want) is None
