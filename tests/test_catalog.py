"""Registered queries against their oracle SQL on the smallest data set."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT / "scripts"))
SF = Path("/root/testdata/sf0.001")

duckdb = pytest.importorskip("duckdb")
from verify import TABLES, canon  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

# One query per kind of plan; scripts/verify.py runs all of them.
CHOSEN = [
    "daily_sales_by_category", "daily_sales_as_sql_text", "customer_order_summary", "recon_orders_by_source",
    "latest_state_order_items", "state_as_of_half_log", "invalid_status_transitions", "order_age_quantiles",
    "counter_rate", "condition_held_for", "instant_values", "ingestion_stalled", "dashboard_metric_names",
    "typed_products", "replace_one_lake_day", "daily_chain", "streamed_ingest_current_orders",
    "compare_control_with_warehouse", "panel_cpu_used", "relationships_check", "orders_changed_by_digest",
    "alert_stretches_streamed", "silent_series_streamed",
]


@pytest.fixture(scope="module")
def oracle():
    if not SF.exists():
        pytest.skip("test data is not here")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_oracle(spark, oracle, name):
    df = entry.queries()[name](spark, str(SF))
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = oracle.execute(entry.oracle_sql()[name])
    assert got == canon([d[0] for d in cur.description], cur.fetchall())


def test_every_query_has_an_oracle():
    assert set(entry.catalog.QUERIES) == set(entry.catalog.ORACLES) <= set(entry.oracle_sql())


def test_flagship_query(spark):
    if not SF.exists():
        pytest.skip("test data is not here")
    assert entry.entry(spark).columns == ["day", "category", "orders", "items", "revenue"]
