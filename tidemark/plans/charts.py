"""The dashboard's charts as queries over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.metric_layer import aggregate_query, raw_query

# Chart name, dataset and what it shows.
CHARTS: dict[str, dict] = {
    "Revenue": {"dataset": "daily_sales_by_category", "metrics": ["revenue"]},
    "Orders": {"dataset": "daily_sales_by_category", "metrics": ["orders"]},
    "Average order value": {"dataset": "daily_sales_by_category", "metrics": ["avg_order_value"]},
    "Customers who have ordered": {"dataset": "customer_order_summary", "metrics": ["buyers"]},
    "Revenue by day": {
        "dataset": "daily_sales_by_category", "metrics": ["revenue"],
        "time_column": "day", "grain": "P1D", "order_by": [("day", False)],
    },
    "Revenue by category": {
        "dataset": "daily_sales_by_category", "metrics": ["revenue"], "groupby": ["category"],
        "order_by": [("revenue", True), ("category", False)],
    },
    "Top customers": {
        "dataset": "customer_order_summary", "metrics": ["lifetime_value"],
        "groupby": ["customer_id", "country_code"], "limit": 25,
        "order_by": [("lifetime_value", True), ("customer_id", False)],
    },
    "Warehouse against its source": {
        "dataset": "recon_orders_by_source",
        "columns": ["order_date", "pg_orders", "cdc_orders", "s3_orders", "cdc_minus_pg", "verdict"],
        "order_by": [("order_date", True)], "limit": 30,
    },
}


def chart(name: str, datasets: dict[str, DataFrame]) -> DataFrame:
    """Run one chart over the marts it may refer to."""
    spec = dict(CHARTS[name])
    dataset = spec.pop("dataset")
    if "columns" in spec:
        return raw_query(datasets[dataset], **spec)
    return aggregate_query(datasets[dataset], dataset, **spec)


def dangling_charts(charts: DataFrame, datasets: DataFrame) -> DataFrame:
    """Charts that point at a dataset which does not exist."""
    return charts.join(datasets.select("dataset"), "dataset", "left_anti")
