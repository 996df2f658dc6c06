"""Named metrics, defined once per dataset, and queries that refer to them by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as S

# Time grains by their ISO-8601 duration.
GRAINS = {"P1D": "DAY", "P1W": "WEEK", "P1M": "MONTH", "P3M": "QUARTER", "P1Y": "YEAR", "PT1H": "HOUR"}


@dataclass(frozen=True)
class Metric:
    title: str
    expression: Callable[[], Column]
    number_format: str
    description: str = ""


def _sum(column: str) -> Callable[[], Column]:
    return lambda: F.sum(column)


def _count_where(predicate: Callable[[], Column]) -> Callable[[], Column]:
    return lambda: F.count_if(predicate())


DATASETS: dict[str, dict[str, Metric]] = {
    "daily_sales_by_category": {
        "revenue": Metric("Revenue", _sum("revenue"), ",.2f", "Cancelled orders are left out."),
        "orders": Metric("Orders", _sum("orders"), ",d"),
        "items": Metric("Items sold", _sum("items"), ",d"),
        "avg_order_value": Metric(
            "Average order value", lambda: S.ratio_of_sums("revenue", "orders"), ",.2f",
            "Ratio of the sums, so busy days weigh more than quiet ones.",
        ),
    },
    "customer_order_summary": {
        "customers": Metric("Customers", lambda: F.count(F.lit(1)), ",d"),
        "lifetime_value": Metric("Lifetime value", _sum("lifetime_value"), ",.2f"),
        "buyers": Metric(
            "Customers who have ordered", _count_where(lambda: F.col("orders_placed") > 0), ",d",
            "The rest of the customers never ordered.",
        ),
    },
    "recon_orders_by_source": {
        "days_checked": Metric("Days checked", lambda: F.count(F.lit(1)), ",d"),
        "days_diverged": Metric(
            "Days diverged", _count_where(lambda: F.col("verdict") == "DIVERGED"), ",d",
            "Zero is the expected value.",
        ),
    },
}


def metric(dataset: str, name: str) -> Column:
    """The aggregate of a named metric, carrying its format as column metadata."""
    m = DATASETS[dataset][name]
    return m.expression().alias(name, metadata={"title": m.title, "format": m.number_format})


def aggregate_query(
    df: DataFrame,
    dataset: str,
    metrics: list[str],
    groupby: list[str] | tuple[str, ...] = (),
    order_by: list[tuple[str, bool]] | tuple = (),
    limit: int | None = None,
    time_column: str | None = None,
    grain: str | None = None,
) -> DataFrame:
    """Metrics by group; ``order_by`` lists (column, descending). All groups, unless ``limit`` says otherwise."""
    groups: list = list(groupby)
    if time_column:
        ts = F.col(time_column)
        if grain:
            ts = F.date_trunc(GRAINS[grain], ts)
            ts = ts if grain.startswith("PT") else ts.cast("date")
        groups.insert(0, ts.alias(time_column))
    out = df.groupBy(*groups).agg(*[metric(dataset, m) for m in metrics])
    return _limited(_ordered(out, order_by), limit)


def raw_query(
    df: DataFrame,
    columns: list[str],
    order_by: list[tuple[str, bool]] | tuple = (),
    limit: int | None = None,
) -> DataFrame:
    """Plain rows of a dataset: all of them, unless ``limit`` says otherwise."""
    return _limited(_ordered(df.select(*columns), order_by), limit)


def _limited(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def _ordered(df: DataFrame, order_by) -> DataFrame:
    if not order_by:
        return df
    return df.orderBy(*[F.col(c).desc() if desc else F.col(c).asc() for c, desc in order_by])
