"""Ordered, limited and sampled results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalar as S


def mart_day(mart: DataFrame, day: str) -> DataFrame:
    """One day of the sales mart, best category first."""
    return mart.filter(S.in_day("day", day)).orderBy(F.col("revenue").desc(), "category")


def mart_recent(mart: DataFrame, n: int = 20) -> DataFrame:
    """Newest rows of the sales mart."""
    return mart.orderBy(F.col("day").desc(), F.col("revenue").desc(), "category").limit(n)


def top_customers(summary: DataFrame, n: int = 25) -> DataFrame:
    """Customers by lifetime value."""
    return (
        summary.select("customer_id", "country_code", "lifetime_value")
        .orderBy(F.col("lifetime_value").desc(), "customer_id")
        .limit(n)
    )


def recon_recent(recon: DataFrame, n: int = 30) -> DataFrame:
    """Newest days of the reconciliation."""
    return recon.orderBy(F.col("order_date").desc()).limit(n)


def topk(df: DataFrame, k: int, by: str, per: list[str], tiebreak: list[str]) -> DataFrame:
    """The k largest rows of each group; the rank limit is applied before the shuffle."""
    ranked = Window.partitionBy(*per).orderBy(F.col(by).desc(), *tiebreak)
    return df.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def latest_day(orders: DataFrame, created: str = "created_at") -> DataFrame:
    """The newest day that has data."""
    return orders.agg(F.to_date(F.max(created)).alias("day"))


def sample_k(df: DataFrame, k: int, key: str, seed: int = 0) -> DataFrame:
    """k rows in a repeatable random order of their key."""
    return df.orderBy(shuffled(key, seed), key).limit(k)


def shuffled(key: str, seed: int) -> Column:
    """A repeatable pseudo-random sort key."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
