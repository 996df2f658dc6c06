"""Aggregations that are more than a single built-in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import shared_dir


def dedup_then_sum(df: DataFrame, group: str, replica: str, value: str) -> DataFrame:
    """Copies of a group counted once: the latest figure of each copy, then the largest copy."""
    per_copy = df.groupBy(group, replica).agg(F.max(value).alias("_v"))
    return per_copy.groupBy(group).agg(
        F.max("_v").alias("value"), F.count(F.lit(1)).alias("replicas")
    )


def total_over_groups(df: DataFrame, group: str, replica: str, value: str) -> DataFrame:
    """Sum over groups of the largest copy, so that copies do not double the total."""
    return dedup_then_sum(df, group, replica, value).agg(F.sum("value").alias("value"))


def status_breakdown(orders: DataFrame, status: str = "status") -> DataFrame:
    """Rows per status, most frequent first."""
    counted = orders.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), status)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables in one result."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def day_last_change(orders: DataFrame, day: str = "order_date", changed: str = "updated_at") -> DataFrame:
    """When any order of a day last changed."""
    return orders.groupBy(F.col(day).alias("day")).agg(F.max(changed).alias("last_changed_at"))


def closed_days(orders: DataFrame, computed_at: Column) -> DataFrame:
    """Days with no order changed since a mart was computed. A past day is not closed by age."""
    return day_last_change(orders).filter(F.col("last_changed_at") < computed_at)


def ingest_progress(df: DataFrame, by: str, messages: str, polled: str, consumer: str) -> DataFrame:
    """Consumers, messages read and latest poll per table, over all nodes.

    ``messages`` is a running total per consumer, so the largest one counts.
    """
    per_consumer = df.groupBy(by, consumer).agg(
        F.max(messages).alias("_m"), F.max(polled).alias("_p")
    )
    return per_consumer.groupBy(by).agg(
        F.count(F.lit(1)).alias("consumers"),
        F.sum("_m").alias("messages_read"),
        F.max("_p").alias("last_poll"),
    )


# The quantiles kept of every duration.
QUANTILES = (0.5, 0.9, 0.99)


# A window orders at most about this many different values; a sketch keeps about this many items.
WINDOW_VALUES = 100_000
SKETCH_ITEMS = 1_000
# A bracket reaches one to two of so many steps of the ranks to each side; a sketch of 1000 items errs by half a step.
STEPS = 200


def quantiles(
    df: DataFrame, col: str, by: list[str], accuracy: int | None = None, most: int = WINDOW_VALUES
) -> DataFrame:
    """Median, 0.9 and 0.99 quantile per group; with ``accuracy`` from a bounded sketch.

    Without it the values are exact nearest-rank quantiles, and no window ever
    holds more than about ``most`` values. A larger group is bracketed: a
    mergeable quantile sketch gives two values around each wanted rank, one
    pass counts the rows below, between and above them exactly, and the segment
    that holds the rank is the next bracket. That repeats until a bracket has
    few values, whatever their distribution; a bad sketch costs a round, not
    the result. Only bracketed rows are shuffled. Null values are left out, NaN
    is the largest value, null group keys are a group.
    """
    if accuracy is not None:
        return df.groupBy(*by).agg(
            *[F.percentile_approx(col, p, accuracy).alias(_quantile_name(p)) for p in QUANTILES]
        )
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    # Every pass reads these two columns; what makes them runs once.
    rows = _written(df.filter(F.col(col).isNotNull()).select(group.alias("_g"), F.col(col).alias("_v")), "values")
    bounds = [F.lit(None).cast(rows.schema["_v"].dataType).alias(c) for c in ("_from", "_to")]
    whole = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_total")).select(
        "_g", "_total", F.lit(0).cast("bigint").alias("_rank"), F.lit(0).cast("bigint").alias("_below"),
        F.col("_total").alias("_inside"), *bounds, F.col("_total").alias("_kinds"))
    closed = whole
    if (whole.agg(F.max("_inside")).first()[0] or 0) > most:
        parts = _written(whole, "brackets")
        closed = parts.filter(_few(most))
        opened = parts.filter(~_few(most)).withColumn(
            "_rank", F.explode(F.array(*[F.ceil(F.lit(p) * F.col("_total")) for p in QUANTILES])))
        while not opened.isEmpty():
            parts = _written(_tighter(rows, opened), "brackets")
            closed = closed.unionByName(parts.filter(_few(most)))
            opened = parts.filter(~_few(most))
    part = ["_g", "_total", "_rank", "_below"]
    ordered = _inside(rows, closed.select(*part, "_from", "_to")).groupBy(*part, "_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.col("_below") + F.sum("_n").over(
        Window.partitionBy(*part).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    return ordered.withColumn("_upto", upto).groupBy("_g").agg(*[
        F.max(F.when((rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("_n")), F.col("_v"))).alias(_quantile_name(p))
        for p in QUANTILES for rank in [F.ceil(F.lit(p) * F.col("_total"))]
    ]).select(*[F.col("_g").getField(c).alias(c) for c in by], *[_quantile_name(p) for p in QUANTILES])


def _written(df: DataFrame, label: str) -> DataFrame:
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _few(most: int) -> Column:
    """Whether a bracket can be ordered: few rows, few different values, or one value."""
    return (F.col("_inside") <= most) | (F.col("_kinds") <= most) | F.coalesce(F.col("_from") == F.col("_to"), F.lit(False))


def _inside(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows of a group within the bounds of its parts; null bounds hold everything."""
    other = parts.withColumnRenamed("_g", "_h")
    within = (F.col("_from").isNull() | (F.col("_v") >= F.col("_from"))) & (F.col("_to").isNull() | (F.col("_v") <= F.col("_to")))
    return rows.join(other, (F.col("_g") == F.col("_h")) & within).drop("_h")


def _tighter(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """The segment of each part that holds its rank, cut by a sketch of the part's own rows."""
    kind = rows.schema["_v"].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        number = F.when(F.isnan("_v"), F.lit(float("inf"))).otherwise(F.col("_v").cast("double"))
    else:
        # Distances from the lower bound keep the digits that a double of the value itself would lose.
        exact = kind if isinstance(kind, T.DecimalType) else T.DecimalType(20, 0)
        number = F.coalesce((F.col("_v").cast(exact) - F.col("_from").cast(exact)).cast("double"), F.col("_v").cast("double"))
    bounds = parts.select("_g", "_from", "_to").distinct()
    sketches = _inside(rows, bounds).groupBy("_g", "_from", "_to").agg(
        F.kll_sketch_agg_double(number, SKETCH_ITEMS).alias("_sketch"))
    grid = F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))
    step = (F.col("_rank") - F.col("_below")) * STEPS / F.col("_inside")
    low, high = F.floor(step).cast("int") - 1, F.ceil(step).cast("int") + 1
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("_from", "_to")]
    cut = parts.alias("p").join(sketches.alias("s"), (F.col("p._g") == F.col("s._g")) & same[0] & same[1]).select(
        "p._g", "p._total", "p._rank", "p._below", "p._from", "p._to",
        F.when(low > 0, F.get(grid, low)).otherwise(float("-inf")).alias("_lo"),
        F.when(high < STEPS, F.get(grid, high)).otherwise(float("inf")).alias("_hi"))
    # Each part's rows in three segments: below, between and above the two values.
    placed = _inside(rows, _written(cut, "cuts")).withColumn("_n", number).withColumn(
        "_segment", F.when(F.col("_n") < F.col("_lo"), 0).when(F.col("_n") <= F.col("_hi"), 1).otherwise(2))
    part = ["_g", "_total", "_rank", "_below"]
    segments = placed.groupBy(*part, "_segment").agg(
        F.count(F.lit(1)).alias("_inside"), F.min("_v").alias("_from"), F.max("_v").alias("_to"),
        F.approx_count_distinct("_v").alias("_kinds"))
    earlier = Window.partitionBy(*part).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_below") + F.coalesce(F.sum("_inside").over(earlier), F.lit(0))
    return segments.withColumn("_before", before).filter(
        (F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_inside"))
    ).select("_g", "_total", "_rank", F.col("_before").alias("_below"), "_inside", "_from", "_to", "_kinds")


def _quantile_name(p: float) -> str:
    return f"p{round(p * 100)}"
