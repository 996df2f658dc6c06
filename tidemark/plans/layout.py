"""Two tables laid out together so that their join needs no shuffle, hot keys split.

A key with many rows gets several sub-buckets. How many is decided once, written
as a small table and used for both sides: rows of the many side are dealt to the
sub-buckets of their key, the row of the one side is repeated in each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.plans.jobs import materialize_bucketed

SUB = "sub_bucket"


@dataclass(frozen=True)
class Layout:
    """The names of both tables and the key they are laid out by."""

    many: str
    one: str
    key: str

    def join(self, spark: SparkSession) -> DataFrame:
        """Rows of the many side with their partner; rows without one are left out."""
        return spark.table(self.many).join(spark.table(self.one), [self.key, SUB])


def hot_keys(many: DataFrame, key: str, rows_per_split: int) -> DataFrame:
    """(key, splits) of keys with more rows than a sub-bucket is meant to hold."""
    counted = many.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counted.filter(F.col("_n") > rows_per_split).select(
        key, (S.id_block(F.col("_n") - 1, rows_per_split) + 1).alias("splits"))


def lay_out(
    many: DataFrame, one: DataFrame, key: str, member: str, buckets: int, root: str, name: str,
    rows_per_split: int = 10_000_000,
) -> Layout:
    """Write both sides in buckets by (key, sub-bucket), sorted.

    ``one`` must be unique on ``key``. Rows of ``many`` are dealt by ``member``,
    so versions of one member stay together and can be collapsed in place. At
    most rows / ``rows_per_split`` keys are hot. Both tables have the column
    ``sub_bucket`` besides their own.
    """
    spark, path = many.sparkSession, f"{root.rstrip('/')}/hot"
    hot_keys(many, key, rows_per_split).write.parquet(path)
    # Read back, so the planner knows how small it is; both sides use the same numbers.
    hot = spark.read.schema(f"{key} {many.schema[key].dataType.simpleString()}, splits bigint").parquet(path)
    splits = F.coalesce("splits", F.lit(1).cast("bigint"))
    dealt = many.join(hot, key, "left").withColumn(SUB, F.pmod(F.xxhash64(member), splits)).drop("splits")
    repeated = one.join(hot, key, "left").withColumn(SUB, F.explode(F.sequence(F.lit(0).cast("bigint"), splits - 1)))
    layout = Layout(f"{name}_many", f"{name}_one", key)
    materialize_bucketed(dealt, layout.many, [key, SUB], buckets, root)
    materialize_bucketed(repeated.drop("splits"), layout.one, [key, SUB], buckets, root)
    return layout
