"""Join shapes used by the marts and checks.

No side is hinted to broadcast: the planner broadcasts a side whose size it
knows to be below the threshold, at run time as well, and shuffles otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as S


def without(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``left`` with no partner in ``right``; keys of ``right`` are made distinct first."""
    return left.join(right.select(*on).distinct(), on, "left_anti")


def with_match(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``left`` with a partner in ``right``, none doubled."""
    return left.join(right.select(*on).distinct(), on, "left_semi")


def spine_join(parts: dict[str, DataFrame], on: list[str]) -> DataFrame:
    """Left-join aggregates (unique on ``on``) to the union of their keys."""
    frames = list(parts.values())
    spine = reduce(DataFrame.union, [f.select(*on) for f in frames]).distinct()
    return reduce(lambda acc, f: acc.join(f, on, "left"), frames, spine)


def ratio_on(
    num: DataFrame, den: DataFrame, on: list[str], num_value: str = "value", den_value: str = "value",
    scale: float = 1.0,
) -> DataFrame:
    """sum(num) per ``on`` divided by the single ``den`` row of that key, times ``scale``."""
    top = num.groupBy(*on).agg(F.sum(num_value).alias("_num"))
    bottom = den.select(*on, F.col(den_value).alias("_den"))
    return top.join(bottom, on, "inner").select(
        *on, (S.ratio("_num", "_den") * F.lit(scale)).alias("ratio")
    )


def compare(a: DataFrame, b: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Rows that differ between two relations, also those present on one side only.

    Both sides must be unique on ``keys``. Result: keys, ``a_<col>``,
    ``b_<col>`` and ``diff`` (only in a / only in b / differs).
    """
    left = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in cols], F.lit(True).alias("_in_a"))
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in cols], F.lit(True).alias("_in_b"))
    differs: Column = F.lit(False)
    for c in cols:
        differs = differs | ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    diff = (
        F.when(F.col("_in_b").isNull(), "only in a")
        .when(F.col("_in_a").isNull(), "only in b")
        .when(differs, "differs")
    )
    return (
        left.join(right, keys, "full_outer")
        .withColumn("diff", diff)
        .filter(F.col("diff").isNotNull())
        .drop("_in_a", "_in_b")
    )
