"""Data-quality checks. Each gives one row: ``check, severity, violations``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as S

ERROR, WARN = "error", "warn"


def _line(df: DataFrame, check: str, severity: str, violations: Column) -> DataFrame:
    return df.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(check).alias("check"), F.lit(severity).alias("severity"), "violations"
    )


def line(rows: DataFrame, check: str, severity: str = ERROR) -> DataFrame:
    """A check whose violations are the rows of a query."""
    return _line(rows, check, severity, F.count(F.lit(1)))


def duplicates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keys that occur more than once; a null key is no key."""
    present = reduce(lambda a, c: a & F.col(c).isNotNull(), cols, F.lit(True))
    counted = df.filter(present).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1)


def unique(df: DataFrame, cols: list[str], name: str, severity: str = ERROR) -> DataFrame:
    """Number of keys that occur more than once."""
    return _line(duplicates(df, cols), f"unique {name}({', '.join(cols)})", severity, F.count(F.lit(1)))


def row_checks(df: DataFrame, checks: dict[str, tuple[str, Column]]) -> DataFrame:
    """Any number of per-row rules in one pass: name -> (severity, rule that must hold)."""
    names = list(checks)
    broken = df.agg(*[
        F.count_if(F.coalesce(~rule, F.lit(False))).alias(f"c{i}")
        for i, (_, rule) in enumerate(checks.values())
    ])
    lines = F.array(*[
        F.struct(F.lit(n).alias("check"), F.lit(checks[n][0]).alias("severity"),
                 F.col(f"c{i}").alias("violations"))
        for i, n in enumerate(names)
    ])
    return broken.select(F.inline(lines))


def not_null_rules(name: str, cols: list[str], severity: str = ERROR) -> dict[str, tuple[str, Column]]:
    return {f"not_null {name}({c})": (severity, F.col(c).isNotNull()) for c in cols}


def accepted_rule(name: str, col: str, values: list[str], severity: str = ERROR) -> dict[str, tuple[str, Column]]:
    """A value outside the list breaks the rule; null is another check's business."""
    return {f"accepted_values {name}({col})": (severity, F.col(col).isin(*values))}


def check_rule(name: str, predicate: Column, severity: str = ERROR) -> dict[str, tuple[str, Column]]:
    """A column rule; a null outcome passes, as it does in a table constraint."""
    return {f"check {name}": (severity, predicate)}


def not_null(df: DataFrame, cols: list[str], name: str, severity: str = ERROR) -> DataFrame:
    return row_checks(df, not_null_rules(name, cols, severity))


def accepted_values(df: DataFrame, col: str, values: list[str], name: str, severity: str = ERROR) -> DataFrame:
    return row_checks(df, accepted_rule(name, col, values, severity))


def check(df: DataFrame, name: str, predicate: Column, severity: str = ERROR) -> DataFrame:
    return row_checks(df, check_rule(name, predicate, severity))


def dangling(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """References without a parent and how many rows use each; a null reference is allowed.

    Equal references are counted before the join, so a very common one joins once.
    """
    used = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_fk")).agg(
        F.count(F.lit(1)).alias("n")
    )
    keys = parent.select(F.col(pk).alias("_fk"))
    return used.join(keys, "_fk", "left_anti").withColumnRenamed("_fk", fk)


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str, name: str,
                  severity: str = WARN) -> DataFrame:
    """Number of child rows whose reference has no parent."""
    return _line(dangling(child, fk, parent, pk), f"relationships {name}({fk})", severity, F.sum("n"))


def run_checks(lines: list[DataFrame]) -> DataFrame:
    """One report of many checks with a status per line."""
    report = reduce(DataFrame.unionByName, lines)
    status = F.when(F.col("violations") == 0, "pass").otherwise(
        F.when(F.col("severity") == WARN, "warn").otherwise("fail")
    )
    return report.withColumn("status", status)


def summary(report: DataFrame) -> DataFrame:
    """Passed, warned and failed checks and the overall outcome; warnings alone still pass."""
    return report.agg(
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "warn").alias("warned"),
        F.count_if(F.col("status") == "fail").alias("failed"),
    ).withColumn(
        "outcome",
        F.when(F.col("failed") > 0, "failed").when(F.col("warned") > 0, "passed with warnings")
        .otherwise("passed"),
    )


def diverged_days(recon: DataFrame, as_of: str) -> DataFrame:
    """Days whose routes disagree; the reporting day itself is still being written."""
    return recon.filter(
        (F.col("verdict") == "DIVERGED") & (F.col("order_date") < F.lit(as_of).cast("date"))
    ).select("order_date", "pg_orders", "cdc_orders", "cdc_minus_pg", "verdict")


def row_parity(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Row counts of two relations and whether they are equal."""
    n = F.count(F.lit(1))
    left = a.agg(n.alias("n")).select(F.lit("a").alias("side"), "n")
    right = b.agg(n.alias("n")).select(F.lit("b").alias("side"), "n")
    return left.unionByName(right).agg(
        F.lit(name).alias("name"),
        F.sum(F.when(F.col("side") == "a", F.col("n"))).alias("a_rows"),
        F.sum(F.when(F.col("side") == "b", F.col("n"))).alias("b_rows"),
    ).withColumn("equal", F.col("a_rows") == F.col("b_rows"))


def count_compare(control: dict[str, DataFrame], warehouse: dict[str, DataFrame]) -> DataFrame:
    """Row counts of source and warehouse, table by table."""
    return reduce(
        DataFrame.unionByName,
        [row_parity(control[t], warehouse[t], t) for t in control if t in warehouse],
    ).select(
        F.col("name").alias("table"), F.col("a_rows").alias("source_rows"),
        F.col("b_rows").alias("warehouse_rows"),
        S.signed_gap("b_rows", "a_rows").alias("gap"),
    )


def mart_agreement(job: DataFrame, model: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows of two marts that differ, on days nothing changed since the job computed them.

    ``job`` carries ``computed_at``; ``orders`` has order_date and updated_at.
    """
    changed = orders.groupBy(F.col("order_date").alias("day")).agg(
        F.max("updated_at").alias("last_changed_at")
    )
    j = job.select("day", "category", *[F.col(c).alias(f"job_{c}") for c in ("orders", "items", "revenue")],
                   "computed_at")
    m = model.select("day", "category", *[F.col(c).alias(f"model_{c}") for c in ("orders", "items", "revenue")])
    differs = F.lit(False)
    for c in ("orders", "items", "revenue"):
        differs = differs | (F.col(f"job_{c}") != F.col(f"model_{c}"))
    return (
        j.join(m, ["day", "category"])
        .join(changed, "day")
        .filter((F.col("last_changed_at") < F.col("computed_at")) & differs)
    )


def tombstone_complete(log: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Deletes that lost some of their columns."""
    deleted = log.filter(F.col("is_deleted") == 1)
    return not_null(deleted, cols, f"{name} tombstone")


def landed(mart: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Expected mart rows that are not there."""
    return expected.select(*keys).distinct().join(mart.select(*keys), keys, "left_anti")


def total_matches_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose total is not the sum of their lines; an order without lines sums to zero."""
    lines = items.groupBy("order_id").agg(
        F.sum(S.line_total("quantity", "unit_price")).cast("decimal(18,2)").alias("lines_total")
    )
    both = orders.select("order_id", "total_amount").join(lines, "order_id", "left")
    total = F.coalesce("lines_total", F.lit(0).cast("decimal(18,2)"))
    return both.withColumn("lines_total", total).filter(F.col("total_amount") != F.col("lines_total"))


def collapsed(report: DataFrame) -> DataFrame:
    """Tables whose log does not hold more versions than current rows."""
    return report.filter(F.col("collapsed") <= 0)
