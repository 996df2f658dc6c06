"""Narrow live reads of the operational tables, the control of the reconciliation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The columns the control needs of each table.
CONTROL_COLUMNS = {
    "orders": ["order_id", "customer_id", "status", "total_amount", "created_at", "updated_at"],
    "customers": ["customer_id", "email", "full_name", "country_code", "created_at", "updated_at"],
}


@dataclass(frozen=True)
class ControlSource:
    """Where the operational tables are read from.

    ``fmt="jdbc"`` takes the connection settings in ``options`` and, for a
    parallel read, ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``. ``fmt="parquet"`` reads ``<root>/<table>``.
    """

    fmt: str = "parquet"
    root: str = ""
    schema: str = "public"
    options: dict[str, str] = field(default_factory=dict)


def read_control(
    spark: SparkSession, source: ControlSource, table: str, columns: list[str] | None = None
) -> DataFrame:
    """A narrow projection of one operational table; filters on it reach the source."""
    columns = columns or CONTROL_COLUMNS[table]
    if source.fmt == "jdbc":
        reader = spark.read.format("jdbc").options(**source.options)
        return reader.option("dbtable", f"{source.schema}.{table}").load().select(*columns)
    return spark.read.format(source.fmt).options(**source.options).load(
        f"{source.root}/{table}"
    ).select(*columns)
