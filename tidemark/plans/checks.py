"""The declared checks of the staging models and marts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality as Q
from tidemark.schemas import STATUSES, VERDICTS
from tidemark.sources.lake import write_verified

# Which columns of which model must be unique or present.
UNIQUE = [
    ("stg_orders", "order_id"),
    ("stg_order_items", "order_item_id"),
    ("stg_customers", "customer_id"),
    ("stg_customers", "email"),
    ("stg_products", "product_id"),
    ("stg_products", "sku"),
    ("stg_lake_orders", "order_id"),
    ("recon_orders_by_source", "order_date"),
    ("customer_order_summary", "customer_id"),
]
NOT_NULL = {
    "stg_orders": ["order_id", "customer_id", "status", "total_amount", "order_date"],
    "stg_order_items": ["order_item_id", "order_id", "product_id", "quantity", "line_total"],
    "stg_customers": ["customer_id", "email", "country_code"],
    "stg_products": ["product_id", "sku", "category", "current_price"],
    "stg_lake_orders": ["order_id", "dt", "total_amount"],
    "stg_control_orders": ["order_id", "status"],
    "stg_control_customers": ["customer_id", "email"],
    "recon_orders_by_source": ["order_date", "verdict"],
    "daily_sales_by_category": ["day", "category", "orders", "revenue"],
    "customer_order_summary": ["customer_id", "country_code", "orders_placed", "lifetime_value"],
}
ACCEPTED = {
    "stg_orders": ("status", STATUSES),
    "recon_orders_by_source": ("verdict", VERDICTS),
}
RELATIONSHIPS = [
    ("stg_orders", "customer_id", "stg_customers", "customer_id"),
    ("stg_order_items", "order_id", "stg_orders", "order_id"),
    ("stg_order_items", "product_id", "stg_products", "product_id"),
]


def row_rules(model: str) -> dict:
    """The per-row rules of a model: name -> (severity, rule that must hold)."""
    rules = Q.not_null_rules(model, NOT_NULL.get(model, []))
    if model in ACCEPTED:
        col, values = ACCEPTED[model]
        rules |= Q.accepted_rule(model, col, values)
    return rules


def write_model(df: DataFrame, model: str, root: str) -> tuple[DataFrame, list[tuple[str, str, int]]]:
    """Write a model and count what breaks its per-row rules in the same pass: (the written model, check lines)."""
    rules, seen, path = row_rules(model), Observation(), f"{root.rstrip('/')}/{model}"
    broken = [F.count_if(F.coalesce(~rule, F.lit(False))).alias(f"c{i}") for i, (_, rule) in enumerate(rules.values())]
    write_verified(df.observe(seen, *broken) if broken else df, path)
    lines = [(name, severity, int(seen.get[f"c{i}"])) for i, (name, (severity, _)) in enumerate(rules.items())]
    return df.sparkSession.read.schema(df.schema).parquet(path), lines


def build_and_check(
    spark: SparkSession, staging: dict[str, DataFrame | Callable[[dict[str, DataFrame]], DataFrame]],
    marts: Callable[[dict[str, DataFrame]], dict[str, DataFrame]],
    root: str, job: DataFrame | Callable[[dict[str, DataFrame]], DataFrame], as_of: str,
) -> DataFrame:
    """Write the staging models, the marts built from them, then report every declared check.

    Per-row rules are counted while a model is written, so a model is scanned
    again only by the checks that need a grouping or another model: uniqueness,
    references, days whose routes diverged before ``as_of``, and rows of
    ``job`` (the sales mart another job keeps, with ``computed_at``) that
    differ from the mart made here on days that nothing changed since. A
    staging model or ``job`` may be a function of the models written before it,
    so that no log is collapsed twice.
    """
    models, observed = {}, []
    for plans in (lambda: staging, lambda: marts(models)):
        for name, df in plans().items():
            models[name], lines = write_model(df(models) if callable(df) else df, name, root)
            observed += lines
    lines = [spark.createDataFrame(observed, "check string, severity string, violations bigint")]
    lines += grouped_checks(models)
    lines.append(Q.line(Q.diverged_days(models["recon_orders_by_source"], as_of), "no_diverged_days", Q.WARN))
    differing = Q.mart_agreement(job(models) if callable(job) else job, models["daily_sales_by_category"], models["stg_orders"])
    lines.append(Q.line(differing, "mart_matches_job", Q.WARN))
    return Q.run_checks(lines)


def grouped_checks(models: dict[str, DataFrame]) -> list[DataFrame]:
    """Uniqueness and references, of the models that are given."""
    lines = [Q.unique(models[model], [col], model) for model, col in UNIQUE if model in models]
    for child, fk, parent, pk in RELATIONSHIPS:
        if child in models and parent in models:
            lines.append(Q.relationships(models[child], fk, models[parent], pk, child))
    return lines


def report(models: dict[str, DataFrame]) -> DataFrame:
    """One line per declared check of the given models with its status; the per-row ones of a model share one pass."""
    lines = [Q.row_checks(df, row_rules(model)) for model, df in models.items() if row_rules(model)]
    return Q.run_checks(lines + grouped_checks(models))
