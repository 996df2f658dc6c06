"""Evaluating the alert rules over metric samples.

Two passes serve all rules: one over the newest values (gauges, targets that
answer, ratios, ages) and one over counter growth. Every sample is tagged with
the rules it feeds, so it is read once per pass and not once per rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.operators import timeseries as TS
from tidemark.plans.alert_rules import RULES, Rule

COUNTERS = ("rate", "increase", "changes")


def _where(rule: Rule) -> Column:
    out = F.lit(True)
    for name, op, text in rule.where:
        value = TS.label(name)
        out = out & {
            "=": lambda v=value, t=text: v == t,
            "!=": lambda v=value, t=text: v != t,
            "=~": lambda n=name, t=text: TS.label_matches(n, t),
            "!~": lambda n=name, t=text: TS.label_matches(n, t, negate=True),
        }[op]()
    return out


def _feeds(rules: list[Rule]) -> dict[str, list[str]]:
    """The names of the rules that a metric feeds."""
    feeds: dict[str, list[str]] = {}
    for r in rules:
        for m in dict.fromkeys(m for m in (r.metric, r.other) if m):
            feeds.setdefault(m, []).append(r.name)
    return feeds


def _tag(samples: DataFrame, rules: list[Rule]) -> DataFrame:
    """Samples once per rule they feed, in a column ``alert``.

    The metric name gives the candidate rules by one lookup; only rules with
    label conditions are then tested.
    """
    feeds = _feeds(rules)
    candidates = _lookup("metric", {m: F.array(*[F.lit(n) for n in names]) for m, names in feeds.items()})
    fed = samples.filter(F.col("metric").isin(*feeds)).select(
        "*", F.explode(candidates).alias("alert")
    )
    kept = F.lit(True)
    for r in rules:
        if r.where:
            kept = F.when(F.col("alert") == r.name, _where(r)).otherwise(kept)
    return fed.filter(kept)


def _lookup(column: str, values: dict[str, Column]) -> Column:
    """A chain of comparisons. Not a map literal: those never compare equal, and two uses of
    the same samples would then not share their shuffle."""
    out = None
    for key, value in values.items():
        hit = F.col(column) == key
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out


def _per_rule(rules: list[Rule], value) -> Column:
    """A value of the rule as a column, by the rule's name; rules of equal value share a test."""
    groups: dict = {}
    for r in rules:
        groups.setdefault(value(r), []).append(r.name)
    common = max(groups, key=lambda v: len(groups[v]))
    out = F.lit(common)
    for v, names in groups.items():
        if v != common:
            out = F.when(F.col("alert").isin(names), F.lit(v)).otherwise(out)
    return out


def _breached(rules: list[Rule]) -> Column:
    value, limit = F.col("value"), _per_rule(rules, lambda r: float(r.limit))
    op = _per_rule(rules, lambda r: r.op)
    hit = (
        F.when(op == "==", value == limit)
        .when(op == "!=", value != limit)
        .when(op == "<", value < limit)
        .otherwise(value > limit)
    )
    return F.coalesce(hit, F.lit(False))


def _unit(rules: list[Rule]) -> Column:
    """What a rule reports on: a series, an instance, or everything folded into one."""
    how = _per_rule(rules, lambda r: (
        "instance" if r.on else "" if r.agg or r.kind in ("up", "stale") else "series"
    ))
    return (
        F.when(how == "series", F.col("series"))
        .when(how == "instance", F.concat(F.lit("instance="), TS.label("instance")))
        .otherwise("")
    )


def _below(rules: list[Rule]) -> Column:
    """Does a sample belong to the lower side of a ratio?"""
    out = F.lit(False)
    for r in rules:
        if r.other:
            out = out | ((F.col("alert") == r.name) & (F.col("metric") == r.other))
    return out


def _scaled(rules: list[Rule], value: Column) -> Column:
    return _per_rule(rules, lambda r: float(r.offset)) + _per_rule(rules, lambda r: float(r.scale)) * value


def _newest_values(samples: DataFrame, rules: list[Rule], step: int, lookback: int) -> DataFrame:
    """Rules over the newest value each evaluation time sees."""
    # Cut to the newest sample of a step first: rules and series are then named per step and not per sample.
    fed = samples.filter(F.col("metric").isin(*_feeds(rules)))
    tagged = (
        _tag(TS.newest_of_steps(fed, step), rules)
        .withColumn("series", TS.series_key())
        .withColumns({"unit": _unit(rules), "below": _below(rules)})
    )
    seen = TS.instant(tagged, ["alert", "unit", "below", "series"], step, lookback)
    kind = _per_rule(rules, lambda r: r.kind)
    seen = seen.filter((kind != "up") | (F.col("value") == 1)).select(
        "alert", "unit", "t", "below", "value", F.lit(False).alias("grid")
    )

    aged = [r for r in rules if r.kind == "stale"]
    if aged:
        # Every evaluation time takes part, so that an absent series is noticed.
        alerts = F.explode(F.array(*[F.lit(r.name) for r in aged])).alias("alert")
        grid = TS.spine(samples, step).select("t", alerts).select(
            "alert", F.lit("").alias("unit"), "t", F.lit(False).alias("below"),
            F.lit(None).cast("double").alias("value"), F.lit(True).alias("grid"),
        )
        seen = seen.unionByName(grid)

    above, value = ~F.col("below"), F.col("value")
    folded = seen.groupBy("alert", F.col("unit").alias("series"), "t").agg(
        F.sum(F.when(above, value)).alias("_sum"),
        F.sum(F.when(~above, value)).alias("_den"),
        F.count(F.when(above, value)).cast("double").alias("_n"),
        F.max(F.when(above, value)).alias("_max"),
        F.max("grid").alias("_grid"),
    )
    floor = _per_rule(rules, lambda r: float("-inf") if r.floor is None else float(r.floor))
    age = F.coalesce(S.epoch_micros("t") / F.lit(1e6) - F.col("_max"), F.lit(float("inf")))
    measured = (
        F.when((kind == "stale") & F.col("_grid"), age)
        .when(kind == "up", F.col("_n"))
        .when((kind == "ratio") & F.col("_den").isNotNull(),
              S.ratio(F.col("_sum"), F.greatest("_den", floor)))
        .when(kind == "gauge", F.col("_sum"))
    )
    return (
        folded.withColumn("value", _scaled(rules, measured))
        .filter(F.col("value").isNotNull())
        .select("alert", "series", "t", "value")
    )


def _growth(samples: DataFrame, rules: list[Rule], step: int) -> DataFrame:
    """Rules over what a counter grew by, or how often a value changed."""
    tagged = (
        _tag(samples, rules).withColumn("series", TS.series_key()).withColumn("unit", _unit(rules))
    )
    keys = ["alert", "unit", "series"]
    kind, window = _per_rule(rules, lambda r: r.kind), _per_rule(rules, lambda r: r.window)
    pairs = TS.counter_deltas(tagged, keys).withColumn(
        "measure", F.when(kind == "changes", F.col("changed").cast("double")).otherwise(F.col("delta"))
    )
    total = TS.over_windows(pairs, keys, "measure", window, step)
    each = F.when(kind == "rate", F.col("value") / window).otherwise(F.col("value"))
    average = _per_rule(rules, lambda r: r.agg == "avg")
    folded = total.groupBy("alert", F.col("unit").alias("series"), "t").agg(
        F.sum(each).alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    value = F.when(average, F.col("_sum") / F.col("_n")).otherwise(F.col("_sum"))
    return folded.select("alert", "series", "t", _scaled(rules, value).alias("value"))


def conditions(
    samples: DataFrame, rules: list[Rule] = RULES, step: int = TS.STEP, lookback: int = TS.LOOKBACK
) -> DataFrame:
    """Value of every rule at every evaluation time and whether it breaches its limit."""
    growing = [r for r in rules if r.kind in COUNTERS]
    newest = [r for r in rules if r.kind not in COUNTERS]
    parts = []
    if newest:
        parts.append(_newest_values(samples, newest, step, lookback).withColumn("breached", _breached(newest)))
    if growing:
        parts.append(_growth(samples, growing, step).withColumn("breached", _breached(growing)))
    return reduce(DataFrame.unionByName, parts)


def evaluate(
    samples: DataFrame, rules: list[Rule] = RULES, step: int = TS.STEP, lookback: int = TS.LOOKBACK
) -> DataFrame:
    """Stretches in which a rule was active, with the time it fired, null if it never did."""
    active = conditions(samples, rules, step, lookback)
    held = TS.held_for(
        active, ["alert", "series"], "breached", _per_rule(rules, lambda r: r.hold),
        max_gap_seconds=step,
    )
    return held.select(
        "alert", _per_rule(rules, lambda r: r.severity).alias("severity"), "series",
        F.col("start").alias("active_since"), "fire_at", F.col("end").alias("last_active"),
    )
