"""Turning dotted metric names into a metric and labels, and rewriting label sets."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NameRule:
    """``match`` is a dotted glob (``*`` is one segment) or, with ``regex``, an expression."""

    match: str
    name: str
    labels: dict[str, str] = field(default_factory=dict)
    regex: bool = False
    drop: bool = False

    def pattern(self) -> str:
        if self.regex:
            body = self.match.removeprefix("^").removesuffix("$")
        else:
            body = r"\.".join("([^.]+)" if p == "*" else re.escape(p) for p in self.match.split("."))
        return f"^{body}$"


# The name rules of the two exporters, in order of precedence.
SCHEDULER_RULES = [
    NameRule("airflow.ti.finish.*.*.*", "airflow_task_finish_total",
             {"dag_id": "$1", "task_id": "$2", "state": "$3"}),
    NameRule("airflow.dag.*.*.duration", "airflow_task_duration_seconds",
             {"dag_id": "$1", "task_id": "$2"}),
    NameRule("airflow.dagrun.duration.success.*", "airflow_dagrun_duration_success_seconds",
             {"dag_id": "$1"}),
    NameRule("airflow.dagrun.duration.failed.*", "airflow_dagrun_duration_failed_seconds",
             {"dag_id": "$1"}),
    NameRule("airflow.dagrun.schedule_delay.*", "airflow_dagrun_schedule_delay_seconds",
             {"dag_id": "$1"}),
    NameRule("airflow.(.+)", "airflow_$1", regex=True),
]
DASHBOARD_RULES = [
    NameRule("superset.health", "dropped", drop=True),
    NameRule("superset.log", "dropped", drop=True),
    NameRule("superset.ChartDataRestApi.json_dumps", "superset_json_dumps"),
    NameRule("superset.QueryObject.post_processing", "superset_post_processing"),
    NameRule(r"^superset\.([A-Za-z]+)RestApi\.([^.]+)\.([^.]+)$", "superset_api",
             {"resource": "$1", "method": "$2", "outcome": "$3"}, regex=True),
    NameRule(r"^superset\.([A-Za-z]+)RestApi\.([^.]+)$", "superset_api_duration",
             {"resource": "$1", "method": "$2"}, regex=True),
    NameRule("superset.execute_sql", "superset_execute_sql"),
    NameRule("superset.loaded_from_source", "superset_loaded_from_source"),
    NameRule("superset.loaded_from_source_without_force", "superset_loaded_from_source_no_force"),
    NameRule("superset.loading_from_cache", "superset_loading_from_cache"),
    NameRule("superset.loaded_from_cache", "superset_loaded_from_cache"),
    NameRule("superset.set_cache_key", "superset_set_cache_key"),
    NameRule("superset.load_into_dataframe", "superset_load_into_dataframe"),
    NameRule("superset._get_data_response", "superset_get_data_response"),
    NameRule("superset.dashboard", "superset_dashboard"),
    NameRule(r"^superset\.(.+)$", "superset_other", {"metric": "$1"}, regex=True),
]


def _fill(template: str, name: Column, pattern: str) -> Column:
    """A template with $1, $2 … replaced by the groups of the matched name."""
    parts = [p for p in re.split(r"(\$\d)", template) if p]
    cols = [
        F.regexp_extract(name, pattern, int(p[1:])) if re.fullmatch(r"\$\d", p) else F.lit(p)
        for p in parts
    ]
    return F.concat(*cols)


def map_names(df: DataFrame, rules: list[NameRule], name: str = "name") -> DataFrame:
    """Add ``metric`` and ``labels`` by the first rule that matches; dropped names disappear.

    A name no rule matches keeps itself. Characters a metric name cannot hold
    become underscores.
    """
    source = F.col(name)
    which: Column = F.lit(len(rules))
    for i, rule in reversed(list(enumerate(rules))):
        which = F.when(source.rlike(rule.pattern()), F.lit(i)).otherwise(which)

    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    metric, labels = source, none
    for i, rule in reversed(list(enumerate(rules))):
        hit, pattern = F.col("_rule") == i, rule.pattern()
        metric = F.when(hit, _fill(rule.name, source, pattern)).otherwise(metric)
        if rule.labels:
            made = F.create_map(*[
                c for k, v in rule.labels.items() for c in (F.lit(k), _fill(v, source, pattern))
            ])
            labels = F.when(hit, made).otherwise(labels)
    dropped = [i for i, rule in enumerate(rules) if rule.drop]
    # The generated row keeps the rule chain in one place: as a plain column the
    # optimizer would copy it into every expression below that refers to it.
    numbered = df.select("*", F.explode(F.array(which)).alias("_rule"))
    return (
        numbered.filter(~F.col("_rule").isin(dropped) if dropped else F.lit(True))
        .withColumns({"metric": F.regexp_replace(metric, "[^a-zA-Z0-9_:]", "_"), "labels": labels})
        .drop("_rule")
    )


def unmapped(mapped: DataFrame, catch_all: str = "superset_other") -> DataFrame:
    """Names that only the catch-all rule took, with how often."""
    return (
        mapped.filter(F.col("metric") == catch_all)
        .groupBy(F.try_element_at("labels", F.lit("metric")).alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@dataclass(frozen=True)
class RelabelRule:
    """Keep rows, or set ``target``, where the joined source labels match the whole ``regex``."""

    source: tuple[str, ...]
    regex: str = "(.*)"
    action: str = "replace"
    target: str = ""
    replacement: str = "$1"


# How discovered containers become scrape targets.
TARGET_RULES = [
    RelabelRule(("__meta_docker_container_label_prometheus_scrape",), "true", "keep"),
    RelabelRule(("__address__", "__meta_docker_container_label_prometheus_port"),
                r"([^:]+)(?::\d+)?;(\d+)", target="__address__", replacement="$1:$2"),
    RelabelRule(("__meta_docker_container_label_prometheus_path",), "(.+)", target="__metrics_path__"),
    RelabelRule(("__meta_docker_container_label_prometheus_job",), "(.+)", target="job"),
    RelabelRule(("__meta_docker_container_name",), "/(.*)", target="container"),
    RelabelRule(("container",), target="instance"),
]


def discovery_rules(network: str) -> list[RelabelRule]:
    """Containers of one network that ask to be scraped, as targets."""
    return [RelabelRule(("__meta_docker_network_name",), network, "keep"), *TARGET_RULES]


def _without(labels: str, key: str) -> Column:
    return F.map_filter(labels, lambda k, _: k != F.lit(key))


def relabel(df: DataFrame, rules: list[RelabelRule], labels: str = "labels") -> DataFrame:
    """Apply relabelling rules in order to a label map."""
    for rule in rules:
        pattern = f"^(?:{rule.regex})$"
        joined = F.concat_ws(
            ";", *[F.coalesce(F.try_element_at(labels, F.lit(s)), F.lit("")) for s in rule.source]
        )
        if rule.action == "keep":
            df = df.filter(joined.rlike(pattern))
            continue
        others = _without(labels, rule.target)
        value = _fill(rule.replacement, joined, pattern)
        changed = F.when(value == "", others).otherwise(
            F.map_concat(others, F.create_map(F.lit(rule.target), value))
        )
        df = df.withColumn(labels, F.when(joined.rlike(pattern), changed).otherwise(F.col(labels)))
    return df
