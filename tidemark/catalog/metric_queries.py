"""Metric samples: rates, thresholds, hold times, alert rules, panels, names and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixtures as X
from tidemark.catalog import query
from tidemark.catalog.base import Inputs, sql
from tidemark.catalog.specs import SPECS, Spec, matches
from tidemark.functions import names as N
from tidemark.operators import joins as J
from tidemark.operators import sequences as Q
from tidemark.operators import timeseries as TS
from tidemark.operators.topk import topk
from tidemark.plans import alerts, panels
from tidemark.plans.alert_rules import RULES
from tidemark.streaming import monitor

MINUTE, HOUR = 60, 3600
KEYS = ["metric", "instance"]


def _labelled(x: Inputs):
    return TS.with_labels(x.samples(), "instance", "job")


# Counter differences and their sums over windows, as SQL over a view ``samples``.
PAIRS_SQL = """pairs AS (
  SELECT metric, instance, ts, value, lag(ts) OVER w AS prev_ts, lag(value) OVER w AS prev_value FROM samples
  WINDOW w AS (PARTITION BY metric, instance ORDER BY ts, value)),
deltas AS (
  SELECT *, CASE WHEN value >= prev_value THEN value - prev_value ELSE value END AS delta,
    CASE WHEN value <> prev_value THEN 1 ELSE 0 END AS changed FROM pairs WHERE prev_ts IS NOT NULL)"""


def _windows_sql(measure: str, window: int, step: int, out: str = "sum(m)") -> str:
    us = step * 1_000_000
    body = sql("""SELECT 1""", "samples")
    ctes = body[: body.rindex("SELECT 1")].strip()
    return f"""{ctes}, {PAIRS_SQL},
spread AS (SELECT metric, instance, {measure} AS m,
  unnest(range(epoch_us(ts) // {us} + 1, (epoch_us(prev_ts) + {window * 1_000_000}) // {us} + 1)) AS no FROM deltas)
SELECT metric, instance, make_timestamp(no * {us}) AS t, {out} AS value FROM spread GROUP BY metric, instance, no"""


@query("counter_deltas", _windows_sql("delta", 1, 1).split("spread AS")[0].rstrip().rstrip(",") + """
SELECT metric, instance, ts, prev_ts, delta, changed FROM deltas""")
def _(x: Inputs):
    return TS.counter_deltas(_labelled(x), KEYS)


@query("counter_rate", _windows_sql("delta", 2 * HOUR, 15 * MINUTE, "sum(m) / 7200"))
def _(x: Inputs):
    return TS.rate(_labelled(x), KEYS, 2 * HOUR, 15 * MINUTE)


@query("counter_increase", _windows_sql("delta", 3 * HOUR, 15 * MINUTE))
def _(x: Inputs):
    return TS.increase(_labelled(x), KEYS, 3 * HOUR, 15 * MINUTE)


@query("value_changes", _windows_sql("changed", 3 * HOUR, 30 * MINUTE, "CAST(sum(m) AS BIGINT)"))
def _(x: Inputs):
    return TS.changes(_labelled(x), KEYS, 3 * HOUR, 30 * MINUTE)


def _instant_sql(view_sql: str, keys: str, step: int, lookback: int) -> str:
    """CTE ``inst`` (keys, no, value): what each evaluation time sees."""
    us = step * 1_000_000
    return f"""newest AS (SELECT * EXCLUDE (rn) FROM (
  SELECT {keys}, ts, value, epoch_us(ts) // {us} AS no,
    row_number() OVER (PARTITION BY {keys}, epoch_us(ts) // {us} ORDER BY ts DESC, value DESC) AS rn
  FROM {view_sql}) q WHERE rn = 1),
seen AS (SELECT {keys}, ts, value,
  unnest(list_filter(range(no, no + {lookback // step + 3}), lambda t: t * {us} > epoch_us(ts)
    AND t * {us} - epoch_us(ts) <= {lookback * 1_000_000})) AS no FROM newest),
inst AS (SELECT {keys}, no, value FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys}, no ORDER BY ts DESC, value DESC) AS rn FROM seen) q WHERE rn = 1)"""


def _samples_with(tail: str) -> str:
    body = sql("SELECT 1", "samples")
    return body[: body.rindex("SELECT 1")].strip() + ",\n" + tail


INST = _instant_sql("samples", "metric, instance", 5 * MINUTE, 30 * MINUTE)
US5 = 5 * MINUTE * 1_000_000


@query("instant_values", _samples_with(
    INST + f"\nSELECT metric, instance, make_timestamp(no * {US5}) AS t, value FROM inst"))
def _(x: Inputs):
    return TS.instant(_labelled(x), KEYS, 5 * MINUTE, 30 * MINUTE)


@query("instant_values_of_a_short_lookback", _samples_with(
    _instant_sql("samples", "metric, instance", 10 * MINUTE, 30)
    + f"\nSELECT metric, instance, make_timestamp(no * {2 * US5}) AS t, value FROM inst"))
def _(x: Inputs):
    """Half a minute of lookback at ten-minute steps: most samples are too old when they are looked at."""
    return TS.instant(_labelled(x), KEYS, 10 * MINUTE, 30)


@query("gauge_threshold", _samples_with(
    INST + f"\nSELECT metric, instance, make_timestamp(no * {US5}) AS t, value FROM inst WHERE value > 90"))
def _(x: Inputs):
    return TS.threshold(TS.instant(_labelled(x), KEYS, 5 * MINUTE, 30 * MINUTE), ">", 90)


@query("sum_by_metric", _samples_with(
    INST + f"\nSELECT make_timestamp(no * {US5}) AS t, metric, sum(value) AS value FROM inst GROUP BY no, metric"))
def _(x: Inputs):
    return TS.across(TS.instant(_labelled(x), KEYS, 5 * MINUTE, 30 * MINUTE), "sum", ["metric"])


@query("top_series_per_time", _samples_with(INST + f"""
SELECT metric, instance, make_timestamp(no * {US5}) AS t, value, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY no ORDER BY value DESC, metric, instance) AS rank FROM inst) q
WHERE rank <= 3"""))
def _(x: Inputs):
    seen = TS.instant(_labelled(x), KEYS, 5 * MINUTE, 30 * MINUTE)
    return topk(seen, 3, "value", ["t"], ["metric", "instance"])


@query("targets_up", sql(f"""
SELECT make_timestamp(no * {US5}) AS t, CAST(count(*) AS DOUBLE) AS value FROM (
  SELECT instance, no, value, row_number() OVER (PARTITION BY instance, no ORDER BY ts DESC, value DESC) AS rn
  FROM (SELECT CAST(user_id % 4 AS VARCHAR) AS instance, ts, CASE WHEN event_type = 'error' THEN 0.0 ELSE 1.0 END AS value,
          unnest(range(epoch_us(ts) // {US5} + 1,
            greatest((epoch_us(ts) + 3600000000) // {US5}, epoch_us(ts) // {US5} + 1) + 1)) AS no
        FROM events WHERE user_id % 2 = 0) s) q
WHERE rn = 1 AND value = 1 GROUP BY no"""))
def _(x: Inputs):
    up = x.samples().select(
        "ts", F.lit("up").alias("metric"), "labels",
        F.when(F.col("metric") == "events_error", 0.0).otherwise(1.0).alias("value"))
    return TS.count_up(up, "even", 5 * MINUTE, HOUR)


@query("metric_ratio_by_instance", _samples_with(INST.replace("FROM samples", "FROM samples WHERE metric IN ('events_purchase', 'events_view')") + f"""
SELECT instance, make_timestamp(no * {US5}) AS t, n / NULLIF(greatest(d, 1), 0) * 100 AS value FROM (
  SELECT instance, no, sum(CASE WHEN metric = 'events_purchase' THEN value END) AS n,
    sum(CASE WHEN metric = 'events_view' THEN value END) AS d FROM inst GROUP BY instance, no) q
WHERE n IS NOT NULL AND d IS NOT NULL"""))
def _(x: Inputs):
    return TS.metric_ratio(_labelled(x), "events_purchase", "events_view", ["instance"], 5 * MINUTE,
                           floor=1, lookback=30 * MINUTE)


@query("ratio_on_instance", _samples_with("""
n AS (SELECT instance, sum(value) AS v FROM samples GROUP BY instance),
d AS (SELECT instance, max(value) AS v FROM samples WHERE metric = 'events_view' GROUP BY instance)
SELECT instance, n.v / NULLIF(d.v, 0.0) * 100 AS ratio FROM n JOIN d USING (instance)"""))
def _(x: Inputs):
    labelled = _labelled(x)
    views = labelled.filter(F.col("metric") == "events_view")
    limit = views.groupBy("instance").agg(F.max("value").alias("value"))
    return J.ratio_on(labelled, limit, ["instance"], scale=100.0)


@query("label_filters", _samples_with("""
m AS (SELECT * FROM samples WHERE job <> 'odd' AND metric IN ('events_view', 'events_click') AND instance NOT IN ('2', '3'))
SELECT metric, instance, count(*) AS n FROM m GROUP BY 1, 2"""))
def _(x: Inputs):
    kept = x.samples().filter(
        TS.label_matches("job", "od.|none", negate=True) & TS.label_matches("instance", "[01]")
        & F.col("metric").rlike("^(?:events_(view|click))$"))
    return TS.with_labels(kept, "instance").groupBy("metric", "instance").agg(F.count(F.lit(1)).alias("n"))


@query("series_that_have_a_partner", _samples_with("""
m AS (SELECT DISTINCT instance FROM samples WHERE metric = 'events_signup' AND value > 97)
SELECT metric, count(*) AS n FROM samples WHERE instance IN (SELECT instance FROM m) GROUP BY metric"""))
def _(x: Inputs):
    labelled = _labelled(x)
    partner = labelled.filter((F.col("metric") == "events_signup") & (F.col("value") > 97))
    return J.with_match(labelled, partner, ["instance"]).groupBy("metric").agg(F.count(F.lit(1)).alias("n"))


STALE_AT = "2024-01-20 00:00:00"


@query("stale_series", _samples_with(f"""
e AS (SELECT DISTINCT metric, instance FROM samples UNION SELECT 'events_refund', instance FROM samples),
l AS (SELECT metric, instance, max(ts) AS last_seen FROM samples WHERE ts <= TIMESTAMP '{STALE_AT}' GROUP BY 1, 2)
SELECT metric, instance, last_seen, CASE WHEN last_seen IS NULL THEN 'absent'
  WHEN epoch_us(TIMESTAMP '{STALE_AT}') - epoch_us(last_seen) > 3600000000 THEN 'stale' ELSE 'fresh' END AS status
FROM e LEFT JOIN l USING (metric, instance)"""))
def _(x: Inputs):
    labelled = _labelled(x)
    known = labelled.select("metric", "instance").distinct()
    missing = labelled.select(F.lit("events_refund").alias("metric"), "instance").distinct()
    return TS.stale(labelled, known.union(missing), KEYS, F.lit(STALE_AT).cast("timestamp_ntz"), HOUR)


@query("condition_or_absent", sql("""
SELECT CASE WHEN (SELECT count(*) FROM samples WHERE metric = 'events_refund') = 0 THEN 'events_refund is absent' END AS finding""",
    "samples"))
def _(x: Inputs):
    found = x.samples().filter(F.col("metric") == "events_refund").select(F.col("metric").alias("finding"))
    return TS.or_absent(found, F.lit("events_refund is absent"))


HELD_SQL = """
c AS (SELECT metric, instance, ts, value > 30 AS cond,
  lag(value > 30) OVER w AS prev_cond, lag(ts) OVER w AS prev_ts FROM samples
  WINDOW w AS (PARTITION BY metric, instance ORDER BY ts, value > 30)),
b AS (SELECT *, sum(CASE WHEN prev_cond IS NOT DISTINCT FROM cond AND prev_ts IS NOT NULL
    AND epoch_us(ts) - epoch_us(prev_ts) <= {gap} THEN 0 ELSE 1 END)
  OVER (PARTITION BY metric, instance ORDER BY ts, cond ROWS UNBOUNDED PRECEDING) AS run FROM c)
"""


@query("condition_held_for", _samples_with(HELD_SQL.format(gap=12 * HOUR * 1_000_000) + """
SELECT metric, instance, min(ts) AS start, max(ts) AS "end",
  CASE WHEN epoch_us(max(ts)) - epoch_us(min(ts)) >= 14400000000 THEN min(ts) + INTERVAL '4' HOUR END AS fire_at
FROM b WHERE cond GROUP BY metric, instance, run"""))
def _(x: Inputs):
    conds = _labelled(x).withColumn("cond", F.col("value") > 30)
    return TS.held_for(conds, KEYS, "cond", 4 * HOUR, ts="ts", max_gap_seconds=12 * HOUR)


@query("runs_of_a_state", _samples_with(HELD_SQL.format(gap=10**15) + """
SELECT metric, instance, cond, min(ts) AS start, max(ts) AS "end", count(*) AS n
FROM b GROUP BY metric, instance, cond, run"""))
def _(x: Inputs):
    conds = _labelled(x).withColumn("cond", F.col("value") > 30)
    return Q.runs(conds, KEYS, "ts", "cond")


@query("ingestion_stalled", _samples_with(f"""
{PAIRS_SQL.replace('FROM samples', "FROM samples WHERE metric = 'events_purchase'")},
g AS (SELECT no, sum(m) AS v FROM (SELECT delta AS m,
    unnest(range(epoch_us(ts) // 600000000 + 1, (epoch_us(prev_ts) + 3600000000) // 600000000 + 1)) AS no FROM deltas) q GROUP BY no),
n AS (SELECT unnest(range(a + 1, b + 2)) AS no FROM (
  SELECT min(epoch_us(ts) // 600000000) AS a, max(epoch_us(ts) // 600000000) AS b FROM samples WHERE metric = 'events_purchase') q)
SELECT make_timestamp(no * 600000000) AS t FROM n LEFT JOIN g USING (no) WHERE coalesce(v, 0) = 0"""))
def _(x: Inputs):
    one = _labelled(x).filter(F.col("metric") == "events_purchase")
    return TS.stalled(one, KEYS, HOUR, 10 * MINUTE)


@query("series_count", _samples_with("""
m AS (SELECT DISTINCT metric, instance, job FROM samples WHERE metric IN ('events_view', 'events_click'))
SELECT count(*) AS series FROM m"""))
def _(x: Inputs):
    return TS.series_count(x.samples(), "events_(view|click)")


@query("label_value_count", _samples_with("m AS (SELECT DISTINCT instance FROM samples) SELECT count(*) AS \"values\" FROM m"))
def _(x: Inputs):
    return TS.label_values(x.samples(), "instance")


@query("sliding_windows", _samples_with("""
w AS (SELECT metric, value, unnest(range((epoch_us(ts) - 3600000000) // 900000000 + 1, epoch_us(ts) // 900000000 + 1)) AS no FROM samples)
SELECT metric, make_timestamp(no * 900000000) AS start, make_timestamp(no * 900000000 + 3600000000) AS "end",
  count(*) AS samples, sum(value) AS total, max(value) AS highest FROM w GROUP BY metric, no"""))
def _(x: Inputs):
    out = monitor.windowed_stream(x.samples(), "1 hour", "15 minutes", "10 minutes")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query("recent_errors_only", sql("""
SELECT event_id, ts FROM events WHERE event_type = 'error' AND ts > (SELECT max(ts) FROM events) - INTERVAL '6' HOUR"""))
def _(x: Inputs):
    events = x.table("events")
    errors = events.filter(F.col("event_type") == "error").select("event_id", "ts")
    return TS.recent(errors, "ts", events.agg(F.max("ts")).scalar(), "6 HOURS")


# names and labels

NAMES_SQL = {
    "metric": """CASE
  WHEN name LIKE 'airflow.ti.finish.%' THEN 'airflow_task_finish_total'
  WHEN name LIKE 'airflow.dag.%.duration' THEN 'airflow_task_duration_seconds'
  WHEN name LIKE 'airflow.dagrun.schedule_delay.%' THEN 'airflow_dagrun_schedule_delay_seconds'
  ELSE replace(name, '.', '_') END""",
}


@query("scheduler_metric_names", sql(f"""
SELECT event_id, {NAMES_SQL['metric']} AS metric,
  CASE WHEN name LIKE 'airflow.ti.finish.%' THEN split_part(name, '.', 4)
    WHEN name LIKE 'airflow.dag.%' THEN split_part(name, '.', 3)
    WHEN name LIKE 'airflow.dagrun.schedule_delay.%' THEN split_part(name, '.', 4) END AS dag_id,
  CASE WHEN name LIKE 'airflow.ti.finish.%' THEN split_part(name, '.', 5)
    WHEN name LIKE 'airflow.dag.%' THEN split_part(name, '.', 4) END AS task_id,
  CASE WHEN name LIKE 'airflow.ti.finish.%' THEN split_part(name, '.', 6) END AS state
FROM names WHERE name LIKE 'airflow.%'""", "names"))
def _(x: Inputs):
    mapped = N.map_names(x.names().filter(F.col("name").startswith("airflow.")), N.SCHEDULER_RULES)
    return mapped.select("event_id", "metric", *[
        F.try_element_at("labels", F.lit(k)).alias(k) for k in ("dag_id", "task_id", "state")])


@query("dashboard_metric_names", sql("""
SELECT metric, resource, method, outcome, other, count(*) AS n FROM (
  SELECT CASE WHEN name LIKE 'superset.%RestApi.%.%' THEN 'superset_api' WHEN name LIKE 'superset.%RestApi.%' THEN 'superset_api_duration'
      WHEN name = 'superset.execute_sql' THEN 'superset_execute_sql' ELSE 'superset_other' END AS metric,
    CASE WHEN name LIKE 'superset.%RestApi.%' THEN regexp_extract(name, '^superset\\.([A-Za-z]+)RestApi', 1) END AS resource,
    CASE WHEN name LIKE 'superset.%RestApi.%' THEN split_part(name, '.', 3) END AS method,
    CASE WHEN name LIKE 'superset.%RestApi.%.%' THEN split_part(name, '.', 4) END AS outcome,
    CASE WHEN name LIKE 'superset.new.%' THEN substr(name, 10) END AS other
  FROM names WHERE name LIKE 'superset.%' AND name <> 'superset.health') q
GROUP BY ALL""", "names"))
def _(x: Inputs):
    mapped = N.map_names(x.names().filter(F.col("name").startswith("superset.")), N.DASHBOARD_RULES)
    return mapped.select("metric", *[
        F.try_element_at("labels", F.lit(k)).alias(v)
        for k, v in {"resource": "resource", "method": "method", "outcome": "outcome", "metric": "other"}.items()
    ]).groupBy("metric", "resource", "method", "outcome", "other").agg(F.count(F.lit(1)).alias("n"))


@query("unmapped_names", sql("""
SELECT substr(name, 10) AS name, count(*) AS n FROM names WHERE name LIKE 'superset.new.%' GROUP BY 1""", "names"))
def _(x: Inputs):
    dotted = x.names().filter(F.col("name").startswith("superset."))
    return N.unmapped(N.map_names(dotted, N.DASHBOARD_RULES))


@query("relabelled_targets", sql("""
SELECT event_id, '10.0.0.' || CAST(user_id % 50 AS VARCHAR) || ':' || CAST(9000 + event_id % 7 AS VARCHAR) AS address,
  CASE WHEN event_id % 4 = 0 THEN '/minio/v2/metrics/cluster' ELSE '/metrics' END AS path,
  CASE WHEN event_id % 3 = 0 THEN event_type ELSE 'docker-sd' END AS job,
  event_type || '-' || CAST(user_id AS VARCHAR) AS instance
FROM events WHERE user_id % 5 <> 0 AND event_type <> 'signup'"""))
def _(x: Inputs):
    meta = "__meta_docker_container_label_prometheus_"
    uid, eid = F.col("user_id"), F.col("event_id")
    labels = F.map_concat(
        F.create_map(
            F.lit("__meta_docker_network_name"), F.when(uid % 5 == 0, "bridge").otherwise("backend"),
            F.lit(meta + "scrape"), F.when(F.col("event_type") == "signup", "false").otherwise("true"),
            F.lit("__address__"), F.concat(F.lit("10.0.0."), (uid % 50).cast("string"), F.lit(":80")),
            F.lit(meta + "port"), (eid % 7 + 9000).cast("string"),
            F.lit("__metrics_path__"), F.lit("/metrics"), F.lit("job"), F.lit("docker-sd"),
            F.lit("__meta_docker_container_name"), F.concat(F.lit("/"), "event_type", F.lit("-"), uid.cast("string")),
            F.lit(meta + "path"), F.when(eid % 4 == 0, "/minio/v2/metrics/cluster").otherwise(""),
            F.lit(meta + "job"), F.when(eid % 3 == 0, F.col("event_type")).otherwise(""),
        ))
    done = N.relabel(x.table("events").select("event_id", labels.alias("labels")), N.discovery_rules("backend"))
    return done.select("event_id", *[
        F.try_element_at("labels", F.lit(k)).alias(v)
        for k, v in {"__address__": "address", "__metrics_path__": "path", "job": "job", "instance": "instance"}.items()])


# alert rules and panels over the specified series

STEP, LOOKBACK = MINUTE, 5 * MINUTE
STEP_US = STEP * 1_000_000


def _text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _spec_ctes(specs: list[Spec]) -> str:
    """The samples of some series as SQL: CTE ``s`` (ts, metric, series, instance, value)."""
    rows = ",\n".join(
        f"({_text(p.metric)}, {_text(p.series)}, '{p.mode}', {float(p.low)!r}::DOUBLE, {float(p.high)!r}::DOUBLE, {p.period})"
        for p in specs)
    return f"""spec(metric, series, mode, low, high, period) AS (VALUES {rows}),
e AS (SELECT make_timestamp((epoch_us(ts) - {X.EPOCH_MICROS}) // {X.PACK} + {X.EPOCH_MICROS}) AS ts, event_id, value,
    sum(CAST(round(value * 100) AS BIGINT)) OVER w AS cents, count(*) OVER w AS n
  FROM events WINDOW w AS (PARTITION BY event_id // {X.READING})),
s AS (SELECT ts, metric, series, CASE mode
    WHEN 'reset' THEN CAST(floor(e.value) AS DOUBLE) WHEN 'steps' THEN CAST(event_id // period AS DOUBLE)
    WHEN 'seen' THEN CAST(epoch_us(ts) // 1000000 AS DOUBLE)
      - CASE WHEN cents > ({X.LEAST_LOAD} + period % {X.LOADS}) * 100 * n THEN high ELSE low END
    ELSE CASE WHEN cents > ({X.LEAST_LOAD} + period % {X.LOADS}) * 100 * n THEN high ELSE low END END AS value
  FROM e, spec)"""


def _alert_sql() -> str:
    fed = []
    for r in RULES:
        for p in SPECS:
            if p.metric in (r.metric, r.other) and matches(r.where, p.labels):
                role = "n" if p.metric == r.metric else "d"
                on = f"instance={dict(p.labels).get('instance', '')}" if r.on else p.series
                fed.append(f"({_text(r.name)}, '{role}', {_text(p.metric)}, {_text(p.series)}, {_text(on)})")
    rules = ",\n".join(
        f"({_text(r.name)}, '{r.kind}', '{r.op}', {float(r.limit)!r}::DOUBLE, {r.hold}, '{r.severity}', {r.window}, "
        f"'{'count' if r.kind == 'up' else r.agg}', {float(r.scale)!r}::DOUBLE, {float(r.offset)!r}::DOUBLE, "
        f"{'-1e300' if r.floor is None else float(r.floor)!r}::DOUBLE)" for r in RULES)
    return f"""WITH {_spec_ctes(SPECS)},
fed(alert, role, metric, series, onkey) AS (VALUES {", ".join(fed)}),
r(alert, kind, op, lim, hold, severity, win, agg, scale, off, floor) AS (VALUES {rules}),
tagged AS (SELECT fed.alert, role, onkey, s.series, ts, value, kind FROM s JOIN fed USING (metric, series) JOIN r USING (alert)),
points AS (SELECT * FROM tagged WHERE kind NOT IN ('rate', 'increase', 'changes')),
{_instant_sql('points', 'alert, kind, role, onkey, series', STEP, LOOKBACK)},
gauges AS (SELECT alert, CASE WHEN agg = '' THEN series ELSE '' END AS series, no,
    off + scale * (CASE WHEN agg = 'count' THEN CAST(count(value) AS DOUBLE) ELSE sum(value) END) AS value
  FROM inst JOIN r USING (alert, kind) WHERE kind = 'gauge' OR (kind = 'up' AND value = 1)
  GROUP BY alert, CASE WHEN agg = '' THEN series ELSE '' END, no, agg, off, scale),
ratios AS (SELECT alert, series, no, n / NULLIF(greatest(d, floor), 0) * scale AS value FROM (
    SELECT alert, onkey AS series, no, floor, scale, sum(CASE WHEN role = 'n' THEN value END) AS n,
      sum(CASE WHEN role = 'd' THEN value END) AS d
    FROM inst JOIN r USING (alert, kind) WHERE kind = 'ratio' GROUP BY alert, onkey, no, floor, scale) q
  WHERE n IS NOT NULL AND d IS NOT NULL),
grid AS (SELECT unnest(range(a + 1, b + 2)) AS no FROM (
  SELECT min(epoch_us(ts) // {STEP_US}) AS a, max(epoch_us(ts) // {STEP_US}) AS b FROM s) q),
stales AS (SELECT r.alert, '' AS series, grid.no, coalesce(grid.no * {STEP} - max(inst.value), 'Infinity'::DOUBLE) AS value
  FROM grid JOIN r ON r.kind = 'stale' LEFT JOIN inst ON inst.alert = r.alert AND inst.no = grid.no
  GROUP BY r.alert, grid.no),
pairs AS (SELECT alert, kind, series, ts, value, lag(ts) OVER w AS prev_ts, lag(value) OVER w AS prev_value
  FROM tagged WHERE kind IN ('rate', 'increase', 'changes')
  WINDOW w AS (PARTITION BY alert, series ORDER BY ts, value)),
spread AS (SELECT alert, series, kind, win, agg, off, scale,
    CASE WHEN kind = 'changes' THEN CASE WHEN value <> prev_value THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
      WHEN value >= prev_value THEN value - prev_value ELSE value END AS m,
    unnest(range(epoch_us(ts) // {STEP_US} + 1, (epoch_us(prev_ts) + win::BIGINT * 1000000) // {STEP_US} + 1)) AS no
  FROM pairs JOIN r USING (alert, kind) WHERE prev_ts IS NOT NULL),
single AS (SELECT alert, series, no, agg, off, scale,
    CASE WHEN kind = 'rate' THEN sum(m) / win ELSE sum(m) END AS value
  FROM spread GROUP BY alert, series, no, agg, off, scale, kind, win),
counters AS (SELECT alert, CASE WHEN agg = '' THEN series ELSE '' END AS series, no,
    off + scale * (CASE WHEN agg = 'avg' THEN sum(value) / count(value) ELSE sum(value) END) AS value
  FROM single GROUP BY alert, CASE WHEN agg = '' THEN series ELSE '' END, no, agg, off, scale),
conds AS (SELECT * FROM gauges UNION ALL SELECT * FROM ratios UNION ALL SELECT * FROM stales UNION ALL SELECT * FROM counters),
hit AS (SELECT c.alert, c.series, c.no, no - row_number() OVER (PARTITION BY c.alert, c.series ORDER BY no) AS island, hold, severity
  FROM conds c JOIN r USING (alert)
  WHERE CASE op WHEN '==' THEN value = lim WHEN '!=' THEN value <> lim WHEN '<' THEN value < lim ELSE value > lim END)
SELECT alert, severity, series, make_timestamp(min(no) * {STEP_US}) AS active_since,
  CASE WHEN (max(no) - min(no)) * {STEP} >= hold THEN make_timestamp((min(no) * {STEP} + hold)::BIGINT * 1000000) END AS fire_at,
  make_timestamp(max(no) * {STEP_US}) AS last_active
FROM hit GROUP BY alert, severity, series, island, hold"""


@query("alerts_of_all_rules", _alert_sql())
def _(x: Inputs):
    samples = X.rule_samples(x.spark, x.sf_dir, SPECS)
    return alerts.evaluate(samples, RULES, STEP, LOOKBACK)


def _panel_specs(p: panels.Panel) -> list[Spec]:
    return [s for s in SPECS if s.metric == p.metric]


def _panel_matches(p: panels.Panel, s: Spec) -> bool:
    if not p.where:
        return True
    name, regex, negate = p.where
    return matches([(name, "!~" if negate else "=~", regex)], s.labels)


def _panel_sql(title: str) -> str:
    p = panels.PANELS[title]
    specs = _panel_specs(p)
    by = p.by[0] if p.by else None
    chosen = [s for s in specs if _panel_matches(p, s)]
    pick = ", ".join(
        f"({_text(s.series)}, {_text(dict(s.labels).get(by, '') if by else '')})" for s in chosen)
    head = f"""WITH {_spec_ctes(specs)},
pick(series, by_label) AS (VALUES {pick}),
p AS (SELECT s.series, by_label, ts, value FROM s JOIN pick USING (series)),
"""
    if p.how == "rate":
        series = f"""pairs AS (SELECT *, lag(ts) OVER w AS prev_ts, lag(value) OVER w AS prev_value FROM p
  WINDOW w AS (PARTITION BY series ORDER BY ts, value)),
sp AS (SELECT series, by_label, CASE WHEN value >= prev_value THEN value - prev_value ELSE value END AS m,
    unnest(range(epoch_us(ts) // {STEP_US} + 1, (epoch_us(prev_ts) + {p.window * 1_000_000}) // {STEP_US} + 1)) AS no
  FROM pairs WHERE prev_ts IS NOT NULL),
inst AS (SELECT series, by_label, no, sum(m) / {p.window} AS value FROM sp GROUP BY ALL)"""
    else:
        series = _instant_sql("p", "series, by_label", STEP, LOOKBACK)
    t = f"make_timestamp(no * {STEP_US}) AS t"
    scaled = f"{float(p.offset)!r}::DOUBLE + {float(p.scale)!r}::DOUBLE * " if p.offset else ""
    if p.how == "up":
        return head + series + f" SELECT {t}, CAST(count(*) AS DOUBLE) AS value FROM inst WHERE value = 1 GROUP BY no"
    if p.agg:
        cols, group = (f"{t}, by_label AS {by}", "no, by_label") if by else (t, "no")
        return head + series + f" SELECT {cols}, {scaled}{p.agg}(value) AS value FROM inst GROUP BY {group}"
    if p.top:
        return head + series + f""" SELECT series, {t}, value, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY no ORDER BY value DESC, series) AS rank FROM inst) q WHERE rank <= {p.top}"""
    return head + series + f" SELECT series, {t}, value FROM inst"


def _register_panel(title: str) -> None:
    @query("panel_" + title.lower().replace(" ", "_").replace("-", "_"), _panel_sql(title))
    def _(x: Inputs):
        samples = X.rule_samples(x.spark, x.sf_dir, _panel_specs(panels.PANELS[title]))
        return panels.panel(title, samples, STEP, LOOKBACK)


for _title in panels.PANELS:
    _register_panel(_title)
