import datetime as dt
import random

from pyspark.sql import functions as F

from tables import rows
from tidemark.functions import names as N
from tidemark.operators import timeseries as TS
from tidemark.plans import alerts, panels
from tidemark.plans.alert_rules import RULES, Rule

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def samples(spark, *data):
    lines = [(at(s), m, labels, float(v)) for s, m, labels, v in data]
    return spark.createDataFrame(lines, "ts timestamp_ntz, metric string, labels map<string,string>, value double")


def counter(spark, values, step=15, metric="c", labels=None):
    return samples(spark, *[(i * step, metric, labels or {"i": "a"}, v) for i, v in enumerate(values)])


def keyed(df):
    return df.withColumn("series", TS.series_key())


def test_increase_counts_a_reset_from_zero(spark):
    df = keyed(counter(spark, [10, 14, 3, 5]))
    got = {r.t: r.value for r in TS.increase(df, ["series"], 60, 15).collect()}
    assert got[at(60)] == 4 + 3 + 2
    assert got[at(30)] == 4
    assert got[at(75)] == 3 + 2
    assert at(15) not in got


def test_rate_is_growth_per_second_and_changes_counts_moves(spark):
    df = keyed(counter(spark, [0, 30, 30, 60]))
    assert {r.t: r.value for r in TS.rate(df, ["series"], 60, 60).collect()}[at(60)] == 1.0
    assert {r.t: r.value for r in TS.changes(df, ["series"], 60, 60).collect()}[at(60)] == 2


def test_window_needs_both_samples_of_a_difference(spark):
    df = keyed(samples(spark, (0, "c", {}, 1), (100, "c", {}, 5)))
    assert TS.increase(df, ["series"], 60, 20).isEmpty()


def test_instant_shows_the_newest_value_for_the_lookback(spark):
    df = keyed(samples(spark, (1, "g", {}, 1), (16, "g", {}, 2), (17, "g", {}, 3)))
    got = {r.t: r.value for r in TS.instant(df, ["series"], 15, 45).collect()}
    assert got == {at(15): 1, at(30): 3, at(45): 3, at(60): 3}


def test_instant_shows_nothing_older_than_a_lookback_below_the_step(spark):
    df = keyed(samples(spark, (1, "g", {}, 1), (580, "g", {}, 2), (1190, "g", {}, 3)))
    got = {r.t: r.value for r in TS.instant(df, ["series"], 600, 30).collect()}
    assert got == {at(600): 2, at(1200): 3}
    assert TS.instant(df.filter("value = 1"), ["series"], 600, 30).isEmpty()


def test_instant_spreads_a_sample_only_to_the_next_one(spark):
    rnd = random.Random(3)
    data, t = [], -70_000
    for i in range(900):
        t += rnd.choice([0, 1, 7, 40, 40, 700])
        data.append((t, "g", {}, rnd.randint(0, 9)))
    df = keyed(samples(spark, *data))
    # Times before 1970 are not counted in whole steps.
    for step, lookback in ((15, 300), (60, 45), (15, 15), (20, 70)):
        seen = TS.instant(df, ["series"], step, lookback)
        got = {r.t: r.value for r in seen.collect()}
        grid = range(-70_000 // step * step, t + lookback + step, step)
        want = {}
        for now in grid:
            visible = [(s, v) for s, _, _, v in data if s < now <= s + lookback]
            # A sample on an evaluation time belongs to the step that begins there.
            if visible:
                want[at(now)] = max(visible)[1]
        assert got == want and seen.count() == len(want)
        # All that is spread is a row of the result: nothing is brought together after it.
        plan = seen._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan[:plan.index("sequence(_start")]


def test_newest_of_steps_keeps_what_instant_reads(spark):
    df = samples(spark, (1, "g", {"a": "1", "b": "2"}, 1), (16, "g", {"a": "1", "b": "2"}, 2), (17, "g", {"a": "1", "b": "2"}, 3),
                 (17, "g", {"a": "1", "b": "2"}, 7), (17, "h", {"a": "1", "b": "2"}, 9),
                 (2, "h", None, 5), (3, "h", None, 6))
    kept = TS.newest_of_steps(df, 15)
    assert kept.count() == 4 and kept.columns == df.columns
    want, got = (rows(TS.instant(keyed(d), ["metric", "series"], 15, 45)) for d in (df, kept))
    assert want == got


def test_samples_are_cut_to_steps_before_they_are_tagged(spark):
    df = samples(spark, *[(s, "pg_up", {"instance": "a"}, s % 2) for s in range(0, 120)])
    plan = alerts.conditions(df, [r for r in RULES if r.name == "PostgresDown"], 60, 300)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in text[text.index("Generate explode("):]


def test_up_targets_and_sums(spark):
    df = samples(spark, (1, "up", {"job": "k", "i": "1"}, 1), (2, "up", {"job": "k", "i": "2"}, 0),
                 (3, "up", {"job": "k", "i": "3"}, 1), (3, "up", {"job": "x", "i": "3"}, 1))
    assert rows(TS.count_up(df, "k", 15, 15)) == [(at(15), 2.0)]


def test_ratio_with_floor_and_missing_side(spark):
    df = samples(spark, (1, "a", {"i": "1"}, 5), (1, "b", {"i": "1"}, 0), (1, "a", {"i": "2"}, 5))
    with_i = TS.with_labels(df, "i")
    assert rows(TS.metric_ratio(with_i, "a", "b", ["i"], 15, floor=1, lookback=15)) == [("1", at(15), 500.0)]
    assert rows(TS.metric_ratio(with_i, "a", "b", ["i"], 15, lookback=15)) == [("1", at(15), None)]


def test_held_for_fires_when_due(spark):
    states = [(0, True), (15, True), (30, True), (45, False), (60, True)]
    df = spark.createDataFrame([("s", at(t), v) for t, v in states], "k string, t timestamp_ntz, c boolean")
    assert rows(TS.held_for(df, ["k"], "c", 30)) == [
        ("s", at(0), at(30), at(30)), ("s", at(60), at(60), None)]
    assert rows(TS.held_for(df, ["k"], "c", 0, max_gap_seconds=10))[0] == ("s", at(0), at(0), at(0))


def test_stale_absent_and_filler(spark):
    df = samples(spark, (0, "seen", {}, 1), (500, "late", {}, 1))
    expected = spark.createDataFrame([("seen",), ("late",), ("gone",)], "metric string")
    got = TS.stale(df, expected, ["metric"], F.lit(at(400)), 300).select("metric", "status")
    assert rows(got) == [("gone", "absent"), ("late", "absent"), ("seen", "stale")]
    none = df.filter("metric = 'x'").select("metric")
    assert rows(TS.or_absent(none, F.lit("missing"))) == [("missing",)]
    assert rows(TS.or_absent(df.select("metric").limit(1), F.lit("missing"))) != [("missing",)]


def test_stalled_notices_empty_windows(spark):
    df = keyed(samples(spark, (0, "c", {}, 1), (20, "c", {}, 2), (40, "c", {}, 2), (400, "c", {}, 3)))
    quiet = {r.t for r in TS.stalled(df, ["series"], 60, 60).collect()}
    assert at(60) not in quiet and at(240) in quiet


def test_label_matching_is_anchored(spark):
    df = samples(spark, (0, "m", {"db": "template1"}, 1), (0, "m", {"db": "shop"}, 1), (0, "m", {}, 1))
    assert df.filter(TS.label_matches("db", "template.*|postgres", negate=True)).count() == 2
    assert df.filter(TS.label_matches("db", "sho")).count() == 0
    assert TS.label_values(df, "db").first()[0] == 2
    assert TS.series_count(df, "m").first()[0] == 3


def test_rule_table_covers_every_shape():
    assert len(RULES) == 55 and len({r.name for r in RULES}) == 55
    assert {r.kind for r in RULES} == {"gauge", "up", "ratio", "stale", "rate", "increase", "changes"}
    assert len(panels.PANELS) == 17


def fired(spark, rule, df, step=15, lookback=15):
    return [(r.series, r.active_since, r.fire_at) for r in
            alerts.evaluate(df, [rule], step, lookback).orderBy("active_since").collect()]


def test_gauge_rule_is_pending_then_firing(spark):
    rule = Rule("R", "gauge", "g", ">", 5, 30, "warning")
    df = samples(spark, *[(i * 15 + 1, "g", {"i": "a"}, v) for i, v in enumerate([9, 9, 9, 1, 9, 1])])
    assert fired(spark, rule, df) == [('{"i":"a"}', at(15), at(45)), ('{"i":"a"}', at(75), None)]


def test_up_rule_counts_answering_targets(spark):
    rule = Rule("R", "up", "up", "<", 2, 0, "critical", where=(("job", "=", "k"),))
    df = samples(spark, (1, "up", {"job": "k", "i": "1"}, 1), (1, "up", {"job": "k", "i": "2"}, 1),
                 (16, "up", {"job": "k", "i": "1"}, 1), (16, "up", {"job": "k", "i": "2"}, 0))
    assert fired(spark, rule, df) == [("", at(30), at(30))]


def test_stale_rule_fires_on_age_and_on_absence(spark):
    epoch = T0.replace(tzinfo=dt.timezone.utc).timestamp()
    rule = Rule("R", "stale", "seen", ">", 20, 0, "critical", where=(("name", "=", "web"),))
    df = samples(spark, (1, "seen", {"name": "web"}, epoch), (16, "seen", {"name": "web"}, epoch + 1),
                 (46, "other", {}, 1))
    assert fired(spark, rule, df) == [("", at(30), at(30))]


def test_increase_rule_ignores_other_labels(spark):
    rule = Rule("R", "increase", "c", ">", 0, 0, "warning", where=(("state", "=", "failed"),), window=60)
    ok = counter(spark, [1, 2, 3], labels={"state": "ok"})
    bad = counter(spark, [1, 1, 2], labels={"state": "failed"})
    assert [s for s, _, _ in fired(spark, rule, ok.unionByName(bad))] == ['{"state":"failed"}']


def test_panel_topk_and_idle_share(spark):
    data = [(i, "container_memory_usage_bytes", {"name": f"c{i}"}, i) for i in range(14)]
    top = panels.panel("Memory by container", samples(spark, *data, (0, "container_memory_usage_bytes", {}, 99)), 15, 15)
    assert top.count() == 10 and top.agg(F.max("value")).first()[0] == 13
    cpu = counter(spark, [0, 3, 6, 9, 12], metric="node_cpu_seconds_total", labels={"mode": "idle"})
    got = {r.t: r.value for r in panels.panel("CPU used", cpu, 60).collect()}
    assert got[at(60)] == 100 - 9 / 300 * 100


def test_names_first_rule_wins(spark):
    data = ["airflow.ti.finish.etl.load.success", "airflow.dag.etl.load.duration", "airflow.pool.open-slots",
            "superset.health", "superset.DashboardRestApi.get.success", "superset.DashboardRestApi.get",
            "superset.ChartDataRestApi.json_dumps", "superset.loaded_from_source_without_force", "superset.brand.new",
            "superset.execute_sql"]
    df = spark.createDataFrame([(n,) for n in data], "name string")
    got = {r.name: (r.metric, r.labels) for r in N.map_names(df, N.SCHEDULER_RULES + N.DASHBOARD_RULES).collect()}
    assert got["airflow.ti.finish.etl.load.success"] == (
        "airflow_task_finish_total", {"dag_id": "etl", "task_id": "load", "state": "success"})
    assert got["airflow.pool.open-slots"] == ("airflow_pool_open_slots", {})
    assert "superset.health" not in got
    assert got["superset.DashboardRestApi.get"] == ("superset_api_duration", {"resource": "Dashboard", "method": "get"})
    assert got["superset.ChartDataRestApi.json_dumps"][0] == "superset_json_dumps"
    assert got["superset.loaded_from_source_without_force"][0] == "superset_loaded_from_source_no_force"
    assert got["superset.brand.new"] == ("superset_other", {"metric": "brand.new"})


def test_relabelling_of_a_discovered_target(spark):
    meta = "__meta_docker_container_label_prometheus_"
    base = {"__meta_docker_network_name": "backend", meta + "scrape": "true", "__address__": "10.0.0.5:80",
            meta + "port": "9187", meta + "job": "postgres", "__meta_docker_container_name": "/pg"}
    df = spark.createDataFrame([(1, base), (2, {**base, meta + "scrape": "false"}),
                                (3, {**base, "__meta_docker_network_name": "x"})], "id int, labels map<string,string>")
    out = N.relabel(df, N.discovery_rules("backend")).collect()
    assert [r.id for r in out] == [1]
    labels = out[0].labels
    assert (labels["__address__"], labels["job"], labels["instance"]) == ("10.0.0.5:9187", "postgres", "pg")
    assert "__metrics_path__" not in labels
