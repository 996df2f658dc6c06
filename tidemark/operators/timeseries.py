"""Windowed questions over metric samples ``(ts, metric, labels, value)``.

An evaluation time ``t`` sees the samples of ``[t - window, t)``. Evaluation
times are the multiples of ``step``. Increases are sums of the counted
differences inside the window; they are not extrapolated to its edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.operators.sequences import adjacent_pairs, hour_chunk, runs

# Scrape and evaluation interval, and how long a sample stays visible.
STEP = 15
LOOKBACK = 300
MICROS = 1_000_000
SPINE_BLOCK = 4096
# Lookbacks in a block of evaluation times: one sample in so many is placed in two blocks.
SEEN_BLOCK = 16


def label(name: str) -> Column:
    """Value of a label, empty text where the series does not carry it."""
    return F.coalesce(F.try_element_at("labels", F.lit(name)), F.lit(""))


def label_matches(name: str, regex: str, negate: bool = False) -> Column:
    """Whole-value regular expression match on a label."""
    hit = label(name).rlike(f"^(?:{regex})$")
    return ~hit if negate else hit


def series_key(labels="labels") -> Column:
    """A label set as JSON text with sorted names, the identity of a series.

    Free of lambda functions: two uses of the same samples then have equal
    plans and share one shuffle.
    """
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(labels))))


def with_labels(samples: DataFrame, *names: str) -> DataFrame:
    """Labels as columns, ready to group by."""
    return samples.withColumns({n: label(n) for n in names})


def _div(c: Column, by: int) -> Column:
    return F.call_function("div", c, F.lit(by).cast("bigint"))


def _block_of(step_no: Column, size: int) -> Column:
    """The block of so many steps that a step lies in; blocks before 1970 are as long as the others."""
    return _div(step_no - F.pmod(step_no, F.lit(size).cast("bigint")), size)


def _at(step_no: Column, step: int) -> Column:
    return S.from_micros(step_no * F.lit(step * MICROS))


def counter_deltas(
    samples: DataFrame, keys: list[str], ts: str = "ts", value: str = "value", chunk: Column | None = None
) -> DataFrame:
    """What a counter grew by since its previous sample; after a reset it grew by its new value."""
    pairs = adjacent_pairs(samples, keys, [ts, value], [], hour_chunk(ts) if chunk is None else chunk)
    now, before = F.col(value), F.col(f"prev_{value}")
    return pairs.filter(F.col(f"prev_{ts}").isNotNull()).select(
        *keys,
        F.col(ts).alias("ts"),
        F.col(f"prev_{ts}").alias("prev_ts"),
        F.when(now >= before, now - before).otherwise(now).alias("delta"),
        S.flag(now != before).alias("changed"),
    )


def over_windows(pairs: DataFrame, keys: list[str], measure: str, window, step: int) -> DataFrame:
    """Sum a per-pair measure over every window that holds both samples of the pair.

    Pairs are first added up per range of evaluation times, then spread out, so
    the expansion works on one row per range and not per sample.
    """
    width = window if isinstance(window, Column) else F.lit(window)
    micros = step * MICROS
    first = _div(S.epoch_micros("ts"), micros) + 1
    last = _div(S.epoch_micros("prev_ts") + width.cast("bigint") * MICROS, micros)
    ranges = (
        pairs.select(*keys, first.alias("_from"), last.alias("_to"), F.col(measure).alias("_m"))
        .filter(F.col("_from") <= F.col("_to"))
        .groupBy(*keys, "_from", "_to")
        .agg(F.sum("_m").alias("_m"))
    )
    spread = ranges.select(*keys, F.explode(F.sequence("_from", "_to")).alias("_no"), "_m")
    return spread.groupBy(*keys, "_no").agg(F.sum("_m").alias("value")).select(
        *keys, _at(F.col("_no"), step).alias("t"), "value"
    )


def increase(samples: DataFrame, keys: list[str], window: int | Column, step: int = STEP) -> DataFrame:
    """Growth of a counter over a window (seconds), counter resets included."""
    return over_windows(counter_deltas(samples, keys), keys, "delta", window, step)


def rate(samples: DataFrame, keys: list[str], window: int | Column, step: int = STEP) -> DataFrame:
    """Growth per second over a window. ``window`` may be a column that depends on ``keys``."""
    width = window if isinstance(window, Column) else F.lit(window)
    grown = increase(samples, keys, window, step)
    return grown.withColumn("value", F.col("value") / width.cast("double"))


def changes(samples: DataFrame, keys: list[str], window: int | Column, step: int = STEP) -> DataFrame:
    """How often a value changed within a window."""
    return over_windows(counter_deltas(samples, keys), keys, "changed", window, step)


def newest_of_steps(samples: DataFrame, step: int = STEP) -> DataFrame:
    """The newest sample of each metric, label map and step; all that ``instant`` reads of ``samples``.

    A map whose entries stand in another order counts as another one, so no label has to be sorted or written out per
    sample. Metrics and maps are told apart by a 128-bit hash: the rows of the aggregate are then ordered by numbers only.
    """
    named = ["metric", "_names", "_texts"]
    split = samples.select(
        "ts", "value", "metric", F.map_keys("labels").alias("_names"), F.map_values("labels").alias("_texts"))
    newest = split.groupBy(
        F.xxhash64(*named).alias("_h1"), F.xxhash64(F.lit("second"), *named).alias("_h2"),
        _div(S.epoch_micros("ts"), step * MICROS).alias("_no"),
    ).agg(F.max(F.struct("ts", "value", *named)).alias("_s"))
    return newest.select(
        "_s.ts", "_s.metric", F.map_from_arrays("_s._names", "_s._texts").alias("labels"), "_s.value")


def instant(samples: DataFrame, keys: list[str], step: int = STEP, lookback: int = LOOKBACK) -> DataFrame:
    """The newest value each evaluation time sees, at most ``lookback`` seconds old.

    Only the newest sample of a (series, step) counts. It is seen until the next one comes or it is too old; what comes
    next is looked up inside blocks of evaluation times, so a long series is not one group.
    """
    no = _div(S.epoch_micros("ts"), step * MICROS)
    newest = samples.groupBy(*keys, no.alias("_no")).agg(F.max(F.struct("ts", "value")).alias("_s"))
    # A sample at ts is visible at t while ts < t <= ts + lookback.
    last = _div(S.epoch_micros(F.col("_s.ts")) + lookback * MICROS, step * MICROS)
    first = F.col("_no") + 1
    size = SEEN_BLOCK * max(1, -(-lookback // step))
    # With a lookback below the step, a sample may be too old at the first time after it.
    placed = newest.select(*keys, "_no", "_s", last.alias("_last")).filter(F.col("_last") >= first).select(
        "*", F.explode(F.sequence(_block_of(first, size), _block_of(F.col("_last"), size))).alias("_block"))
    inside = Window.partitionBy(*keys, "_block").orderBy("_no")
    start = F.greatest(first, F.col("_block") * size)
    end = F.least("_last", F.lead("_no").over(inside), F.col("_block") * size + (size - 1))
    # In a later block a newer sample may have come before the block's first time.
    seen = placed.select(*keys, "_s.value", start.alias("_start"), end.alias("_end")).filter("_start <= _end")
    return seen.select(*keys, F.explode(F.sequence("_start", "_end")).alias("_t"), "value").select(
        *keys, _at(F.col("_t"), step).alias("t"), "value"
    )


def breaches(value: Column, op: str, limit) -> Column:
    """Comparison of a value with a limit."""
    limit = limit if isinstance(limit, Column) else F.lit(float(limit))
    return {
        "==": value == limit,
        "!=": value != limit,
        "<": value < limit,
        ">": value > limit,
    }[op]


def threshold(series: DataFrame, op: str, limit: float) -> DataFrame:
    """Evaluation times at which a series breaches a limit."""
    return series.filter(breaches(F.col("value"), op, limit))


def count_up(samples: DataFrame, job: str, step: int = STEP, lookback: int = LOOKBACK) -> DataFrame:
    """Targets of a job that answer, per evaluation time; no row when none does."""
    up = samples.filter((F.col("metric") == "up") & (label("job") == job))
    seen = instant(up.withColumn("series", series_key()), ["series"], step, lookback)
    return seen.filter(F.col("value") == 1).groupBy("t").agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )


def across(series: DataFrame, how: str, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """sum / avg / max / min / count over the series of each evaluation time, optionally by labels."""
    agg = {"sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min, "count": F.count}[how]
    return series.groupBy("t", *by).agg(agg("value").cast("double").alias("value"))


def metric_ratio(
    samples: DataFrame,
    num: str,
    den: str,
    on: list[str],
    step: int = STEP,
    scale: float = 100.0,
    floor: float | None = None,
    lookback: int = LOOKBACK,
) -> DataFrame:
    """Sum of one metric over another per ``on`` labels and time, times ``scale``.

    Both metrics come out of one scan and one grouping instead of a self-join.
    ``floor`` keeps the denominator from falling below a value.
    """
    both = samples.filter(F.col("metric").isin(num, den)).withColumn("series", series_key())
    keys = list(dict.fromkeys(["metric", *on, "series"]))
    seen = instant(both, keys, step, lookback)
    is_num, is_den = F.col("metric") == num, F.col("metric") == den
    sides = seen.groupBy(*on, "t").agg(
        F.sum(F.when(is_num, F.col("value"))).alias("_num"),
        F.sum(F.when(is_den, F.col("value"))).alias("_den"),
    ).filter(F.col("_num").isNotNull() & F.col("_den").isNotNull())
    den_value = F.col("_den") if floor is None else S.at_least("_den", floor)
    return sides.select(*on, "t", (S.ratio(F.col("_num"), den_value) * F.lit(scale)).alias("value"))


def stale(samples: DataFrame, expected: DataFrame, keys: list[str], as_of, seconds: int) -> DataFrame:
    """Expected series and whether they are fresh, stale or absent at ``as_of``."""
    seen = samples.filter(F.col("ts") <= as_of).groupBy(*keys).agg(F.max("ts").alias("last_seen"))
    age = (S.epoch_micros(as_of) - S.epoch_micros("last_seen")) / F.lit(float(MICROS))
    status = (
        F.when(F.col("last_seen").isNull(), "absent").when(age > seconds, "stale").otherwise("fresh")
    )
    return expected.join(seen, keys, "left").withColumn("status", status)


def or_absent(rows: DataFrame, filler: Column) -> DataFrame:
    """The rows themselves, or one filler row when there are none."""
    name = rows.columns[0]
    empty = rows.agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == 0)
    return rows.unionByName(empty.select(filler.alias(name)), allowMissingColumns=True)


def held_for(
    series: DataFrame,
    keys: list[str],
    condition: str,
    seconds: int | Column,
    ts: str = "t",
    max_gap_seconds: float | None = None,
) -> DataFrame:
    """Stretches in which a condition held, and when they had held for ``seconds``.

    ``fire_at`` is null for a stretch that ended while still pending.
    ``seconds`` may be a column that depends on ``keys``.
    """
    hold = seconds if isinstance(seconds, Column) else F.lit(seconds)
    held = runs(series, keys, ts, condition, max_gap_seconds).filter(F.col(condition))
    due = S.from_micros(S.epoch_micros("start") + hold.cast("bigint") * MICROS)
    return held.select(
        *keys, "start", "end",
        F.when(F.col("end") >= due, due).alias("fire_at"),
    )


def spine(samples: DataFrame, step: int) -> DataFrame:
    """Every evaluation time from the first sample to the last, also the quiet ones."""
    no = _div(S.epoch_micros("ts"), step * MICROS)
    bounds = samples.agg((F.min(no) + 1).alias("_a"), (F.max(no) + 1).alias("_b"))
    # Blocks first, so that no single array spans the whole range.
    block, size = F.col("_block"), SPINE_BLOCK
    inside = F.sequence(F.greatest("_a", block * size), F.least("_b", block * size + size - 1))
    return (
        bounds.filter(F.col("_a").isNotNull())
        .select("_a", "_b", F.explode(F.sequence(_div(F.col("_a"), size), _div(F.col("_b"), size))).alias("_block"))
        .repartition("_block")  # else one task makes the whole time axis
        .select(F.explode(inside).alias("_no"))
        .select(_at(F.col("_no"), step).alias("t"))
    )


def stalled(samples: DataFrame, keys: list[str], window: int, step: int = STEP) -> DataFrame:
    """Evaluation times whose window saw no growth at all, empty windows included."""
    grown = across(increase(samples, keys, window, step), "sum")
    quiet = spine(samples, step).join(grown, "t", "left")
    return quiet.filter(F.coalesce("value", F.lit(0.0)) == 0).select("t")


def recent(df: DataFrame, ts: str, as_of, interval: str) -> DataFrame:
    """Rows of the last ``interval`` before ``as_of`` only."""
    return df.filter(F.col(ts) > as_of - F.expr(f"INTERVAL {interval}"))


def series_count(samples: DataFrame, pattern: str) -> DataFrame:
    """Distinct series whose metric name matches a pattern."""
    hit = samples.filter(F.col("metric").rlike(f"^(?:{pattern})$"))
    distinct = hit.groupBy("metric", series_key().alias("series")).agg(F.lit(1).alias("one"))
    return distinct.agg(F.count(F.lit(1)).alias("series"))


def label_values(samples: DataFrame, name: str) -> DataFrame:
    """Distinct values a label takes."""
    return samples.groupBy(label(name).alias("v")).agg(F.lit(1).alias("one")).agg(
        F.count_if(F.col("v") != "").alias("values")
    )


def unfold_windows(samples: DataFrame, keys: list[str], window: str, slide: str, *aggs: Column) -> DataFrame:
    """Aggregates over sliding event-time windows; the same call serves batch and streaming."""
    framed = samples.groupBy(F.window("ts", window, slide).alias("_w"), *keys).agg(*aggs)
    names = [c for c in framed.columns if c not in ("_w", *keys)]
    return framed.select(*keys, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *names)
