"""Mixing sources to target weights by capped water-filling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import WORD, id_text, replace_columns, running_totals, staged

SALTS = 32


def _word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, epochs: float = 2.0) -> DataFrame:
    """(source, rows, source_size, target): words each source gives to the mix.

    Sources in code-point order, null last, take the weights in turn. Targets
    share ``share`` times all words by weight; a target stops at ``epochs``
    times its source's size and the excess is shared again by weight until no
    target is above. In the order of (cap / weight) the sources that stop come
    first, so one pass of running totals finds the final level; only single
    rows of totals reach the driver. Without any word all targets are 0.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    ranked = running_totals(per_source, [F.col("source").asc_nulls_last()], {}, "mix-sources")
    turns = F.array(*[F.lit(float(w)) for w in weights])
    weighted = ranked.select(
        "source", "rows", "source_size",
        F.get(turns, (F.col("rank") % len(weights)).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(epochs))).alias("cap"))
    filled = staged(running_totals(
        weighted.withColumn("level", F.col("cap") / F.col("weight")),
        [F.col("level"), F.col("source").asc_nulls_last()], {"cap_before": "cap", "weight_before": "weight"}, "mix-levels",
    ), "mix-filled")
    total, weight = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    if total is None:
        return filled.select("source", "rows", "source_size", F.lit(0.0).alias("target"))
    wanted = F.lit(float(share) * total)
    stops = F.col("level") < (wanted - F.col("cap_before")) / (F.lit(weight) - F.col("weight_before"))
    stopped, free = filled.agg(
        F.coalesce(F.sum(F.when(stops, F.col("cap"))), F.lit(0.0)),
        F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0.0))).first()
    level = (float(share) * total - stopped) / free if free else float("inf")
    return filled.select("source", "rows", "source_size",
                         F.least(F.col("cap"), F.col("weight") * F.lit(level)).alias("target"))


def _salted(per_source: DataFrame) -> DataFrame:
    return per_source.withColumnRenamed("source", "__source").withColumn(
        "__salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))


def _with_source(rows: DataFrame, per_source: DataFrame, source: str = "source", key: str = "doc_id") -> DataFrame:
    """Give each row its source's columns. A hot source is spread over ``SALTS`` keys; a small
    per-source table, whose size is known because it was written, is broadcast by the planner."""
    salted = rows.withColumn("__row_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    plan = _salted(per_source)
    return (salted.join(plan, salted[f"`{source}`"].eqNullSafe(plan["__source"])
                        & (salted["__row_salt"] == plan["__salt"]), "left")
            .drop("__source", "__salt", "__row_salt"))


def mix_plan(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, epochs: float = 2.0, seed: int = 17,
             doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per source: its target, its whole repetitions and where its fractional one ends.

    Each document gets the whole repetitions; one more goes to documents in
    seeded order while at least half of the next one fits into what is left of
    the target. The seeded order is cut into about sqrt(rows) buckets per
    source: whole buckets are decided from their sums, and only the rows of the
    one bucket where the target ends are put in order.
    """
    key = F.md5(F.concat(id_text("doc_id"), F.lit(f":{seed}")))
    sizes = staged(docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        _word_count(F.col(f"`{text}`")).alias("size")).withColumn("key", key), "mix-sizes")
    targets = source_targets(sizes, weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = staged(targets.withColumn("whole", whole)
                  .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
                  .withColumn("buckets", F.ceil(F.sqrt(F.col("rows").cast("double"))).cast("long")), "mix-plan")
    cut = _with_source(sizes, plan.select("source", "rest", "buckets")).withColumn("bucket", _bucket("key", "buckets"))
    order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    last = (cut.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
            .withColumn("before", F.coalesce(F.sum("words").over(order), F.lit(0)))
            .filter("before < rest AND before + words >= rest")
            .select("source", F.col("bucket").alias("last_bucket"), F.col("before").alias("bucket_before")))
    last = staged(last, "mix-last")
    inside = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ends = (_with_source(cut, last).filter("bucket = last_bucket")
            .withColumn("before", F.col("bucket_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .filter("before < rest AND 2 * before + size <= 2 * rest")
            .groupBy("source").agg(F.max(F.struct("key", "doc_id", "size")).alias("last_row")))
    shape = plan.alias("p").join(last.alias("l"), F.expr("p.source <=> l.source"), "left").join(
        ends.alias("e"), F.expr("p.source <=> e.source"), "left")
    return staged(shape.select("p.*", "last_bucket", "last_row"), "mix-ends")


def _bucket(key: str, buckets: str):
    unit = F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return F.floor(unit * F.col(buckets))


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, epochs: float = 2.0, seed: int = 17,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken.

    ``size`` counts words (0 for a null or empty text), ``copies`` says how
    often the mix repeats the document, ``taken`` is size times copies. No
    document is repeated more than ceil(epochs) times. A source's taken words
    differ from its target by half a document at most. A null source is a
    source of its own. Rows that repeat an id, source and size are taken or
    left together at the end of a target. Result columns replace input columns
    of the same name; an empty table gives an empty result.
    """
    plan = mix_plan(docs, weights, share, epochs, seed, doc_id, text, source)
    plan = plan.select("source", *[F.col(c).alias(f"__{c}") for c in plan.columns if c != "source"])
    named = docs.withColumns({
        "__size": _word_count(F.col(f"`{text}`")),
        "__key": F.md5(F.concat(id_text(F.col(f"`{doc_id}`")), F.lit(f":{seed}")))})
    rows = _with_source(named, plan, source, f"`{doc_id}`")
    bucket = _bucket("__key", "__buckets")
    mine = F.struct(F.col("__key").alias("key"), F.col(f"`{doc_id}`").alias("doc_id"), F.col("__size").alias("size"))
    more = F.coalesce((bucket < F.col("__last_bucket"))
                      | ((bucket == F.col("__last_bucket")) & (mine <= F.col("__last_row"))), F.lit(False))
    copies = F.col("__whole") + more.cast("long")
    out = replace_columns(rows, {
        "size": F.col("__size"), "source_size": F.col("__source_size"), "target": F.col("__target"),
        "copies": copies, "taken": F.col("__size") * copies})
    return out.select(*[f"`{c}`" for c in docs.columns if c not in MIX_COLUMNS], *MIX_COLUMNS)


MIX_COLUMNS = ("size", "source_size", "target", "copies", "taken")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    names = {c: f"__in_{c}" for c in docs.columns if c in MIX_COLUMNS}
    rows = mix(docs.withColumnsRenamed(names), **options).filter("copies > 0")
    kept = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("__copy", *MIX_COLUMNS)
    return kept.withColumnsRenamed({v: k for k, v in names.items()}).select(*[f"`{c}`" for c in docs.columns])
