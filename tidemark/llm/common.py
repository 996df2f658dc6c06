"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import shared_dir, tune

# A word is a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Documents are long: a thousand of them are a fitting Arrow batch.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    This cuts the lineage (a lost executor costs only the current step), gives
    the planner true sizes, and runs an expensive step once.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, label)
    spark.conf.set(CLEAN, "true")  # the step's shuffle files go when it has been written
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a ``staged`` table that nothing will read any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._staged_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_text(doc_id: str | Column) -> Column:
    """The id as text; a null id counts as the empty text."""
    return F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id's text modulo ``n``."""
    return F.crc32(id_text(doc_id)) % n


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Add columns; one that has the name of an input column takes its place."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in new], *[v.alias(k) for k, v in new.items()])


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, str], label: str) -> DataFrame:
    """Number the rows in a global order and add sums over all rows before each.

    Adds ``rank`` (from 0) and for each ``new: column`` of ``sums`` the total of
    the column over earlier rows. Rows are dealt by range and written, so no
    task sees more than its range; only one row per range meets in one task.
    """
    ranges = staged(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), label)
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("__range").agg(
        F.count("*").alias("__rows"), *[F.sum(c).alias(f"__sum_{n}") for n, c in sums.items()]
    ).select("__range", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows_before"),
             *[F.coalesce(F.sum(f"__sum_{n}").over(earlier), F.lit(0)).alias(f"__before_{n}") for n in sums])
    inside = Window.partitionBy("__range").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (ranges.join(starts, "__range")
            .withColumn("rank", F.col("__rows_before") + F.row_number().over(inside) - 1)
            .withColumns({n: F.col(f"__before_{n}") + F.coalesce(F.sum(c).over(before), F.lit(0))
                          for n, c in sums.items()})
            .select(*[f"`{c}`" for c in df.columns], "rank", *sums))


def components(edges: DataFrame, a: str = "a", b: str = "b", label: str = "components") -> DataFrame:
    """(node, root): every node of ``edges`` with the smallest node it is connected to.

    Alternates two star steps until nothing changes: each node's larger
    neighbours are linked to its smallest neighbour, then each node and its
    smaller neighbours. A step is one aggregate with map-side combining and one
    join; edges stay linear in number, and each round is written, so a hot
    centre is neither collected nor recomputed. Rounds grow with the logarithm
    of the longest chain.
    """
    edges = staged(edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
                   .filter("lo <> hi").distinct(), label)
    previous = None
    while True:
        # Large star: every neighbour above the centre points to the smallest of the centre's circle.
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(
            edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        # Small star: smaller neighbours and the centre itself point to the smallest one.
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").select(F.col("m").alias("x"), F.col("lo").alias("y")).unionAll(
            down.select(F.col("m").alias("x"), F.col("hi").alias("y"))).filter("x <> y")
        edges = staged(small.select(F.col("x").alias("lo"), F.col("y").alias("hi")).distinct(), label)
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)")).alias("h")).first()
        if state == previous:
            break
        previous = state
    roots = edges.groupBy("hi").agg(F.min("lo").alias("root")).select(F.col("hi").alias("node"), "root")
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
