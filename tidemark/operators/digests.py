"""Comparing two large relations by digests of key ranges, so that equal ranges are never joined.

Every row has a 128-bit digest of its key and values. A leaf is a range of keys
(or of their hashes) and holds the number of its rows and the exclusive or of
their digests, which does not depend on order; ``FANOUT`` nodes make one node
of the level above. Building a tree is one scan with one small aggregate: no
row is shuffled. Two trees are compared from the top, and only rows of leaves
that differ are read again and joined. A tree can be kept beside its table.

Two ranges that differ have equal digests with a chance of about 2^-128.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.operators import changes, joins
from tidemark.session import shared_dir

FANOUT = 64
# At most this many differing nodes of a level are named in filters; beyond it the level above serves.
NAMED = 64
NO_KEY = -1


@dataclass(frozen=True)
class ByRange:
    """Leaves are equal ranges of one integer key between ``lo`` and ``hi``; other keys fall into the outer two.

    Fits tables that are written in key order: changes that lie together touch
    few leaves, and the differing ranges become pushed filters.
    """

    key: str
    lo: int
    hi: int
    depth: int = 3

    @property
    def width(self) -> int:
        return max(1, -(-(self.hi - self.lo + 1) // FANOUT**self.depth))

    def leaf(self) -> Column:
        inside = F.least(F.greatest(F.col(self.key).cast("bigint"), F.lit(self.lo)), F.lit(self.hi))
        return F.when(F.col(self.key).isNotNull(), S.id_block(inside - self.lo, self.width)).otherwise(NO_KEY)

    def inside(self, level: int, nodes: list[int]) -> Column:
        """Rows below the named nodes, as ranges of the key that a scan can prune by."""
        span = self.width * FANOUT ** (self.depth - level)
        last = (self.hi - self.lo) // span
        key, parts = F.col(self.key), [F.col(self.key).isNull()]
        for node in nodes:
            part = F.lit(True)
            if node > 0:
                part = part & (key >= self.lo + node * span)
            if node < last:
                part = part & (key < self.lo + (node + 1) * span)
            parts.append(part)
        return reduce(Column.__or__, parts)


@dataclass(frozen=True)
class ByHash:
    """Leaves are ranges of the hash of keys of any type."""

    keys: tuple[str, ...]
    depth: int = 3

    def leaf(self) -> Column:
        known = reduce(Column.__and__, [F.col(k).isNotNull() for k in self.keys])
        return F.when(known, F.pmod(F.xxhash64(*self.keys), F.lit(FANOUT**self.depth))).otherwise(NO_KEY)

    def inside(self, level: int, nodes: list[int]) -> Column:
        leaf = self.leaf()
        return (leaf == NO_KEY) | S.id_block(leaf, FANOUT ** (self.depth - level)).isin(nodes)


def _row_digest(columns: list[str], seed: int) -> Column:
    # A null leaves a hash as it is, so where the nulls are is hashed as well.
    nulls = [F.col(c).isNull() for c in columns]
    return F.xxhash64(F.lit(seed), *columns, *nulls)


def digest_tree(df: DataFrame, keys: list[str], cols: list[str], places: ByRange | ByHash) -> DataFrame:
    """(level, node, rows, h1, h2) of every node that holds rows; level 0 is the root.

    Rows with a null in a key are in no node; ``keys`` must be unique otherwise.
    """
    named = [*keys, *cols]
    leaves = (
        df.select(places.leaf().alias("leaf"), _row_digest(named, 1).alias("h1"), _row_digest(named, 2).alias("h2"))
        .filter(F.col("leaf") != NO_KEY)
        .groupBy("leaf")
        .agg(F.count(F.lit(1)).alias("rows"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    )
    levels = F.explode(F.array(*[
        F.struct(F.lit(level).alias("level"),
                 S.id_block("leaf", FANOUT ** (places.depth - level)).alias("node"))
        for level in range(places.depth + 1)
    ]))
    return (
        leaves.select(levels.alias("at"), "rows", "h1", "h2")
        .groupBy("at.level", "at.node")
        .agg(F.sum("rows").alias("rows"), F.bit_xor("h1").alias("h1"), F.bit_xor("h2").alias("h2"))
    )


def write_tree(tree: DataFrame, path: str | None = None) -> DataFrame:
    """Write a tree, one folder per level, and read it back."""
    spark = tree.sparkSession
    path = path or shared_dir(spark, "digests")
    tree.write.partitionBy("level").parquet(path)
    kinds = "node bigint, rows bigint, h1 bigint, h2 bigint, level int"
    return spark.read.schema(kinds).parquet(path)


def _differing(a: DataFrame, b: DataFrame, level: int, above: int, nodes: list[int]) -> DataFrame:
    """Nodes of a level whose digests differ, below the named nodes of the level ``above``."""
    span = FANOUT ** (level - above)
    below = reduce(Column.__or__, [F.col("node").between(n * span, (n + 1) * span - 1) for n in nodes], F.lit(False))

    def side(tree: DataFrame, name: str) -> DataFrame:
        own = tree.filter((F.col("level") == level) & below)
        return own.select("node", F.struct("rows", "h1", "h2").alias(name))

    both = side(a, "da").join(side(b, "db"), "node", "full_outer")
    return both.filter(~F.col("da").eqNullSafe(F.col("db"))).select("node")


def differing_leaves(a: DataFrame, b: DataFrame, places: ByRange | ByHash) -> tuple[DataFrame, Column]:
    """Leaves on which two written trees differ, and a filter that holds for all rows in them.

    The driver sees at most ``NAMED`` + 1 node numbers of a level. The filter
    names the nodes of the deepest level that has no more than that.
    """
    above, nodes = 0, [0]
    for level in range(places.depth):
        found = [r[0] for r in _differing(a, b, level, above, nodes).limit(NAMED + 1).collect()]
        if len(found) > NAMED:
            break
        above, nodes = level, found
        if not found:
            break
    return _differing(a, b, places.depth, above, nodes), places.inside(above, nodes)


def unequal_ranges(
    a: DataFrame, b: DataFrame, keys: list[str], cols: list[str], places: ByRange | ByHash,
    tree_a: DataFrame | None = None, tree_b: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that lie in leaves that differ, and those with a null key.

    Both sides are scanned once for their trees (unless kept trees are given)
    and once more below the pushed filter, so they should be tables or cheap to
    make. Compared columns must have equal types, else equal values would hash
    differently.
    """
    kinds = dict(a.select(*keys, *cols).dtypes)
    other = dict(b.select(*keys, *cols).dtypes)
    if kinds != other:
        raise ValueError(f"columns differ in type: {[c for c in kinds if kinds[c] != other[c]]}")
    tree_a = tree_a if tree_a is not None else write_tree(digest_tree(a, keys, cols, places))
    tree_b = tree_b if tree_b is not None else write_tree(digest_tree(b, keys, cols, places))
    leaves, inside = differing_leaves(tree_a, tree_b, places)
    spark, path = a.sparkSession, shared_dir(a.sparkSession, "leaves")
    # Written, so that the planner knows its size before it plans the semi-joins.
    leaves.union(spark.range(1).select(F.lit(NO_KEY).cast("bigint"))).write.parquet(path)
    wanted = spark.read.schema("node bigint").parquet(path)

    def rows(df: DataFrame) -> DataFrame:
        part = df.select(*keys, *cols).filter(inside)
        return part.withColumn("_leaf", places.leaf()).join(wanted, F.col("_leaf") == F.col("node"), "left_semi").drop("_leaf")

    return rows(a), rows(b)


def compare_by_digest(a: DataFrame, b: DataFrame, keys: list[str], cols: list[str], places: ByRange | ByHash,
                      **trees: DataFrame) -> DataFrame:
    """``joins.compare`` that joins only the rows of leaves that differ."""
    return joins.compare(*unequal_ranges(a, b, keys, cols, places, **trees), keys, cols)


def diff_by_digest(old: DataFrame, new: DataFrame, keys: list[str], lsn: int, places: ByRange | ByHash,
                   **trees: DataFrame) -> DataFrame:
    """``changes.diff_snapshots`` that joins only the rows of leaves that differ."""
    cols = [c for c in new.columns if c not in keys]
    before, after = unequal_ranges(old, new, keys, cols, places, **trees)
    return changes.diff_snapshots(before, after, keys, lsn)
