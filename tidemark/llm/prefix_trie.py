"""Prefix trie of conversations, by ROLLUP over positional turn-id columns.

A conversation becomes rows of ``WIDTH`` turn-id columns: one row per block of
turns, keyed by the node the block starts at. One ROLLUP over the columns
aggregates every prefix of every block at once, and grouping_id tells a
group's depth. A longer conversation continues in the next block's columns,
keyed by the node its last block ended at.

Turns are identified by 128 bits of SHA-256 over role and text; a node by its
depth and two 64-bit xors of position-dependent hashes of the turns on its path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import running_totals, staged

WIDTH = 8  # turn-id columns of a block
CHUNK = 4_096  # blocks, or nodes, of one conversation that meet in one window
PIECE = 10  # ids that share all but their last 10 bits are joined before they are hashed


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _lane(seed: int, turn: Column, pos: Column) -> Column:
    """One hash of a turn at a place (from 1); absent turns count nothing."""
    return F.when(turn.isNotNull(), F.xxhash64(F.lit(seed), pos.cast("long"), turn["hi"], turn["lo"], turn["n"])).otherwise(F.lit(0))


def turns_of(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv_id, pos from 1, id): the turns of each conversation in order.

    ``id`` is struct(hi, lo, n): the turn's digest and the code points of its
    text. Null turns come first; rows that share a turn are ordered by role and
    digest, so equal rows are turns of their own. A null role or text is empty.
    Rows without a conversation id belong to no conversation and are left out.
    """
    role_, text_ = F.coalesce(_c(role).cast("string"), F.lit("")), F.coalesce(_c(text).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), 256)
    rows = (conversations.filter(_c(conv_id).isNotNull())
            .select(_c(conv_id).cast("long").alias("conv_id"), _c(turn).alias("turn"), role_.alias("role"),
                    digest.alias("digest"), F.length(text_).cast("long").alias("n"))
            .select("conv_id", "turn", "role", F.struct(
                F.conv(F.substring("digest", 1, 16), 16, -10).cast("long").alias("hi"),
                F.conv(F.substring("digest", 17, 16), 16, -10).cast("long").alias("lo"), "n").alias("id")))
    # A global rank splits a conversation of any length over the ranges.
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("id")]
    ranked = staged(running_totals(rows, order, {}, "trie-ranges").select("conv_id", "id", "rank"), "trie-turns")
    first = ranked.groupBy("conv_id").agg(F.min("rank").alias("first"))
    return ranked.join(first, "conv_id").select("conv_id", (F.col("rank") - F.col("first") + 1).alias("pos"), "id")


def rebuild(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, pos, id, length): conversations that open with turns of their group's first one.

    Conversation c starts with the first h turns of c - c % ``group`` (all, if
    it has fewer; none, if it is absent), h = crc32 of c's decimal digits modulo
    ``most``; its own turns after its first h follow. A conversation that is
    left without turns has one row with nulls and length 0.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % most
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).select(
        "conv_id", "own", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h"))
    # Only the first few turns of one conversation in ``group`` can open others.
    heads = turns.filter((F.col("pos") < most) & (F.col("conv_id") % group == 0)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("head")).withColumnRenamed("conv_id", "base")
    convs = staged(convs.join(heads, "base", "left").select(
        "conv_id", "h", F.coalesce(F.slice("head", 1, F.col("h").cast("int")), F.array().cast(
            "array<struct<pos:bigint,id:struct<hi:bigint,lo:bigint,n:bigint>>>")).alias("head"), "own")
        .withColumn("opened", F.size("head").cast("long"))
        .withColumn("length", F.col("opened") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "trie-conversations")
    opening = convs.filter("opened > 0").select("conv_id", "length", F.explode("head").alias("t")).select(
        "conv_id", "t.pos", "t.id", "length")
    own = turns.join(convs.drop("head"), "conv_id").filter("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("opened")).alias("pos"), "id", "length")
    bare = convs.filter("length = 0").select(
        "conv_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast(turns.schema["id"].dataType).alias("id"), "length")
    return opening.unionAll(own).unionAll(bare)


def _before(df: DataFrame, key: str, place: Column, folds: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds, for each ``new: (function, column)``, the fold of the column over the key's rows at smaller places.

    Rows of a key meet in windows of ``CHUNK`` places; what earlier chunks
    amount to is carried by one row per chunk, of which short keys have none.
    """
    df = df.withColumn("__place", place).withColumn("__chunk", F.floor(F.col("__place") / CHUNK))
    inside = Window.partitionBy(key, "__chunk").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(key).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    functions = {"sum": F.sum, "bit_xor": F.bit_xor}

    def join(function: str, a: Column, b: Column) -> Column:
        return a + b if function == "sum" else a.bitwiseXOR(b)

    long_keys = df.filter("__chunk > 0").select(key).distinct()
    totals = df.join(long_keys, key, "left_semi").groupBy(key, "__chunk").agg(
        *[functions[f](c).alias(f"__all_{n}") for n, (f, c) in folds.items()])
    carried = totals.select(key, "__chunk", *[functions[f](f"__all_{n}").over(earlier).alias(f"__carry_{n}")
                                              for n, (f, c) in folds.items()]).filter("__chunk > 0")
    zero = F.lit(0).cast("long")
    out = df.withColumns({n: F.coalesce(functions[f](c).over(inside), zero) for n, (f, c) in folds.items()})
    out = out.join(carried, [key, "__chunk"], "left")
    return out.withColumns({n: join(f, F.col(n), F.coalesce(F.col(f"__carry_{n}"), zero)) for n, (f, c) in folds.items()}) \
        .drop("__place", "__chunk", *[f"__carry_{n}" for n in folds])


def blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, length, block, key1, key2, t0 … t7): one row per conversation and block, and block 0 for all."""
    place = F.coalesce(F.col("pos") - 1, F.lit(0))
    slot = place % WIDTH
    rows = turns.withColumn("block", F.floor(place / WIDTH)).groupBy("conv_id", "block").agg(
        F.max("length").alias("length"),
        *[F.max(F.when(slot == j, F.col("id"))).alias(f"t{j}") for j in range(WIDTH)])

    def lane(seed: int) -> Column:
        out = F.lit(0).cast("long")
        for j in range(WIDTH):
            out = out.bitwiseXOR(_lane(seed, F.col(f"t{j}"), F.col("block") * WIDTH + j + 1))
        return out

    rows = rows.withColumns({"all1": lane(1), "all2": lane(2)})
    return _before(rows, "conv_id", F.col("block"), {"key1": ("bit_xor", F.col("all1")), "key2": ("bit_xor", F.col("all2"))})


def _rollup(rows: DataFrame, measures: dict[str, str]) -> DataFrame:
    """Measures of every node: (depth, z1, z2, p1, p2, n, …); p1 and p2 are the parent's z1 and z2."""
    slots = [f"t{j}" for j in range(WIDTH)]
    grouped = rows.sparkSession.sql(
        f"SELECT block, key1, key2, {', '.join(slots)}, grouping_id() AS gid, "
        + ", ".join(f"{sql} AS {name}" for name, sql in measures.items())
        + f" FROM {{rows}} GROUP BY block, key1, key2, ROLLUP ({', '.join(slots)})", rows=rows)
    # grouping_id has a one for each column rolled away, the last column lowest.
    away = F.bit_count("gid")
    grouped = grouped.withColumn("d", F.lit(WIDTH) - away)
    last = F.element_at(F.array(*slots), F.greatest(F.col("d").cast("int"), F.lit(1)))
    # A block's top is the node the block before ended at; a null turn is behind the end of its rows.
    grouped = grouped.filter((F.col("d") == 0) & (F.col("block") == 0) | (F.col("d") > 0) & last.isNotNull())

    def prefix(seed: int, depth: Column) -> Column:
        out = F.col(f"key{seed}")
        for j in range(WIDTH):
            out = out.bitwiseXOR(F.when(depth > j, _lane(seed, F.col(f"t{j}"), F.col("block") * WIDTH + j + 1)).otherwise(F.lit(0)))
        return out

    parent = F.col("d") - 1
    return grouped.select(
        (F.col("block") * WIDTH + F.col("d")).cast("long").alias("depth"),
        prefix(1, F.col("d")).alias("z1"), prefix(2, F.col("d")).alias("z2"),
        F.when(F.col("d") > 0, prefix(1, parent)).alias("p1"), F.when(F.col("d") > 0, prefix(2, parent)).alias("p2"),
        F.when(F.col("d") > 0, last["n"]).otherwise(F.lit(0)).alias("n"),
        *measures)


def _hash_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per node over its pieces, which arrive in order; only the running hash is kept."""
    node, running = None, None
    for batch in batches:
        found = []
        for d, a, b, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if (d, a, b) != node:
                if node is not None:
                    found.append((*node, running.hexdigest()))
                node, running = (d, a, b), hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["depth", "z1", "z2", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, running.hexdigest())],
                                         names=["depth", "z1", "z2", "ends_sha256"])


def _ends(rows: DataFrame) -> DataFrame:
    """(depth, z1, z2, ends_sha256): hash of the ids of the conversations that end at a node.

    Ids are joined in pieces of neighbouring ids, at most 1024 each. A node with
    one piece is hashed by SQL; the pieces of others stream through one task
    per node in order, because the hash of a list is made front to back.
    """
    last = rows.filter("length <= (block + 1) * {0} AND (length > block * {0} OR block = 0)".format(WIDTH)).select(
        F.col("length").alias("depth"), F.col("key1").bitwiseXOR(F.col("all1")).alias("z1"),
        F.col("key2").bitwiseXOR(F.col("all2")).alias("z2"), "conv_id")
    pieces = last.groupBy("depth", "z1", "z2", F.shiftright("conv_id", PIECE).alias("piece")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    pieces = staged(pieces, "trie-ends")
    many = staged(pieces.groupBy("depth", "z1", "z2").agg(F.count("*").alias("c")).filter("c > 1").drop("c"), "trie-long-ends")
    one = pieces.join(many, ["depth", "z1", "z2"], "left_anti").select("depth", "z1", "z2", F.sha2("ids", 256).alias("ends_sha256"))
    streamed = (pieces.join(many, ["depth", "z1", "z2"], "left_semi").repartition("depth", "z1", "z2")
                .sortWithinPartitions("depth", "z1", "z2", "piece").select("depth", "z1", "z2", "ids"))
    return one.unionAll(streamed.mapInArrow(_hash_pieces, "depth long, z1 long, z2 long, ends_sha256 string"))


def trie(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations in ``turns`` (conv_id, pos, id, length).

    Columns: conv_id (smallest member), depth, parent_conv_id (null at the
    root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256. Without
    any conversation there is no node, not even a root.

    A subtree's sums need no walk. Each node belongs to its smallest member; a
    conversation's own nodes are the lower end of its path. So the sum over a
    node's subtree is the sum, over its members, of all their own nodes, less
    what the smallest member owns above the node: a second ROLLUP.
    """
    rows = staged(blocks(turns), "trie-blocks")
    nodes = staged(_rollup(rows, {"conv_id": "min(conv_id)", "n_convs": "count(*)", "longest": "max(length)"}), "trie-nodes")
    nodes = nodes.withColumn("weight", (F.col("n_convs") - 1) * F.col("n")).withColumn(
        "leaf", (F.col("longest") == F.col("depth")).cast("long"))
    owned = nodes.groupBy("conv_id").agg(F.sum("weight").alias("weight"), F.sum("leaf").alias("leaves"))
    sums = _rollup(rows.join(owned, "conv_id", "left"),
                   {"total": "coalesce(sum(weight), 0)", "n_leaves": "coalesce(sum(leaves), 0)"})
    key = ["depth", "z1", "z2"]
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("z1"),
                                                 F.col("p2").alias("z2")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("z1").alias("p1"), F.col("z2").alias("p2"),
                           F.col("conv_id").alias("parent_conv_id"))
    placed = _before(nodes, "conv_id", F.col("depth"), {"above": ("sum", F.col("weight"))})
    out = (placed.join(sums.select(*key, "total", "n_leaves"), key).join(children, key, "left").join(_ends(rows), key, "left")
           .join(parents, ["depth", "p1", "p2"], "left"))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        (F.col("total") - F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                      text: str = "text", group: int = 100, most: int = 6) -> DataFrame:
    """The prefix trie of the rebuilt conversations; see ``turns_of``, ``rebuild`` and ``trie``.

    Odd rows: null turns come first, null roles and texts are empty, texts of
    any length are hashed whole, ties are ordered by role and digest, repeated
    rows are turns of their own, rows without conv_id are left out, other
    columns are ignored, an empty table has no node. Ids must be integers.
    """
    return trie(rebuild(turns_of(conversations, conv_id, turn, role, text), group, most))
