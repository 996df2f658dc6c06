"""Ranked lexical search: exact inner products by best-first search in sparse ball trees.

A document is a sparse vector over the queries' terms: a term's saturated
frequency. A query is the vector of its terms' weights, so a score is an inner
product. Documents are cut into shards, each with a ball tree: every node has
the centre of its documents and a radius that holds them all. For a query q no
document under a node scores above q·centre + |q|·radius; nodes are opened in
the order of that bound until none can reach the k-th best document found so
far. The bound is computed in doubles and widened by more than their rounding;
leaves are scored in 64-bit integers, so results are exact.

Queries are dealt in blocks of a bounded number of terms, and a block's terms
travel with the tasks. Terms are identified by 64-bit hashes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import running_totals, staged
from tidemark.llm.words import LOWER_VALUES, hash_runs, slices

BLOCK_TERMS = 1 << 18  # different terms of a block of queries; one query may have more
SHARD_TERMS = 1 << 20  # (document, term) entries of a shard; one document may have more
LEAF = 32  # documents of a leaf

# A term is a run of digits, letters and any bytes of characters beyond ASCII.
TERM = np.zeros(256, bool)
TERM[0x80:] = True
for first, last in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    TERM[first:last] = True


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every term, offsets of each text's terms); terms end with their text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    inside = TERM[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[bounds] = True
    edges = np.flatnonzero(edge)
    starts, ends = edges[:-1], edges[1:]
    kept = inside[starts]
    starts, ends = starts[kept], ends[kept]
    return hash_runs(data, starts, ends, LOWER_VALUES), np.searchsorted(starts, bounds)


def _grouped(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, count) of the different terms of each text."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])])[:len(text)])
    return text[first], hashes[first], np.diff(np.append(first, len(text)))


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, bounds in slices(batch.column("text")):
            text, hashes, _ = _grouped(*terms(data, bounds))
            yield pa.record_batch([batch.column("item").take(pa.array(text + lo)), pa.array(hashes.view(np.int64))],
                                  names=["item", "term"])


def _postings(batches: Iterable[pa.RecordBatch], known: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per document: id, number of terms, and the places in ``known`` and counts of those it knows."""
    for batch in batches:
        for lo, hi, data, bounds in slices(batch.column("text")):
            hashes, offsets = terms(data, bounds)
            at = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
            hit = known[at] == hashes if len(known) else np.zeros(len(hashes), bool)
            before = np.concatenate([[0], np.cumsum(hit)])
            text, place, count = _grouped(at[hit].astype(np.uint64), before[offsets])
            cut = np.searchsorted(text, np.arange(hi - lo + 1)).astype(np.int32)
            yield pa.record_batch(
                [batch.column("id").slice(lo, hi - lo), pa.array(np.diff(offsets)),
                 pa.ListArray.from_arrays(cut, pa.array(place.astype(np.int32))),
                 pa.ListArray.from_arrays(cut, pa.array(count.astype(np.int32)))], names=["id", "n", "terms", "tf"])


def _frequencies(batches: Iterable[pa.RecordBatch], n_known: int) -> Iterator[pa.RecordBatch]:
    """One row per term seen: in how many documents of this task."""
    seen = np.zeros(n_known, np.int64)
    for batch in batches:
        seen += np.bincount(pc.list_flatten(batch.column("terms")).to_numpy(zero_copy_only=False), minlength=n_known)
    some = np.flatnonzero(seen)
    yield pa.record_batch([pa.array(some), pa.array(seen[some])], names=["place", "df"])


class Shard:
    """Documents as rows of a sparse matrix, reordered so that every node of the ball tree is a run of rows."""

    def __init__(self, cut: np.ndarray, place: np.ndarray, value: np.ndarray):
        self.cut, self.place, self.value = cut, place, value
        # Terms of this shard only, so that dense helpers do not grow with the block of queries.
        self.terms, self.local = np.unique(place, return_inverse=True)
        self.weight = value.astype(float)
        self.square = np.add.reduceat(np.append(self.weight ** 2, 0.0), cut[:-1]) * (np.diff(cut) > 0)
        self.order = np.arange(len(cut) - 1)
        self.nodes: list[tuple[int, int, int, int]] = []  # rows from, to; children
        self.radius: list[float] = []
        self.centres: list[tuple[np.ndarray, np.ndarray]] = []
        self._grow()
        sizes = np.diff(cut)[self.order]
        self.row_cut = np.concatenate([[0], np.cumsum(sizes)])
        entries = np.repeat(cut[:-1][self.order] - self.row_cut[:-1], sizes) + np.arange(self.row_cut[-1])
        self.row_place, self.row_value = place[entries], value[entries]
        node = np.repeat(np.arange(len(self.nodes)), [len(c[0]) for c in self.centres])
        slot = np.concatenate([c[0] for c in self.centres]) if self.centres else np.zeros(0, np.int64)
        by_term = np.argsort(slot, kind="stable")
        self.term_cut = np.searchsorted(slot[by_term], np.arange(len(self.terms) + 1))
        self.term_node, self.term_value = node[by_term], np.concatenate([c[1] for c in self.centres])[by_term]

    def _entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = (self.cut[1:] - self.cut[:-1])[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        return np.repeat(self.cut[:-1][rows] - starts[:-1], sizes) + np.arange(starts[-1]), np.repeat(np.arange(len(rows)), sizes)

    def _distances(self, rows: np.ndarray, centre: np.ndarray) -> np.ndarray:
        """Squared distances of rows to a dense point."""
        entries, owner = self._entries(rows)
        dots = np.bincount(owner, self.weight[entries] * centre[self.local[entries]], len(rows))
        return np.maximum(0.0, self.square[rows] - 2 * dots + centre @ centre)

    def _point(self, row: int) -> np.ndarray:
        out = np.zeros(len(self.terms))
        s = slice(self.cut[row], self.cut[row + 1])
        out[self.local[s]] = self.weight[s]
        return out

    def _grow(self) -> None:
        """Cuts rows at the middle between two far apart ones, until a leaf is left."""
        if not len(self.order):
            return
        pending = [(0, len(self.order), -1, 0)]
        while pending:
            lo, hi, parent, side = pending.pop()
            me, rows = len(self.nodes), self.order[lo:hi]
            entries, _ = self._entries(rows)
            centre = np.bincount(self.local[entries], self.weight[entries], len(self.terms)) / len(rows)
            far = self._distances(rows, centre)
            # Squares lose digits where they cancel; the widening covers that for any number of terms.
            slack = 1e-9 * (float(self.square[rows].max()) + float(centre @ centre))
            slot = np.flatnonzero(centre)
            self.centres.append((slot, centre[slot]))
            self.radius.append(float(np.sqrt(far.max() + slack)))
            self.nodes.append((lo, hi, -1, -1))
            if parent >= 0:
                a, b, left, right = self.nodes[parent]
                self.nodes[parent] = (a, b, me, right) if side == 0 else (a, b, left, me)
            if hi - lo > LEAF:
                one = self._point(rows[int(far.argmax())])
                d_one = self._distances(rows, one)
                two = self._point(rows[int(d_one.argmax())])
                sorted_rows = np.argsort(d_one - self._distances(rows, two), kind="stable")
                self.order[lo:hi] = rows[sorted_rows]
                middle = (lo + hi) // 2
                pending += [(middle, hi, me, 1), (lo, middle, me, 0)]

    def bounds(self, place: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """For every node a number that no document below it exceeds."""
        at = np.searchsorted(self.terms, place)
        hit = np.flatnonzero((at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == place)) if len(self.terms) else []
        total = np.zeros(len(self.nodes))
        if not len(hit):
            return total
        first, last = self.term_cut[at[hit]], self.term_cut[at[hit] + 1]
        sizes = last - first
        entries = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        w = weight[hit].astype(float)
        total += np.bincount(self.term_node[entries], self.term_value[entries] * np.repeat(w, sizes), len(self.nodes))
        return (total + np.sqrt((w * w).sum()) * np.array(self.radius)) * (1 + 1e-9) + 1

    def best(self, place: np.ndarray, weight: np.ndarray, dense: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, scores) that hold all of the k best documents with score above 0 and at least ``floor``; leaves opened."""
        limit, opened = max(1, floor), 0
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not self.nodes:
            return rows, scores, opened
        bounds = self.bounds(place, weight)
        dense[place] = weight
        heap = [(-bounds[0], 0)]
        while heap and -heap[0][0] >= limit:
            _, node = heapq.heappop(heap)
            lo, hi, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    # A child's documents are its parent's: the smaller bound holds.
                    bounds[child] = min(bounds[child], bounds[node])
                    heapq.heappush(heap, (-bounds[child], child))
                continue
            opened += 1
            a, b = self.row_cut[lo], self.row_cut[hi]
            running = np.concatenate([[0], np.cumsum(dense[self.row_place[a:b]] * self.row_value[a:b])])
            exact = np.diff(running[self.row_cut[lo:hi + 1] - a])
            good = np.flatnonzero(exact >= limit)
            if len(good):
                rows, scores = np.append(rows, self.order[lo + good]), np.append(scores, exact[good])
                if len(scores) >= k:
                    limit = max(limit, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                    kept = scores >= limit
                    rows, scores = rows[kept], scores[kept]
        dense[place] = 0
        return rows, scores, opened


def _search(batches: Iterable[pa.RecordBatch], items: list[tuple[np.ndarray, np.ndarray]], n_known: int, k: int,
            n_docs: int, n_terms: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """The k best documents of this task for each query, from one shard after the other."""
    dense = np.zeros(n_known, np.int64)
    best: list[pa.Table | None] = [None] * len(items)
    floors = [1] * len(items)
    waiting: list[pa.RecordBatch] = []

    def finish() -> None:
        table = pa.Table.from_batches(waiting)
        waiting.clear()
        counts = pc.list_value_length(table.column("terms")).to_numpy()
        cut = np.concatenate([[0], np.cumsum(counts)])
        place = pc.list_flatten(table.column("terms")).to_numpy()
        tf = pc.list_flatten(table.column("tf")).to_numpy().astype(np.int64)
        m = 50 + (50 * table.column("n").to_numpy().astype(np.int64) * n_docs) // n_terms
        shard = Shard(cut, place, (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, counts)))
        for i, (p, w) in enumerate(items):
            rows, scores, _ = shard.best(p, w, dense, k, floors[i])
            if len(rows):
                found = pa.table({"doc_id": table.column("id").take(pa.array(rows)), "score": scores})
                found = found if best[i] is None else pa.concat_tables([best[i], found])
                order = pc.sort_indices(found, [("score", "descending"), ("doc_id", "ascending")], null_placement="at_end")[:k]
                best[i] = found.take(order).combine_chunks()
                if len(best[i]) == k:
                    floors[i] = best[i].column("score")[-1].as_py()

    held = 0
    for batch in batches:
        # A document without any of the terms scores 0 everywhere.
        batch = batch.filter(pc.greater(pc.list_value_length(batch.column("terms")), 0))
        lo = 0
        while lo < batch.num_rows:
            ends = held + np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False)[lo:])
            n = max(1, int(np.searchsorted(ends, SHARD_TERMS, "right")))
            waiting.append(batch.slice(lo, n))
            lo, held = lo + n, int(ends[min(n, len(ends)) - 1])
            if held >= SHARD_TERMS or lo < batch.num_rows:
                finish()
                held = 0
    if waiting:
        finish()
    for i, found in enumerate(best):
        if found is not None:
            yield pa.record_batch([pa.array(np.full(len(found), i)), found.column("doc_id").combine_chunks().cast(id_type),
                                   found.column("score").combine_chunks()], names=["item", "doc_id", "score"])


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item, equal scores by ascending id.

    Every document is indexed, whole. Odd rows: a null text has no term; a
    document or item without terms has no result; rows that share an item id
    are one item with the terms of all of them, a null item id is an item too;
    repeated documents each have their rank; a document with a null id comes
    last among equal scores; other columns are ignored; empty tables give an
    empty result.
    """
    spark = docs.sparkSession
    source = docs.select(_c(doc_id).alias("id"), _c(text).cast("string").alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    asked = items.select(_c(item_id).alias("item"), _c(item_text).cast("string").alias("text"))
    item_type = asked.schema["item"].dataType.simpleString()
    queries = asked.mapInArrow(_item_terms, f"item {item_type}, term long").distinct()
    sizes = queries.groupBy("item").agg(F.count("*").alias("size"))
    # Whole items, in order, go to a block until its terms are full.
    numbered = running_totals(sizes, [F.col("item")], {"before": "size"}, "search-items").select(
        "item", "size", F.col("rank").alias("number"), F.floor(F.col("before") / BLOCK_TERMS).alias("block"))
    numbered = staged(numbered, "search-blocks")
    queries = staged(queries.join(numbered.withColumnRenamed("item", "__item"), F.col("item").eqNullSafe(F.col("__item")))
                     .select("number", "block", "term"), "search-terms")
    results = None
    for block in range(int((numbered.agg(F.max("block")).first()[0] or 0)) + 1):
        # One block's terms: bounded by BLOCK_TERMS and one item more.
        asked_here = queries.filter(F.col("block") == block).select("number", "term").toArrow().sort_by(
            [("number", "ascending"), ("term", "ascending")])
        hashes = asked_here.column("term").to_numpy().view(np.uint64)
        known, place = np.unique(hashes, return_inverse=True)
        postings = staged(source.mapInArrow(lambda batches, known=known: _postings(batches, known),
                                            f"id {id_type}, n long, terms array<int>, tf array<int>"), "search-postings")
        total = postings.filter("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not total.docs or not len(known):
            continue
        df = np.zeros(len(known), np.int64)
        seen = postings.select("terms").mapInArrow(lambda batches, n=len(known): _frequencies(batches, n), "place long, df long")
        counted = seen.groupBy("place").agg(F.sum("df").alias("df")).toArrow()  # one row per term of the block
        df[counted.column("place").to_numpy()] = counted.column("df").to_numpy()
        weight = np.floor(1000 * np.log((2 * total.docs + 2) / (2 * df + 1))).astype(np.int64)
        numbers, starts = np.unique(asked_here.column("number").to_numpy(), return_index=True)
        parts = np.split(place, starts[1:])
        vectors = [(np.sort(p).astype(np.int32), weight[np.sort(p)]) for p in parts]
        shared = spark.sparkContext.broadcast((vectors, numbers))

        def task(batches, shared=shared, n=len(known), total=tuple(total)):
            arrow = pa.int64() if id_type == "bigint" else pa.string()
            for found in _search(batches, shared.value[0], n, k, *total, arrow):
                yield found.set_column(0, "item", pa.array(shared.value[1][found.column("item").to_numpy()]))

        found = postings.mapInArrow(task, f"item long, doc_id {id_type}, score long")
        results = found if results is None else results.unionAll(found)
    if results is None:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = results.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(numbered.select("number", F.col("item").alias("item_id")), F.col("item") == F.col("number")).select(
        "item_id", "rank", "doc_id", "score")
