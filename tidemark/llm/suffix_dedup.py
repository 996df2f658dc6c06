"""Repeated passages: every byte that lies in a string of ``length`` bytes which also starts earlier.

Inserting one symbol of every document per round needs as many rounds over the
whole collection as the longest document has bytes. Here the column-wise
construction runs on short texts of equal width instead, in two steps:

1. Anchors. Of the ``length - K + 1`` substrings of K bytes in a string the one
   with the smallest hash is its anchor, so equal strings have equal anchors at
   the same place, and neighbouring strings mostly share one. Only an anchor
   that occurs more than once can lie in a repeated string; the bytes around it
   that hold all strings it anchors are its context. The strings of an anchor
   that very many texts share get wider anchors, which are rarer. A context
   that equals one of an earlier document is repeated as a whole; only the
   others, those of its first document among them, go on.
2. Columns. The contexts of a bucket of anchors are lined up at their anchors.
   Round by round, from the last column to the first, one symbol of each is put
   before its suffix: the order of the suffixes and the common prefixes of
   neighbours (as far as ``length`` counts) follow from those of the round
   before. Neighbours that share ``length`` symbols are equal strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import release, staged
from tidemark.llm.words import GOLDEN, VALUES, mix, powers, slices

K = 32  # bytes of an anchor
BUCKET = 2_000  # contexts that are sorted together, on average
WIDE = 80  # bytes of the anchors that take the place of hot ones
HOT = 1_000  # an anchor with more contexts is hot


def _rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` bytes."""
    base, inverse = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(VALUES[data] * base[:len(data)], out=total[1:])
    return mix((total[width:] - total[:-width]) * inverse[:len(data) + 1 - width])


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, k: int = K, wanted: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(hash, place, first start, last start, text) of each anchor with the run of ``wanted`` strings that it anchors."""
    none = (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 4
    if len(data) < length:
        return none
    hashes = _rolling(data, k)
    window = length - k + 1
    # The hash's upper half and the place: among equal hashes the leftmost is the smallest.
    least = (hashes >> np.uint64(32) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= window:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < window:
        least = np.minimum(least[:size - window], least[window - size:])
    inside = np.zeros(len(data) + 1, np.int64)
    sizes = np.diff(bounds)
    long = sizes >= length
    np.add.at(inside, bounds[:-1][long], 1)
    np.add.at(inside, bounds[1:][long] - length + 1, -1)
    valid = np.cumsum(inside)[:len(least)] > 0
    starts = np.flatnonzero(valid if wanted is None else valid & wanted[:len(least)])
    if not len(starts):
        return none
    place = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    first, last = starts[at], starts[np.append(at[1:], len(starts)) - 1]
    place = place[at]
    return hashes[place], place, first, last, np.searchsorted(bounds, place, "right") - 1


def _anchor_rows(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        for lo, hi, data, bounds in slices(batch.column("text")):
            hashes, place, _, _, text = anchors(data, bounds, length)
            yield pa.record_batch([pa.array(hashes.view(np.int64)), pa.array(ids[lo + text]), pa.array(place - bounds[text])],
                                  names=["hash", "id", "place"])


MARKS = "hash long, key long, id long, place long, first long, last long"


def _mark_rows(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Each repeated anchor; equal contexts with the anchor at the same place have equal keys.

    The strings of a hot anchor get wider anchors, which fewer texts share.
    """
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        for lo, hi, data, bounds in slices(batch.column("text")):
            found = anchors(data, bounds, length)
            listed = batch.column("places").slice(lo, hi - lo)
            values = listed.flatten()
            at = values.field("place").to_numpy() + np.repeat(bounds[:-1], np.diff(listed.offsets.to_numpy()))
            hot = values.field("hot").to_numpy(zero_copy_only=False)
            if not len(at) or not len(found[0]):
                continue
            order = np.argsort(at)
            at, hot = at[order], hot[order]
            spot = np.minimum(np.searchsorted(at, found[1]), len(at) - 1)
            repeated = at[spot] == found[1]
            hot = repeated & hot[spot]
            sets = [[x[repeated & ~hot] for x in found]]
            if hot.any():
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, found[2][hot], 1)
                np.add.at(edge, found[3][hot] + 1, -1)
                sets.append(anchors(data, bounds, length, WIDE, np.cumsum(edge) > 0))
            base, inverse = powers(len(data) + 1)
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(VALUES[data] * base[:len(data)], out=total[1:])
            for hashes, place, first, last, text in sets:
                shape = ((place - first) << 16 | (last - first)).astype(np.uint64)
                key = mix(mix((total[last + length] - total[first]) * inverse[first]) + shape * GOLDEN)
                base = bounds[text]
                yield pa.record_batch([pa.array(x) for x in (hashes.view(np.int64), key.view(np.int64), ids[lo + text],
                                                             place - base, first - base, last - base)], names=MARK_NAMES)


MARK_NAMES = [c.split()[0] for c in MARKS.split(", ")]
CONTEXTS = "hash long, id long, place long, first long, last long, context binary"


def _context_rows(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The listed contexts with their bytes."""
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        for lo, hi, data, bounds in slices(batch.column("text")):
            listed = batch.column("places").slice(lo, hi - lo)
            text = np.repeat(np.arange(hi - lo), np.diff(listed.offsets.to_numpy()))
            hashes, place, first, last = (listed.flatten().field(c).to_numpy() for c in ("hash", "place", "first", "last"))
            base = bounds[text]
            yield pa.record_batch([pa.array(x) for x in (hashes, ids[lo + text], place, first, last)] + [
                pa.array([data[f:e + length].tobytes() for f, e in zip(first + base, last + base)], pa.binary())],
                names=CONTEXT_NAMES)


CONTEXT_NAMES = [c.split()[0] for c in CONTEXTS.split(", ")]


def _strings(batches: Iterable[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Every string of the contexts by its hash."""
    for batch in batches:
        for lo, hi, data, bounds in slices(batch.column("context")):
            hashes = _rolling(data, length)
            runs = np.diff(bounds) - length + 1
            who = np.repeat(np.arange(hi - lo), runs)
            nth = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
            take = pa.array(who + lo)
            first = batch.column("first").to_numpy()[lo + who] + nth
            yield pa.record_batch([batch.column("hash").take(take), pa.array(hashes[bounds[who] + nth].view(np.int64)),
                                   batch.column("id").take(take), pa.array(first)], names=["hash", "key", "id", "first"])


def _range_minimum(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """The least value from each ``lo`` to its ``hi``; ``logs`` has the binary logarithm of every length."""
    table, starts, step = [values], [0], 1
    while 2 * step <= len(values):
        starts.append(starts[-1] + len(table[-1]))
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
        step *= 2
    level = logs[hi - lo + 1]
    flat, at = np.concatenate(table), np.array(starts)[level]
    return np.minimum(flat[at + lo], flat[at + hi + 1 - (1 << level)])


def insert_columns(symbols: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(column, order, common): suffix order of the rows from each column on, last column first.

    ``common[i]`` is the number of symbols that the i-th suffix shares with the
    one before it, up to ``length``.
    """
    n = len(symbols)
    order, common = np.arange(n), np.full(n, 0, np.uint8)
    logs = np.frexp(np.arange(n + 1).astype(float))[1] - 1
    symbols = np.ascontiguousarray(symbols.T)
    for column in range(len(symbols) - 1, -1, -1):
        symbol = symbols[column][order]
        moved = np.argsort(symbol, kind="stable")
        a, b = moved[:-1], moved[1:]
        same = symbol[a] == symbol[b]
        fresh = np.zeros(n, np.uint8)
        lo, hi = a[same] + 1, b[same]
        if column == len(symbols) - 1:
            shared = np.zeros(len(lo), np.uint8)
        else:
            shared = _range_minimum(common, lo, hi, logs)
        fresh[1:][same] = np.minimum(shared.astype(np.int64) + 1, length)
        order, common = order[moved], fresh
        yield column, order, common


def _repeated(key, rows: pa.Table, length: int) -> pa.Table:
    """(id, first, last): runs of starts in a bucket whose string also starts earlier."""
    rows = rows.sort_by([("id", "ascending"), ("place", "ascending")])
    id, place = rows.column("id").to_numpy(zero_copy_only=False), rows.column("place").to_numpy()
    first, last = rows.column("first").to_numpy() - place, rows.column("last").to_numpy() - place
    left, right = length - K, length  # columns before and from the anchor on
    symbols = np.zeros((len(rows), left + right), np.uint8)
    for i, context in enumerate(rows.column("context").to_pylist()):
        symbols[i, left + first[i]:left + first[i] + len(context)] = np.frombuffer(context, np.uint8)
    removed = np.zeros((len(rows), left + 2), bool)
    for column, order, common in insert_columns(symbols, length):
        if column > left:
            continue
        group = np.cumsum(common < length)
        start = column - left
        valid = (first[order] <= start) & (start <= last[order])
        order, group = order[valid], group[valid]
        if not len(order):
            continue
        new = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        # Rows are in order of place, so the earliest of equal strings is the smallest row.
        earliest = np.repeat(np.minimum.reduceat(order, new), np.diff(np.append(new, len(order))))
        removed[order, column + 1] = order != earliest
    edge = np.diff(removed.astype(np.int8), axis=1, append=0)
    row_a, a = np.nonzero(edge == 1)
    row_b, b = np.nonzero(edge == -1)
    return pa.table({"id": pa.array(id[row_a], pa.int64()), "first": pa.array(place[row_a] + a - left, pa.int64()),
                     "last": pa.array(place[row_a] + b - 1 - left, pa.int64())})


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut(batches: Iterable[pa.RecordBatch], length: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"doc_id": batch.column("id"), "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        texts = []
        runs = batch.column("runs").fill_null([])
        bounds, values = runs.offsets.to_numpy() - runs.offsets[0].as_py(), runs.flatten()
        firsts, lasts = (values.field(c).to_numpy() for c in ("first", "last"))
        for i, text in enumerate(batch.column("text")):
            data = (text.as_buffer().to_pybytes() if text.is_valid else b"")
            first, end = firsts[bounds[i]:bounds[i + 1]], np.minimum(lasts[bounds[i]:bounds[i + 1]] + length, len(data))
            order = np.argsort(first)
            first, end = first[order], np.maximum.accumulate(end[order])
            # A span begins where all runs before have ended.
            new = np.flatnonzero(np.append(True, first[1:] > end[:-1])) if len(first) else np.zeros(0, int)
            first, end = first[new], end[np.append(new[1:], len(end)) - 1] if len(new) else end
            kept = b"".join(data[a:b] for a, b in zip([0, *end.tolist()], [*first.tolist(), len(data)]))
            out["n_bytes"].append(len(data))
            out["n_removed"].append(len(data) - len(kept))
            out["n_spans"].append(len(new))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            texts.append(kept)
        columns = [out["doc_id"]] + [pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")] + [
            pa.array(out["kept_sha256"], pa.string())]
        yield pa.record_batch(columns + ([pa.array(texts, pa.binary())] if with_text else []),
                              names=list(out) + (["kept"] if with_text else []))


def _once(rows: DataFrame) -> DataFrame:
    """``rows`` (id, text) without repetitions. Texts are compared (by a 128-bit hash) only where an id occurs again."""
    again = staged(rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"), "suffix-again")
    if again.isEmpty():
        return rows
    once = rows.join(again, "id", "left_semi").groupBy(
        "id", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("second"), "text").alias("h2")).agg(F.first("text").alias("text"))
    return rows.join(again, "id", "left_anti").unionAll(once.select("id", "text"))


def repeated_passages(docs: DataFrame, length: int = 100, doc_id: str = "doc_id", text: str = "text",
                      with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``with_text`` the kept bytes.

    Texts count as UTF-8 bytes, a null one as empty; no match crosses from one
    document into the next. A byte is removed if a string of ``length`` bytes
    that covers it also starts earlier: in a document with a smaller doc_id, or
    further left in the same one. Strings are judged on the input. A null
    doc_id comes before all others; rows that share a doc_id must share their
    text and are one document. Other columns are not read; an empty table gives
    an empty result.
    """
    if not WIDE < length <= 255:
        raise ValueError(f"length must be more than {WIDE} and at most 255")
    null_id = -(2**63)
    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(null_id)).alias("id"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    texts = _once(rows)
    found = staged(texts.mapInArrow(lambda b: _anchor_rows(b, length), "hash long, id long, place long"), "suffix-anchors")
    repeated = staged(found.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1"), "suffix-repeated")
    places = staged(found.join(repeated, "hash").groupBy("id").agg(
        F.collect_list(F.struct("place", (F.col("n") > HOT).alias("hot"))).alias("places")), "suffix-places")
    release(found)
    marks = staged(texts.join(places, "id").mapInArrow(lambda b: _mark_rows(b, length), MARKS), "suffix-marks")
    release(places)
    release(repeated)
    # Written, so that the partitions of the join below can be split where a context has very many copies.
    earlier = staged(marks.groupBy("hash", "key").agg(F.min("id").alias("earliest"), F.count("*").alias("n"))
                     .filter("n > 1").drop("n"), "suffix-earlier")
    judged = staged(marks.join(earlier, ["hash", "key"], "left").select(
        "hash", "id", "place", "first", "last", F.coalesce(F.col("id") > F.col("earliest"), F.lit(False)).alias("copy")), "suffix-judged")
    release(marks)
    release(earlier)
    copies = judged.filter("copy").select("id", "first", "last")
    listed = judged.filter("NOT copy").groupBy("id").agg(F.collect_list(F.struct("hash", "place", "first", "last")).alias("places"))
    contexts = staged(texts.join(listed, "id").mapInArrow(lambda b: _context_rows(b, length), CONTEXTS), "suffix-contexts")

    # Anchors that are hot even so stand in long passages that very many documents share.
    many = staged(contexts.groupBy("hash").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("hash"), "suffix-hot")
    cold = contexts.join(many, "hash", "left_anti")
    buckets = max(1, -(-contexts.count() // BUCKET))
    runs = cold.withColumn("bucket", F.pmod(F.xxhash64("hash"), F.lit(buckets))).groupBy("bucket").applyInArrow(
        lambda key, table: _repeated(key, table, length), "id long, first long, last long")
    strings = contexts.join(many, "hash", "left_semi").mapInArrow(
        lambda b: _strings(b, length), "hash long, key long, id long, first long")
    earliest = (strings.groupBy("hash", "key").agg(F.min(F.struct("id", "first")).alias("at"), F.count("*").alias("n"))
                .filter("n > 1").select("hash", "key", "at"))
    later = strings.join(earliest, ["hash", "key"]).filter(F.struct("id", "first") != F.col("at")).select(
        "id", "first", F.col("first").alias("last"))
    spans = staged(copies.unionAll(runs).unionAll(later).groupBy("id").agg(F.collect_list(F.struct("first", "last")).alias("runs")), "suffix-spans")
    cut = rows.join(spans, "id", "left").mapInArrow(
        lambda b: _cut(b, length, with_text), RESULT + (", kept binary" if with_text else ""))
    return cut.withColumn("doc_id", F.when(F.col("doc_id") != null_id, F.col("doc_id")))
