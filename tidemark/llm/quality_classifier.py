"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL updates.

A text's tokens are its runs of letters and digits, lower-cased in ASCII, and its runs
of other visible characters; a word in capitals is marked by one more token. The
features are hashed runs of one and two tokens with the weight of their share of
the text, so long and short texts are alike; a score is one sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, staged
from tidemark.llm.words import GOLDEN, LOWER_VALUES, SPACE, hash_runs, mix, slices

BITS = 18  # 2**18 weights of four bytes: the model is one megabyte at every input size
SAMPLE = 8_000  # labelled documents the model is fitted on, at most
PASSES = 3

# Byte classes: white space, ASCII marks, and everything else (letters, digits, all of UTF-8 beyond ASCII).
CLASS = np.full(256, 2, np.uint8)
CLASS[33:128] = 1
for first, last in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    CLASS[first:last] = 2
CLASS[:33] = np.where(SPACE[:33], 0, 2)
UPPER = np.zeros(256, np.int64)
UPPER[0x41:0x5B] = 1
SHOUT = np.uint64(0x5CA1AB1E0DDBA11)


def features(data: np.ndarray, bounds: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, value, offsets) of a batch of texts; the values of a text have the length 1."""
    n = len(bounds) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(n + 1, np.int64)
    kind = CLASS[data]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = kind[1:] != kind[:-1]
    cut[bounds] = True
    edges = np.flatnonzero(cut)
    starts, ends = edges[:-1], edges[1:]
    token = kind[starts] > 0
    starts, ends = starts[token], ends[token]
    text = np.searchsorted(bounds, starts, "right") - 1
    hashes = hash_runs(data, starts, ends, LOWER_VALUES)
    upper = np.concatenate([[0], np.cumsum(UPPER[data])])
    shouted = (ends - starts > 1) & (upper[ends] - upper[starts] == ends - starts)
    marks = kind[starts] == 1
    # What marks consist of says more than how many follow each other.
    hashes[marks] = hash_runs(data, starts[marks], starts[marks] + 1, LOWER_VALUES)
    pairs = mix(hashes[:-1] * np.uint64(0xD6E8FEB86659FD93) + hashes[1:])
    inside = text[:-1] == text[1:]
    every = np.concatenate([hashes, pairs[inside], np.full(int(shouted.sum()), SHOUT)])
    owner = np.concatenate([text, text[:-1][inside], text[shouted]])
    slot = (mix(every ^ GOLDEN) >> np.uint64(64 - bits)).astype(np.int64)
    code, count = np.unique(owner * (1 << bits) + slot, return_counts=True)
    owner, slot = code >> bits, code & ((1 << bits) - 1)
    length = np.sqrt(np.bincount(owner, count.astype(float) ** 2, n))
    return slot, count / length[owner], np.searchsorted(owner, np.arange(n + 1))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, bits: int = BITS, passes: int = PASSES,
         alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias by follow-the-regularised-leader updates, one document at a time.

    Each class counts alike, however rare it is.
    """
    z, s = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    share = np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3)
    bias = np.array([1 << bits])
    for _ in range(passes):
        for (slot, value), y in zip(rows, labels):
            at = np.concatenate([slot, bias])
            x = np.concatenate([value, [1.0]])
            zi, si = z[at], s[at]
            w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(si)) / alpha + l2))
            p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
            g = (p - y) * x * (0.5 / share if y else 0.5 / (1 - share))
            sigma = (np.sqrt(si + g * g) - np.sqrt(si)) / alpha
            z[at] = zi + g - sigma * w
            s[at] = si + g * g
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(s)) / alpha + l2))
    return w[:-1].astype(np.float32), float(w[-1])


def _train(key, rows: pa.Table, bits: int) -> pa.Table:
    rows = rows.sort_by([("order", "ascending"), ("id", "ascending")])
    examples = []
    for lo, hi, data, bounds in slices(rows.column("text")):
        slot, value, offsets = features(data, bounds, bits)
        examples += [(slot[offsets[i]:offsets[i + 1]], value[offsets[i]:offsets[i + 1]]) for i in range(hi - lo)]
    weights, bias = ftrl(examples, rows.column("label").to_numpy().astype(float), bits)
    return pa.table({"weights": pa.array([weights.tobytes()], pa.binary()), "bias": [bias]})


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = SAMPLE, bits: int = BITS) -> DataFrame:
    """One row (weights, bias), fitted on ``sample`` labelled documents at most, chosen and ordered by a hash of the id.

    ``sample`` bounds the one task that trains; a quantile of the hash, taken
    from the labels' count, selects about as many. Null labels, null ids and
    repeated labels with different values are not used.
    """
    known = (labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("double").alias("label"))
             .filter("id IS NOT NULL AND label IS NOT NULL").groupBy("id")
             .agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").drop("other")
             .withColumn("order", F.pmod(F.xxhash64(F.lit("train"), F.col("id").cast("string")), F.lit(1_000_000_000))))
    share = min(1.0, sample / max(1, known.count()))
    known = known.filter(F.col("order") < int(share * 1_000_000_000))
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    # The chosen labels are bounded by ``sample``, so they may be broadcast.
    rows = texts.join(F.broadcast(known), "id").select("id", "text", "label", "order").withColumn("group", F.lit(0))
    return staged(rows.groupBy("group").applyInArrow(
        lambda key, table: _train(key, table, bits), "weights binary, bias double"), "quality-model")


def _score(batches: Iterable[pa.RecordBatch], weights: np.ndarray, bias: float, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = np.empty(batch.num_rows)
        for lo, hi, data, bounds in slices(batch.column("text")):
            slot, value, offsets = features(data, bounds, bits)
            total = np.bincount(np.repeat(np.arange(hi - lo), np.diff(offsets)), weights[slot] * value, hi - lo)
            scores[lo:hi] = 1 / (1 + np.exp(-np.clip(total + bias, -35, 35)))
        yield pa.record_batch([batch.column("row"), pa.array(scores)], names=["row", "score"])


def score(docs: DataFrame, model: DataFrame, text: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1 (higher: label 1 likelier).

    Only the text is scored; a null or empty one gets the score of the bias
    alone. The model, of a size fixed by ``bits``, travels with the tasks. A
    column ``score`` of the input is replaced; rows and their number are
    unchanged.
    """
    found = model.first()
    weights = np.frombuffer(found.weights, np.float32) if found else np.zeros(1 << bits, np.float32)
    bias = found.bias if found else 0.0
    keep = [c for c in docs.columns if c != "score"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    row_type = rows.schema["row"].dataType.simpleString()
    scored = rows.mapInArrow(lambda batches: _score(batches, weights, bias, bits), f"row {row_type}, score double")
    return scored.select("row.*", "score")


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; labels of held-out documents are not learnt from."""
    held_out = fold(doc_id, 3) == 1
    model = train(docs.filter(~held_out), labels.filter(~held_out), doc_id, text, label)
    scored = score(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), model)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_rejected(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
                  threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that score below ``threshold``; columns unchanged.

    Without any label nothing is known and every document stays.
    """
    model = train(docs, labels, doc_id, text, label)
    scored = score(docs.withColumnRenamed("score", "__score") if "score" in docs.columns else docs, model, text)
    kept = scored.filter(F.col("score") >= threshold).drop("score")
    return kept.withColumnRenamed("__score", "score") if "score" in docs.columns else kept
