"""Language-model scoring: a log-bilinear model trained with noise-contrastive estimation.

Tokens are lower-cased words and one end per text. The model predicts units:
the most frequent words, and classes that share out all other words by their
first letters and last mark. A unit's vector is predicted from those of the two
units before it by one matrix each, and a softmax over all units normalises.
Within a class a word has its add-one share of the class's count, one place
being kept for words never seen. So every text, known words or not, has one
normalised probability.

Counts cover all training documents. Training covers them too: each task runs
noise-contrastive updates over its own share from one common start, and the
tasks' parameters are averaged by their numbers of tokens.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, staged
from tidemark.llm.words import LOWER, LOWER_VALUES, find_words, hash_runs, mix, slices

FREQUENT = 256  # words that are units of their own, the end among them
GROUPS = 128  # classes of the other words, each with and without a mark at the end
UNITS = FREQUENT + 2 * GROUPS
START = UNITS  # what stands before the first token
DIM = 24
KNOWN = 1 << 18  # counts that travel with the tasks: three megabytes; rarer words are joined
END = np.uint64(0xE17D0FDA7A)
BATCH, NOISE = 2048, 64
MARKS = np.zeros(256, bool)
MARKS[list(b".,;:!?%&$#*|")] = True


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, class, offsets) of each text's tokens, the last being the end."""
    starts, ends, offsets = find_words(data, bounds)
    words = hash_runs(data, starts, ends, LOWER_VALUES)
    second = np.where(ends - starts > 1, LOWER[data[np.minimum(starts + 1, max(len(data) - 1, 0))]], 0) if len(starts) else starts
    head = (LOWER[data[starts]] * 256 + second).astype(np.uint64) if len(starts) else np.zeros(0, np.uint64)
    group = (mix(head) % np.uint64(GROUPS)).astype(np.int64) * 2 + (MARKS[data[ends - 1]] if len(starts) else 0)
    n = len(bounds) - 1
    place = np.arange(len(words)) + np.repeat(np.arange(n), np.diff(offsets))
    hashes, classes = np.full(len(words) + n, END), np.zeros(len(words) + n, np.int64)
    hashes[place], classes[place] = words, group
    return hashes, classes, offsets + np.arange(n + 1)


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, class, n) of a task's training tokens, merged as they come."""
    hashes, classes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    pending: list[tuple] = []

    def merge() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, c, n = (np.concatenate(x) for x in zip((hashes, classes, counts), *pending))
        values, first, place = np.unique(h, return_index=True, return_inverse=True)
        return values, c[first], np.bincount(place, n, len(values)).astype(np.int64)

    def rows(h, c, n) -> pa.RecordBatch:
        return pa.record_batch([pa.array(h.view(np.int64)), pa.array(c, pa.int64()), pa.array(n)], names=["hash", "class", "n"])

    for batch in batches:
        for _, _, data, bounds in slices(batch.column("text")):
            h, c, _ = tokens(data, bounds)
            values, first, n = np.unique(h, return_index=True, return_counts=True)
            pending.append((values, c[first], n))
            if sum(len(p[0]) for p in pending) > 1_000_000:
                hashes, classes, counts = merge()
                pending = []
                if len(hashes) > 2_000_000:  # what a task keeps in memory is bounded
                    yield rows(hashes, classes, counts)
                    hashes, classes, counts = hashes[:0], classes[:0], counts[:0]
    if len(hashes) or pending:
        yield rows(*merge())


@dataclass
class Vocabulary:
    """What the tasks need to know of the counts; its size does not depend on the corpus."""

    units: np.ndarray  # hashes of the frequent words, sorted
    unit_of: np.ndarray  # their unit numbers
    hashes: np.ndarray  # the KNOWN most frequent words, sorted
    logs: np.ndarray  # log10(count + 1) of them
    class_log: np.ndarray  # log10 of (words + kinds + 1) of each class
    share: np.ndarray  # share of each unit in the training tokens

    def unit(self, hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.units, hashes), len(self.units) - 1)
        return np.where(self.units[at] == hashes, self.unit_of[at], FREQUENT + classes)


def vocabulary(counts: DataFrame) -> Vocabulary:
    top = counts.orderBy(F.desc("n"), "hash").limit(KNOWN).select("hash", "n").toArrow()
    hashes, n = top.column("hash").to_numpy().view(np.uint64), top.column("n").to_numpy()
    frequent = hashes[hashes != END][:FREQUENT - 1]
    units = np.concatenate([[END], frequent]).astype(np.uint64)
    order = np.argsort(units)
    is_unit = F.array_contains(F.array(*[F.lit(int(h)) for h in units.view(np.int64)]), F.col("hash"))
    rest = {r["class"]: (r.words, r.kinds) for r in counts.filter(~is_unit).groupBy("class").agg(
        F.sum("n").alias("words"), F.count("*").alias("kinds")).collect()}
    words = np.array([rest.get(c, (0, 0))[0] for c in range(2 * GROUPS)], float)
    kinds = np.array([rest.get(c, (0, 0))[1] for c in range(2 * GROUPS)], float)
    found = dict(zip(hashes.tolist(), n.tolist()))
    own = np.array([found.get(int(h), 0) for h in units] + [0] * (FREQUENT - len(units)), float)
    share = np.concatenate([own, words]) + 0.5
    by_hash = np.argsort(hashes)
    return Vocabulary(units[order], np.arange(len(units))[order], hashes[by_hash], np.log10(n[by_hash] + 1.0),
                      np.log10(words + kinds + 1), share / share.sum())


@dataclass
class Model:
    """Vectors of the units as context and as prediction, one matrix per context place, biases."""

    context: np.ndarray
    output: np.ndarray
    one: np.ndarray
    two: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, share: np.ndarray, seed: int = 5) -> Model:
        rng = np.random.default_rng(seed)
        vectors = lambda n: (rng.standard_normal((n, DIM)) * 0.3).astype(np.float32)
        return cls(vectors(UNITS + 1), vectors(UNITS), np.eye(DIM, dtype=np.float32), 0.5 * np.eye(DIM, dtype=np.float32),
                   np.log(share).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.output, self.one, self.two, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    @classmethod
    def of(cls, flat: np.ndarray) -> Model:
        shapes = [(UNITS + 1, DIM), (UNITS, DIM), (DIM, DIM), (DIM, DIM), (UNITS,)]
        out, at = [], 0
        for shape in shapes:
            size = int(np.prod(shape))
            out.append(flat[at:at + size].reshape(shape).astype(np.float32))
            at += size
        return cls(*out)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(one, two, norm): a unit's score after units a and b is one[a] + two[b] less norm[a, b].

        The scores of all units after one context place are a matrix product;
        the softmax is normalised exactly, for all pairs of units, in batches.
        """
        one = self.context @ self.one @ self.output.T + self.bias
        two = self.context @ self.two @ self.output.T
        norm = np.empty((UNITS + 1, UNITS + 1), np.float32)
        for a in range(UNITS + 1):
            scores = one[a] + two
            most = scores.max(axis=1)
            norm[a] = most + np.log(np.exp(scores - most[:, None]).sum(axis=1))
        return one, two, norm


def contexts(units: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The units one and two places before each token of its text."""
    before = np.empty_like(units)
    before[:1], before[1:] = START, units[:-1]
    first = offsets[:-1][offsets[:-1] < len(units)]
    before[first] = START
    earlier = np.empty_like(units)
    earlier[:1], earlier[1:] = START, before[:-1]
    earlier[first] = START
    return before, earlier


def _sum_rows(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(index, kind="stable")
    index = index[order]
    new = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
    return index[new], np.add.reduceat(values[order], new, axis=0)


class Trainer:
    """Noise-contrastive updates with per-parameter step sizes."""

    def __init__(self, model: Model, share: np.ndarray, seed: int, rate: float = 0.15):
        self.model, self.rate, self.rng = model, rate, np.random.default_rng(seed)
        self.squares = [np.full_like(p, 0.1) for p in model.parts()]
        self.cumulative, self.log_noise = np.cumsum(share), np.log(share * NOISE).astype(np.float32)

    def _step(self, part: int, grad: np.ndarray, rows=slice(None)) -> None:
        self.squares[part][rows] += grad * grad
        self.model.parts()[part][rows] += self.rate * grad / np.sqrt(self.squares[part][rows])

    def update(self, word: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        m = self.model
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), UNITS - 1)
        va, vb, out, out_noise = m.context[a], m.context[b], m.output[word], m.output[noise]
        predicted = va @ m.one + vb @ m.two
        score = np.einsum("ij,ij->i", predicted, out) + m.bias[word] - self.log_noise[word]
        score_noise = predicted @ out_noise.T + m.bias[noise] - self.log_noise[noise]
        # Gradient of the log-likelihood of telling data from noise.
        right = (1 / (1 + np.exp(np.clip(score, -30, 30)))).astype(np.float32)
        wrong = (-1 / (1 + np.exp(-np.clip(score_noise, -30, 30)))).astype(np.float32)
        n = np.float32(1 / len(word))
        to_predicted = (right[:, None] * out + wrong @ out_noise) * n
        rows, grad = _sum_rows(np.concatenate([word, noise]), np.concatenate([
            np.concatenate([right[:, None] * predicted, right[:, None]], axis=1) * n,
            np.concatenate([wrong.T @ predicted, wrong.sum(axis=0)[:, None]], axis=1) * n]))
        to_one, to_two = va.T @ to_predicted, vb.T @ to_predicted
        back = _sum_rows(np.concatenate([a, b]), np.concatenate([to_predicted @ m.one.T, to_predicted @ m.two.T]))
        self._step(1, grad[:, :-1] * 30, rows)
        self._step(4, grad[:, -1] * 30, rows)
        self._step(0, back[1] * 30, back[0])
        self._step(2, to_one)
        self._step(3, to_two)


def _train(batches: Iterable[pa.RecordBatch], vocab: Vocabulary, start: np.ndarray) -> Iterator[pa.RecordBatch]:
    trainer, seen = Trainer(Model.of(start.copy()), vocab.share, 11), 0
    for batch in batches:
        for _, _, data, bounds in slices(batch.column("text")):
            hashes, classes, offsets = tokens(data, bounds)
            units = vocab.unit(hashes, classes)
            a, b = contexts(units, offsets)
            order = np.random.default_rng(seen).permutation(len(units))
            for lo in range(0, len(units), BATCH):
                at = order[lo:lo + BATCH]
                trainer.update(units[at], a[at], b[at])
            seen += len(units)
    if seen:
        yield pa.record_batch([pa.array([float(seen)]), pa.array([trainer.model.flat()], pa.list_(pa.float32()))],
                              names=["tokens", "values"])


def train(training: DataFrame, vocab: Vocabulary, rounds: int = 1) -> Model:
    """Every round, each task updates the model over its documents; the average is the next round's start."""
    model = Model.fresh(vocab.share)
    for _ in range(rounds):
        start = model.flat()
        found = training.mapInArrow(lambda b: _train(b, vocab, start), "tokens double, values array<float>")
        mean = (found.select("tokens", F.posexplode("values").alias("i", "v")).groupBy("i")
                .agg((F.sum(F.col("tokens") * F.col("v")) / F.sum("tokens")).alias("v")).toArrow())
        flat = start.copy()
        flat[mean.column("i").to_numpy()] = mean.column("v").to_numpy()
        model = Model.of(flat)
    return model


SCORES = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, "
          "rare array<struct<hash: long, n: int>>")


def _scores(batches: Iterable[pa.RecordBatch], vocab: Vocabulary, tables: tuple) -> Iterator[pa.RecordBatch]:
    one, two, norm = tables
    rare_type = pa.struct([("hash", pa.int64()), ("n", pa.int32())])
    for batch in batches:
        for lo, hi, data, bounds in slices(batch.column("text")):
            hashes, classes, offsets = tokens(data, bounds)
            n = hi - lo
            text = np.repeat(np.arange(n), np.diff(offsets))
            units = vocab.unit(hashes, classes)
            a, b = contexts(units, offsets)
            at = np.minimum(np.searchsorted(vocab.hashes, hashes), max(len(vocab.hashes) - 1, 0))
            known = vocab.hashes[at] == hashes if len(vocab.hashes) else np.zeros(len(hashes), bool)
            logs = np.where(known, vocab.logs[at], 0.0) if len(vocab.hashes) else np.zeros(len(hashes))
            inside = np.where(units < FREQUENT, 0.0, logs - vocab.class_log[np.maximum(units - FREQUENT, 0)])
            natural = (one[a, units] + two[b, units] - norm[a, b]).astype(float)
            model = natural / np.log(10) + inside
            # Words beyond the known ones get their counts by a join.
            who, what = text[~known], hashes[~known]
            order = np.lexsort((what, who))
            who, what = who[order], what[order]
            new = np.flatnonzero(np.append(True, (who[1:] != who[:-1]) | (what[1:] != what[:-1]))) if len(who) else np.zeros(0, int)
            times = np.diff(np.append(new, len(who)))
            rare = pa.StructArray.from_arrays([pa.array(what[new].view(np.int64)), pa.array(times, pa.int32())], fields=list(rare_type))
            edges = np.searchsorted(who[new], np.arange(n + 1)).astype(np.int32)
            yield pa.record_batch([
                batch.column("row")[lo:hi], batch.column("doc_id")[lo:hi], batch.column("held_out")[lo:hi],
                pa.array(np.diff(offsets), pa.int64()), pa.array(np.bincount(text, known, n).astype(np.int64)),
                pa.array(np.bincount(text, logs, n)), pa.array(np.bincount(text, model, n)),
                pa.ListArray.from_arrays(pa.array(edges), rare)],
                names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare"])


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7,
                    held_out_fold: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Documents whose crc32(doc_id as text) modulo ``folds`` is ``held_out_fold``
    are scored and not learnt from. A null or empty text is its end alone; a
    null id counts as the empty text. Repeated rows count as often as they
    occur; other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.withColumn("held_out", fold("doc_id", folds) == held_out_fold)
    training = rows.filter("NOT held_out").select("text")
    counts = staged(training.mapInArrow(_counts, "hash long, class long, n long").groupBy("hash").agg(
        F.first("class").alias("class"), F.sum("n").alias("n")), "lm-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    vocab = vocabulary(counts)
    model = train(training, vocab)
    tables = model.tables()
    # Plain arrays: a broadcast names the classes it holds, and executors may not have this package.
    shared = docs.sparkSession.sparkContext.broadcast(([getattr(vocab, f.name) for f in fields(Vocabulary)], tables))
    scored = staged(rows.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text")
                    .mapInArrow(lambda b: _scores(b, Vocabulary(*shared.value[0]), shared.value[1]), SCORES), "lm-scores")
    rare = (scored.select("row", F.inline("rare")).join(counts.select("hash", F.col("n").alias("c")), "hash")
            .groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("log"), F.sum("n").alias("known")))
    out = scored.drop("rare").join(rare, "row", "left")
    log = F.coalesce("log", F.lit(0.0))
    smooth = float(np.log10(total.n + total.v + 1))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total.n).cast("long").alias("train_tokens"),
        (F.col("base") + log - F.col("n_tokens") * F.lit(smooth)).alias("base_score"), (F.col("model") + log).alias("score"))
