"""Language identification by hierarchical discrimination.

A text's family of languages is predicted first, then its language among the
family's, each time by linear support vector machines, one for every two
classes. Families are learnt: languages whose mean texts are most alike are
joined, average link, until about the square root of their number is left.

Features are hashed runs of one to three bytes and whole words, ASCII
lower-cased, with everything that is no letter as one blank: the part of a word
that tells its language is mostly short. Their weights are the square roots of
their shares of the text, so a text's vector has the length 1 at any size.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import fold, staged
from tidemark.llm.words import GOLDEN, mix, slices

BITS = 16  # 2**16 features; a machine has as many weights of four bytes
SAMPLE = 1_500  # texts of each language that are learnt from, at most
SAMPLE_BYTES = 64 << 20  # bytes of all texts that are learnt from, at most
PIECE = 1 << 20  # bytes whose features are counted at once
PASSES = 12

# Letters: A-Z as a-z, and all bytes of characters beyond ASCII. The rest is blank.
FOLDED = np.full(256, 0x20, np.uint64)
FOLDED[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLDED[0x41:0x5B] = np.arange(0x61, 0x7B)
FOLDED[0x80:] = np.arange(0x80, 0x100)
BLANK = np.uint64(0x20)


def counts(data: np.ndarray, bits: int = BITS) -> np.ndarray:
    """How often each feature occurs in one text (or in a piece that begins and ends with a blank)."""
    x = np.concatenate([[BLANK], FOLDED[data], [BLANK]])
    # Blanks in a row are one.
    x = x[np.concatenate([[True], (x[1:] != BLANK) | (x[:-1] != BLANK)])]
    if len(x) < 2:
        return np.zeros(1 << bits)
    two = x[:-1] << np.uint64(8) | x[1:]
    runs = [x[x != BLANK] | np.uint64(1 << 32), two | np.uint64(2 << 32)]
    if len(x) > 2:
        three = two[:-1] << np.uint64(8) | x[2:]
        runs.append(three[x[1:-1] != BLANK] | np.uint64(3 << 32))
    blank = np.flatnonzero(x == BLANK)
    # A word's hash is read off running sums over its bytes, weighted by their place in it.
    place = np.arange(len(x)) - np.repeat(blank, np.diff(np.append(blank, len(x))))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(x * GOLDEN + place.astype(np.uint64)))])
    words = total[blank[1:]] - total[blank[:-1] + 1]
    slots = (mix(np.concatenate([*runs, words]) * GOLDEN) >> np.uint64(64 - bits)).astype(np.int64)
    return np.bincount(slots, minlength=1 << bits).astype(float)


def vector(data: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(feature, weight) of a text; a very long one is counted in pieces that end at blanks."""
    total, lo = np.zeros(1 << bits), 0
    while lo < len(data):
        hi = min(len(data), lo + PIECE)
        if hi < len(data):
            blanks = np.flatnonzero(FOLDED[data[lo:hi]] == BLANK)
            hi = lo + int(blanks[-1]) + 1 if len(blanks) else hi
        total += counts(data[lo:hi], bits)
        lo = hi
    slot = np.flatnonzero(total)
    return slot, np.sqrt(total[slot] / max(1.0, total.sum()))


def machine(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, bits: int = BITS, cost: float = 8.0,
            passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear support vector machine by dual coordinate ascent; both sides weigh alike."""
    w, dual = np.zeros((1 << bits) + 1), np.zeros(len(rows))
    limit = np.where(signs > 0, cost * len(rows) / max(1, 2 * (signs > 0).sum()), cost * len(rows) / max(1, 2 * (signs < 0).sum()))
    order, draw, bias = np.arange(len(rows)), np.random.default_rng(11), 1 << bits
    for _ in range(passes):
        draw.shuffle(order)
        moved = 0.0
        for i in order:
            slot, x = rows[i]
            gap = 1 - signs[i] * (x @ w[slot] + w[bias])
            new = min(limit[i], max(0.0, dual[i] + gap / (x @ x + 1)))  # the bias is a feature of weight 1
            step = (new - dual[i]) * signs[i]
            if step:
                w[slot] += step * x
                w[bias] += step
                moved = max(moved, abs(step))
                dual[i] = new
        if moved < 1e-3:
            break
    return w[:-1].astype(np.float32), float(w[-1])


def families(centres: np.ndarray) -> list[list[int]]:
    """Classes joined by the similarity of their mean vectors until about sqrt(classes) groups are left."""
    groups = [[i] for i in range(len(centres))]
    alike = centres @ centres.T
    while len(groups) > max(1, round(math.sqrt(len(centres)))):
        a, b = max(itertools.combinations(range(len(groups)), 2),
                   key=lambda p: (alike[np.ix_(groups[p[0]], groups[p[1]])].mean(), -p[0], -p[1]))
        groups[a] += groups.pop(b)
    return [sorted(g) for g in groups]


def duels(rows: list, classes: np.ndarray, among: list[list[int]], bits: int) -> list[tuple[int, int, np.ndarray, float]]:
    """(a, b, weights, bias) for every two of the given groups of classes; positive scores speak for a."""
    out = []
    for a, b in itertools.combinations(range(len(among)), 2):
        chosen = np.flatnonzero(np.isin(classes, among[a] + among[b]))
        out.append((a, b, *machine([rows[i] for i in chosen], np.where(np.isin(classes[chosen], among[a]), 1.0, -1.0), bits)))
    return out


def _fit(key, table: pa.Table, bits: int) -> pa.Table:
    """Rows (level, a, b, …): families as level -1, family machines as level 0, those within family f as level f + 1."""
    table = table.sort_by([("label", "ascending"), ("order", "ascending"), ("text", "ascending")])
    labels = table.column("label").to_pylist()
    rows = []
    for lo, hi, data, bounds in slices(table.column("text")):
        rows += [vector(data[bounds[i]:bounds[i + 1]], bits) for i in range(hi - lo)]
    names = sorted(set(labels))
    classes = np.array([names.index(v) for v in labels])
    centres = np.zeros((len(names), 1 << bits))
    for c, (slot, x) in zip(classes, rows):
        centres[c, slot] += x
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    groups = families(centres)
    found = [(-1, f, 0, names[c], b"", 0.0) for f, g in enumerate(groups) for c in g]
    found += [(0, a, b, "", w.tobytes(), bias) for a, b, w, bias in duels(rows, classes, groups, bits)]
    for f, g in enumerate(groups):
        found += [(f + 1, a, b, "", w.tobytes(), bias) for a, b, w, bias in duels(rows, classes, [[c] for c in g], bits)]
    return pa.table(dict(zip(("level", "a", "b", "name", "weights", "bias"), (pa.array(list(c)) for c in zip(*found)))))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES,
        bits: int = BITS) -> DataFrame:
    """The model, fitted on whole texts of about ``sample`` rows of each language.

    Rows with letters are chosen by a hash of their text below a quantile that
    the language's number of rows and bytes sets, so that about ``sample`` rows
    and, over all languages, ``sample_bytes`` meet in the one task that trains.
    Copies of a text count once; null languages teach nothing. One machine is
    made for every two families and every two languages of a family, so
    languages are meant to be few (hundreds).
    """
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("label")).filter(
        F.col("label").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("order", F.pmod(F.xxhash64("text"), F.lit(1_000_000_000)))
    sizes = rows.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    room = sample_bytes / F.count("*").over(Window.partitionBy())  # one row per language meets here
    # A share of each language that holds about ``sample`` rows and its part of the bytes.
    shares = staged(sizes.select("label", F.least(F.lit(1.0), F.lit(float(sample)) / F.col("n"), room / F.col("bytes")).alias("share"),
                                 room.alias("room")), "languages")
    chosen = rows.join(shares, "label").filter(F.col("order") < F.col("share") * 1_000_000_000)
    # The quantile bounds bytes on average; a text longer than a language's whole room is not learnt from.
    # Copies share their hash: all of a text's rows are chosen, and one of them travels.
    chosen = chosen.filter(F.octet_length("text") <= F.col("room")).select("text", "label", "order").distinct()
    return staged(chosen.withColumn("group", F.lit(0)).groupBy("group").applyInArrow(
        lambda key, table: _fit(key, table, bits),
        "level long, a long, b long, name string, weights binary, bias double"), "language-model")


def _decide(margins: np.ndarray, n: int, duels: list[tuple[int, int, int]]) -> tuple[int, float]:
    """The class that wins most duels (machine, a, b), ties by their margins, and how sure the duels of the winner are."""
    if n == 1:
        return 0, 1.0
    wins, margin, sure = np.zeros(n), np.zeros(n), np.ones(n)
    for j, a, b in duels:
        s = margins[j]
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, 3 * s))))
        wins[a if s >= 0 else b] += 1
        margin[a] += s
        margin[b] -= s
        sure[a] = min(sure[a], p)
        sure[b] = min(sure[b], 1 - p)
    best = max(range(n), key=lambda c: (wins[c], margin[c], -c))
    return best, float(sure[best])


def _predict(batches: Iterable[pa.RecordBatch], model: dict, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, scores = [], []
        told = batch.column("letters").to_pylist()
        for lo, hi, data, bounds in slices(batch.column("text")):
            for i in range(hi - lo):
                if not told[lo + i] or not model["families"]:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                slot, x = vector(data[bounds[i]:bounds[i + 1]], bits)
                margins = x @ model["weights"][slot] + model["bias"]
                f, sure = _decide(margins, len(model["families"]), model["duels"].get(0, []))
                names = model["families"][f]
                c, surer = _decide(margins, len(names), model["duels"].get(f + 1, []))
                langs.append(names[c])
                scores.append(sure * surer)
        yield pa.record_batch([batch.column("row"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                              names=["row", "lang_pred", "score"])


def predict(docs: DataFrame, model: DataFrame, text: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1); columns of those names are replaced.

    Only the text is looked at, all of it. A text that is null or has no letter
    is ``und`` with score 0; so is every text if nothing was learnt. The model,
    2**bits weights per machine and language names, travels with the tasks.
    """
    found = model.collect()  # bounded by the labels' number: families, and a machine for every two
    found.sort(key=lambda r: (r.level, r.a, r.b, r.name))
    groups: dict[int, list[str]] = {}
    for r in found:
        if r.level == -1:
            groups.setdefault(r.a, []).append(r.name)
    machines = [r for r in found if r.level >= 0]
    weights = np.array([np.frombuffer(r.weights, np.float32) for r in machines]).reshape(len(machines), 1 << bits).T
    plain = {"families": [groups[f] for f in sorted(groups)], "duels": {k: [(j, r.a, r.b) for j, r in enumerate(machines) if r.level == k] for k in {r.level for r in machines}},
             "weights": np.ascontiguousarray(weights) if machines else np.zeros((1 << bits, 0), np.float32),
             "bias": np.array([r.bias for r in machines])}
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    column = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), column.alias("text"),
                       F.coalesce(column.rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    row_type = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _predict(batches, plain, bits),
                           f"row {row_type}, lang_pred string, score double").select("row.*", "lang_pred", "score")


def languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4,
              held_out_fold: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document; held-out languages are not learnt from.

    Odd rows: null or letterless texts are ``und`` with score 0, null languages
    are not learnt from, a null id counts as empty text in the fold, very long
    texts are read in pieces, copies and repeated rows each get their row,
    other columns are ignored, and an empty table gives an empty result.
    """
    held_out = fold(doc_id, folds) == held_out_fold
    model = fit(docs.filter(~held_out), text, lang)
    scored = predict(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), model)
    return scored.select("doc_id", (fold("doc_id", folds) == held_out_fold).alias("held_out"), "lang_pred", "score")
