"""Best-fit packing of tokenized documents, planned on the length histogram."""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import staged


# Pre-tokenization of the byte-level vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_UNSAFE = re.compile(r"\s\s |\0")


def added_tokens(path: str) -> dict[str, int]:
    """Ids of the added tokens of a JSON file, or of the JSON file beside a rank file."""
    path = path.removesuffix(".tiktoken") + ".json" if path.endswith(".tiktoken") else path
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f).get("added_tokens") or ()}


class Encoder:
    """Token ids of whole texts through a bounded memory of word encodings.

    ``path`` is a ``tokenizers`` JSON file or a ``tiktoken`` rank file of a
    byte-level BPE; the rank file gives the ids of the JSON file of the same
    vocabulary (tested) in a third of the time. The tokens of ``added`` are
    found inside a text before it is encoded, as the library does by default;
    others are ordinary text.

    Such a BPE never merges across the step from a non-space to a space, so a
    text is cut before its spaces and equal pieces are encoded once. Where
    three white-space characters meet, the last being a space, such a cut could
    part a merge, and the whole text is encoded at once.
    """

    def __init__(self, path: str, remember: int = 300_000, added: dict[str, int] | None = None):
        self.remember = remember
        self.added = {t: array("I", [i]).tobytes() for t, i in (added or {}).items()}
        self._added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}
        if path.endswith(".tiktoken"):
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            ordinary = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
            self._ids = lambda texts: map(ordinary, texts)
        else:
            from tokenizers import Tokenizer

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            tokenizer = Tokenizer.from_file(path)
            tokenizer.encode_special_tokens = True
            self._ids = lambda texts: (e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False))

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", ids).tobytes() for ids in self._ids(texts)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not any(token in t for token in self.added for t in texts):
            return self._plain(texts)
        cut = [self._added.split(t) for t in texts]  # every second part is an added token
        plain = iter(self._plain([part for parts in cut for part in parts[::2]]))
        return [b"".join(self.added[part] if i % 2 else next(plain) for i, part in enumerate(parts)) for parts in cut]

    def _plain(self, texts: list[str]) -> list[bytes]:
        known = self.known
        pieces = [None if _UNSAFE.search(t) else t.replace(" ", "\0 ").split("\0") for t in texts]
        new = {p for text in pieces if text is not None for p in text if p not in known}
        if len(known) + len(new) > self.remember:
            known.clear()
            new = {p for text in pieces if text is not None for p in text}
        new = list(new)
        known.update(zip(new, self._encode(new)))
        return [b"".join(map(known.__getitem__, text)) if text is not None else self._encode([texts[i]])[0]
                for i, text in enumerate(pieces)]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(batches: Iterable[pa.RecordBatch], path: str, capacity: int, end_id: int, id_type,
            keep_ids: bool) -> Iterator[pa.RecordBatch]:
    """Token pieces of a partition's documents with their rank by length within the partition."""
    encode, seen = Encoder(path, added=added_tokens(path)), Counter()
    end, part = array("I", [end_id]).tobytes(), TaskContext.get().partitionId()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        # The texts of a batch are encoded a few at a time, so memory follows the longest text.
        for lo in range(0, batch.num_rows, 64):
            out = defaultdict(list)
            chunk = [t or "" for t in texts.slice(lo, 64).to_pylist()]
            for doc, encoded in zip(ids.slice(lo, 64).to_pylist(), encode(chunk)):
                encoded += end
                n = len(encoded) // 4
                first = n % capacity or min(n, capacity)
                starts = [0, *range(first, n, capacity)]
                for k, s in enumerate(starts):
                    e = first if k == 0 else s + capacity
                    piece = encoded[4 * s:4 * e]
                    out["doc_id"].append(doc)
                    out["piece"].append(k)
                    out["start"].append(s)
                    out["length"].append(e - s)
                    out["ids_crc32"].append(zlib.crc32(piece))
                    if keep_ids:
                        out["ids"].append(piece)
                    out["part"].append(part)
                    out["nth"].append(seen[e - s])
                    seen[e - s] += 1
            if out:
                types = {"doc_id": id_type, "piece": pa.int32(), "part": pa.int32(), "ids": pa.binary()}
                yield pa.record_batch([pa.array(v, types.get(c, pa.int64())) for c, v in out.items()], names=list(out))


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: runs of (length, first rank, items, first sequence, offset).

    Sequences that are filled alike are one group, known by their count, so the
    work depends on the number of lengths and not on the number of pieces.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    open_groups: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> (first sequence, count)
    sequences = 0
    for length in sorted((n for n, c in histogram.items() if c and n > 0), reverse=True):
        rank, left = 0, histogram[length]
        while left:
            free = min((f for f in open_groups if f >= length), default=None)
            if free is None:
                per = capacity // length  # new sequences, each filled with this length as far as it goes
                full, rest = divmod(left, per)
                for first, count, items in ((sequences, full, per), (sequences + full, 1 if rest else 0, rest)):
                    for i in range(items if count else 0):
                        runs.append((length, rank, count, first, i * length))
                        rank += count
                    if count and capacity - items * length:
                        open_groups[capacity - items * length].append((first, count))
                sequences += full + (1 if rest else 0)
                left = 0
                continue
            first, count = open_groups[free].pop()
            if not open_groups[free]:
                del open_groups[free]
            used = min(count, left)
            runs.append((length, rank, used, first, capacity - free))
            rank, left = rank + used, left - used
            if free > length:
                open_groups[free - length].append((first, used))
            if used < count:
                open_groups[free].append((first + used, count - used))
    return runs


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, doc_id: str = "doc_id",
         text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Token pieces of ``docs`` placed into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and with ``keep_ids`` the ids as little-endian unsigned 32-bit
    binary. A document is its ids and then ``end_id``; only a longer document
    is cut, its first piece being the shorter one. A null or empty text is the
    end id alone. Repeated documents are packed as often as they occur; an
    empty table gives an empty result; other columns are not read.

    The histogram of lengths has at most ``capacity`` entries; only it reaches
    the driver. Ranks within a length are made of counts per partition, so a
    length that a third of all pieces share is not sorted in one task.
    """
    spark: SparkSession = docs.sparkSession
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    id_type = pa.int64() if dict(source.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint") else pa.string()
    source = source.withColumn("doc_id", F.col("doc_id").cast("long" if id_type == pa.int64() else "string"))
    schema = PIECES.replace("doc_id long", f"doc_id {dict(source.dtypes)['doc_id']}") + (
        ", ids binary" if keep_ids else "") + ", part int, nth long"
    pieces = staged(source.mapInArrow(
        lambda batches: _pieces(batches, tokenizer, capacity, end_id, id_type, keep_ids), schema), "pack-pieces")
    counts = pieces.groupBy("length", "part").agg((F.max("nth") + 1).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = staged(counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "pack-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(histogram, capacity)
    slots = staged(spark.createDataFrame(
        runs, "length long, first_rank long, items long, first_sequence long, offset long"), "pack-plan")
    ranked = pieces.join(counts.select("length", "part", "before"), ["length", "part"]).withColumn(
        "rank", F.col("before") + F.col("nth"))
    placed = ranked.join(slots.withColumnRenamed("length", "slot_length"), (F.col("length") == F.col("slot_length"))
                         & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("items")))
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else []),
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset")
