"""Near-duplicate lines by a segment-partition edit join, in DataFrame operations only.

Two lines are linked if at most ``max_edits`` inserted, deleted or replaced
characters turn one into the other. A line is cut into max_edits + 1 segments:
such edits leave one of them untouched. Every line is indexed by its segments
and looks up the substrings that could be a segment of a line of its own length
or up to max_edits shorter, at the few places that edits on either side allow.
A line too short for such segments meets others by what is left of both when up
to max_edits characters are taken out. What meets is verified by a banded
bit-parallel edit distance.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, components, staged

# Characters whose counts are compared before a pair leaves the join; all others count together (fixed value).
LETTERS = "etaoinshrdlucmfwypvbg0123456789"
# Ids that are broadcast at once to the lines they name (fixed value).
PIECE = 1 << 18


def look_ups(max_edits: int) -> list[tuple[int, int, int]]:
    """(shorter, segment, shift): where a line may hold a segment of a line that is ``shorter`` characters shorter.

    The first ``segment`` segments left of it and the others right of it leave
    room for that many edits on each side only.
    """
    return [(shorter, i, shift) for shorter in range(max_edits + 1) for i in range(max_edits + 1)
            for shift in range(max(-i, shorter - (max_edits - i)), min(i, shorter + max_edits - i) + 1)]


def segment_keys(lines: DataFrame, max_edits: int, own: bool = False) -> DataFrame:
    """Rows (id, key, indexed) of ``lines`` (id, line, n): its own segments and, unless ``own``, the others to look up."""
    places = F.array(*[F.struct(F.lit(s).alias("shorter"), F.lit(i).alias("i"), F.lit(d).alias("shift"))
                       for s, i, d in look_ups(max_edits) if not own or s == d == 0])
    rows = lines.select("id", "line", "n", F.inline(places))
    k = max_edits + 1
    cut = {"m": F.col("n") - F.col("shorter"),
           "base": F.expr(f"cast((n - shorter) div {k} as int)"),
           "longer": F.expr(f"i - {k} + (n - shorter) % {k}")}  # segments up to here are longer by one, from 0 on
    rows = rows.withColumns(cut)
    start = F.col("i") * F.col("base") + F.greatest(F.lit(0), F.col("longer"))
    length = F.col("base") + (F.col("longer") >= 0).cast("int")
    key = F.xxhash64("m", "i", F.substring(F.col("line"), start + F.col("shift") + 1, length))
    return rows.select("id", key.alias("key"), ((F.col("shorter") == 0) & (F.col("shift") == 0)).alias("indexed"))


def deletion_keys(lines: DataFrame, max_edits: int) -> DataFrame:
    """Rows (id, n, key) of ``lines`` (id, line, n): what is left of a line without up to max_edits of its characters.

    An inserted or deleted character is one to take out on one side, a replaced
    one on both, so any two lines within max_edits share a key.
    """
    left = F.array("line")
    for _ in range(max_edits):
        shorter = F.flatten(F.transform(left, lambda t: F.transform(
            F.filter(F.sequence(F.lit(0), F.char_length(t)), lambda i: i > 0),
            lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.char_length(t))))))
        left = F.array_distinct(F.concat(left, shorter))
    return lines.select("id", "n", F.explode(left).alias("key"))


def letter_counts(line: Column) -> Column:
    """Counts of 31 characters and of all the others modulo 4, two bits each, as 0, 1, 3, 2: neighbours differ in one bit."""
    size = F.octet_length(line)
    counts = [size - F.octet_length(F.replace(line, F.lit(letter))) for letter in LETTERS]
    counts.append(F.char_length(line) - reduce(lambda x, y: x + y, counts))
    packed = F.lit(0).cast("long")
    for i, count in enumerate(counts):
        two = count.bitwiseXOR(F.shiftright(count, 1)).bitwiseAND(F.lit(3))
        packed = packed.bitwiseOR(F.shiftleft(two.cast("long"), 2 * i))
    return packed


def letters_apart(a: Column, b: Column) -> Column:
    """A lower bound of the summed difference of the counts; an edit changes it by two at most."""
    return F.bit_count(a.bitwiseXOR(b))


def lines_of(lines: DataFrame, ids: DataFrame, label: str, *columns: Column) -> DataFrame:
    """``columns`` of the ``lines`` (id, line) that the different ``ids`` (id) name, written.

    A line is many times as long as its id, so the lines stay where they are:
    ids are broadcast, about ``PIECE`` at a time. An id has the number of the
    task that wrote it above its 33 lowest bits, so a piece is a range of files,
    and the others are left out by their least and largest id.
    """
    counts = ids.groupBy(F.shiftright("id", 33).alias("task")).agg(F.count("*").alias("ids")).orderBy("task").collect()
    starts, size = [0], 0
    for task, n in counts:
        if size and size + n > PIECE:
            starts.append(task << 33)
            size = 0
        size += n
    pieces = []
    for start, end in zip(starts, [*starts[1:], 1 << 63]):
        inside = F.col("id").between(start, end - 1)
        piece = lines.filter(inside).join(F.broadcast(ids.filter(inside)), "id", "left_semi").select(*columns)
        pieces.append(staged(piece, label))
    return ids.sparkSession.read.schema(pieces[0].schema).parquet(*[piece._staged_at for piece in pieces])


def segment_pairs(lines: DataFrame, max_edits: int) -> DataFrame:
    """Rows (a, b), not yet verified: different ``lines`` (id, line, n) that share a segment and nearly all letters.

    Letters cost more to count than all keys of a line, so this is done for lines
    that meet another only. The look-ups that find a segment of another line are
    kept, then the segments that they found, each once however many lines share
    it; only these rows meet in pairs, if the letters allow.
    """
    look_up = segment_keys(lines, max_edits)
    index = segment_keys(lines, max_edits, own=True).select("key", F.col("id").alias("b"))
    found = staged(look_up.join(index, (look_up["key"] == index["key"]) & (F.col("id") != F.col("b")), "left_semi")
                   .select("key", F.col("id").alias("a"), "indexed"), "lines-found")
    # Merged at every size: where few look-ups find a segment, they would be broadcast, and disk would leap once they are many.
    held = staged(index.join(found.select("key").hint("merge"), "key", "left_semi"), "lines-held")
    met = staged(found.select(F.col("a").alias("id")).unionAll(held.select("b")).distinct(), "lines-meeting")
    letters = lines_of(lines, met, "lines-letters", F.col("id"), letter_counts(F.col("line")).alias("letters"))
    probes = found.join(letters.select(F.col("id").alias("a"), F.col("letters").alias("letters_a")), "a")
    held = held.join(letters.select(F.col("id").alias("b"), F.col("letters").alias("letters_b")), "b")
    # A line looks up its own segments too: of two lines of one length that meet there, the pair is taken once.
    pairs = probes.join(held, (probes["key"] == held["key"]) & (F.col("a") != F.col("b"))
                        & (~F.col("indexed") | (F.col("a") < F.col("b")))
                        & (letters_apart(F.col("letters_a"), F.col("letters_b")) <= 2 * max_edits))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _common_prefix(a: Column, b: Column) -> Column:
    """Length of a common prefix: all of it up to two million characters."""
    most = F.least(F.char_length(a), F.char_length(b))
    return F.aggregate(
        F.array(*[F.lit(1 << k) for k in range(20, -1, -1)]), F.lit(0),
        lambda n, step: F.when((n + step <= most) & (F.substring(a, n + 1, step) == F.substring(b, n + 1, step)),
                               n + step).otherwise(n))


def within_edits(df: DataFrame, a: str, b: str, max_edits: int) -> DataFrame:
    """Rows of ``df`` whose texts ``a`` and ``b`` are at most ``max_edits`` edits apart.

    After the common prefix and suffix are taken off, one pass over the rest of
    ``b`` keeps, for each number of errors, a word with one bit for each
    diagonal of the band: bit k is set if the diagonal's cell needs at most so
    many errors.
    """
    width, t = 2 * max_edits + 1, max_edits
    full = (1 << width) - 1
    df = df.withColumn("__p", _common_prefix(F.col(a), F.col(b)))
    for c in (a, b):
        df = df.withColumn(f"__{c}", F.reverse(F.substring(F.col(c), F.col("__p") + 1, F.char_length(c))))
    df = df.withColumn("__s", _common_prefix(F.col(f"__{a}"), F.col(f"__{b}")))
    for c in (a, b):
        rest = F.substring(F.col(f"__{c}"), F.col("__s") + 1, F.char_length(f"__{c}"))
        df = df.withColumn(f"__{c}", F.regexp_extract_all(rest, F.lit("(?s)."), F.lit(0)))
    # Written, so that the filter below is not pushed into these steps and does not repeat them per character.
    df = staged(df.drop("__p", "__s"), "lines-rests")
    x, y = F.col(f"__{a}"), F.col(f"__{b}")

    def step(state: Column, j: Column) -> Column:
        match = F.lit(0)
        for k in range(width):
            i = j + k - t - 1
            same = F.coalesce((i >= 0) & (F.get(x, i) == F.get(y, j - 1)), F.lit(False))
            match = match + F.when(same, 1 << k).otherwise(0)
        new = []
        for d in range(t + 1):
            bits = state[f"s{d}"].bitwiseAND(match)
            if d:
                less = state[f"s{d - 1}"]
                bits = bits.bitwiseOR(less).bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(new[-1], 1))
            new.append(bits.bitwiseAND(F.lit(full)))
        return F.when(state[f"s{t}"] == 0, state).otherwise(F.struct(*[v.alias(f"s{d}") for d, v in enumerate(new)]))

    start = F.struct(*[F.lit(sum(1 << (t + i) for i in range(d + 1)) & full).alias(f"s{d}") for d in range(t + 1)])
    gap = F.size(x) - F.size(y) + t
    last = F.when(F.size(y) == 0, start).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(y), F.lit(1))), start, step))
    near = F.getbit(last[f"s{t}"].cast("long"), F.greatest(F.lit(0), F.least(gap, F.lit(63)))) == 1
    return df.filter((gap >= 0) & (gap < width) & near).drop(f"__{a}", f"__{b}")


def _lines(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    exploded = docs.select(F.col(f"`{doc_id}`").alias("doc_id"),
                           F.posexplode(F.split(F.col(f"`{text}`").cast("string"), "\n")).alias("line_no", "line"))
    return exploded.filter((F.char_length("line") >= min_chars) & F.col("line").rlike(WORD)).withColumns(
        {"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit("second"), "line")})


def line_classes(docs: DataFrame, max_edits: int = 2, min_chars: int = 30, doc_id: str = "doc_id",
                 text: str = "text", linked_from: int | None = None) -> DataFrame:
    """One row per line of at least ``min_chars`` characters and a word; with 1, per line with a word.

    doc_id, line_no (from 0), class_doc_id and class_line_no (the first line, by
    document and number, that equal lines and links connect it to), n_links
    (different lines it is linked to directly) and kept (it is that first line).
    Lines shorter than (max_edits + 1)² + max_edits characters, 11 at two edits,
    leave a segment too few characters. Those of at least ``linked_from``
    characters meet others by their deletions, so with 1 no link is left out;
    those below it, by default all of them, are compared by equality only. A
    null or empty text has no lines; a null doc_id sorts before all others; rows
    with the same doc_id are one document. An empty table gives an empty result,
    other columns are not read.

    Equal lines meet by a 128-bit hash with map-side combining, so a line that a
    third of all documents share is one row per task, and only different lines
    enter the join, whose skewed partitions can be split.
    """
    lines = _lines(docs, doc_id, text, min_chars)
    distinct = staged(
        lines.groupBy("h1", "h2").agg(F.first("line").alias("line"), F.min(F.struct("doc_id", "line_no")).alias("first_at"))
        .withColumns({"id": F.monotonically_increasing_id(), "n": F.char_length("line")}), "lines-distinct")

    # From this length on, each of the max_edits + 1 segments has more than max_edits characters.
    long = (max_edits + 1) ** 2 + max_edits
    met = segment_pairs(distinct.filter(F.col("n") >= long).select("id", "line", "n"), max_edits)
    least = long if linked_from is None else max(linked_from, min_chars)
    if least < long:
        left = deletion_keys(distinct.filter(F.col("n").between(least, long + max_edits - 1)), max_edits)
        left = left.select("key", F.col("id").alias("a"), F.col("n").alias("n_a"))
        right = left.select("key", F.col("a").alias("b"), F.col("n_a").alias("n_b"))
        # Merged: before it is known how many deletions there are, a small table of lines would be broadcast with all of them.
        near = left.join(right.hint("merge"), "key").filter(
            (F.col("a") < F.col("b")) & (F.least("n_a", "n_b") < long) & (F.abs(F.col("n_a") - F.col("n_b")) <= max_edits))
        met = met.unionAll(near.select("a", "b"))
    pairs = staged(met.distinct(), "lines-pairs")
    wanted = staged(pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b")).distinct(), "lines-wanted")
    texts = lines_of(distinct, wanted, "lines-met", F.col("id"), F.col("line"))
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("line_a")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("line").alias("line_b")), "b"))
    links = staged(within_edits(both, "line_a", "line_b", max_edits).select("a", "b"), "lines-links")

    degree = links.select(F.col("a").alias("id")).unionAll(links.select("b")).groupBy("id").agg(F.count("*").alias("links"))
    roots = components(links, label="lines-classes").withColumnRenamed("node", "id")
    linked = staged(roots.join(degree, "id"), "lines-linked")
    placed = distinct.select("h1", "h2", "id", "first_at").join(linked, "id", "left")
    first = (placed.filter("root IS NOT NULL").groupBy("root").agg(F.min("first_at").alias("class_first")))
    classes = placed.join(first, "root", "left").select(
        "h1", "h2", F.coalesce("class_first", "first_at").alias("class_at"), F.coalesce("links", F.lit(0)).alias("n_links"))
    at = F.struct("doc_id", "line_no")
    return lines.drop("line").join(classes, ["h1", "h2"]).select(
        "doc_id", "line_no", F.col("class_at.doc_id").alias("class_doc_id"), F.col("class_at.line_no").alias("class_line_no"),
        "n_links", at.eqNullSafe(F.col("class_at")).alias("kept"))


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one.

    A document that loses its last line with a word goes; one that had none
    stays as it is. A column ``n_chars`` is brought up to date; other columns
    and documents without repeated lines are unchanged.
    """
    gone = (line_classes(docs, doc_id=doc_id, text=text, **options).filter("NOT kept").distinct()
            .groupBy(F.col("doc_id").alias("__doc")).agg(F.collect_list("line_no").alias("__gone")))
    # Merged at every size: where few rows go, their list would be broadcast, and disk would leap once it is long.
    gone = staged(gone, "lines-gone").hint("merge")
    rows = docs.join(gone, docs[f"`{doc_id}`"] == gone["__doc"], "left")
    left = F.array_join(F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda l, i: ~F.array_contains("__gone", i)), "\n")
    rows = rows.withColumn("__left", F.when(F.col("__gone").isNull(), F.col(f"`{text}`")).otherwise(left))
    rows = rows.filter(F.col("__gone").isNull() | F.col("__left").rlike(WORD))
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(F.col("__left").alias(c))
        elif c == "n_chars":
            columns.append(F.when(F.col("__gone").isNull(), F.col(c)).otherwise(
                F.char_length("__left").cast(docs.schema[c].dataType)).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return rows.select(*columns)
