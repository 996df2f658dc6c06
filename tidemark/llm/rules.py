"""Quality rules: a threshold table compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD


@dataclass(frozen=True)
class Rule:
    """A measure must lie in [low, high]; a bound that is None does not hold anyone back."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# Words that running text of the four languages cannot do without (fixed values).
STOP_WORDS = tuple(
    "the of and to in is that it for as with was on are by this be at or from "
    "der die und den von zu das mit ist ein nicht im des sich auf "
    "de la le et les des en un du une que est pour qui dans "
    "el los y se del las por con para una no su al lo".split())

# Marks that a word may begin or end with (fixed values).
MARKS = ".,;:!?\"'()[]"

# Texts up to so many words are too short for a share of stop words to tell anything.
SHORT = 50

# Characters that mark markup and tables rather than prose.
SYMBOLS = r"[#*$%&|<>]"

BASE_RULES = (
    Rule("enough words", "n_words", low=10),
    Rule("few repeated words", "repeat_percent", high=20),
)

RULES = (
    Rule("word length", "mean_word_chars", low=2, high=12),
    Rule("symbols", "symbols_per_word", high=0.1),
    Rule("shouting", "exclamations_per_word", high=0.3),
    Rule("stop words", "stop_word_share", low=0.01),
    Rule("repeated lines", "dup_line_share", high=0.3),
)


def measures(text: Column) -> dict[str, Column]:
    """Counts of a text as columns of one projection; needs the columns made by ``_steps``."""
    words = F.col("__words")
    lines = F.col("__lines")
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.col("__repeat").cast("long"),
        "stop_words": F.size(F.filter(words, lambda w: F.lower(F.btrim(w, F.lit(MARKS))).isin(*dict.fromkeys(STOP_WORDS)))),
    }


def _steps(df: DataFrame, text: str, window: int) -> DataFrame:
    """Intermediate arrays: words, non-blank lines, window hashes and the number of repeated words.

    Windows are compared by a 64-bit hash of their words in order. Only a text
    with two equal windows sorts them; the words they cover are the steps from
    each start to the next, at most one window long.
    """
    df = df.withColumn("__text", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    df = df.withColumns({
        "__words": F.regexp_extract_all("__text", F.lit(WORD), F.lit(0)),
        "__lines": F.filter(F.split("__text", "\n"), lambda l: l.rlike(WORD)),
    })
    df = df.withColumn("__hash", F.transform("__words", lambda w: F.xxhash64(w)))
    df = df.withColumn("__grams", F.when(F.size("__words") >= window, F.transform(
        F.sequence(F.lit(0), F.size("__words") - window),
        lambda i: F.xxhash64(*[F.get(F.col("__hash"), i + k) for k in range(window)]))))
    some = F.size("__grams") > F.size(F.array_distinct("__grams"))
    df = df.withColumn("__sorted", F.when(some, F.sort_array(F.transform(
        "__grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    last = F.size("__sorted") - 1
    df = df.withColumn("__starts", F.when(some, F.sort_array(F.transform(
        F.filter("__sorted", lambda s, j: ((j > 0) & (F.get(F.col("__sorted"), j - 1)["h"] == s["h"]))
                 | ((j < last) & (F.get(F.col("__sorted"), j + 1)["h"] == s["h"]))), lambda s: s["i"]))))
    covered = F.aggregate(
        F.transform("__starts", lambda s, j: F.least(
            F.lit(window), F.coalesce(F.get(F.col("__starts"), j + 1) - s, F.lit(window)))),
        F.lit(0), lambda total, step: total + step)
    return df.withColumn("__repeat", F.when(some, covered).otherwise(0))


def _ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "repeat_percent": 100 * F.col("n_repeat_words") / words,
        "mean_word_chars": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "exclamations_per_word": F.regexp_count("__text", F.lit("!")) / words,
        "stop_word_share": F.when(F.col("n_words") > SHORT, F.col("__stop_words") / words).otherwise(F.lit(1.0)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.size("__lines"), F.lit(1)),
    }


def _holds(rules, ratios: dict[str, Column]) -> Column:
    ok = F.lit(True)
    for rule in rules:
        value = ratios.get(rule.measure, F.col(rule.measure))
        if rule.low is not None:
            ok = ok & (value >= rule.low)
        if rule.high is not None:
            ok = ok & (value <= rule.high)
    return ok


def apply_rules(docs: DataFrame, rules=RULES, base=BASE_RULES, text: str = "text", window: int = 5) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept.

    Every measure and threshold is a built-in expression of one narrow
    projection: no shuffle, no user function, whole texts. A null text counts
    as empty and fails the base rules for want of words. Result columns replace
    input columns of the same name; rows and their number are unchanged, so
    repeated rows are judged alike and an empty table gives an empty result.
    Stop words count in any case and with marks around them; texts of up to
    ``SHORT`` words are not judged by their share.
    """
    steps = _steps(docs, text, window)
    counted = steps.withColumns({f"__{k}": v for k, v in measures(F.col("__text")).items()})
    counts = RULE_COLUMNS[:5]
    keep = [c for c in docs.columns if c not in RULE_COLUMNS]
    plain = counted.select(*[F.col(f"`{c}`") for c in keep], "__text", "__lines", "__stop_words",
                           *[F.col(f"__{k}").alias(k) for k in counts])
    ratios = _ratios()
    failed = ~_holds(base, ratios)
    return plain.select(*[f"`{c}`" for c in keep], *counts, failed.alias("base_failed"),
                        (~failed & _holds(rules, ratios)).alias("kept"))


RULE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
