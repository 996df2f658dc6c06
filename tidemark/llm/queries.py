"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    embed_dedup, html_text, language_id, lexical_search, line_dedup, lm, minhash, mixing, packing, prefix_trie,
    quality_classifier, rules, suffix_dedup,
)
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The rank file holds the vocabulary of byte_bpe_50k.json.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


MIX_SQL = r"""
WITH sizes AS (
  SELECT *, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':17') AS mix_key,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size, count(*) AS n,
    [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sizes GROUP BY source),
lv AS (
  SELECT *, 2.0 * source_size AS cap, 1.5 * sum(source_size) OVER () AS wanted,
    coalesce(sum(2.0 * source_size) OVER before, 0) AS cap_before,
    sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_left
  FROM src WINDOW before AS (ORDER BY 2.0 * source_size / w, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lam AS (
  SELECT (any_value(wanted) - coalesce(sum(cap) FILTER (cap / w < (wanted - cap_before) / w_left), 0))
    / sum(w) FILTER (NOT cap / w < (wanted - cap_before) / w_left) AS level FROM lv),
tgt AS (
  SELECT source, source_size, least(cap, w * level) AS target,
    CASE WHEN source_size > 0 THEN floor(least(cap, w * level) / source_size) ELSE 0 END AS whole
  FROM lv, lam),
ordered AS (
  SELECT s.* EXCLUDE (source), s.source, t.source_size, t.target, t.whole, t.target - t.whole * t.source_size AS rest,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.mix_key, s.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes s JOIN tgt t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT *, CAST(whole + CASE WHEN before < rest AND 2 * before + size <= 2 * rest THEN 1 ELSE 0 END AS BIGINT) AS copies
  FROM ordered)"""

query("op1_mix_sources", MIX_SQL + """
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(size * copies AS BIGINT) AS taken
FROM mixed""")(
    lambda spark, sf: mixing.mix(table(spark, sf, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken"))


@query("op2_pack_sequences")
def _pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, capacity=1024, end_id=2)


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(rules.STOP_WORDS))
_MARKS = rules.MARKS.replace("'", "''")
RULES_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) q
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
grams AS (
  SELECT doc_id, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
    lead(word, 4) OVER o) AS gram, lead(i, 4) OVER o AS last
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
starts AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams WHERE last IS NOT NULL) q
  WHERE n > 1),
repeats AS (
  SELECT doc_id, sum(step) AS n_repeat
  FROM (SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS step FROM starts) q
  GROUP BY doc_id),
m AS (
  SELECT d.doc_id, d.t, d.w, CAST(len(d.w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(d.w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(d.t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.n_dup, 0) AS BIGINT) AS n_dup_lines, coalesce(l.n_lines, 0) AS n_lines,
    CAST(coalesce(r.n_repeat, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 12 * n_words
    AND 1.0 * n_symbols / n_words <= 0.1::DOUBLE AND 1.0 * len(regexp_extract_all(t, '!')) / n_words <= 0.3::DOUBLE
    AND (n_words <= {rules.SHORT} OR len(list_filter(w, lambda x: lower(trim(x, '{_MARKS}')) IN ({_STOPS}))) * 1.0::DOUBLE
      / n_words >= 0.01::DOUBLE)
    AND (n_lines = 0 OR CAST(n_dup_lines AS DOUBLE) / n_lines <= 0.3::DOUBLE) AS kept
FROM judged"""


@query("op10_quality_rules", RULES_SQL)
def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_minhash_near_duplicates")
def _minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=5, share=0.8)


@query("op6_line_dedup")
def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(table(spark, sf_dir, "documents"), max_edits=2, min_chars=1, linked_from=1)


@query("op8_quality_classifier")
def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_repeated_passages")
def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"), length=100)


@query("op3_lm_scores")
def _lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"), folds=7, held_out_fold=2)


@query("op4_embedding_near_duplicates")
def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"), least=0.9)


@query("op5_html_text")
def _html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


TRIE_SQL = """
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda c: CAST(ascii(c) AS BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
      lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END), CAST(4294967295 AS BIGINT)),
      4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own) q),
head AS (
  SELECT c.conv_id, o.pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h),
tail AS (
  SELECT o.conv_id, 1000000 + o.pos AS pos, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS pos, length(text) AS n,
    md5(length(role) || ':' || role || text) AS id
  FROM (SELECT * FROM head UNION ALL SELECT * FROM tail) q),
paths AS (
  SELECT conv_id, pos AS depth, n, string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY pos
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
ends AS (
  SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, max_by(path, depth) AS path FROM paths GROUP BY conv_id) q GROUP BY path),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS weight,
    CASE WHEN depth > 0 THEN left(path, 32 * (CAST(depth AS INT) - 1)) END AS parent
  FROM paths GROUP BY path, depth),
children AS (SELECT parent AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
marked AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (path)),
sums AS (
  SELECT left(path, 32 * CAST(up AS INT)) AS path, sum(weight) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM marked) q GROUP BY 1)
SELECT m.conv_id, m.depth, p.conv_id AS parent_conv_id, m.n_convs, CAST(m.n_children AS BIGINT) AS n_children,
  CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
  coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM marked m JOIN sums s USING (path) LEFT JOIN nodes p ON p.path = m.parent LEFT JOIN ends e ON e.path = m.path"""


@query("op13_conversation_trie", TRIE_SQL)
def _trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), group=100, most=6)


@query("op12_language_id")
def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"), folds=4, held_out_fold=2)


SEARCH_SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
total AS (SELECT count(*) AS n_docs, sum(len(terms)) AS n_terms FROM docs WHERE len(terms) > 0),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (
  SELECT row, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) q
  WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term),
sizes AS (
  SELECT row, doc_id, 50 + (50 * CAST(len(terms) AS BIGINT) * n_docs) // CAST(n_terms AS BIGINT) AS m FROM docs, total),
scores AS (
  SELECT a.item_id, s.doc_id, s.row, CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * s.m))) AS BIGINT) AS score
  FROM asked a JOIN weights w USING (term) JOIN tf f USING (term) JOIN sizes s ON s.row = f.row
  GROUP BY a.item_id, s.doc_id, s.row),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""


@query("op11_lexical_search", SEARCH_SQL)
def _search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)
