import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import lexical_search
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    docs = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in docs), sum(len(t) for _, t in docs)
    df = Counter(t for _, d in docs for t in set(d))
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for item, query in asked.items():
        found = []
        for doc, words in docs:
            tf, m = Counter(words), 50 + (50 * len(words) * n_docs) // max(1, n_terms)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m))
                        for t in query if t in tf)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def test_whole_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    assert found(QUERIES["op11_lexical_search"](spark, sf)) == brute(docs, items)


@pytest.mark.parametrize("terms_in_block, entries", [(1 << 18, 1 << 20), (8, 60)])
def test_odd_rows(spark, messy, monkeypatch, terms_in_block, entries):
    """Nulls, ties, repeated rows, empty and long texts; the same through many blocks and shards."""
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", terms_in_block)
    monkeypatch.setattr(lexical_search, "SHARD_TERMS", entries)
    monkeypatch.setattr(lexical_search, "LEAF", 2)
    items = [(1, "The QUICK brown fox"), (2, None), (3, "word word5 word5"), (3, "line"), (None, "is, too"), (4, "nowhere"), (5, ""),
             (6, "\u00e9 \u00c9 \u6f22\u5b57 \U0001f600"), (6, "\u00e9 \u00c9 \u6f22\u5b57 \U0001f600")]
    frame = spark.createDataFrame([(*r, "x", 1, 2.0) for r in items], "item_id long, text string, doc_id string, rank int, score double")
    docs = [(r.doc_id, r.text) for r in messy.collect()]
    assert found(lexical_search.search(messy, frame)) == brute(docs, items)
    assert found(lexical_search.search(messy, frame, k=2)) == brute(docs, items, 2)


def test_empty_tables(spark, nothing, messy):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    for docs, asked in ((nothing, items), (messy, items.filter("false")), (nothing, items.filter("false"))):
        got = lexical_search.search(docs, asked)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0


def test_bounds_hold_and_prune():
    """No document exceeds a node's bound, and groups of much alike documents are mostly not opened."""
    draw, rng = random.Random(4), np.random.default_rng(4)
    rows = [range(40 * (d // 200), 40 * (d // 200) + 39 + d % 2) for d in range(2000)]
    cut = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    place = np.array([t for r in rows for t in r], np.int32)
    value = rng.integers(1, 10**6, 500)[place] + rng.integers(0, 10**4, len(place))
    shard = lexical_search.Shard(cut, place, value)
    dense, opened, leaves = np.zeros(500, np.int64), 0, sum(n[2] < 0 for n in shard.nodes)
    for q in range(40):
        p = np.array(sorted(draw.sample(range(40 * (q % 10), 40 * (q % 10) + 40), 12)), np.int32)
        w = rng.integers(1, 9000, len(p))
        full = np.zeros(500, np.int64)
        full[p] = w
        exact = np.add.reduceat(full[place] * value, cut[:-1])
        bounds = shard.bounds(p, w)
        for (lo, hi, _, _), bound in zip(shard.nodes, bounds):
            assert exact[shard.order[lo:hi]].max() <= bound
        got, scores, n = shard.best(p, w, dense, 10, 1)
        opened += n
        assert (np.sort(scores)[::-1][:10] == np.sort(exact)[::-1][:10]).all() and (exact[got] == scores).all()
    assert opened < 0.5 * leaves * 40 and not dense.any()


def test_largest_numbers_do_not_wrap():
    shard = lexical_search.Shard(np.array([0, 100_000]), np.arange(100_000, dtype=np.int32), np.full(100_000, 10**6))
    _, scores, _ = shard.best(np.arange(100_000, dtype=np.int32), np.full(100_000, 50_000), np.zeros(100_000, np.int64), 1, 1)
    assert scores.tolist() == [100_000 * 50_000 * 10**6]
