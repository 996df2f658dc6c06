import hashlib
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import prefix_trie
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows, group=100, most=6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    base = lambda c: c - int(c - group * int(c / group))
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % most
        paths[c] = tuple(own.get(base(c), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    weight = {n: (len(m) - 1) * (len(n[-1][1]) if n else 0) for n, m in members.items()}
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = weight[node] + sum(saved[k] for k in children[node])
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(n)).encode()).hexdigest())
                  for n, m in members.items())


def found(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*COLUMNS).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, depth string, n_convs int")


def test_whole_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table(spark, "/root/testdata/sf0.01", "conversations").collect()]
    assert found(QUERIES["op13_conversation_trie"](spark, "/root/testdata/sf0.01")) == brute(rows)


@pytest.mark.parametrize("chunk", [4_096, 2])
def test_odd_rows(spark, monkeypatch, chunk):
    """Nulls, empty and long texts, repeated rows, turnless conversations, hot ends, long conversations, negative ids."""
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    rows = [(None, 1, "user", "lost"), (None, None, None, None), (100, 0, "user", "a"), (101, None, None, None), (101, 0, "user", ""),
            (101, 1, "u", "é漢\U0001f600"), (102, 0, "user", "b"), (102, 0, "user", "b"), (102, 0, "user", "b"), (-5, 3, "u", "neg"),
            (-105, 0, "u", "neg"), (-100, 0, "u", "neg"), (300, 5, "user", "long " * 40_000), (301, 5, "user", "c"), (9_999, 1, "a", "b")]
    rows += [(c, t, "user", f"turn {t}") for c in (400, 401, 402, 407) for t in range(37 + (c == 401))]
    rows += [(400, 37, "user", "other"), (407, 38, "user", "other")]
    rows += [(c, t, "user", f"same {t}") for c in range(5_000, 7_500) for t in range(3)]
    assert found(prefix_trie.conversation_trie(frame(spark, rows))) == brute(rows)


def test_random_trees(spark):
    import random
    draw = random.Random(3)
    rows = [(c, t, "u", draw.choice("ab")) for c in range(600) for t in range(draw.randint(1, 20))]
    assert found(prefix_trie.conversation_trie(frame(spark, rows))) == brute(rows)


def test_empty(spark):
    assert prefix_trie.conversation_trie(frame(spark, [(None, 1, "u", "t")]).filter("false")).count() == 0
