import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import embed_dedup, line_dedup, minhash, queries, suffix_dedup
from tidemark.llm.common import components, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def classes(nodes, linked):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


def test_components(spark):
    random.seed(1)
    edges = [(random.randint(0, 400), random.randint(0, 400)) for _ in range(180)] + [(500 + i, 501 + i) for i in range(60)]
    edges += [(1000, 1000 + i) for i in range(200)]
    want = classes({n for e in edges for n in e}, edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: r for n, r in want.items() if any(n in e and e[0] != e[1] for e in edges)}


def shingles(text):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_near_duplicates_against_all_pairs(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    sets = {r.doc_id: shingles(r.text) for r in docs.collect()}
    ids = sorted(sets)
    linked = []
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = sum((sets[a] & sets[b]).values())
            if both and both >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - both):
                linked.append((a, b))
    want = classes(ids, linked)
    got = minhash.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == want and len(got) == len(ids)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_near_groups_whose_members_are_far_from_one_centre(spark):
    """Copies of one text with a few swapped words: some pairs reach 0.8, most do not, none need reach the centre."""
    random.seed(11)
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join(base)]
    for _ in range(220):
        words = list(base)
        for _ in range(random.choice((2, 3, 3, 4, 4, 5))):
            words[random.randrange(16) * 5] = random.choice("abc")
        texts.append(" ".join(words))
    ids = list(range(len(texts)))
    sets = [shingles(t) for t in texts]
    linked = []
    for i in ids:
        for j in range(i):
            both = sum((sets[i] & sets[j]).values())
            if both >= 0.8 * (sum(sets[i].values()) + sum(sets[j].values()) - both):
                linked.append((i, j))
    want = classes(ids, linked)
    assert 20 < len(set(want.values())) < 200
    got = minhash.near_duplicates(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == want


def test_prefixes_lose_no_pair_and_leave_most_out(spark):
    rng = random.Random(5)
    sets = {}
    for i in range(300):
        # Families of sets around 40 values, changed in up to nine places.
        s = {(i % 20) * 1000 + v for v in range(40)}
        for _ in range(rng.randrange(10)):
            s.discard(rng.choice(sorted(s)))
            s.add(rng.randrange(10**6, 10**6 + 400))
        sets[i] = s
    data = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "id long, shingles array<long>")
    texts = spark.createDataFrame([(i, i) for i in sets], "rep long, class long")
    got = {(r.a, r.b) for r in minhash._prefix_pairs(texts, data, 0.8).collect()}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    same_family = sum(1 for a in sets for b in sets if a < b and a % 20 == b % 20)
    assert want and want <= got and len(got) < same_family


def test_texts_that_share_many_rare_shingles_meet_once(spark):
    """30 sets with 40 values in common: each pair holds several of them in both prefixes."""
    sets = {i: [*range(40), *range(1000 + i * 10, 1006 + i * 10)] for i in range(30)}
    data = spark.createDataFrame(list(sets.items()), "id long, shingles array<long>")
    texts = spark.createDataFrame([(i, i) for i in sets], "rep long, class long")
    got = [(r.a, r.b) for r in minhash._prefix_pairs(texts, data, 0.7).collect()]
    assert sorted(got) == [(a, b) for a in sets for b in sets if a < b]


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for trial in range(30):
        a, b = rng.integers(0, 6, 200), rng.integers(0, 6, 200)
        keep = rng.random(200) < 0.7
        b[keep] = a[keep]
        a[0], b[0] = 900, 700
        h = minhash.mix(np.arange(200, dtype=np.uint64) + np.uint64(trial << 20))
        i, j = np.flatnonzero(a), np.flatnonzero(b)
        s = minhash.signatures(np.concatenate([h[i], h[j]]), np.repeat([0, 1], [len(i), len(j)]), np.concatenate([a[i], b[j]]), 2)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_near_duplicates_on_odd_rows(messy, nothing):
    got = minhash.near_duplicates(messy).collect()
    assert len(got) == messy.count() and minhash.near_duplicates(nothing).count() == 0
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].class_id == by_id[3].class_id == 1 and by_id[10].class_id == 6
    assert all(by_id[i].kept for i in (1, 4, 5, 6, 7, 8, 9)) and by_id[None].class_id is None and by_id[None].kept
    kept = minhash.keep_one(messy)
    assert kept.columns == messy.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r.doc_id) for r in got if r.kept)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_lines_against_all_pairs(spark):
    random.seed(6)
    rows: list[tuple[int, str]] = []
    for d in range(60):
        lines = []
        for _ in range(3):
            if rows and random.random() < 0.6:
                s = random.choice(random.choice(rows)[1].split("\n"))
                for _ in range(random.choice([0, 1, 2, 2, 3, 4])):
                    p, o = random.randrange(len(s) + 1), random.random()
                    s = s[:p] + (random.choice("abé ") + s[p:] if o < 0.33 else s[p + 1:] if o < 0.66 else "z" + s[p + 1:])
            else:
                s = "".join(random.choice("abcdé\U0001f600 ") for _ in range(random.choice([31, 33, 40, 64])))
            lines.append(s)
        rows.append((d, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    places = [(d, i, s) for d, t in rows for i, s in enumerate(t.split("\n")) if len(s) >= 30 and s.strip()]
    lines = sorted({s for *_, s in places})
    linked = [(a, b) for i, a in enumerate(lines) for b in lines[:i] if abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2]
    root, degree = classes(lines, linked), Counter(x for pair in linked for x in pair)
    first: dict = {}
    for d, i, s in places:
        first[root[s]] = min(first.get(root[s], (d, i)), (d, i))
    got = {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no, r.n_links, r.kept) for r in line_dedup.line_classes(df).collect()}
    assert got == {(d, i): (*first[root[s]], degree[s], (d, i) == first[root[s]]) for d, i, s in places}
    texts = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(df).collect()}
    for d, t in rows:
        left = [s for i, s in enumerate(t.split("\n")) if (d, i) not in got or got[(d, i)][3]]
        assert texts.get(d) == ("\n".join(left) if any(s.strip() for s in left) else None)


def test_short_lines_against_all_pairs(spark):
    random.seed(9)
    pool = ["".join(random.choice("abé ") for _ in range(random.choice([1, 2, 5, 9, 10, 11, 12, 13, 20, 31]))) for _ in range(60)]
    pool += [s[:p] + "z" + s[p + random.choice([0, 1]):] for s in pool for p in [random.randrange(len(s) + 1)]]
    rows = [(d, "\n".join(random.choice(pool) for _ in range(4))) for d in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    places = [(d, i, s) for d, t in rows for i, s in enumerate(t.split("\n")) if s.strip()]
    lines = sorted({s for *_, s in places})
    linked = [(a, b) for i, a in enumerate(lines) for b in lines[:i] if min(len(a), len(b)) >= 11 and edits(a, b) <= 2]
    root, degree = classes(lines, linked), Counter(x for pair in linked for x in pair)
    first: dict = {}
    for d, i, s in places:
        first[root[s]] = min(first.get(root[s], (d, i)), (d, i))
    got = {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no, r.n_links, r.kept)
           for r in line_dedup.line_classes(df, max_edits=2, min_chars=1).collect()}
    assert got == {(d, i): (*first[root[s]], degree[s], (d, i) == first[root[s]]) for d, i, s in places}


def test_lines_of_any_length_are_linked_where_asked(spark):
    random.seed(10)
    pool = ["".join(random.choice("abé\U0001f600 ") for _ in range(random.choice([1, 2, 3, 5, 8, 10, 11, 12, 13, 20]))) for _ in range(50)]
    pool += [s[:p] + "z" + s[p + random.choice([0, 1]):] for s in pool for p in [random.randrange(len(s) + 1)]]
    rows = [(i, s) for i, s in enumerate(pool) if s.strip()]
    lines = sorted({s for _, s in rows})
    linked = [(a, b) for i, a in enumerate(lines) for b in lines[:i] if edits(a, b) <= 2]
    degree = Counter(x for pair in linked for x in pair)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.line_classes(df, max_edits=2, min_chars=1, linked_from=1).collect()
    assert {r.doc_id: r.n_links for r in got} == {i: degree[s] for i, s in rows}


def test_letter_counts_part_lines_that_are_far_apart_only(spark):
    rng = random.Random(12)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("etaonrih sz09é\U0001f600.") for _ in range(rng.randrange(40)))
        b = a
        for _ in range(rng.randrange(4)):
            p, o = rng.randrange(len(b) + 1), rng.random()
            b = b[:p] + (rng.choice("ts7é ") + b[p:] if o < 0.33 else b[p + 1:] if o < 0.66 else "漢" + b[p + 1:])
        pairs.append((a, b))
    rows = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", line_dedup.letters_apart(*[line_dedup.letter_counts(F.col(c)) for c in "ab"]).alias("apart")).collect()
    assert all(r.apart <= 2 * edits(r.a, r.b) for r in rows) and any(r.apart > 4 for r in rows)


def test_near_copies_beyond_the_edits_are_not_verified(spark, monkeypatch):
    """Copies of one long line with four characters put in somewhere: nearly all pairs are eight edits apart."""
    rng, met = random.Random(13), []
    base = " ".join("".join(rng.choice("etaonrihsd") for _ in range(rng.randrange(2, 9))) for _ in range(90))
    places = [rng.randrange(len(base)) for _ in range(150)]
    lines = [base[:p] + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) + base[p:] for p in places]
    write = line_dedup.staged
    monkeypatch.setattr(line_dedup, "staged", lambda df, label: (out := write(df, label), met.append((label, out)))[0])
    got = line_dedup.line_classes(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert len(got) == len(lines)
    # 11 175 pairs, of which the counts of eight letters left more than 7600.
    assert dict(met)["lines-pairs"].count() < 11175 // 2


def test_letters_are_counted_for_lines_that_meet_another_only(spark, monkeypatch):
    """200 lines alone, and 40 that share all but their last four characters: rows before the pairs stay in proportion to lines."""
    rng, written = random.Random(14), {}
    alone = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60)) for _ in range(200)]
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60))
    group = [base + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4)) for _ in range(40)]
    near = [group[0][:-1] + "#", alone[0][:30] + "##" + alone[0][30:]]
    lines = alone + group + near
    write = line_dedup.staged
    monkeypatch.setattr(line_dedup, "staged", lambda df, label: (out := write(df, label), written.setdefault(label, []).append(out))[0])
    got = line_dedup.line_classes(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_links for r in got} == {
        i: sum(1 for b in lines if a != b and abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2) for i, a in enumerate(lines)}
    assert "letters" not in written["lines-distinct"][0].columns
    counts = {label: sum(df.count() for df in tables) for label, tables in written.items()}
    assert counts["lines-letters"] == len(group) + len(near) + 1
    assert counts["lines-found"] <= 12 * 43 and counts["lines-held"] <= 3 * 43


def test_lines_are_looked_up_in_pieces(spark, monkeypatch):
    """Ids of four tasks and no more than ten at a time: lines do not travel, none is lost or twice."""
    pieces, write = [], line_dedup.staged
    lines = write(spark.range(100).repartition(4).select(F.monotonically_increasing_id().alias("id"), F.col("id").alias("line")), "lines")
    ids = lines.filter("line % 3 = 0").select("id")
    monkeypatch.setattr(line_dedup, "PIECE", 10)
    monkeypatch.setattr(line_dedup, "staged", lambda df, label: (out := write(df, label), pieces.append((df, out)))[0])
    got = line_dedup.lines_of(lines, ids, "some", F.col("line")).collect()
    assert sorted(r.line for r in got) == list(range(0, 100, 3)) and len(pieces) > 1
    assert "Exchange hashpartitioning" not in "".join(df._jdf.queryExecution().executedPlan().toString() for df, _ in pieces)
    assert line_dedup.lines_of(lines, ids.filter("false"), "none", F.col("line")).collect() == []


def test_registered_line_query_links_short_lines(spark, tmp_path):
    spark.createDataFrame([(1, "abcde"), (2, "abcdz"), (3, "vwxyz")], "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op6_line_dedup"](spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.class_doc_id, r.n_links, r.kept) for r in got} == {1: (1, 1, True), 2: (1, 1, False), 3: (3, 0, True)}


def test_registered_line_query_has_every_line_with_a_word(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").collect()
    want = {(r.doc_id, i) for r in docs for i, s in enumerate((r.text or "").split("\n")) if WORD.search(s)}
    got = queries.QUERIES["op6_line_dedup"](spark, "/root/testdata/sf0.001").collect()
    assert {(r.doc_id, r.line_no) for r in got} == want


def test_few_removed_rows_are_joined_as_many_are(spark):
    docs = spark.createDataFrame([(i, f"the same line of all\n{'of its own ' * i}") for i in range(6)] * 2, "doc_id long, text string")
    docs = docs.unionAll(docs.withColumn("doc_id", F.col("doc_id") + 10))
    for out, kind in ((line_dedup.drop_repeated_lines(docs, min_chars=1), "LeftOuter"), (minhash.keep_one(docs), "LeftAnti")):
        assert out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert re.search(f"SortMergeJoin.*{kind}", plan) and not re.search(f"BroadcastHashJoin.*{kind}", plan)


def test_lines_on_odd_rows(messy, nothing):
    out = line_dedup.drop_repeated_lines(messy)
    assert out.columns == messy.columns and line_dedup.line_classes(nothing).count() == 0
    left = {r.doc_id: r for r in out.collect()}
    assert left[4].text == "" and left[5].text is None and left[8].text == "word" and 10 not in left and left[6].n_chars == 9


def brute_passages(docs, length=100):
    seen, out = set(), {}
    for doc, data in docs:
        marks = np.zeros(len(data) + 1, int)
        for p in range(len(data) - length + 1):
            s = data[p:p + length]
            if s in seen:
                marks[p] += 1
                marks[p + length] -= 1
            seen.add(s)
        gone = np.cumsum(marks)[:-1] > 0
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_passages_against_all_strings(spark, monkeypatch):
    random.seed(8)
    parts = [" ".join(random.choice(["ab", "é", "the", "x"]) for _ in range(random.choice([20, 45, 90]))) for _ in range(9)]
    rows = [(i, "".join(random.choice(parts) + random.choice(["", "\n", "q"]) for _ in range(random.choice([1, 3, 9]))))
            for i in range(50)] + [(60, "z" * 700), (61, "z" * 99), (62, "yz" * 300)]
    want = brute_passages([(i, t.encode()) for i, t in rows])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (10**9, 5):  # by columns only, and with the strings of most anchors dealt out
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_passages(df).collect()}
        assert got == want


def test_passages_of_documents_and_odd_rows(spark, messy, nothing):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = brute_passages(sorted((r.doc_id, (r.text or "").encode()) for r in docs.collect()))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_passages(docs).collect()}
    assert got == want
    assert suffix_dedup.repeated_passages(nothing).count() == 0
    odd = {r.doc_id: r for r in suffix_dedup.repeated_passages(messy).collect()}
    assert odd[5].n_bytes == 0 and odd[10].n_removed == odd[10].n_bytes > 0 and odd[6].n_removed > 0


def test_passages_of_a_repeated_row(spark, monkeypatch):
    random.seed(10)
    alone = "".join(random.choice("abcdefgh ") for _ in range(400))
    twice = "".join(random.choice("abcdefgh ") for _ in range(150))
    rows = [(1, alone), (1, alone), (2, twice + "!" + twice), (2, twice + "!" + twice), (3, "x" + twice), (4, "short"), (4, "short")]
    want = brute_passages([(i, t.encode()) for i, t in dict(rows).items()])
    assert want[1][1] == 0 and want[2][1] == 150
    for hot in (10**9, 0):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        got = [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in suffix_dedup.repeated_passages(
            spark.createDataFrame(rows, "doc_id long, text string")).collect()]
        assert sorted(got) == sorted((i, want[i]) for i, _ in rows)


def test_copies_of_a_context_are_not_compared_again(spark, monkeypatch):
    random.seed(11)
    shared = "".join(random.choice("abcdefgh ") for _ in range(600))
    # Thirty copies, two of them inside one document, one cut short and one with another end.
    rows = [(i, shared) for i in range(28)] + [(40, shared + "-" + shared), (41, shared[:350]), (42, shared[100:] + "other end")]
    rows.append((-1, shared[250:] + "!"))
    kept, orig = {}, suffix_dedup.staged

    def counted(df, label):
        out = orig(df, label)
        kept[label] = out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "staged", counted)
    want = brute_passages(sorted((i, t.encode()) for i, t in rows))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
    assert kept["suffix-contexts"] < kept["suffix-places"] * 3


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((700, 24))
    x[200:400] = x[rng.integers(0, 200, 200)] + 0.2 * rng.standard_normal((200, 24))
    x[400:500] = x[0] + 0.15 * rng.standard_normal((100, 24))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    want = classes(range(700), list(zip(*np.nonzero(near))))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(800, None), (801, []), (802, [0.0] * 24), (803, [float("nan")] + [1.0] * 23), (804, [None] + [1.0] * 23),
           (805, [float("inf")] + [1.0] * 23), (806, [1.0, 2.0]), (807, [2.0, 4.0]), (None, x[0].tolist()), (5, x[5].tolist())]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows + odd], "vec_id long, embedding array<double>, kept string, n_links int")
    got = embed_dedup.near_vectors(df).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.vec_id: r for r in got}
    links = sum(r.n_links for i, r in by_id.items() if i is not None and i < 700)
    assert 0.99 * near.sum() <= links <= near.sum()
    assert np.mean([by_id[i].component_id == want[i] for i in range(700)]) > 0.99
    assert all(by_id[i].n_links <= near[i].sum() for i in range(700))
    assert all(by_id[i].n_links == 0 and by_id[i].kept for i in (800, 801, 802, 803, 804, 805)) and by_id[807].component_id == 806
    assert by_id[None].n_links == 0 and embed_dedup.near_vectors(df.filter("false")).count() == 0


def test_vectors_that_no_link_leads_to_are_found():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((900, 24))
    x[600:] = x[0] + 0.02 * rng.standard_normal((300, 24))  # a third in one group, whose links outnumber the others
    x[1:200:2] = x[2:201:2] + 0.05 * rng.standard_normal((100, 24))
    x = embed_dedup.normalised(x)
    graph = embed_dedup.Graph(x)
    for links in graph.layers:
        links[np.isin(links, np.arange(1, 201))] = -1
    near = x @ x.T >= 0.9
    found = graph.within(x, 0.9)
    hit = [set(np.flatnonzero(near[i])) <= set(found[i].tolist()) for i in range(900)]
    assert all(hit[1:201])


def test_vectors_of_many_graphs_in_rounds(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x, y = rng.standard_normal((500, 16)).astype(np.float32), rng.standard_normal((60, 5)).astype(np.float32)
    x[300:400] = x[:100] + 0.1 * rng.standard_normal((100, 16)).astype(np.float32)
    x[400:] = x[0] + 0.1 * rng.standard_normal((100, 16)).astype(np.float32)
    want = {}
    for first, v in ((0, x), (1000, y)):
        unit = embed_dedup.normalised(v.astype(float))
        near = unit @ unit.T >= 0.9
        np.fill_diagonal(near, False)
        inside = classes(range(len(v)), list(zip(*np.nonzero(near))))
        want |= {first + i: (int(near[i].sum()), first + inside[i]) for i in range(len(v))}
    for name, value in {"SHARD": 100, "ROUND_BYTES": 40_000, "BLOCK": 64, "ROWS": 16, "FOUND": 50, "MARKS": 900, "PRODUCTS": 5_000}.items():
        monkeypatch.setattr(embed_dedup, name, value)
    kept, rounds, orig = {}, [], embed_dedup.staged

    def counted(df, label):
        out = orig(df, label)
        kept[label] = out.count()
        rounds.append(label)
        return out

    monkeypatch.setattr(embed_dedup, "staged", counted)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, v.tolist()) for i, v in enumerate(y)]
    for kind in ("float", "double"):
        rounds.clear()
        got = embed_dedup.near_vectors(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
        assert kept["vector-graphs"] == len(rows)  # a row for each node, not one for each graph
        assert rounds.count("vector-found") > 1


def test_a_full_shard_is_searched_in_little_memory():
    rng = np.random.default_rng(8)
    n = 65_536
    x = rng.standard_normal((n, 32)).astype(np.float32)
    group = rng.permutation(n)[:3000]
    x[group] = x[group[0]] + 0.01 * rng.standard_normal((3000, 32)).astype(np.float32)
    x = embed_dedup.normalised(x).astype(np.float32)
    graph = embed_dedup.Graph.restored(x, np.zeros(n, int), rng.integers(0, n, (n, embed_dedup.DEGREE)).astype(np.int32))
    others = np.setdiff1d(np.arange(n), group)
    queries = np.concatenate([group[:60], others[:1000]])
    tracemalloc.start()
    found = [len(f) for run in graph.runs(x[queries], 0.9) for f in run]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[:60] == [3000] * 60
    assert most < 150e6


def test_equal_vectors_are_all_counted(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((40, 8))
    rows = [(i, x[0].tolist()) for i in range(400)] + [(400 + i, v.tolist()) for i, v in enumerate(x)]
    rows += [(500 + i, (v + 1e-3).tolist()) for i, v in enumerate(x[:20])]
    every = embed_dedup.normalised(np.array([v for _, v in rows]))
    near = every @ every.T >= 0.9
    np.fill_diagonal(near, False)
    ids = [i for i, _ in rows]
    want = classes(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))])
    got = embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (int(near[k].sum()), want[i], want[i] == i) for k, i in enumerate(ids)}
