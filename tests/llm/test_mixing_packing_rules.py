import zlib
from array import array
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import mixing, packing, queries, rules
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


def oracle(name, tables):
    con = duckdb.connect()
    for t, df in tables.items():
        con.register(t, df)
    cur = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    return sorted((dict(zip(names, r)) for r in cur.fetchall()), key=lambda r: (r["doc_id"] is None, r["doc_id"]))


@pytest.mark.parametrize("name", ["op1_mix_sources", "op10_quality_rules"])
def test_against_sql(spark, name):
    docs = table(spark, SF, "documents").toArrow()
    got = sorted((r.asDict() for r in queries.QUERIES[name](spark, SF).collect()), key=lambda r: r["doc_id"])
    assert got == oracle(name, {"documents": docs})


def test_mix_meets_its_targets_and_repeats(spark, messy, nothing):
    rows = mixing.mix(messy).collect()
    again = mixing.mix(messy.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), r["size"], r.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.taken <= 2 * r["size"] and r.target <= 2 * r.source_size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for r in rows:
        assert abs(taken[r.source] - r.target) <= largest[r.source]
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).columns == nothing.columns
    mixed = mixing.mixed_documents(messy)
    assert mixed.columns == messy.columns
    assert sum(r.copies for r in rows) == mixed.count()


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 7)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # a and the null source stop at twice their size; b and c share the rest by 1 to 2, where c stops too.
    assert got["a"] == 20 and got[None] == 14 and got["c"] == 1000
    assert got["b"] == pytest.approx(1.5 * 1517 - 1034)


def test_ids_are_those_of_the_tokenizers_library(spark):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    texts += ["", "  a   b \n\n  c", "x  y", "a\tb\x00 c", "<|endoftext|> it's  we'll", "tab\t\t end ", "é  ü   "]
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    slow.encode_special_tokens = True
    want = [array("I", e.ids).tobytes() for e in slow.encode_batch(texts, add_special_tokens=False)]
    fast = packing.Encoder(queries.TOKENIZER, remember=5000)
    for lo in range(0, len(texts), 50):
        assert fast(texts[lo:lo + 50]) == want[lo:lo + 50]
    assert packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))(texts[-40:]) == want[-40:]


def test_added_tokens_have_the_ids_of_the_library(spark):
    texts = ["<|endoftext|>", "a<|endoftext|> b  c <|endoftext|><|endoftext|>\n\n d", "none <|endoftext| >", "", " x   <|endoftext|>   y"]
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = [array("I", e.ids).tobytes() for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    for file in (queries.TOKENIZER, path):
        assert packing.Encoder(file, added=packing.added_tokens(file))(texts) == want
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: bytes(r.ids) for r in packing.pack(df, queries.TOKENIZER, keep_ids=True).collect()}
    assert got == {i: w + array("I", [2]).tobytes() for i, w in enumerate(want)}


def test_packing_round_trip(spark, messy, nothing):
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = packing.pack(messy, queries.TOKENIZER, keep_ids=True).collect()
    want = Counter()
    for r in messy.collect():
        want[(r.doc_id, tuple(slow.encode(r.text or "", add_special_tokens=False).ids + [2]))] += 1
    texts = defaultdict(list)
    for p in pieces:
        ids = array("I", bytes(p.ids))
        assert len(ids) == p.length <= 1024 and p.ids_crc32 == zlib.crc32(p.ids)
        texts[(p.doc_id, p.piece)].append((p.start, ids))
    for (doc, ids), n in want.items():
        if len(ids) <= 1024:
            assert sum(tuple(i) == ids and s == 0 for s, i in texts[(doc, 0)]) >= n
        else:
            first = len(ids) % 1024 or 1024
            starts = [0, *range(first, len(ids), 1024)]
            for k, s in enumerate(starts):
                assert any(s == t and tuple(i) == ids[s:s + 1024 if k else first] for t, i in texts[(doc, k)])
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for slots in by_sequence.values():
        end = 0
        for offset, length in sorted(slots):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(pieces) >= sum(want.values())
    assert packing.pack(nothing, queries.TOKENIZER).count() == 0


def test_plan_is_best_fit_decreasing():
    import random

    random.seed(2)
    lengths = [random.randint(1, 64) for _ in range(900)] + [64] * 5 + [1] * 40
    runs = packing.plan(Counter(lengths), 64)
    bins: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, free in enumerate(bins) if free >= n]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= n
        else:
            bins.append(64 - n)
    assert len({first + k for _, _, items, first, _ in runs for k in range(items)}) == len(bins)
    assert sum(items for _, _, items, _, _ in runs) == len(lengths)


def test_rules_on_odd_rows(messy, nothing):
    out = rules.apply_rules(messy)
    assert out.count() == messy.count() and rules.apply_rules(nothing).count() == 0
    got = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert got[5].n_words == got[4].n_words == got[7].n_words == 0 and got[5].base_failed and not got[5].kept
    assert got[1].kept and got[9].word_chars == 5 and got[6].base_failed
    assert set(messy.columns) - {"n_words", "kept"} <= set(out.columns)


def test_stop_words_must_be_a_share_of_the_text(spark):
    other = [f"w{i}x" for i in range(100)]
    texts = {
        "one in many": " ".join(f"u{i}v" for i in range(100_000)) + " la",
        "enough": " ".join(other[:98] + ["(The)", "OF,"]),
        "none": " ".join(other),
        "short": " ".join(other[:50]),
    }
    got = {r.doc_id: r.kept for r in rules.apply_rules(spark.createDataFrame(list(texts.items()), "doc_id string, text string")).collect()}
    assert got == {"one in many": False, "enough": True, "none": False, "short": True}
