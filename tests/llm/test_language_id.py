import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import language_id
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_languages(spark):
    told = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    got = QUERIES["op12_language_id"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(told) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    for lang in set(told.values()):
        unseen = [r.lang_pred == lang for r in got if r.held_out and told[r.doc_id] == lang]
        assert len(unseen) > 10 and np.mean(unseen) > 0.95, lang


def test_close_languages_are_one_family(spark):
    rows = language_id.fit(table(spark, SF, "documents")).filter("level = -1").collect()
    groups = {f: {r.name for r in rows if r.a == f} for f in {r.a for r in rows}}
    assert sorted(map(sorted, groups.values())) == [["de", "en"], ["es", "fr"]]


def test_reads_no_held_out_language_and_no_other_column(spark):
    docs = table(spark, SF, "documents")
    turned = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, "xx").otherwise(F.col("lang"))) \
        .withColumn("source", F.lit(None).cast("string"))
    assert sorted(language_id.languages(docs).collect()) == sorted(language_id.languages(turned).collect())


def test_odd_rows(spark, messy, nothing):
    got = language_id.languages(messy).collect()
    assert len(got) == messy.count() and language_id.languages(nothing).count() == 0
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (4, 5, 7)} == {("und", 0.0)}
    assert all(r.lang_pred in ("en", "de", "fr") for r in got if r.doc_id in (1, 2, 3, 6, 8, 9, 10))
    model = language_id.fit(messy.filter("lang = 'en'"))
    every = language_id.predict(messy, model)
    assert every.columns == [c for c in messy.columns if c != "score"] + ["lang_pred", "score"]
    assert {r.lang_pred for r in every.collect()} == {"en", "und"}
    unknown = language_id.languages(messy.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}


def test_pieces_of_a_long_text_count_like_the_whole(monkeypatch):
    data = np.frombuffer("The quick brown Fox, jumps. Über 12 alles ".encode() * 50, np.uint8)
    whole = language_id.vector(data)
    monkeypatch.setattr(language_id, "PIECE", 100)
    parts = language_id.vector(data)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1], atol=0.02)


def test_letters_are_of_any_script(spark):
    docs = spark.createDataFrame([(1, "\u6f22\u5b57"), (2, "123 !?"), (3, "\u0301 \U0001f600"), (4, "\u03b1"), (5, "")], "doc_id long, text string")
    got = language_id.languages(docs.withColumn("lang", F.lit("zz"))).collect()
    assert {r.doc_id: r.lang_pred == "und" for r in got} == {1: False, 2: True, 3: True, 4: False, 5: True}


def test_machine_separates():
    rng = np.random.default_rng(2)
    rows = [(np.arange(4), np.abs(rng.normal(size=4)) + (i % 2) * np.array([2.0, 0, 0, 0])) for i in range(200)]
    signs = np.where(np.arange(200) % 2 == 1, 1.0, -1.0)
    w, bias = language_id.machine(rows, signs, bits=2)
    assert np.mean([np.sign(x @ w[s] + bias) == y for (s, x), y in zip(rows, signs)]) > 0.9
