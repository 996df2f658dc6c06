import html
import math
import re
import zlib
from collections import Counter

import numpy as np

from tidemark.llm import html_text, lm, quality_classifier
from tidemark.llm.common import table

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id, n, fold):
    return zlib.crc32(str(doc_id).encode()) % n == fold


def test_quality_on_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    got = quality_classifier.quality_scores(table(spark, SF, "documents"), table(spark, SF, "labels")).collect()
    assert len(got) == 1000 and all(r.held_out == held_out(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in got)
    unseen = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in unseen]) > 0.95


def test_quality_does_not_learn_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(string(doc_id)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality")
    key = lambda r: r.doc_id
    assert sorted(quality_classifier.quality_scores(docs, labels).collect(), key=key) == sorted(
        quality_classifier.quality_scores(docs, turned).collect(), key=key)


def test_quality_on_odd_rows(spark, messy, nothing):
    labels = spark.createDataFrame([(1, 1), (6, 0), (8, None), (None, 1), (2, 0), (2, 1)], "doc_id long, quality int")
    assert quality_classifier.quality_scores(messy, labels).count() == messy.count()
    assert quality_classifier.quality_scores(nothing, labels).count() == 0
    kept = quality_classifier.drop_rejected(messy, labels)
    assert kept.columns == messy.columns
    assert quality_classifier.drop_rejected(messy, labels.filter("false")).count() == messy.count()


def test_lm_counts_and_base_scores(spark):
    docs = table(spark, SF, "documents")
    words = {r.doc_id: WORD.findall((r.text or "").translate(LOWER)) + [None] for r in docs.collect()}
    count = Counter(w for d, t in words.items() if not held_out(d, 7, 2) for w in t)
    total, kinds = sum(count.values()), len(count)
    got = lm.score_documents(docs).collect()
    assert len(got) == len(words)
    for r in got:
        t = words[r.doc_id]
        assert r.held_out == held_out(r.doc_id, 7, 2) and r.train_tokens == total
        assert (r.n_tokens, r.n_known) == (len(t), sum(count[w] > 0 for w in t))
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in t), rel_tol=1e-9)
    unseen = [r for r in got if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) * 0.97


def test_lm_shares_no_class_of_the_package(spark, monkeypatch):
    import pickle

    from pyspark import SparkContext

    seen, real = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: seen.append(pickle.dumps(value)) or real(self, value))
    lm.score_documents(table(spark, "/root/testdata/sf0.001", "documents").limit(20))
    assert seen and not any(b"tidemark" in s for s in seen)


def test_lm_is_normalised():
    rng = np.random.default_rng(1)
    share = rng.random(lm.UNITS)
    model = lm.Model.fresh(share / share.sum())
    one, two, norm = model.tables()
    for a, b in ((0, 1), (lm.START, lm.START), (7, 300)):
        assert abs(np.exp((one[a] + two[b]).astype(float) - norm[a, b]).sum() - 1) < 1e-4


def test_lm_on_odd_rows(messy, nothing):
    got = lm.score_documents(messy).collect()
    assert len(got) == messy.count() and lm.score_documents(nothing).count() == 0
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (4, 5, 7)} == {1}


def expected(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(t for t in texts if t)


def test_html_text_of_pages(spark):
    pages = table(spark, SF, "pages")
    want = {r.page_id: expected(r.html) for r in pages.collect()}
    got = html_text.extract(pages).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_html_field_on_other_templates(spark):
    pages = [r.html for r in table(spark, SF, "pages").collect()]
    field, rng = html_text.fit(pages[:120]), np.random.default_rng(5)
    right = total = 0
    for page in pages[120:]:
        found = html_text.blocks(html_text.varied(page, rng))
        labels = html_text._labels(found)
        right += (np.array(field.decode(html_text.features(found))) == labels).sum()
        total += len(labels)
    assert right / total > 0.98
    best = field.decode(html_text.features(found))
    score = field.scores(html_text.features(found))

    def value(path):
        return sum(score[i] for i, y in enumerate(path) if y) + sum(field.step[a, b] for a, b in zip(path, path[1:]))

    for _ in range(200):
        assert value(rng.integers(0, 2, len(best)).tolist()) <= value(best) + 1e-9


def test_html_reads_no_labels_from_pages_and_keeps_what_follows_empty_elements():
    for attribute in ('data-youtube="x"', 'data-year="2020"', 'data-y="12.5"', "data-y", 'data-y="3"'):
        found = html_text.blocks(f"<div {attribute}>text</div>")
        assert [(b.text, b.label) for b in found] == [("text", None)]
    page = '<article data-y="12.5"><p data-yy="z">some words of the text<p>and more of them</article>'
    found = html_text.blocks(html_text.varied(page, np.random.default_rng(1)))
    assert {b.label for b in found if "some words of the text" == b.text} == {1}
    assert html_text.fit([page], epochs=1).decode(html_text.features(html_text.blocks(page)))
    assert html_text.blocks('<div data-id="nav" title="class=menu">x</div>')[0].hints == frozenset()

    def texts(page):
        return [b.text for b in html_text.blocks(page)]

    assert texts('<p>a</p><svg width="5" /><p>b</p><iframe/><p>c</p><svg><text>no</text></svg><iframe src="u"></iframe><p>d</p>') == list("abcd")
    assert texts("<script src=/u/>no</script><p>a</p>") == ["a"]
    assert texts("<article><p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><button>More</button>"
                 "<object>instead</object><noscript>plain</noscript></article>") == ["where x=2 holds", "More", "instead", "plain"]


def test_html_time_is_linear_in_broken_pages():
    import time

    n = 1 << 20
    pages = ["<a " * (n // 3), '<p x="' * (n // 6), "<a b='" * (n // 6) + '"', "<!" * (n // 2), "<svg>" * (n // 5), "</svg " * (n // 6),
             "<div>" * 20_000 + "<div>text" * 20_000, "</nothing>" * (n // 10), "<svg></svg " * (n // 11), "<" * n, "<a" + " " * n, '"' * n + "<p>"]
    for page in pages:
        start = time.perf_counter()
        found = html_text.blocks(page)
        assert time.perf_counter() - start < 10, (page[:20], len(found))
    assert len(html_text.blocks("<div>" * 20_000 + "<div>text" * 20_000)) == 20_000
    assert [b.text for b in html_text.blocks("<p>one<div <p>two<p title='a<b>c'>three")] == ["one", "two", "three"]


def test_html_labels_stop_at_elements_beside_the_text():
    page = "<header><article>a<aside>b<article>c</article></aside><main>d</main></article></header><p>e</p>"
    found = html_text.blocks(page)
    assert [b.text for b in found] == list("abcde") and html_text._labels(found).tolist() == [1, 0, 0, 1, 0]


def test_html_on_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, None, "<p>a &amp; b<p>c"), (3, "u", "<article><p>x</article>"), (3, "u", "<article><p>x</article>"),
            (4, "u", "no markup"), (5, "u", "<script>if (a < b) {"), (6, "u", "<" * 500), (7, "u", "<article>" + "<div>" * 3000 + "deep")]
    df = spark.createDataFrame([(*r, "t", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = html_text.extract(df).collect()
    assert len(got) == len(rows) and html_text.extract(df.filter("false")).count() == 0
    assert all(r.text == "" and r.n_chars == 0 for r in got if r.page_id in (1, 2, 5))
