import corpus_pipeline as pipeline
from tidemark.llm import minhash, packing, queries
from tidemark.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_hold_what_they_promise(spark, tmp_path):
    docs, columns = table(spark, SF, "documents"), table(spark, SF, "documents").columns
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "minhash_near_dedup", "source_mixing", "best_fit_packing"]
    seen = {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != names[-1]:
            assert docs.columns == columns
        seen[name] = docs
    kept = {r.doc_id for r in seen["quality_classifier"].collect()}
    assert all(i in kept for i, q in labels.items() if q == 1) and not any(i in kept for i, q in labels.items() if q == 0)
    near = minhash.near_duplicates(seen["line_dedup"]).collect()
    assert {r.doc_id for r in seen["minhash_near_dedup"].collect()} == {r.doc_id for r in near if r.kept}
    alone = packing.pack(seen["source_mixing"], queries.TOKENIZER)
    assert alone.agg({"length": "sum"}).first()[0] == seen["best_fit_packing"].agg({"length": "sum"}).first()[0]


def test_run_on_an_empty_table(spark, nothing, tmp_path):
    docs = table(spark, SF, "documents").filter("false")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / str(len(list(tmp_path.iterdir())))))
        assert docs.count() == 0
