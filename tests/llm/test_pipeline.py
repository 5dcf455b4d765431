"""Each stage of the pipeline on its own input, and the whole against what its stages decide."""

import corpus_pipeline
from siteloom.llm import neardup, quality, toxicity


def test_stages_take_effect(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns, before = docs.columns, docs.count()
    want = {
        "quality": lambda d: {r.doc_id for r in quality.score(d, quality.train(d, labels)).where(f"score >= {quality.THRESHOLD}").collect()},
        "toxicity": lambda d: {r.doc_id for r in toxicity.score(d, toxicity.train(d, labels)).where(f"score < {toxicity.THRESHOLD}").collect()},
        "near_duplicates": lambda d: {r.doc_id for r in neardup.near_duplicates(d).where("kept").collect()},
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        expected = want[name](docs)
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        assert {r.doc_id for r in docs.select("doc_id").collect()} == expected
        assert len(expected) < before
        before = len(expected)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    whole = corpus_pipeline.run(spark, sf_dir)
    assert whole.columns == packed.columns
    assert sorted(whole.collect()) == sorted(packed.collect())
    assert {r.doc_id for r in whole.select("doc_id").distinct().collect()} == expected
