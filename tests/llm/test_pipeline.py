"""The pipeline against a plain version of each stage."""

import corpus_pipeline
from strandline.llm import dartminhash
from strandline.llm.common import materialize


def test_stages(spark):
    data = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = materialize(stage(spark, docs, data), name)
        assert docs.columns == columns
        sizes.append(docs.count())
        assert docs.join(before, "doc_id", "left_semi").count() == sizes[-1]
    assert sizes[1] == sizes[0] and 0.8 * sizes[1] < sizes[2] < sizes[1] and 0.7 * sizes[2] < sizes[3] < sizes[2]
    classes = dartminhash.near_duplicates(before)
    assert {r["class_id"] for r in classes.collect()} == {r["doc_id"] for r in docs.collect()}
    assert dartminhash.near_duplicates(docs).where("doc_id <> class_id").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert pieces.select("doc_id").distinct().count() == sizes[3]
    whole = corpus_pipeline.run(spark, data)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, pieces.collect()))


def test_kept_labels(spark):
    """Toxic documents go and clean ones stay, but for few."""
    data = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, data).join(labels, "doc_id").groupBy("toxic").count().collect()
    kept = {r["toxic"]: r["count"] for r in kept}
    total = {r["toxic"]: r["count"] for r in docs.join(labels, "doc_id").groupBy("toxic").count().collect()}
    assert kept.get(1, 0) < 0.05 * total[1] and kept[0] > 0.98 * total[0]


def test_stages_with_odd_rows(spark):
    """Nulls in any column, empty, repeated and very long texts, and no row at all."""
    data = "/root/testdata/sf0.01"
    real = spark.read.parquet(f"{data}/documents.parquet")
    columns = [f"{c} {k}" for c, k in real.dtypes]
    base = {"doc_id": 1, "text": "x", "lang": "en", "source": "s", "n_chars": 1}
    changed = [{"text": None}, {"text": ""}, {"doc_id": None}, {"lang": None}, {"source": None}, {"n_chars": None}, {"text": "word " * 30_000, "doc_id": 2}, {"text": "same text", "doc_id": 3}, {"text": "same text", "doc_id": 3}]
    rows = [tuple((base | c).get(n) for n in real.columns) for c in changed]
    odd = spark.createDataFrame(rows, ", ".join(columns))
    for docs in (real.where("doc_id % 2 = 0").unionByName(odd), real.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, data), name)
            assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == real.columns
        assert docs.columns[0] == "doc_id"
