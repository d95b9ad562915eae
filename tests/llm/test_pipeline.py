"""The pipeline on the small tables: every stage's decisions take effect."""

import corpus_pipeline
from conftest import SF_SMALL

from pyspark.sql import functions as F

from salesfacts.llm.near_dup import near_duplicates
from salesfacts.llm.secrets import find_secrets

from .conftest import empty


def test_stages_in_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near-dedup", "secret scan", "packing"]
    columns, ids = docs.columns, {r[0] for r in docs.select("doc_id").collect()}
    at = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, SF_SMALL).write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
        if name != "packing":
            assert out.columns == columns
        kept = {r[0] for r in out.select("doc_id").collect()}
        assert kept <= ids
        if name in ("line dedup", "secret scan", "packing"):
            assert kept == ids
        if name == "near-dedup":
            assert near_duplicates(out, 5, 0.8).where("NOT kept").count() == 0
        if name == "secret scan":
            assert find_secrets(out).where("size(filter(spans, s -> s.ord = 2)) > 0").count() == 0
        at, ids = out, kept
    assert corpus_pipeline.run(spark, SF_SMALL).count() == at.count()


def test_odd_documents_pass_all_stages(spark, odd_docs, tmp_path):
    """Nulls, blanks, repeated rows, a very long text, and columns named like the operators' results, which keep their values."""
    sf = str(tmp_path / "sf")
    clash = {"score": "x", "predicted": 7, "n_lines": "y", "kept": "z", "spans": "w", "component_id": 1.5}
    docs = odd_docs.withColumns({c: F.lit(v) for c, v in clash.items()})
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(4, 1, 1), (5, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    at = spark.read.parquet(f"{sf}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, sf).write.parquet(f"{sf}/{i}")
        at = spark.read.parquet(f"{sf}/{i}")
        if name != "packing":
            assert at.columns == docs.columns
            assert {tuple(r) for r in at.select(*clash).collect()} == {tuple(clash.values())}
    ids = {r["doc_id"] for r in at.collect()}
    assert {*range(1, 11), None} == ids  # 6, a copy of 5, has lost its line and is an empty text from then on
    empty(docs).write.parquet(f"{sf}-none/documents.parquet")
    empty(spark.read.parquet(f"{sf}/labels.parquet")).write.parquet(f"{sf}-none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{sf}-none").count() == 0
