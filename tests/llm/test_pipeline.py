"""The pipeline's stages: each one's decisions, on tables with every odd case and on the small tables."""

import brute
from pyspark.sql import functions as F

import corpus_pipeline as P
from glyphmill.llm import toxicity

SF = "/root/testdata/sf0.001"


def test_stages_on_odd_rows(spark, docs, tmp_path):
    spark.createDataFrame([(10, 1, 1), *((i, 1, 0) for i in range(11, 40))], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, " ".join(["zz"] * 12)), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = docs
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, now, str(tmp_path))
        if k < len(P.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"out{k}"))
        now = spark.read.parquet(str(tmp_path / f"out{k}"))
    assert 0 < now.count() < docs.count()
    for k, (_, stage) in enumerate(P.STAGES):
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, k


def test_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = toxicity.fitted(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r._toxicity for r in toxicity.score(docs, model).collect()}
    assert {r.doc_id for r in P.reject_toxic(spark, docs, SF).collect()} == {i for i, s in scores.items() if s < 0.3}
    cleaned = {r.doc_id: r for r in P.drop_lines(spark, docs, SF).collect()}
    expect = {i: h for i, _, _, h in brute.line_dedup(rows)}
    assert {i: brute.sha(r.text) for i, r in cleaned.items()} == expect
    assert all(r.n_chars == len(r.text) for i, r in cleaned.items() if r.text != dict(rows)[i])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i for i, *_, hit in brute.contamination(rows, items) if not hit}
    assert {r.doc_id for r in P.drop_contaminated(spark, docs, SF).collect()} == clean
    assert P.run(spark, SF).where(F.col("epochs") < 1).count() == 0


def test_near_copies_by_fingerprints(spark):
    """What op4 links goes in the pipeline too, though few distinct shingles are shared; so does what only shingles link, and chains of both."""
    from glyphmill.llm import similar, simhash

    tail = lambda k: " ".join(f"t{k}w{i}" for i in range(12))
    often = "x y z w v " * 100
    long = [f"word{i}" for i in range(60)]
    rows = [(1, often + tail(1)), (2, often + tail(2)), (3, " ".join(long)), (4, " ".join([*long[:-1], "last"])), (5, "quite another text of some words " + tail(5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    component = {r.doc: r.component for r in simhash.near_duplicates(docs).collect()}
    assert component[2] == 1 and component[5] == 5
    assert {r.doc_id for r in similar.drop_near_duplicates(docs).collect()} == {1, 2, 3, 5}
    assert {r.doc_id for r in P.drop_near_copies(spark, docs, SF).collect()} == {1, 3, 5}
