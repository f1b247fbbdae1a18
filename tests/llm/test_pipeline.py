"""The corpus pipeline: each stage's decisions hold, and awkward rows pass."""

import corpus_pipeline
from maskwright.llm import line_dedup, near_dedup, pii, toxicity
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    one = corpus_pipeline.drop_toxic(spark, docs, DATA)
    assert one.columns == docs.columns and {r["doc_id"] for r in one.select("doc_id").collect()} == {i for i, s in scores.items() if s < 0.7}
    two = corpus_pipeline.drop_repeated_lines(spark, one, DATA).persist()
    assert two.columns == docs.columns and two.filter(F.length("text") != F.col("n_chars")).isEmpty()
    assert two.count() == one.count() and line_dedup.dedup_lines(one).agg(F.sum("n_removed")).first()[0] > 0
    three = corpus_pipeline.drop_near_copies(spark, two, DATA).persist()
    want = {r["doc_id"] for r in near_dedup.near_dedup(two).filter("kept").collect()}
    assert three.columns == docs.columns and {r["doc_id"] for r in three.select("doc_id").collect()} == want and len(want) < two.count()
    four = corpus_pipeline.redact_pii(spark, three, DATA)
    assert four.columns == docs.columns and not any(pii.base_spans(r["text"]) for r in four.select("text").collect())
    five = corpus_pipeline.pack_windows(spark, four, DATA)
    assert five.select("doc_id").distinct().count() == three.count()


def test_awkward(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (2, "a@b.co hi", None, "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:4]:
            rows = stage(spark, rows, "/root/testdata/sf0.001")
            assert rows.columns == docs.columns, name
        assert corpus_pipeline.pack_windows(spark, rows, "").count() == rows.count()


def test_extra_columns_pass(spark):
    """Columns of the names that stages use inside keep their values through the first four stages."""
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s", 11), (2, "other words stand here now", "en", "s", 26)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "7 AS n_lines", "8 AS n_removed", "9 AS _toxicity", "10 AS __toxicity", "11 AS pii", "12 AS score", "13 AS id", "14 AS kept", "15 AS component_id", "16 AS _id")
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        rows = docs.collect()
        assert len(rows) == 2 and all(tuple(r)[5:] == (7, 8, 9, 10, 11, 12, 13, 14, 15, 16) for r in rows), name
