"""The corpus pipeline: toxicity, line dedup, near-dedup, PII, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame; `run` writes it as Parquet to the shared folder and reads it
again for the next stage.  All stages but the last return the columns of documents, with n_chars brought up to date.

Nulls in any column stay; a null text counts as empty.  Columns other than those of documents pass through the first
four stages.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskwright.llm import line_dedup, near_dedup, packing, pii, toxicity
from maskwright.llm.common import table, unused, written


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.7 or more; the model learns from the labels of `sf_dir`."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "_toxicity")
    return toxicity.with_score(docs, model, score).filter(F.col(score) < 0.7).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out later occurrences of line windows."""
    return _measured(line_dedup.dedup_lines(docs, counts=False))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    gone = near_dedup.near_dedup(docs).filter("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind."""
    return _measured(pii.redact(docs))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("pii", redact_pii),
    ("packing", pack_windows),
]
#: The classifier and the tokenizer can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
