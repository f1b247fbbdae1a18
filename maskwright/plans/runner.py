"""Checkpointed runs: stages whose outputs stay, and the model-bound stages of captions and their review."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import adapters as A
from ..operators.captions import caption_record, review_record, reviewed
from ..operators.providers import answered
from ..sources.sinks import read_json, write_json

Stage = Callable[[SparkSession, DataFrame], DataFrame]


def run_checkpointed(spark: SparkSession, root: str, stages: list[tuple[str, Stage]], rows: DataFrame, signature: str) -> DataFrame:
    """Runs stages one after another; each is written below `root` and read back, then its marker is put in place.

    A stage whose marker carries the digest of `signature` and all stages up to it isn't run again, so an interrupted run goes on
    where it stopped and a changed input (see `sources.sinks.source_signature`) or order of stages starts over from there.
    """
    chain = signature
    for name, stage in stages:
        chain = hashlib.sha256(f"{chain}\0{name}".encode()).hexdigest()
        marker, folder = f"{root}/{name}.json", f"{root}/{name}-{chain[:16]}"
        if (read_json(spark, marker) or {}).get("chain") != chain:
            stage(spark, rows).write.mode("overwrite").option("compression", "zstd").parquet(folder)
            write_json(spark, {"chain": chain, "folder": folder, "rows": spark.read.parquet(folder).count()}, marker)
        rows = spark.read.parquet(folder)
    return rows


def caption_stage(masks: DataFrame, backend: str = "mock-caption", stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(captions, rejected): each mask (mask_id, prompt and more) with its caption record; stored answers are taken again."""
    a = answered(masks, backend, "mask_id", "prompt", stored).withColumn("c", caption_record(F.col("answer"))).drop("answer")
    out = a.select("*", "c.*").drop("c")
    return out.filter("NOT reject").drop("reject", "reject_reason"), out.filter("reject")


def review_captions(captions: DataFrame, backend: str = "mock-mask-review", stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) captions after a review of each."""
    a = answered(captions, backend, "mask_id", "caption", stored).withColumn("review", review_record(F.col("answer"))).drop("answer")
    out = reviewed(a)
    return out.filter("mask_review_keep"), out.filter("NOT mask_review_keep")


def purged(streams: dict[str, DataFrame], incomplete: DataFrame) -> dict[str, DataFrame]:
    """Streams without rows of images that are to be tried again."""
    return {k: df.join(incomplete.select("image_id").distinct(), "image_id", "left_anti") for k, df in streams.items()}


def _both(s, d):
    masks = A.sources(s, d).select(F.col("image_id").alias("mask_id"), F.concat_ws(" ", "source_dataset", "source_split").alias("prompt"))
    kept, gone = review_captions(caption_stage(masks)[0])
    out = kept.unionByName(gone)
    return out.select("mask_id", "object", "caption", F.array_join("attributes", ",").alias("attributes"), "mask_review_keep", "mask_review_reason")


QUERIES = {"stage_captions": _both}
ORACLES = {
    "stage_captions": f"""WITH {A.SOURCES}, c AS (SELECT image_id AS mask_id, source_dataset AS object, 'A ' || source_dataset || ' ' || source_split || '.' AS caption FROM sources), h AS (SELECT *, CAST('0x' || left(sha256(caption), 8) AS BIGINT) AS h FROM c)
      SELECT mask_id, CASE WHEN h % 4 = 1 THEN 'thing' ELSE object END AS object, caption, 'plain' AS attributes, h % 4 <> 0 AS mask_review_keep, CASE WHEN h % 4 = 0 THEN 'not the mask' ELSE 'fits' END AS mask_review_reason FROM h""",
}
