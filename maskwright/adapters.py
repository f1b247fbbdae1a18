"""The driver's tables in the shapes the operators read: boxes, masks, sources, change logs; and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WIDTH, HEIGHT = 640, 480


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One box a line item: image = order."""
    t = table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return t.select(
        F.col("l_orderkey").alias("image_id"), (F.row_number().over(w) - 1).alias("raw_index"),
        F.expr("cast(l_partkey % 640 AS int)").alias("x"), F.expr("cast(l_suppkey % 480 AS int)").alias("y"), F.expr("cast(l_quantity AS int)").alias("w"),
        (F.lit(1) + F.col("l_linenumber") * 7).cast("int").alias("h"), F.col("l_extendedprice").alias("score"), F.col("l_returnflag").alias("subject"),
        F.expr("cast(floor(cast(l_quantity AS int) * (1 + l_linenumber * 7) * (l_discount * 9.5 + 0.02)) AS bigint)").alias("area"),
    )


BOXES = """boxes AS (SELECT l_orderkey AS image_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INT) AS raw_index,
  CAST(l_partkey % 640 AS INT) AS x, CAST(l_suppkey % 480 AS INT) AS y, CAST(floor(l_quantity) AS INT) AS w, CAST(1 + l_linenumber * 7 AS INT) AS h,
  l_extendedprice AS score, l_returnflag AS subject,
  CAST(floor(CAST(floor(l_quantity) AS INT) * (1 + l_linenumber * 7) * (l_discount * 9.5 + 0.02)) AS BIGINT) AS area FROM lineitem)"""


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 8 x 8 mask a vector: bit i (column-major) is set where component i is positive."""
    bits = F.aggregate(
        F.transform("embedding", lambda x, i: F.struct((x > 0).cast("int").alias("b"), i.alias("i"))), F.lit(0).cast("long"),
        lambda acc, x: acc.bitwiseOR(F.when(x["b"] == 1, F.call_function("shiftleft", F.lit(1).cast("long"), x["i"])).otherwise(F.lit(0).cast("long"))),
    )
    t = table(spark, sf_dir, "embeddings")
    return t.select(F.col("vec_id").alias("mask_id"), F.expr("vec_id div 10").alias("image_id"), F.col("label").alias("subject"), F.col("embedding")[0].cast("double").alias("score"), bits.alias("bits"))


#: pixels of a mask as a DuckDB list of 0/1 instead of one word
MASKS = """masks AS (SELECT vec_id AS mask_id, vec_id // 10 AS image_id, label AS subject, CAST(embedding[1] AS DOUBLE) AS score,
  list_transform(embedding, lambda e: CASE WHEN e > 0 THEN 1 ELSE 0 END) AS px FROM embeddings)"""


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as source manifest."""
    t = table(spark, sf_dir, "documents")
    return t.select(
        F.col("doc_id").cast("string").alias("image_id"), F.col("doc_id").alias("source_manifest_index"), F.expr("doc_id div 8").alias("campaign_unit"),
        F.col("source").alias("source_dataset"), F.col("lang").alias("source_split"), F.concat(F.lit("pair-"), F.col("doc_id").cast("string")).alias("source_pair_key"), "n_chars",
    )


SOURCES = """sources AS (SELECT CAST(doc_id AS VARCHAR) AS image_id, doc_id AS source_manifest_index, doc_id // 8 AS campaign_unit, source AS source_dataset,
  lang AS source_split, 'pair-' || doc_id AS source_pair_key, n_chars FROM documents)"""


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "labels")
    return t.select(
        F.col("doc_id").cast("string").alias("image_id"), (F.col("quality") == 1).alias("accepted"),
        F.when(F.col("toxic") == 1, "toxic").otherwise("").alias("reject_reason"), F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("rationale"), F.col("doc_id").alias("_ord"),
    )


REVIEWS = """reviews AS (SELECT CAST(doc_id AS VARCHAR) AS image_id, quality = 1 AS accepted, CASE WHEN toxic = 1 THEN 'toxic' ELSE '' END AS reject_reason,
  'quality ' || quality AS rationale FROM labels)"""


def audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit for each document whose n_chars isn't a multiple of 3: links, parse flag, issue count, reason."""
    t = sources(spark, sf_dir).filter("n_chars % 3 <> 0")
    return t.select(
        "image_id", F.expr("transform(sequence(1, cast(n_chars % 14 AS int) + 1), i -> concat('m', cast(i % 12 AS string)))").alias("linked"),
        F.expr("n_chars % 5 <> 0").alias("parseable"), F.expr("cast(n_chars % 4 AS int)").alias("issues"), F.expr("IF(n_chars % 7 = 0, 'final_rewrite_unparseable', '')").alias("reason_code"),
        F.expr("IF(n_chars % 11 = 0, '', concat('caption ', image_id))").alias("caption"), F.col("source_manifest_index").alias("_ord"),
    )


AUDITS = """audits AS (SELECT image_id, list_transform(range(1, CAST(n_chars % 14 AS INT) + 2), lambda i: 'm' || (i % 12)) AS linked, n_chars % 5 <> 0 AS parseable,
  CAST(n_chars % 4 AS INT) AS issues, CASE WHEN n_chars % 7 = 0 THEN 'final_rewrite_unparseable' ELSE '' END AS reason_code,
  CASE WHEN n_chars % 11 = 0 THEN '' ELSE 'caption ' || image_id END AS caption FROM sources WHERE n_chars % 3 <> 0)"""


def exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sources(spark, sf_dir).filter("n_chars % 6 = 0")
    return t.select("image_id", F.expr("IF(n_chars % 12 = 0, 'below_minimum_masks', 'input_limit')").alias("reason_code"), F.col("source_manifest_index").alias("_ord"))


EXCLUSIONS = """exclusions AS (SELECT image_id, CASE WHEN n_chars % 12 = 0 THEN 'below_minimum_masks' ELSE 'input_limit' END AS reason_code FROM sources WHERE n_chars % 6 = 0)"""


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as append log: key = user, position = (ts, event_id)."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.struct("ts", "event_id").alias("_ord"), "event_id", "event_type", "value")
