"""Exact dedup by content sort (native: DataFrame functions only).

Rows are dealt by sampled splitters over (first bytes, 64 bits of a digest, piece) of the text and sorted externally by the
whole text, so equal texts lie next to each other; a window whose partition key is the whole text compares each text with its
neighbour in full.  Texts that many rows share are known from a pre-aggregated count of digests and are dealt out in pieces;
the first row of each run in a piece is sorted and compared in full once more, which joins the runs of one text.

Nulls: a null text counts as empty; a null id never wins over another id.  Repeated rows: each is returned.  Ties (equal
ids with equal texts): all rows with the winning id are kept.  Empty table: empty result.  Only `id_col` and `text_col`
are read, so extra columns can't clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import body, parallelism, table, written

#: At most so many digests are dealt out in pieces of some PIECE_ROWS; any other text then has less than 1/HOT of all rows.
HOT = 4096
PIECE_ROWS = 256


def normalised(col, how: str):
    return F.trim(F.regexp_replace(F.lower(col), r"\s+", " ")) if how == "fold" else col


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", normalise: str = "none") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    `keep`: "smallest" or "largest" identifier of the equal texts stays.  `normalise`: "none" (equal as they are) or "fold"
    (lower case, runs of white space as one blank).
    """
    if keep not in ("smallest", "largest") or normalise not in ("none", "fold"):
        raise ValueError("keep: smallest or largest; normalise: none or fold")
    spark, best = docs.sparkSession, F.max if keep == "largest" else F.min
    rows = docs.select(F.col(id_col).alias("_id"), normalised(body(text_col), normalise).alias("_body"))
    rows = rows.withColumn("_sha", F.sha2("_body", 256))
    top = rows.groupBy("_sha").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > PIECE_ROWS).orderBy(F.desc("_n"), "_sha").limit(HOT).collect()  # HOT rows at most
    hot = spark.createDataFrame([tuple(r) for r in top], "_sha string, _n long")
    n = parallelism(spark)
    dealt = (
        rows.join(F.broadcast(hot), "_sha", "left")
        .withColumns({"_head": F.substring("_body", 1, 24), "_hash": F.substring("_sha", 1, 16), "_piece": F.coalesce(F.pmod(F.xxhash64("_id"), F.ceil(F.col("_n") / PIECE_ROWS)), F.lit(-1)).cast("long")})
        .repartitionByRange(n, "_head", "_hash", "_piece")
    )
    same = Window.partitionBy("_head", "_hash", "_piece", "_body")
    first = F.row_number().over(same.orderBy(F.col("_id").desc() if keep == "largest" else F.col("_id").asc_nulls_last())) == 1
    runs = dealt.withColumns({"_best": best("_id").over(same), "_size": F.count(F.lit(1)).over(same), "_first": first})
    if top:
        # one row each, and of a hot text's runs one text each; a run is known by its digest, piece and best id
        runs = written(runs.select("_id", "_sha", "_piece", "_best", "_size", F.when(F.col("_first") & (F.col("_piece") >= 0), F.col("_body")).alias("_body")), "runs")
        heads = runs.filter("_body IS NOT NULL").withColumns({"_head": F.substring("_body", 1, 24), "_hash": F.substring("_sha", 1, 16)}).repartitionByRange(n, "_head", "_hash")
        equal = Window.partitionBy("_head", "_hash", "_body")
        totals = heads.select(F.col("_sha").alias("_s"), F.col("_piece").alias("_p"), F.col("_best").alias("_b"), best("_best").over(equal).alias("_best2"), F.sum("_size").over(equal).alias("_size2"))
        runs = runs.join(totals, F.expr("_sha = _s AND _piece = _p AND _best <=> _b"), "left").withColumns({"_best": F.when(F.col("_s").isNull(), F.col("_best")).otherwise(F.col("_best2")), "_size": F.coalesce("_size2", "_size")})
    return runs.select(F.col("_id").alias(id_col), F.col("_best").alias("keep_id"), F.col("_size").alias("group_size"), F.col("_id").eqNullSafe(F.col("_best")).alias("kept"), F.col("_sha").alias("text_sha256"))


def query(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
