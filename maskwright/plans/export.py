"""Export routing: disposition, views, histograms, shards, training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import adapters as A
from ..operators.incremental import running
from ..operators.keyed import last_wins
from .ledger import WITH, export_parseable

VIEWS = {"parseable_min_10": "links >= 10", "parseable_1_to_9": "links BETWEEN 1 AND 9", "parseable_1_plus": "links >= 1", "all": "true"}


def disposed(sources: DataFrame, audits: DataFrame, exclusions: DataFrame, terminal: DataFrame) -> DataFrame:
    """Star join with disposition and distinct links; quality flags play no part.  `terminal`: units with the terminal marker."""
    a = last_wins(audits, "image_id").select("image_id", export_parseable().alias("ok"), F.size(F.array_distinct("linked")).alias("n_links"), F.col("reason_code").alias("audit_reason"))
    x = last_wins(exclusions, "image_id").select("image_id", F.col("reason_code").alias("excluded_reason"))
    out = sources.join(a, "image_id", "left").join(x, "image_id", "left").join(terminal.select("campaign_unit").distinct().withColumn("done", F.lit(True)), "campaign_unit", "left")
    links = F.when(F.coalesce("ok", F.lit(False)), F.col("n_links")).otherwise(F.lit(0)).cast("long")
    ok = F.coalesce("ok", F.lit(False))
    disposition = (
        F.when(ok & (F.col("n_links") >= 10), "parseable_min_10").when(ok, "parseable_1_to_9")
        .otherwise(F.coalesce(F.nullif("audit_reason", F.lit("")), F.nullif("excluded_reason", F.lit("")), F.when(F.col("done").isNull(), "pipeline_incomplete"), F.lit("did_not_reach_bcc")))
    )
    return out.select("image_id", "source_manifest_index", "source_dataset", "source_split", disposition.alias("disposition"), links.alias("links"))


def views(rows: DataFrame) -> DataFrame:
    """Rows once for each view they belong to (one pass: no view is scanned on its own)."""
    names = F.filter(F.array(*[F.when(F.expr(cond), F.lit(v)) for v, cond in VIEWS.items()]), lambda v: v.isNotNull())
    return rows.withColumn("view", F.explode(names))


def histogram(rows: DataFrame, value: str) -> DataFrame:
    return rows.groupBy(F.col(value).cast("long").alias("value")).agg(F.count(F.lit(1)).alias("frequency"))


def sharded(rows: DataFrame, key: str, order: str, size: int, pieces: int = 64) -> DataFrame:
    """Adds row_index, the place in (order, key), and shard = row_index div size."""
    return running(rows.withColumn("_one", F.lit(1)), [order, key], pieces, row_index="_one").drop("_one").withColumn("row_index", F.col("row_index") - 1).withColumn("shard", F.expr(f"row_index div {size}"))


def shard_manifest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("shard").agg(F.min("row_index").alias("start"), (F.max("row_index") + 1).alias("end"), F.count(F.lit(1)).alias("rows"), F.format_string("part-%05d.parquet", F.col("shard")).alias("path"))


def write_shards(rows: DataFrame, path: str) -> None:
    rows.repartitionByRange("shard").sortWithinPartitions("shard", "row_index").write.partitionBy("shard").option("compression", "zstd").parquet(path)


def training_rows(sources: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows for training: groups without ids dropped, links as compact JSON."""
    a = last_wins(audits, "image_id").filter(export_parseable())
    groups = F.transform(F.array_distinct("linked"), lambda m: F.struct(m.alias("mask_id")))
    return sources.join(a, "image_id").select(F.col("source_dataset").alias("dataset"), F.col("source_split").alias("split"), F.col("source_pair_key").alias("image_key"), "image_id", "caption", F.to_json(groups).alias("groups_json"))


def _disposed(s, d):
    done = A.sources(s, d).filter("campaign_unit % 3 <> 0").select("campaign_unit")
    return disposed(A.sources(s, d), A.audits(s, d), A.exclusions(s, d), done)


DISPOSED = """disp AS (SELECT s.image_id, s.source_manifest_index, s.source_dataset, s.source_split,
  CASE WHEN a.ok AND a.n_links >= 10 THEN 'parseable_min_10' WHEN a.ok THEN 'parseable_1_to_9'
  ELSE coalesce(nullif(a.reason_code, ''), nullif(x.reason_code, ''), CASE WHEN s.campaign_unit % 3 = 0 THEN 'pipeline_incomplete' END, 'did_not_reach_bcc') END AS disposition,
  CASE WHEN a.ok THEN a.n_links ELSE 0 END AS links
  FROM sources s LEFT JOIN (SELECT *, len(list_distinct(linked)) AS n_links, trim(caption) <> '' AND len(linked) > 0 AND parseable AND reason_code <> 'final_rewrite_unparseable' AS ok FROM audits) a USING (image_id)
  LEFT JOIN exclusions x USING (image_id))"""
QUERIES = {
    "export_disposition": _disposed,
    "export_views": lambda s, d: views(_disposed(s, d)).groupBy("view", "disposition").agg(F.count(F.lit(1)).alias("n"), F.sum("links").alias("links")),
    "export_link_histogram": lambda s, d: histogram(_disposed(s, d), "links"),
    "export_shards": lambda s, d: shard_manifest(sharded(_disposed(s, d), "image_id", "source_manifest_index", 100)),
    "export_training_rows": lambda s, d: training_rows(A.sources(s, d), A.audits(s, d)),
}
ORACLES = {
    "export_disposition": f"{WITH}, {DISPOSED} SELECT * FROM disp",
    "export_views": f"{WITH}, {DISPOSED} SELECT view, disposition, count(*) AS n, CAST(sum(links) AS BIGINT) AS links FROM (" + " UNION ALL ".join(f"SELECT *, '{v}' AS view FROM disp WHERE {c}" for v, c in VIEWS.items()) + ") GROUP BY 1, 2",
    "export_link_histogram": f"{WITH}, {DISPOSED} SELECT links AS value, count(*) AS frequency FROM disp GROUP BY 1",
    "export_shards": f"""{WITH}, k AS (SELECT row_number() OVER (ORDER BY source_manifest_index) - 1 AS i FROM sources)
      SELECT i // 100 AS shard, min(i) AS start, max(i) + 1 AS "end", count(*) AS rows, format('part-{{:05d}}.parquet', i // 100) AS path FROM k GROUP BY i // 100""",
    "export_training_rows": f"""{WITH} SELECT source_dataset AS dataset, source_split AS split, source_pair_key AS image_key, s.image_id, caption,
      '[' || array_to_string(list_transform(u, lambda m: '{{"mask_id":"' || m || '"}}'), ',') || ']' AS groups_json
      FROM sources s JOIN (SELECT *, list_filter(linked, lambda m, i: list_position(linked, m) = i) AS u FROM audits) a USING (image_id)
      WHERE trim(caption) <> '' AND len(linked) > 0 AND parseable AND reason_code <> 'final_rewrite_unparseable'""",
}
