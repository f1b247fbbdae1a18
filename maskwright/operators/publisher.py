"""The publisher's store: pairs inserted once with dense numbers, audits upserted, milestones of exact size.

A store is a folder of Parquet tables.  A run writes its parts under its own number and then one small commit file; readers
take committed runs only, so a crash leaves nothing that counts, and a run that comes again overwrites its own parts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import adapters as A
from ..shared import shared_dir
from ..sources.sinks import read_json, write_json
from ..streaming.logs import _names, state_table, upsert_latest
from .incremental import completed_prefix, full_milestones, running

PAIRS = "pair_index long, image_id string, source_manifest_index long, unit long, pair_id string"


def committed(spark: SparkSession, store: str) -> list[int]:
    return [int(n.split(".")[0]) for n in _names(spark, f"{store}/commits") if n.endswith(".json")]


def _parts(spark: SparkSession, store: str, what: str, schema: str, before: int | None = None) -> DataFrame:
    runs = [r for r in committed(spark, store) if before is None or r < before]
    folders = [f"{store}/{what}/run={r}" for r in runs if f"run={r}" in _names(spark, f"{store}/{what}")]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def published_pairs(spark: SparkSession, store: str) -> DataFrame:
    return _parts(spark, store, "pairs", PAIRS)


def published_audits(spark: SparkSession, store: str) -> DataFrame | None:
    """The last audit of each image."""
    return state_table(spark, f"{store}/audits")


def publish_run(pairs: DataFrame, audits: DataFrame, units: DataFrame, store: str, run: int, per_milestone: int = 100) -> dict:
    """Publishes the units of the completed prefix that no run has published.

    pairs: image_id, unit, source_manifest_index.  audits: image_id, unit, _ord and more.  units: unit, done.  An image keeps its
    first pair; numbers go on from the largest.  Returns the run's facts, with the milestones that became full.
    """
    spark = pairs.sparkSession
    if run in committed(spark, store):
        return read_json(spark, f"{store}/commits/{run}.json")
    old, seen = _parts(spark, store, "pairs", PAIRS, run), _parts(spark, store, "units", "unit long", run)
    fresh = completed_prefix(units).select(F.col("unit").cast("long")).join(seen, "unit", "left_anti")
    fresh.write.mode("overwrite").parquet(f"{store}/units/run={run}")
    fresh = spark.read.schema("unit long").parquet(f"{store}/units/run={run}")
    base = old.agg(F.coalesce(F.max("pair_index") + 1, F.lit(0)).alias("n")).first()["n"]
    first = pairs.join(fresh, "unit").groupBy("image_id").agg(F.min(F.struct("unit", "source_manifest_index")).alias("r")).select("image_id", "r.*").join(old.select("image_id"), "image_id", "left_anti")
    numbered = running(first.withColumn("_one", F.lit(1)), ["unit", "source_manifest_index", "image_id"], 16, pair_index="_one").withColumn("pair_index", (F.col("pair_index") - 1 + base).cast("long"))
    numbered.select("pair_index", "image_id", F.col("source_manifest_index").cast("long"), F.col("unit").cast("long"), F.format_string("gpic-bcc-%09d", "pair_index").alias("pair_id")).write.mode("overwrite").parquet(f"{store}/pairs/run={run}")
    upsert_latest(audits.join(fresh, "unit"), run, f"{store}/audits", "image_id", "_ord")
    new = spark.read.schema(PAIRS).parquet(f"{store}/pairs/run={run}")
    full = full_milestones(old.unionByName(new).withColumn("milestone", F.expr(f"pair_index div {per_milestone}")), per_milestone).join(old.select(F.expr(f"pair_index div {per_milestone}").alias("milestone")).groupBy("milestone").count().filter(f"count = {per_milestone}"), "milestone", "left_anti")
    facts = {"run": run, "base": base, "pairs": new.count(), "units": fresh.count(), "milestones": sorted(r["milestone"] for r in full.collect())}  # a row for each hundred pairs of the run
    write_json(spark, facts, f"{store}/commits/{run}.json")
    return facts


def milestone_records(pairs: DataFrame, milestone: int, per_milestone: int = 100) -> DataFrame:
    """The pairs of a milestone in order; raises unless there are exactly as many as it holds."""
    rows = pairs.filter(F.col("pair_index").between(milestone * per_milestone, (milestone + 1) * per_milestone - 1))
    if (n := rows.count()) != per_milestone:
        raise ValueError(f"milestone {milestone} has {n} records, not {per_milestone}")
    return rows.orderBy("pair_index")


def repaired_log(pairs: DataFrame, log: DataFrame | None) -> DataFrame:
    """Pairs that an append log lacks: all of them where the log can't be read (the store is what counts)."""
    return pairs if log is None else pairs.join(log.filter("pair_index IS NOT NULL").select("pair_index"), "pair_index", "left_anti")


def repaired_indexes(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows whose source index is that of their image in the unit's manifest, where the manifest knows the image."""
    known = sources.select("image_id", "unit", F.col("source_manifest_index").alias("_true"))
    return rows.join(known, ["image_id", "unit"], "left").withColumn("source_manifest_index", F.coalesce("_true", "source_manifest_index")).drop("_true")


def preview_pages(accepted: DataFrame, rejected: DataFrame, pairs: int) -> DataFrame:
    """What the preview site shows: the first `pairs` accepted images and all rejected ones that can be drawn."""
    first = accepted.orderBy("pair_index").limit(pairs).select("image_id", F.lit("accepted").alias("kind"))
    return first.unionByName(rejected.filter("coalesce(source_image_path, '') <> '' AND coalesce(correspondence_overlay_path, '') <> ''").select("image_id", F.lit("rejected").alias("kind")))


def _inputs(s, d):
    pairs = A.sources(s, d).withColumnRenamed("campaign_unit", "unit").select("image_id", "unit", "source_manifest_index")
    audits = A.audits(s, d).join(pairs.select("image_id", "unit"), "image_id").select("image_id", "unit", "_ord", "issues")
    return pairs, audits, pairs.groupBy("unit").agg((F.count_distinct("image_id") == 8).alias("done"))


def _two_runs(s: SparkSession, d: str) -> str:
    """A store after two runs: the first sees only the first half of the units done."""
    store = f"{shared_dir(s)}/store-{uuid.uuid4().hex}"
    pairs, audits, units = _inputs(s, d)
    half = units.agg(F.expr("max(unit) div 2").alias("h")).first()["h"]
    publish_run(pairs, audits, units.withColumn("done", F.col("done") & (F.col("unit") < half)), store, 0)
    publish_run(pairs, audits, units, store, 1)
    return store


def _q_audits(s, d):
    return published_audits(s, _two_runs(s, d)).select("image_id", "unit", "issues")


QUERIES = {
    "publish_runs": lambda s, d: published_pairs(s, _two_runs(s, d)),
    "publish_audits": _q_audits,
    "publish_log_repair": lambda s, d: repaired_log(A.sources(s, d).select(F.col("source_manifest_index").alias("pair_index"), "image_id"), A.table(s, d, "labels").select(F.col("doc_id").alias("pair_index"))),
}
_READY = f"""WITH {A.SOURCES}, {A.AUDITS}, u AS (SELECT campaign_unit AS unit, count(DISTINCT image_id) = 8 AS done FROM sources GROUP BY 1), g AS (SELECT min(unit) FILTER (NOT done) AS gap FROM u), k AS (SELECT sources.* FROM sources, g WHERE gap IS NULL OR campaign_unit < gap)"""
ORACLES = {
    "publish_runs": f"{_READY}, p AS (SELECT row_number() OVER (ORDER BY campaign_unit, source_manifest_index) - 1 AS pair_index, image_id, source_manifest_index, campaign_unit AS unit FROM k) SELECT *, format('gpic-bcc-{{:09d}}', pair_index) AS pair_id FROM p",
    "publish_audits": f"{_READY} SELECT image_id, campaign_unit AS unit, issues FROM audits JOIN k USING (image_id)",
    "publish_log_repair": "SELECT doc_id AS pair_index, CAST(doc_id AS VARCHAR) AS image_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
}
