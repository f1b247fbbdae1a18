"""The run ledger: a star join of the manifest with last-wins reviews, pre-aggregated counts, audits and exclusions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import adapters as A
from ..operators.keyed import counts, last_wins

#: Order of the stage markers (fixed values).
STAGES = ("materialized", "image-review", "sam3", "mask-captions", "mask-qa", "consistency", "bcc-draft", "bcc-audit", "bcc-rewrite")


def reason(accepted: str = "accepted"):
    """Reject reason, else rationale."""
    return F.coalesce(F.nullif(F.col("reject_reason"), F.lit("")), F.col("rationale"), F.lit(""))


def ledger_parseable():
    """A caption, at least one link and a parse flag that isn't false."""
    return (F.trim(F.coalesce("caption", F.lit(""))) != "") & (F.size(F.coalesce("linked", F.array())) > 0) & F.coalesce("parseable", F.lit(True))


def export_parseable():
    """As ledger_parseable, and the reason isn't final_rewrite_unparseable."""
    return ledger_parseable() & (F.coalesce("reason_code", F.lit("")) != "final_rewrite_unparseable")


def last_stage(markers: DataFrame) -> DataFrame:
    """The last stage in STAGES order that each image has a marker of."""
    rank = F.array_position(F.array(*map(F.lit, STAGES)), F.col("stage"))
    return markers.filter(rank > 0).groupBy("image_id").agg(F.max_by("stage", rank).alias("last_completed_stage"))


def run_ledger(sources: DataFrame, reviews: DataFrame, audits: DataFrame, exclusions: DataFrame, masks: DataFrame, captions: DataFrame, markers: DataFrame) -> DataFrame:
    """One row per source.  Small keyed sides are pre-aggregated; whether they are broadcast is left to adaptive execution."""
    r = last_wins(reviews, "image_id").select("image_id", "accepted", reason().alias("image_review_reason"))
    a = last_wins(audits, "image_id").select(
        "image_id", ledger_parseable().alias("bcc_parseable"), F.size(F.array_distinct("linked")).cast("long").alias("links"), F.col("reason_code").alias("audit_reason"), F.col("issues").cast("long").alias("issues"), F.lit(1).alias("has_audit")
    )
    x = last_wins(exclusions, "image_id").select("image_id", F.col("reason_code").alias("excluded_reason"))
    out = sources
    for side in (r, a, x, counts(masks, "image_id", "n_masks"), counts(captions, "image_id", "n_captions"), last_stage(markers)):
        out = out.join(side, "image_id", "left")
    status = F.when(F.col("bcc_parseable"), "parseable").when(F.col("has_audit").isNotNull(), "unparseable").when(F.col("excluded_reason").isNotNull(), "excluded").otherwise("not_reached")
    return out.select(
        "source_manifest_index", "campaign_unit", "image_id", "source_dataset", "source_split", "source_pair_key",
        F.when(F.col("accepted"), "accepted").when(~F.col("accepted"), "rejected").otherwise("not_run").alias("image_review_status"), F.coalesce("image_review_reason", F.lit("")).alias("image_review_reason"),
        F.coalesce("n_masks", F.lit(0)).alias("sam3_proposal_count"), F.coalesce("n_captions", F.lit(0)).alias("mask_caption_count"), status.alias("bcc_status"), F.coalesce("bcc_parseable", F.lit(False)).alias("bcc_parseable"),
        F.when(F.col("bcc_parseable"), F.col("links")).otherwise(F.lit(0)).cast("long").alias("final_linked_mask_count"),
        F.coalesce(F.nullif("audit_reason", F.lit("")), "excluded_reason", F.lit("")).alias("bcc_reason"), F.coalesce("issues", F.lit(0)).cast("long").alias("audit_issue_count"), F.coalesce("last_completed_stage", F.lit(STAGES[0])).alias("last_completed_stage"),
    )


def _inputs(spark: SparkSession, sf: str):
    talk = A.table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("image_id"), "role", "turn")
    markers = talk.select("image_id", F.element_at(F.array(*map(F.lit, STAGES)), (F.col("turn") + 1).cast("int")).alias("stage"))
    return A.sources(spark, sf), A.reviews(spark, sf), A.audits(spark, sf), A.exclusions(spark, sf), talk.filter("role = 'user'"), talk.filter("role = 'assistant'"), markers


def q_ledger(spark, sf):
    return run_ledger(*_inputs(spark, sf))


LEDGER = f"""led AS (SELECT s.source_manifest_index, s.campaign_unit, s.image_id, s.source_dataset, s.source_split, s.source_pair_key,
  CASE WHEN r.accepted THEN 'accepted' WHEN NOT r.accepted THEN 'rejected' ELSE 'not_run' END AS image_review_status,
  coalesce(nullif(r.reject_reason, ''), r.rationale, '') AS image_review_reason,
  coalesce(m.n, 0) AS sam3_proposal_count, coalesce(c.n, 0) AS mask_caption_count,
  CASE WHEN a.ok THEN 'parseable' WHEN a.image_id IS NOT NULL THEN 'unparseable' WHEN x.image_id IS NOT NULL THEN 'excluded' ELSE 'not_reached' END AS bcc_status,
  coalesce(a.ok, false) AS bcc_parseable, CASE WHEN a.ok THEN len(list_distinct(a.linked)) ELSE 0 END AS final_linked_mask_count,
  coalesce(nullif(a.reason_code, ''), x.reason_code, '') AS bcc_reason, CAST(coalesce(a.issues, 0) AS BIGINT) AS audit_issue_count,
  coalesce(k.stage, 'materialized') AS last_completed_stage
  FROM sources s LEFT JOIN reviews r USING (image_id)
  LEFT JOIN (SELECT *, trim(caption) <> '' AND len(linked) > 0 AND parseable AS ok FROM audits) a USING (image_id) LEFT JOIN exclusions x USING (image_id)
  LEFT JOIN (SELECT CAST(conv_id AS VARCHAR) AS image_id, count(*) AS n FROM conversations WHERE role = 'user' GROUP BY 1) m USING (image_id)
  LEFT JOIN (SELECT CAST(conv_id AS VARCHAR) AS image_id, count(*) AS n FROM conversations WHERE role = 'assistant' GROUP BY 1) c USING (image_id)
  LEFT JOIN (SELECT CAST(conv_id AS VARCHAR) AS image_id, list_value({', '.join(f"'{s}'" for s in STAGES)})[max(turn) + 1] AS stage FROM conversations WHERE turn < {len(STAGES)} GROUP BY 1) k USING (image_id))"""
WITH = f"WITH {A.SOURCES}, {A.REVIEWS}, {A.AUDITS}, {A.EXCLUSIONS}"


def ledger_summary(ledger: DataFrame) -> DataFrame:
    """Value counts of the status columns and two conditional counts, long."""
    parts = [ledger.groupBy(F.lit(c).alias("field"), F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n")) for c in ("image_review_status", "bcc_status", "last_completed_stage")]
    totals = ledger.agg(F.count_if("bcc_parseable").alias("parseable"), F.count_if(F.col("final_linked_mask_count") >= 10).alias("minimum_10"))
    parts.append(totals.select(F.explode(F.create_map(F.lit("parseable"), "parseable", F.lit("minimum_10"), "minimum_10")).alias("value", "n")).select(F.lit("total").alias("field"), "value", "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def finalize(sources: DataFrame, reviews: DataFrame, audits: DataFrame) -> DataFrame:
    """Final category of each selected image."""
    r, a = last_wins(reviews, "image_id").select("image_id", "accepted"), last_wins(audits, "image_id").select("image_id", export_parseable().alias("ok"))
    out = sources.join(r, "image_id", "left").join(a, "image_id", "left")
    category = F.when(F.col("accepted").isNull(), "not_reviewed").when(~F.col("accepted"), "rejected_review").when(F.col("ok").isNull(), "no_caption").when(F.col("ok"), "accepted").otherwise("rejected_caption")
    return out.groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "ledger": q_ledger,
    "ledger_summary": lambda s, d: ledger_summary(q_ledger(s, d)),
    "finalize_categories": lambda s, d: finalize(A.sources(s, d), A.reviews(s, d), A.audits(s, d)),
    "last_stage": lambda s, d: last_stage(_inputs(s, d)[6]),
}
ORACLES = {
    "ledger": f"{WITH}, {LEDGER} SELECT * FROM led",
    "ledger_summary": f"""{WITH}, {LEDGER} SELECT 'image_review_status' AS field, image_review_status AS value, count(*) AS n FROM led GROUP BY 2
      UNION ALL SELECT 'bcc_status', bcc_status, count(*) FROM led GROUP BY 2 UNION ALL SELECT 'last_completed_stage', last_completed_stage, count(*) FROM led GROUP BY 2
      UNION ALL SELECT 'total', 'parseable', count(*) FILTER (bcc_parseable) FROM led UNION ALL SELECT 'total', 'minimum_10', count(*) FILTER (final_linked_mask_count >= 10) FROM led""",
    "finalize_categories": f"""{WITH} SELECT CASE WHEN r.accepted IS NULL THEN 'not_reviewed' WHEN NOT r.accepted THEN 'rejected_review' WHEN a.image_id IS NULL THEN 'no_caption'
      WHEN trim(a.caption) <> '' AND len(a.linked) > 0 AND a.parseable AND a.reason_code <> 'final_rewrite_unparseable' THEN 'accepted' ELSE 'rejected_caption' END AS category, count(*) AS n
      FROM sources s LEFT JOIN reviews r USING (image_id) LEFT JOIN audits a USING (image_id) GROUP BY 1""",
    "last_stage": f"""SELECT CAST(conv_id AS VARCHAR) AS image_id, list_value({', '.join(f"'{s}'" for s in STAGES)})[max(turn) + 1] AS last_completed_stage FROM conversations GROUP BY 1""",
}
