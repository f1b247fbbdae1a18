"""Caption and mask-review records: normal forms, what a review makes of a caption, the bypass, merged shards, region tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import adapters as A
from ..functions.geometry import ratio
from ..functions.text import _sql_clean, cleaned_attributes, cleaned_caption

# Reasons that are written where a model gives none.
REJECTED, EMPTY_CAPTION, BYPASSED = "captioner_rejected_mask", "empty_after_spacy_cleanup", "quality_filter_disabled_for_throughput"
EMPTY_REVIEW, EMPTY_MODE = "spaCy cleanup removed the entire caption", "empty_after_cleanup"
STREAMS = {
    "caption": ("caption_candidates", "captions", "caption_rejected_masks", "caption_raw", "caption_errors"),
    "mask-review": ("captions", "rejected_captions", "mask_quality_reviews", "mask_quality_raw", "mask_review_errors"),
}


def _list(text: Column, key: str) -> Column:
    """A JSON array of texts, or one text as an array; trimmed, without blanks."""
    raw = F.get_json_object(text, f"$.{key}")
    many = F.from_json(raw, "array<string>")
    some = F.when(raw.startswith("["), F.coalesce(many, F.array().cast("array<string>"))).when(raw.isNotNull(), F.array(raw)).otherwise(F.array().cast("array<string>"))
    return F.filter(F.transform(some, lambda v: F.trim(v)), lambda v: v != "")


def _text(text: Column, key: str) -> Column:
    return F.trim(F.coalesce(F.get_json_object(text, f"$.{key}"), F.lit("")))


def _flag(text: Column, key: str) -> Column:
    """Whether a value is there and isn't false, 0, empty or null."""
    v = F.get_json_object(text, f"$.{key}")
    return F.coalesce(~v.isin("false", "0", "0.0", "", "[]", "{}"), F.lit(False))


def caption_record(answer: Column) -> Column:
    """struct(object, caption, attributes, uncertain, reject, reject_reason) of a caption answer; a caption that cleaning empties is rejected."""
    reject = _flag(answer, "reject")
    clean = cleaned_caption(_text(answer, "caption"))
    given = _text(answer, "reject_reason")
    lost = ~clean["valid"] & ~reject
    reason = F.when(lost, EMPTY_CAPTION).when(reject & (given == ""), REJECTED).otherwise(given)
    return F.struct(
        _text(answer, "object").alias("object"), clean["caption"].alias("caption"), cleaned_attributes(_list(answer, "attributes")).alias("attributes"), _flag(answer, "uncertain").alias("uncertain"),
        (reject | lost).alias("reject"), reason.alias("reject_reason"),
    )


def review_record(answer: Column) -> Column:
    """struct(keep, reason, failure_modes, corrected_object, corrected_caption, corrected_attributes) of a mask review."""
    return F.struct(
        _flag(answer, "keep").alias("keep"), _text(answer, "reason").alias("reason"), _list(answer, "failure_modes").alias("failure_modes"), _text(answer, "corrected_object").alias("corrected_object"),
        _text(answer, "corrected_caption").alias("corrected_caption"), _list(answer, "corrected_attributes").alias("corrected_attributes"),
    )


def reviewed(rows: DataFrame, review: str = "review") -> DataFrame:
    """Captions after their review: corrections of kept ones are taken over and cleaned; one that cleaning empties isn't kept.

    rows: object, caption, attributes and `review` (see review_record); what stood before a correction is kept beside it.
    """
    r, old = F.col(review), {c: F.col(c) for c in ("object", "caption", "attributes")}
    new_object = F.when(r["keep"] & (r["corrected_object"] != ""), r["corrected_object"]).otherwise(old["object"])
    said = F.when(r["corrected_caption"] != "", r["corrected_caption"]).otherwise(old["caption"])
    some = F.when(F.size(r["corrected_attributes"]) > 0, r["corrected_attributes"]).otherwise(old["attributes"])
    clean = cleaned_caption(said)
    lost = r["keep"] & ~clean["valid"]
    return rows.select(
        *[c for c in rows.columns if c not in (*old, review)], F.coalesce("original_caption", "caption").alias("original_caption") if "original_caption" in rows.columns else old["caption"].alias("original_caption"),
        new_object.alias("object"), F.when(r["keep"], clean["caption"]).otherwise(old["caption"]).alias("caption"), F.when(r["keep"], cleaned_attributes(some)).otherwise(old["attributes"]).alias("attributes"),
        F.when(r["keep"] & (r["corrected_caption"] != ""), old["caption"]).alias("caption_before_qa_correction"), F.when(r["keep"] & (F.size(r["corrected_attributes"]) > 0), old["attributes"]).alias("attributes_before_qa_correction"),
        (r["keep"] & ~lost).alias("mask_review_keep"), F.when(lost, EMPTY_REVIEW).otherwise(r["reason"]).alias("mask_review_reason"),
        F.when(lost, F.array_append(r["failure_modes"], F.lit(EMPTY_MODE))).otherwise(r["failure_modes"]).alias("mask_review_failure_modes"),
    )


def bypassed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(captions, reviews) where the review is switched off: all are kept and say so."""
    kept = {"mask_review_keep": F.lit(True), "mask_review_reason": F.lit(BYPASSED), "mask_review_failure_modes": F.array().cast("array<string>"), "qa_status": F.lit("skipped")}
    return rows.withColumns(kept), rows.select("image_id", "mask_id", F.lit(True).alias("keep"), F.lit("skipped").alias("qa_status"), F.lit(BYPASSED).alias("reason"))


def overlaps_regions(box: Column, regions: Column, least: float) -> Column:
    """Whether a box (x0, y0, x1, y1) shares `least` of the smaller area with a region (x, y, w, h); a missing box can't be ruled out.

    Corners are rounded half to even; a side is one pixel at least.
    """
    corner = lambda i: F.bround(box[i], 0).cast("int")
    x, y = corner(0), corner(1)
    w, h = F.greatest(F.lit(1), corner(2) - x), F.greatest(F.lit(1), corner(3) - y)

    def shares(r: Column) -> Column:
        side = lambda at, size, a, b: F.greatest(F.lit(0), F.least(at + size, a + b) - F.greatest(at, a))
        smaller = F.least(w * h, F.greatest(F.lit(0), r[2]) * F.greatest(F.lit(0), r[3]))
        return (smaller > 0) & (ratio(side(x, w, r[0], r[2]) * side(y, h, r[1], r[3]), smaller) >= least)

    return F.when(box.isNull() | (F.size(box) != 4), F.lit(True)).otherwise(F.exists(F.coalesce(regions, F.array()), shares))


def merged_shards(spark: SparkSession, folder: str, stage: str, shards: int) -> dict[str, DataFrame]:
    """Each stream of a sharded stage from its shards' JSON lines, sorted by row index (missing: last), image and mask."""
    from ..streaming.logs import _names

    if stage not in STREAMS:
        raise ValueError(f"stage {stage!r} isn't sharded; known: {sorted(STREAMS)}")
    there, out = set(_names(spark, folder)), {}
    for base in STREAMS[stage]:
        parts = [f"{folder}/{n}" for n in (f"{base}.shard{i}.jsonl" for i in range(shards)) if n in there]
        if parts:
            rows = spark.read.json(parts)
            have = lambda c, rows=rows: F.col(c) if c in rows.columns else F.lit(None)
            out[base] = rows.orderBy(F.coalesce(have("_row_index").cast("long"), F.lit(10**12)), F.coalesce(have("image_id").cast("string"), F.lit("")), F.coalesce(have("mask_id").cast("string"), have("reject_id").cast("string"), F.lit("")))
    return out


def _answers(s, d) -> DataFrame:
    """Answers around the whole text of each turn."""
    t = F.regexp_replace("text", "[^A-Za-z ]", "")
    n = (F.col("conv_id") + F.col("turn")) % 4
    said = F.when(n == 0, F.concat(F.lit("a photo of "), t)).when(n == 1, F.concat(t, F.lit(" against a plain background"))).otherwise(F.lit(" "))
    q = lambda c: F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")
    a = F.concat(F.lit('{"object": " dog ", "caption": '), q(said), F.lit(', "attributes": '), F.when(n == 1, '"red"').otherwise('["red ", "", "a scene", "red"]'), F.lit(', "reject": '), F.when(n == 3, "true").otherwise("false"), F.lit(', "uncertain": 0}'))
    r = F.concat(F.lit('{"keep": '), F.when(n == 3, "false").otherwise("true"), F.lit(', "reason": " r ", "failure_modes": "odd", "corrected_caption": '), q(said), F.lit(', "corrected_attributes": ["blue"]}'))
    return A.table(s, d, "conversations").select("conv_id", "turn", a.alias("a"), r.alias("r"))


def _captions(s, d):
    return _answers(s, d).select("conv_id", "turn", caption_record(F.col("a")).alias("c")).select("conv_id", "turn", "c.object", F.length("c.caption").alias("length"), F.array_join("c.attributes", "|").alias("attributes"), "c.uncertain", "c.reject", "c.reject_reason")


def _reviewed(s, d):
    rows = _answers(s, d).select("conv_id", "turn", F.lit("dog").alias("object"), F.lit("Old.").alias("caption"), F.array(F.lit("old")).alias("attributes"), review_record(F.col("r")).alias("review"))
    keep = reviewed(rows)
    return keep.select("conv_id", "turn", "object", F.length("caption").alias("length"), F.array_join("attributes", "|").alias("attributes"), F.coalesce("caption_before_qa_correction", F.lit("")).alias("before"), "mask_review_keep", "mask_review_reason", F.array_join("mask_review_failure_modes", "|").alias("modes"))


def _regions(s, d):
    b = A.boxes(s, d)
    other = b.groupBy("image_id").agg(F.collect_list(F.when(F.col("subject") == "A", F.array("x", "y", "w", "h"))).alias("regions"))
    box = F.when(F.col("raw_index") % 5 != 4, F.array(F.col("x") + 0.5, F.col("y") + 0.25, F.col("x") + F.col("w") + 0.5, F.col("y") + F.col("h") * 1.0))
    return b.filter("subject <> 'A'").join(other, "image_id").select("image_id", "raw_index", overlaps_regions(box, F.col("regions"), 0.2).alias("overlaps"))


QUERIES = {"caption_records": _captions, "caption_reviewed": _reviewed, "box_regions": _regions}
_C = f"""q AS (SELECT conv_id, turn, (conv_id + turn) % 4 AS n, regexp_replace(text, '[^A-Za-z ]', '', 'g') AS t FROM conversations),
  o AS (SELECT *, trim(CASE n WHEN 0 THEN 'a photo of ' || t WHEN 1 THEN t || ' against a plain background' ELSE ' ' END) AS o FROM q), k AS (SELECT *, {_sql_clean("o")} AS k FROM o),
  c AS (SELECT conv_id, turn, n, o, CASE WHEN k = '' THEN '' ELSE upper(left(k, 1)) || substr(k, 2) || CASE WHEN regexp_matches(k, '[.!?]$') THEN '' ELSE '.' END END AS cap FROM k)"""
ORACLES = {
    "caption_records": f"""WITH {_C} SELECT conv_id, turn, 'dog' AS object, CAST(length(cap) AS INT) AS length, 'red' AS attributes, false AS uncertain, n = 3 OR cap = '' AS reject, CASE WHEN n = 3 THEN '{REJECTED}' WHEN cap = '' THEN '{EMPTY_CAPTION}' ELSE '' END AS reject_reason FROM c""",
    "caption_reviewed": f"""WITH {_C} SELECT conv_id, turn, 'dog' AS object, CAST(CASE WHEN n >= 2 THEN 4 ELSE length(cap) END AS INT) AS length, CASE WHEN n = 3 THEN 'old' ELSE 'blue' END AS attributes, CASE WHEN n < 2 THEN 'Old.' ELSE '' END AS before,
      n <> 3 AND (n = 2 OR cap <> '') AS mask_review_keep, CASE WHEN n < 2 AND cap = '' THEN '{EMPTY_REVIEW}' ELSE 'r' END AS mask_review_reason, CASE WHEN n < 2 AND cap = '' THEN 'odd|{EMPTY_MODE}' ELSE 'odd' END AS modes FROM c""",
    "box_regions": f"""WITH {A.BOXES}, a AS (SELECT image_id, raw_index, CASE WHEN raw_index % 5 <> 4 THEN CAST(round_even(x + 0.5, 0) AS INT) END AS x, CAST(round_even(y + 0.25, 0) AS INT) AS y, greatest(1, CAST(round_even(x + w + 0.5, 0) AS INT) - CAST(round_even(x + 0.5, 0) AS INT)) AS w, greatest(1, y + h - CAST(round_even(y + 0.25, 0) AS INT)) AS h FROM boxes WHERE subject <> 'A')
      SELECT a.image_id, a.raw_index, a.x IS NULL OR coalesce(bool_or(b.x IS NOT NULL AND greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) >= 0.2 * least(a.w * a.h, b.w * b.h) AND least(a.w * a.h, b.w * b.h) > 0), false) AS overlaps
      FROM a LEFT JOIN (SELECT * FROM boxes WHERE subject = 'A') b ON b.image_id = a.image_id GROUP BY 1, 2, a.x""",
}
