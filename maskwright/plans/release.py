"""The rich export: one record a source with its groups and masks, training records, views written as shards, statistics."""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import adapters as A
from ..functions.jsonx import portable_text
from ..functions.masks import _word_mask, encode_rle, rle_to_coco
from ..operators.keyed import counts, last_wins
from ..shared import shared_dir
from .export import histogram

# The version of this export; fixed values: column names of the record, and what each view holds.
VERSION = "rich-export-v1"
VIEWS = {"min_10_masks": "included_min_10", "masks_1_to_9": "bcc_parseable AND final_linked_mask_count BETWEEN 1 AND 9", "parseable_1_plus": "bcc_parseable AND final_linked_mask_count >= 1", "audit_all_processed": "true"}
TRAINING = {"min_10": "final_linked_mask_count >= 10", "1_to_9": "final_linked_mask_count BETWEEN 1 AND 9", "parseable_1_plus": "final_linked_mask_count >= 1"}
COLUMNS = (
    "dataset_export_version", "image_id", "source_manifest_index", "source_dataset", "source_split", "source_pair_key", "image_filename", "image_mime_type", "image_bytes", "image_review_accepted",
    "sam3_proposal_count", "post_consistency_mask_count", "final_linked_mask_count", "bcc_parseable", "included_min_10", "disposition", "caption", "correspondence_groups_json", "accepted_mask_rles_json",
    "post_consistency_mask_rles_json", "bcc_record_json",
)
MIME = {".png": "image/png", ".webp": "image/webp", ".gif": "image/gif", ".bmp": "image/bmp", ".tif": "image/tiff", ".tiff": "image/tiff"}


def usable(caption: str = "caption", groups: str = "groups") -> Column:
    """A caption, groups, no parse failure, and not an unparseable rewrite."""
    return (F.trim(F.coalesce(caption, F.lit(""))) != "") & (F.size(F.coalesce(groups, F.array())) > 0) & F.coalesce("parseable", F.lit(True)) & (F.coalesce("reason_code", F.lit("")) != "final_rewrite_unparseable")


def group_ids(group: Column) -> Column:
    """The instances of a group, or its mask."""
    some = F.filter(F.coalesce(group["instance_ids"], F.array()), lambda i: F.coalesce(i, F.lit("")) != "")
    return F.when(F.size(some) > 0, some).otherwise(F.filter(F.array(group["mask_id"]), lambda i: F.coalesce(i, F.lit("")) != ""))


def _rle_maps(pairs: DataFrame, rles: DataFrame, into: str) -> DataFrame:
    """image_id and the codes of its masks by id, as sorted structs; masks without code are left out."""
    both = pairs.filter("mask_id IS NOT NULL").distinct().join(last_wins(rles, "mask_id", "rle"), "mask_id")
    return both.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("mask_id", "rle"))).alias(into))  # masks of one image


def structured(sources: DataFrame, reviews: DataFrame, proposals: DataFrame, consistent: DataFrame, rles: DataFrame, audits: DataFrame, exclusions: DataFrame, terminal: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """The record of each source with its groups and codes still as arrays.  Sides are keyed and aggregated before the star join.

    audits: image_id, caption, groups (mask_id, instance_ids, char_spans), parseable, reason_code, exclusion_reason, record (JSON).
    rles: mask_id, rle (JSON).  images: image_id, bytes; kept only for usable records with a link.
    """
    a = last_wins(audits, "image_id").select("image_id", "caption", "groups", usable().alias("ok"), F.coalesce(F.nullif("reason_code", F.lit("")), F.nullif("exclusion_reason", F.lit(""))).alias("audit_reason"), F.col("record").alias("audit_record"))
    x = last_wins(exclusions, "image_id").select("image_id", F.col("reason_code").alias("excluded_reason"), F.col("record").alias("excluded_record"))
    linked = a.filter("ok").select("image_id", F.explode(F.array_distinct(F.flatten(F.transform("groups", group_ids)))).alias("mask_id"))
    sides = (
        last_wins(reviews, "image_id").select("image_id", F.col("accepted").alias("image_review_accepted")), counts(proposals, "image_id", "sam3_proposal_count"), counts(consistent, "image_id", "post_consistency_mask_count"),
        a, x, counts(linked, "image_id", "n_links"), _rle_maps(linked, rles, "codes"), _rle_maps(consistent.select("image_id", "mask_id"), rles, "all_codes"),
    )
    out = sources
    for side in sides:
        out = out.join(side, "image_id", "left")
    out = out.join(terminal.select("campaign_unit").distinct().withColumn("_done", F.lit(True)), "campaign_unit", "left")
    ok, n = F.coalesce("ok", F.lit(False)), F.coalesce("n_links", F.lit(0))
    reason = F.coalesce("audit_reason", F.nullif("excluded_reason", F.lit("")), F.when(F.col("_done").isNull(), "pipeline_incomplete"), F.lit("did_not_reach_bcc"))
    out = out.withColumns({
        "bcc_parseable": ok, "final_linked_mask_count": F.when(ok, n).otherwise(F.lit(0)).cast("long"), "included_min_10": ok & (n >= 10),
        "disposition": F.when(ok & (n >= 10), "parseable_min_10").when(ok, "parseable_1_to_9").otherwise(reason), "caption": F.when(ok, F.col("caption")).otherwise(""),
        "groups": F.when(ok, F.col("groups")), "codes": F.when(ok, F.col("codes")),
        "sam3_proposal_count": F.coalesce("sam3_proposal_count", F.lit(0)), "post_consistency_mask_count": F.coalesce("post_consistency_mask_count", F.lit(0)),
    })
    wanted = F.col("bcc_parseable") & (F.col("final_linked_mask_count") >= 1)
    if images is None:
        return out.withColumn("image_bytes", F.lit(None).cast("binary"))
    return out.join(images.select("image_id", F.col("bytes").alias("_bytes")), "image_id", "left").withColumn("image_bytes", F.when(wanted, F.col("_bytes"))).drop("_bytes")


def _quoted(text: Column) -> Column:
    """A text as a JSON string."""
    return F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]$", "")


def records(rows: DataFrame) -> DataFrame:
    """The 21 columns of the record (JSON with sorted keys, absolute paths as base names)."""
    group = lambda g: F.struct(g["char_spans"].alias("char_spans"), g["instance_ids"].alias("instance_ids"), g["mask_id"].alias("mask_id"))
    name = F.regexp_extract(F.coalesce("source_member", F.lit("")), r"([^/]*)$", 1)
    mime, suffix = F, F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    for end, kind in MIME.items():
        mime = mime.when(suffix == end, kind)
    codes = lambda c: F.concat(F.lit("{"), F.array_join(F.transform(F.coalesce(c, F.array()), lambda m: F.concat(_quoted(m["mask_id"]), F.lit(":"), m["rle"])), ","), F.lit("}"))
    out = rows.withColumns({
        "dataset_export_version": F.lit(VERSION), "image_filename": name, "image_mime_type": mime.otherwise("image/jpeg"),
        "correspondence_groups_json": F.coalesce(F.to_json(F.transform("groups", group)), F.lit("[]")), "accepted_mask_rles_json": codes(F.col("codes")),
        "post_consistency_mask_rles_json": codes(F.col("all_codes")), "bcc_record_json": portable_text(F.coalesce("audit_record", "excluded_record", F.lit("{}"))),
    })
    return out.select(*COLUMNS)


@F.pandas_udf(StringType())
def coco_json(rles: pd.Series) -> pd.Series:
    """The public code of each internal one, as JSON."""
    return rles.map(lambda r: None if r is None else json.dumps(rle_to_coco(json.loads(r)), separators=(",", ":")))


def training(rows: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Caption records: groups with spans and ids, their texts cut from the caption, public mask codes.

    Raises on a span outside the caption, on a linked mask without code, and on a record without groups.
    """
    keep = F.filter("groups", lambda g: (F.size(F.coalesce(g["char_spans"], F.array())) > 0) & (F.size(group_ids(g)) > 0))
    r = rows.filter("bcc_parseable AND final_linked_mask_count >= 1").withColumn("_g", keep)
    spans = F.flatten(F.transform("_g", lambda g: g["char_spans"]))
    bad = F.exists(spans, lambda s: (s[0] < 0) | (s[1] <= s[0]) | (s[1] > F.length("caption")))
    ids = F.array_distinct(F.flatten(F.transform("_g", group_ids)))
    lost = F.array_except(ids, F.transform(F.coalesce("codes", F.array()), lambda m: m["mask_id"]))
    fail = lambda text, c: F.raise_error(F.concat(F.lit(text), c.cast("string")))
    checked = F.when(F.size("_g") == 0, fail("no linked groups: ", F.col("image_id"))).when(bad, fail("span outside the caption: ", F.col("image_id"))).when(F.size(lost) > 0, fail("linked mask without code: ", F.array_join(lost, ",")))
    text = lambda s: F.substring(F.col("caption"), s[0] + 1, s[1] - s[0])
    groups = F.to_json(F.transform("_g", lambda g: F.struct(g["char_spans"].alias("char_spans"), F.transform(g["char_spans"], text).alias("text"), group_ids(g).alias("instance_ids"))))
    r = r.withColumn("groups_json", F.coalesce(checked.cast("string"), groups)).withColumn("_ids", ids)
    codes = r.select("image_id", F.explode(F.filter("codes", lambda m: F.array_contains("_ids", m["mask_id"]))).alias("m")).select("image_id", "m.mask_id", coco_json("m.rle").alias("code"))
    by = codes.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("mask_id", "code"))).alias("ms"))
    key = lambda m: F.concat(_quoted(m["mask_id"]), F.lit(":"), m["code"])
    name, dataset = F.coalesce(F.nullif("source_dataset", F.lit("")), F.lit("gpic")), F
    for old, new in (aliases or {}).items():
        dataset = dataset.when(name == old, new)
    dataset = name if aliases is None or not aliases else dataset.otherwise(name)
    size = lambda i: F.get_json_object(F.col("ms")[0]["code"], f"$.size[{i}]").cast("int")
    return r.join(by, "image_id").select(
        dataset.alias("dataset"), F.coalesce(F.nullif("source_split", F.lit("")), F.lit("train")).alias("split"),
        F.coalesce(F.nullif("source_pair_key", F.lit("")), F.nullif(F.regexp_extract(F.coalesce("source_member", F.lit("")), r"([^/]*)$", 1), F.lit("")), "image_id").alias("image_key"),
        "image_id", size(0).alias("height"), size(1).alias("width"), "caption", "groups_json", F.concat(F.lit("{"), F.array_join(F.transform("ms", key), ","), F.lit("}")).alias("masks_json"), "source_manifest_index", "final_linked_mask_count",
    )


def statistics(rows: DataFrame) -> dict[str, DataFrame]:
    """Histograms of the export by name."""
    ok = rows.filter(VIEWS["parseable_1_plus"])
    return {
        "all_sam3_proposal_counts": histogram(rows, "sam3_proposal_count"), "all_post_consistency_mask_counts": histogram(rows, "post_consistency_mask_count"),
        "parseable_1_plus_final_linked_masks": histogram(ok, "final_linked_mask_count"), "min_10_final_linked_masks": histogram(ok.filter("included_min_10"), "final_linked_mask_count"),
        "masks_1_to_9_final_linked_masks": histogram(ok.filter("final_linked_mask_count < 10"), "final_linked_mask_count"),
    }


def write_release(rows: DataFrame, path: str, shard_rows: int = 100, prefix: str = "gpic") -> dict:
    """Writes the four rich and three training views as shards below data/ and train/, and statistics with the shards' manifests.

    Shards whose content is unchanged stay as they are, so an interrupted export goes on where it stopped.
    """
    from ..shared import written
    from ..sources.sinks import write_json, write_parquet_shards

    spark = rows.sparkSession
    rows = written(rows, "release")
    rich, train = records(rows), training(rows)
    shards = {f"data/{v}": write_parquet_shards(rich.filter(c), f"{path}/data/{v}", "image_id", "source_manifest_index", shard_rows) for v, c in VIEWS.items()}
    shards |= {f"train/{prefix}_{v}": write_parquet_shards(train.filter(c), f"{path}/train/{prefix}_{v}", "image_id", "source_manifest_index", shard_rows) for v, c in TRAINING.items()}
    facts = {"dataset_export_version": VERSION, "histograms": {k: {str(r["value"]): r["frequency"] for r in h.collect()} for k, h in statistics(rows).items()}}  # a row a count
    facts["shards"] = {k: [r.asDict() for r in m.orderBy("shard").collect()] for k, m in shards.items()}  # a row a shard
    write_json(spark, facts, f"{path}/stats/summary.json")
    return facts


@F.pandas_udf(StringType())
def _rle_of_word(bits: pd.Series) -> pd.Series:
    return bits.map(lambda b: json.dumps(encode_rle(_word_mask(b)), sort_keys=True))


def _tables(s, d) -> DataFrame:
    """Sources are documents; their masks are vectors; captions are 14 numbered words before the whole text of the document."""
    docs = A.table(s, d, "documents").select(F.col("doc_id").cast("string").alias("image_id"), F.col("text").alias("_text"))
    sources = A.sources(s, d).withColumn("source_member", F.concat(F.lit("source_images/"), "image_id", F.when(F.col("n_chars") % 2 == 0, ".png").otherwise(".jpg")))
    mask = lambda i: F.concat(F.lit("v"), ((F.col("source_manifest_index") + i * 37) % 500).cast("string"))
    group = lambda i: F.struct(mask(i).alias("mask_id"), F.when(i % 3 == 0, F.array(mask(i), mask(i + 1))).alias("instance_ids"), F.array(F.array(i * 4, i * 4 + 3)).alias("char_spans"))
    audits = A.audits(s, d).join(A.sources(s, d).select("image_id", "source_manifest_index", "n_chars"), "image_id").join(docs, "image_id").select(
        "image_id", "_ord", "parseable", "reason_code", F.when(F.col("issues") == 3, "too_many_issues").alias("exclusion_reason"), F.transform(F.sequence(F.lit(0), (F.col("n_chars") % 14).cast("int")), group).alias("groups"),
        F.when(F.col("caption") == "", "").otherwise(F.concat(F.expr("array_join(transform(sequence(0, 13), i -> concat('w', lpad(cast(i AS string), 2, '0'))), ' ')"), F.lit(" "), "_text")).alias("caption"),
        F.to_json(F.struct(F.concat(F.lit("/abs/"), "image_id", F.lit(".png")).alias("path"), F.col("issues").alias("issues"))).alias("record"),
    )
    exclusions = A.exclusions(s, d).withColumn("record", F.to_json(F.struct("reason_code")))
    vectors = A.masks(s, d)
    rles = vectors.select(F.concat(F.lit("v"), F.col("mask_id").cast("string")).alias("mask_id"), _rle_of_word("bits").alias("rle"))
    consistent = vectors.select((F.col("mask_id") % 97).cast("string").alias("image_id"), F.concat(F.lit("v"), F.col("mask_id").cast("string")).alias("mask_id"))
    proposals = A.table(s, d, "conversations").select(F.col("conv_id").cast("string").alias("image_id"))
    return structured(sources, A.reviews(s, d), proposals, consistent, rles, audits, exclusions, sources.filter("campaign_unit % 3 <> 0"))


def _records(s, d):
    r = records(_tables(s, d))
    keys = lambda c: F.array_join(F.array_sort(F.json_object_keys(c)), ",")
    return r.withColumns({"accepted_mask_rles_json": keys("accepted_mask_rles_json"), "post_consistency_mask_rles_json": keys("post_consistency_mask_rles_json"), "image_bytes": F.coalesce(F.length("image_bytes"), F.lit(-1))})


def _written(s: SparkSession, d: str) -> DataFrame:
    """The views read back from a release that was written."""
    path = f"{shared_dir(s)}/release-{uuid.uuid4().hex}"
    write_release(_tables(s, d), path)
    names = [f"data/{v}" for v in VIEWS] + [f"train/gpic_{v}" for v in TRAINING]
    out = None
    for n in names:
        one = s.read.parquet(f"{path}/{n}").agg(F.lit(n).alias("view"), F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("final_linked_mask_count"), F.lit(0)).alias("links"), F.max("row_index").alias("last"))
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = {
    "export_records": _records,
    "export_caption_records": lambda s, d: training(_tables(s, d)).drop("source_manifest_index", "final_linked_mask_count"),
    "export_written": _written,
}
_BASE = f"""{A.SOURCES}, {A.REVIEWS}, {A.AUDITS}, {A.EXCLUSIONS}, d AS (SELECT CAST(doc_id AS VARCHAR) AS image_id, text FROM documents),
  g AS (SELECT image_id, i, ['v' || ((source_manifest_index + i * 37) % 500)] AS one, CASE WHEN i % 3 = 0 THEN ['v' || ((source_manifest_index + i * 37) % 500), 'v' || ((source_manifest_index + (i + 1) * 37) % 500)] END AS ids
    FROM (SELECT image_id, source_manifest_index, unnest(range(0, n_chars % 14 + 1)) AS i FROM sources)),
  l AS (SELECT image_id, count(DISTINCT m) AS n_links, list(DISTINCT m) AS ms FROM (SELECT image_id, unnest(coalesce(ids, one)) AS m FROM g) GROUP BY 1),
  j AS (SELECT image_id, '[' || string_agg('{{"char_spans":[[' || i * 4 || ',' || (i * 4 + 3) || ']],' || CASE WHEN ids IS NULL THEN '' ELSE '"instance_ids":["' || ids[1] || '","' || ids[2] || '"],' END || '"mask_id":"' || one[1] || '"}}', ',' ORDER BY i) || ']' AS rich,
    '[' || string_agg('{{"char_spans":[[' || i * 4 || ',' || (i * 4 + 3) || ']],"text":["w' || lpad(CAST(i AS VARCHAR), 2, '0') || '"],"instance_ids":["' || array_to_string(coalesce(ids, one), '","') || '"]}}', ',' ORDER BY i) || ']' AS plain FROM g GROUP BY 1),
  r AS (SELECT s.*, v.accepted, coalesce(a.parseable AND a.caption <> '' AND a.reason_code <> 'final_rewrite_unparseable', false) AS ok, n_links, ms, rich, plain, a.issues,
    coalesce(nullif(a.reason_code, ''), CASE WHEN a.issues = 3 THEN 'too_many_issues' END, x.reason_code, CASE WHEN s.campaign_unit % 3 = 0 THEN 'pipeline_incomplete' END, 'did_not_reach_bcc') AS why, x.reason_code AS gone,
    'w00 w01 w02 w03 w04 w05 w06 w07 w08 w09 w10 w11 w12 w13 ' || d.text AS said
    FROM sources s JOIN d USING (image_id) JOIN l USING (image_id) JOIN j USING (image_id) LEFT JOIN reviews v USING (image_id) LEFT JOIN audits a USING (image_id) LEFT JOIN exclusions x USING (image_id))"""
_COCO = """mk AS (SELECT vec_id AS mask_id, list_transform(embedding, lambda e: CASE WHEN e > 0 THEN 1 ELSE 0 END) AS px FROM embeddings),
  px AS (SELECT mask_id, px[i] AS v, i, coalesce(px[i - 1], 0) AS b FROM (SELECT mask_id, px, unnest(range(1, 65)) AS i FROM mk)),
  ed AS (SELECT mask_id, i - 1 AS z FROM px WHERE v <> b UNION ALL SELECT mask_id, 64 FROM mk), ru AS (SELECT mask_id, z - coalesce(lag(z) OVER w, 0) AS n, row_number() OVER w AS k FROM ed WINDOW w AS (PARTITION BY mask_id ORDER BY z)),
  di AS (SELECT mask_id, k, n - CASE WHEN k > 3 THEN lag(n, 2) OVER (PARTITION BY mask_id ORDER BY k) ELSE 0 END AS x FROM ru),
  co AS (SELECT 'v' || mask_id AS m, '{"size":[8,8],"counts":"' || replace(string_agg(CASE WHEN x BETWEEN -16 AND 15 THEN chr(48 + CAST(x & 31 AS INT)) ELSE chr(80 + CAST(x & 31 AS INT)) || chr(48 + CAST((x >> 5) & 31 AS INT)) END, '' ORDER BY k), chr(92), chr(92) || chr(92)) || '"}' AS code FROM di GROUP BY mask_id)"""
ORACLES = {
    "export_records": f"""WITH {_BASE}, p AS (SELECT CAST(conv_id AS VARCHAR) AS image_id, count(*) AS n FROM conversations GROUP BY 1), c AS (SELECT CAST(vec_id % 97 AS VARCHAR) AS image_id, count(*) AS n, array_to_string(list_sort(list('v' || vec_id)), ',') AS keys FROM embeddings GROUP BY 1)
      SELECT '{VERSION}' AS dataset_export_version, r.image_id, source_manifest_index, source_dataset, source_split, source_pair_key, image_id || CASE WHEN n_chars % 2 = 0 THEN '.png' ELSE '.jpg' END AS image_filename,
        CASE WHEN n_chars % 2 = 0 THEN 'image/png' ELSE 'image/jpeg' END AS image_mime_type, -1 AS image_bytes, accepted AS image_review_accepted, coalesce(p.n, 0) AS sam3_proposal_count, coalesce(c.n, 0) AS post_consistency_mask_count,
        CASE WHEN ok THEN n_links ELSE 0 END AS final_linked_mask_count, ok AS bcc_parseable, ok AND n_links >= 10 AS included_min_10, CASE WHEN ok AND n_links >= 10 THEN 'parseable_min_10' WHEN ok THEN 'parseable_1_to_9' ELSE why END AS disposition,
        CASE WHEN ok THEN said ELSE '' END AS caption, CASE WHEN ok THEN rich ELSE '[]' END AS correspondence_groups_json, CASE WHEN ok THEN array_to_string(list_sort(ms), ',') ELSE '' END AS accepted_mask_rles_json, coalesce(c.keys, '') AS post_consistency_mask_rles_json,
        CASE WHEN issues IS NOT NULL THEN '{{"issues": ' || issues || ', "path": "' || image_id || '.png"}}' WHEN gone IS NOT NULL THEN '{{"reason_code": "' || gone || '"}}' ELSE '{{}}' END AS bcc_record_json
      FROM r LEFT JOIN p USING (image_id) LEFT JOIN c USING (image_id)""",
    "export_caption_records": f"""WITH {_BASE}, {_COCO}, q AS (SELECT image_id, m FROM (SELECT image_id, unnest(ms) AS m FROM r WHERE ok)), w AS (SELECT image_id, '{{' || string_agg('"' || m || '":' || code, ',' ORDER BY m) || '}}' AS masks_json FROM q JOIN co USING (m) GROUP BY 1)
      SELECT source_dataset AS dataset, source_split AS split, source_pair_key AS image_key, image_id, 8 AS height, 8 AS width, said AS caption, plain AS groups_json, masks_json FROM r JOIN w USING (image_id) WHERE ok""",
    "export_written": f"""WITH {_BASE}, f AS (SELECT image_id, CASE WHEN ok THEN n_links ELSE 0 END AS n FROM r), v(view, lo, hi) AS (VALUES ('data/min_10_masks', 10, 99), ('data/masks_1_to_9', 1, 9), ('data/parseable_1_plus', 1, 99), ('data/audit_all_processed', 0, 99), ('train/gpic_min_10', 10, 99), ('train/gpic_1_to_9', 1, 9), ('train/gpic_parseable_1_plus', 1, 99))
      SELECT view, count(*) AS rows, CAST(sum(n) AS BIGINT) AS links, count(*) - 1 AS last FROM v JOIN f ON n BETWEEN lo AND hi GROUP BY 1""",
}
