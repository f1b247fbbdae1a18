"""Selection, routing and small row operators over manifests and stage streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import adapters as A
from .keyed import counts, remaining, set_mismatch


def source_key() -> Column:
    """pair key of the context, of the row, else the image id."""
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    return F.coalesce(some("context_pair_key"), some("pair_key"), F.col("image_id"))


def current_only(rows: DataFrame, **versions: str) -> DataFrame:
    """Rows of the current prompt, schema and stage versions."""
    for column, version in versions.items():
        rows = rows.filter(F.col(column) == version)
    return rows


def terminal(eligible: DataFrame, audits: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Eligible images (ten masks or more) that are neither audited nor excluded."""
    enough = counts(eligible, "image_id").filter("n >= 10").select("image_id")
    return remaining(enough, [audits.select("image_id"), exclusions.select("image_id")], "image_id")


def quoted_minimum(configured: Column) -> Column:
    return F.greatest(F.lit(10), configured)


def preview_index(image_id: Column, offset: int = 1 << 50) -> Column:
    """First 12 hex digits of the id's SHA-256 as a number, in a name space of its own."""
    return F.conv(F.substring(F.sha2(image_id, 256), 1, 12), 16, 10).cast("long") + F.lit(offset)


def mask_score(*columns: Column) -> Column:
    return F.coalesce(*[c.try_cast("double") for c in columns], F.lit(0.0))


def add_count(target: int | None, current: int, add: int | None) -> int:
    """Images to add: the number itself, or what is missing to the target."""
    if add is not None:
        return add
    if target is None:
        raise ValueError("give a target or a number of images")
    return max(0, target - current)


def enriched(groups: DataFrame, masks: DataFrame, columns: list[str]) -> DataFrame:
    """Groups with the attributes of their masks, in the group's order."""
    one = groups.select("image_id", F.posexplode("linked").alias("pos", "mask_id"))
    both = one.join(masks.select("mask_id", *columns), "mask_id", "left")
    return both.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("pos", "mask_id", *columns))).alias("groups"))


def omitted(masks: DataFrame, links: DataFrame) -> DataFrame:
    return masks.join(links, ["image_id", "mask_id"], "left_anti")


def versions_merged(after: DataFrame, before: DataFrame, key: list[str]) -> DataFrame:
    """First wins over (after, before)."""
    both = after.withColumn("_v", F.lit(0)).unionByName(before.withColumn("_v", F.lit(1)))
    return both.withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy("_v"))).filter("_k = 1").drop("_k").withColumn("version", F.when(F.col("_v") == 0, "after").otherwise("before")).drop("_v")


def funnel(sources: DataFrame, reviews: DataFrame, audits: DataFrame) -> DataFrame:
    """Stage counts and the acceptance rate."""
    n = lambda df, stage: df.agg(F.lit(stage).alias("stage"), F.count(F.lit(1)).cast("double").alias("value"))
    rate = reviews.agg(F.lit("acceptance_rate").alias("stage"), F.coalesce(F.avg(F.col("accepted").cast("double")), F.lit(0.0)).alias("value"))
    return n(sources, "sources").unionByName(n(reviews, "reviews")).unionByName(n(reviews.filter("accepted"), "accepted")).unionByName(n(audits, "audits")).unionByName(rate)


def summary(streams: dict[str, DataFrame]) -> DataFrame:
    """Rows of each stream."""
    parts = [df.agg(F.lit(k).alias("stream"), F.count(F.lit(1)).alias("rows")) for k, df in streams.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def checked_rows(rows: DataFrame, required: list[str]) -> DataFrame:
    """Errors of each caption row: missing keys."""
    return rows.withColumn("errors", F.filter(F.array(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit(f"missing {c}")) for c in required]), lambda e: e.isNotNull()))


# What a caption row must hold, and which of its columns are paths.
REQUIRED = ("area", "attributes", "bbox", "caption", "crop_overlay_path", "full_overlay_path", "image_id", "mask_id", "mask_path", "model", "object", "sam3_score", "source_image_path", "uncertain")
PATHS = ("source_image_path", "mask_path", "full_overlay_path", "crop_overlay_path", "crop_image_path", "inverse_crop_path")


def validated_rows(rows: DataFrame, files: DataFrame | None = None, order: str = "_ord") -> DataFrame:
    """(order, error) of caption rows: missing keys (then nothing else is looked at), boxes that aren't four numbers, and, with
    `files` (path), paths that aren't there.  A key is missing where the column is or the value is null.
    """
    have = lambda c: F.col(c).isNotNull() if c in rows.columns else F.lit(False)
    lost = F.filter(F.array(*[F.when(~have(c), F.lit(f"'{c}'")) for c in REQUIRED]), lambda c: c.isNotNull())
    t = rows.withColumn("_lost", lost)
    out = t.filter("size(_lost) > 0").select(order, F.concat(F.lit("missing keys: ["), F.array_join("_lost", ", "), F.lit("]")).alias("error"))
    rest = t.filter("size(_lost) = 0")
    if "bbox" in rows.columns:
        out = out.unionByName(rest.filter("size(bbox) <> 4").select(order, F.lit("bbox must be a 4-item list").alias("error")))
    if files is not None:
        named = F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("path")) for c in PATHS if c in rows.columns]))
        each = rest.select(order, named.alias("p")).select(order, "p.*").filter("coalesce(path, '') <> ''")
        out = out.unionByName(each.join(files.select("path").distinct(), "path", "left_anti").select(order, F.concat(F.lit("missing path for "), "key", F.lit(": "), "path").alias("error")))
    return out


def _validated(s, d):
    b = A.boxes(s, d)
    box = F.when(F.col("raw_index") % 5 == 1, F.array("x", "y", "w")).otherwise(F.array("x", "y", "w", "h"))
    name = lambda p: F.concat(F.lit(f"{p}/"), F.col("image_id").cast("string"))
    rows = b.select(
        F.struct("image_id", "raw_index").alias("_ord"), F.when(F.col("raw_index") % 3 != 2, F.lit("c")).alias("caption"), F.when(F.col("subject") != "R", F.col("subject")).alias("object"), box.alias("bbox"), "area", F.array(F.lit("a")).alias("attributes"),
        F.lit(False).alias("uncertain"), F.col("score").alias("sam3_score"), F.lit("m").alias("model"), "image_id", F.col("raw_index").alias("mask_id"), name("i").alias("source_image_path"), name("m").alias("mask_path"), name("f").alias("full_overlay_path"), name("o").alias("crop_overlay_path"),
    )
    every = A.table(s, d, "orders").select(F.explode(F.array(*[F.concat(F.lit(f"{p}/"), F.col("o_orderkey").cast("string")) for p in "ifo"])).alias("path"))
    some = A.table(s, d, "orders").filter("o_orderstatus <> 'F'").select(F.concat(F.lit("m/"), F.col("o_orderkey").cast("string")).alias("path"))
    return validated_rows(rows, every.union(some)).select("_ord.*", "error")


def sampled(rows: DataFrame, n: int, seed: int, key: str, excluded: DataFrame | None = None) -> DataFrame:
    """n rows in an order that only seed and key decide, without excluded keys; raises where there are fewer."""
    from .incremental import running

    rest = rows if excluded is None else rows.join(excluded.select(key), key, "left_anti")
    ordered = rest.withColumns({"_h": F.sha2(F.concat_ws("\0", F.lit(str(seed)), F.col(key).cast("string")), 256), "_one": F.lit(1)})
    taken = running(ordered, ["_h", key], 16, place="_one").filter(F.col("place") <= n).drop("_h", "_one")
    if (found := taken.count()) < n:
        raise ValueError(f"a sample of {n} asked for, {found} rows left")
    return taken.withColumn("place", F.col("place") - 1)


def _mism(s, d):
    """Documents against conversations, by number."""
    members = A.table(s, d, "conversations").select((F.col("conv_id") * 3).alias("source_manifest_index"))
    return set_mismatch(A.sources(s, d), members, "source_manifest_index").select("kind", "n", F.array_join("examples", ",").alias("examples"))


def _terminal(s, d):
    return terminal(A.table(s, d, "lineitem").select((F.col("l_partkey") % 1000).cast("string").alias("image_id")), A.audits(s, d), A.exclusions(s, d))


def _enriched(s, d):
    a = A.audits(s, d).select("image_id", F.array_distinct("linked").alias("linked"))
    m = s.range(12).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("mask_id"), (F.col("id") * 10).alias("area"))
    return enriched(a, m, ["area"]).select("image_id", F.array_join(F.transform("groups", lambda g: F.concat(g["mask_id"], F.lit(":"), g["area"].cast("string"))), ",").alias("groups"))


def _sampled(s, d):
    src, gone = A.sources(s, d).select("image_id"), A.reviews(s, d)
    return sampled(src, (src.count() - gone.count()) // 2, 17, "image_id", gone)


def _keys(s, d):
    t = A.sources(s, d).withColumns({"context_pair_key": F.when(F.col("n_chars") % 3 == 0, F.col("source_pair_key")).otherwise(""), "pair_key": F.when(F.col("n_chars") % 2 == 0, F.col("source_dataset"))})
    score = mask_score(F.when(F.col("n_chars") % 2 == 0, "bad"), F.when(F.col("n_chars") % 3 == 0, F.col("n_chars").cast("string")))
    return t.select("image_id", source_key().alias("key"), score.alias("score"))


def _versions(s, d):
    e = A.table(s, d, "events").select("event_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    return current_only(e, event_type="click", k="7").select("event_id")


def _grouped(s, d):
    from .keyed import first_seen_distinct, grouped

    c = A.changes(s, d)
    g = grouped(c, "key", "event_type").select("key", F.array_join("values", ",").alias("types"))
    return g.join(first_seen_distinct(c, "key").select("key", F.col("first_ord.event_id").alias("first")), "key")


def _sparse(s, d):
    from ..functions.masks import components_of_word
    from .suppress import sparse_components

    m = A.masks(s, d).select("mask_id", components_of_word("bits").alias("component_count"), (F.bit_count("bits") / 64).alias("bbox_fill"))
    return sparse_components(m, 6, 0.5).select("mask_id", "tangled")


def _excluded(s, d):
    """Pages whose address, name or stem stands on a list made of addresses without query."""
    from ..functions.text import identifier_variants
    from ..sources.manifest import without_excluded

    p = A.table(s, d, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("url"), F.contains("url", F.lit("?")).alias("q"))
    names = p.filter("NOT q").select(F.explode(identifier_variants(F.col("url"))).alias("identifier")).distinct()
    return without_excluded(p, names, ["url"]).select("page_id")


def _shards(s, d):
    from ..sources.manifest import shard_of, stable_order

    o = stable_order(A.sources(s, d), 5, ["image_id"])
    return shard_of(o, 1, 3, "source_manifest_index").select("image_id", "_shuffle")


_S = f"WITH {A.SOURCES}, {A.REVIEWS}, {A.AUDITS}, {A.EXCLUSIONS}"
QUERIES = {
    "set_mismatch": _mism,
    "terminal_images": _terminal,
    "caption_rows_checked": _validated,
    "sample_seeded": _sampled,
    "source_keys": _keys,
    "current_rows": _versions,
    "log_grouped": _grouped,
    "mask_sparse": _sparse,
    "pages_excluded": _excluded,
    "source_shards": _shards,
    "masks_omitted": lambda s, d: omitted(A.masks(s, d).select(F.col("image_id").cast("string"), F.concat(F.lit("m"), (F.col("mask_id") % 12).cast("string")).alias("mask_id")).distinct(), A.audits(s, d).select("image_id", F.explode("linked").alias("mask_id"))),
    "groups_enriched": _enriched,
    "preview_index": lambda s, d: A.sources(s, d).select("image_id", preview_index(F.col("image_id")).alias("preview")),
    "versions_merged": lambda s, d: versions_merged(A.reviews(s, d).select("image_id", F.lit(1).alias("n_chars")), A.sources(s, d).select("image_id", "n_chars"), ["image_id"]),
    "funnel": lambda s, d: funnel(A.sources(s, d), A.reviews(s, d), A.audits(s, d)).select("stage", F.round("value", 6).alias("value")),
    "stream_rows": lambda s, d: summary({"sources": A.sources(s, d), "reviews": A.reviews(s, d), "audits": A.audits(s, d), "exclusions": A.exclusions(s, d)}),
    "resume_rows": lambda s, d: remaining(A.sources(s, d), [A.audits(s, d), A.exclusions(s, d)], "image_id").select("image_id"),
    "checked_rows": lambda s, d: checked_rows(A.audits(s, d), ["image_id", "caption", "reason_code"]).select("image_id", F.array_join("errors", ",").alias("errors")),
}
ORACLES = {
    "set_mismatch": """WITH c AS (SELECT DISTINCT conv_id * 3 AS i FROM conversations), o AS (SELECT doc_id AS i, 'missing' AS kind FROM documents WHERE doc_id NOT IN (SELECT i FROM c) UNION ALL SELECT i, 'extra' FROM c WHERE i NOT IN (SELECT doc_id FROM documents))
      SELECT kind, count(*) AS n, array_to_string(list_sort(list(i))[1:10], ',') AS examples FROM o GROUP BY 1""",
    "caption_rows_checked": f"""WITH {A.BOXES}, m AS (SELECT image_id, raw_index, array_to_string(list_filter([CASE WHEN raw_index % 3 = 2 THEN '''caption''' END, CASE WHEN subject = 'R' THEN '''object''' END], lambda x: x IS NOT NULL), ', ') AS lost FROM boxes)
      SELECT image_id, raw_index, 'missing keys: [' || lost || ']' AS error FROM m WHERE lost <> '' UNION ALL SELECT image_id, raw_index, 'bbox must be a 4-item list' FROM m WHERE lost = '' AND raw_index % 5 = 1
      UNION ALL SELECT image_id, raw_index, 'missing path for ' || k || ': ' || p || '/' || image_id FROM m, (VALUES ('source_image_path', 'i'), ('mask_path', 'm'), ('full_overlay_path', 'f'), ('crop_overlay_path', 'o')) v(k, p)
        WHERE lost = '' AND image_id NOT IN (SELECT o_orderkey FROM orders WHERE p <> 'm' OR o_orderstatus <> 'F')""",
    "sample_seeded": f"""{_S}, h AS (SELECT image_id, row_number() OVER (ORDER BY sha256('17' || chr(0) || image_id), image_id) - 1 AS place, count(*) OVER () AS n FROM sources WHERE image_id NOT IN (SELECT image_id FROM reviews)) SELECT image_id, place FROM h WHERE place < n // 2""",
    "source_keys": f"""{_S} SELECT image_id, CASE WHEN n_chars % 3 = 0 THEN source_pair_key WHEN n_chars % 2 = 0 THEN source_dataset ELSE image_id END AS key, CASE WHEN n_chars % 3 = 0 THEN CAST(n_chars AS DOUBLE) ELSE 0.0 END AS score FROM sources""",
    "current_rows": "SELECT event_id FROM events WHERE event_type = 'click' AND json_extract_string(props, '$.k') = '7'",
    "log_grouped": "SELECT user_id AS key, string_agg(event_type, ',' ORDER BY ts, event_id) AS types, arg_min(event_id, (ts, event_id)) AS first FROM events GROUP BY 1",
    "mask_sparse": f"""WITH RECURSIVE {A.MASKS}, p AS (SELECT mask_id, i - 1 AS i FROM masks, range(1, 65) r(i) WHERE px[i] = 1),
      e AS (SELECT a.mask_id, a.i AS u, b.i AS v FROM p a JOIN p b ON a.mask_id = b.mask_id AND abs(a.i // 8 - b.i // 8) + abs(a.i % 8 - b.i % 8) <= 1),
      r(mask_id, u, v) AS (SELECT mask_id, u, v FROM e UNION SELECT r.mask_id, r.u, e.v FROM r JOIN e ON e.mask_id = r.mask_id AND e.u = r.v),
      l AS (SELECT mask_id, u, min(v) AS c FROM r GROUP BY 1, 2), n AS (SELECT mask_id, count(DISTINCT c) AS k, count(DISTINCT u) AS a FROM l GROUP BY 1) SELECT m.mask_id, coalesce(k > 6 AND a / 64 < 0.5, false) AS tangled FROM masks m LEFT JOIN n USING (mask_id)""",
    "pages_excluded": """WITH u AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS u, contains(url, '?') AS q FROM pages), n AS (SELECT *, regexp_extract(u, '([^/]*)/*$', 1) AS n FROM u),
      v AS (SELECT page_id, q, unnest(list_distinct([u, n, CASE WHEN regexp_matches(n, '[^.]\\.[^.]+$') THEN regexp_replace(n, '\\.[^.]+$', '') ELSE n END, CASE WHEN regexp_matches(n, '[^.]\\.[^.]+$') THEN regexp_replace(u, '\\.[^.]+$', '') ELSE u END])) AS i FROM n)
      SELECT page_id FROM u WHERE page_id NOT IN (SELECT page_id FROM v WHERE i <> '' AND i IN (SELECT i FROM v WHERE NOT q AND i <> ''))""",
    "source_shards": f"{_S} SELECT image_id, sha256('5' || chr(0) || image_id) AS _shuffle FROM sources WHERE source_manifest_index % 3 = 1",
    "masks_omitted": f"""{_S} SELECT DISTINCT CAST(vec_id // 10 AS VARCHAR) AS image_id, 'm' || (vec_id % 12) AS mask_id FROM embeddings WHERE (CAST(vec_id // 10 AS VARCHAR), 'm' || (vec_id % 12)) NOT IN (SELECT (image_id, m) FROM (SELECT image_id, unnest(linked) AS m FROM audits))""",
    "terminal_images": f"{_S} SELECT CAST(l_partkey % 1000 AS VARCHAR) AS image_id FROM lineitem GROUP BY 1 HAVING count(*) >= 10 AND image_id NOT IN (SELECT image_id FROM audits) AND image_id NOT IN (SELECT image_id FROM exclusions)",
    "groups_enriched": f"{_S} SELECT image_id, array_to_string(list_transform(list_filter(linked, lambda m, i: list_position(linked, m) = i), lambda m: m || ':' || CAST(substr(m, 2) AS INT) * 10), ',') AS groups FROM audits",
    "preview_index": f"{_S} SELECT image_id, CAST(CAST('0x' || left(sha256(image_id), 12) AS BIGINT) + 1125899906842624 AS BIGINT) AS preview FROM sources",
    "versions_merged": f"{_S} SELECT image_id, 1 AS n_chars, 'after' AS version FROM reviews UNION ALL SELECT image_id, n_chars, 'before' FROM sources WHERE image_id NOT IN (SELECT image_id FROM reviews)",
    "funnel": f"""{_S} SELECT 'sources' AS stage, CAST(count(*) AS DOUBLE) AS value FROM sources UNION ALL SELECT 'reviews', count(*) FROM reviews UNION ALL SELECT 'accepted', count(*) FILTER (accepted) FROM reviews
      UNION ALL SELECT 'audits', count(*) FROM audits UNION ALL SELECT 'acceptance_rate', round(avg(CAST(accepted AS INT)), 6) FROM reviews""",
    "stream_rows": f"""{_S} SELECT 'sources' AS stream, count(*) AS rows FROM sources UNION ALL SELECT 'reviews', count(*) FROM reviews UNION ALL SELECT 'audits', count(*) FROM audits UNION ALL SELECT 'exclusions', count(*) FROM exclusions""",
    "resume_rows": f"{_S} SELECT image_id FROM sources WHERE image_id NOT IN (SELECT image_id FROM audits) AND image_id NOT IN (SELECT image_id FROM exclusions)",
    "checked_rows": f"{_S} SELECT image_id, array_to_string(list_filter([CASE WHEN caption = '' THEN 'missing caption' END, CASE WHEN reason_code = '' THEN 'missing reason_code' END], lambda e: e IS NOT NULL), ',') AS errors FROM audits",
}
