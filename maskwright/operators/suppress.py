"""Candidate filters, caps and greedy suppression."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import adapters as A
from ..functions.geometry import bbox_area, ratio


def reject_reason(width: int, height: int, min_area: int = 192, min_fraction: float = 0.0005, min_fill: float = 0.08, giant_mask: float = 0.7, giant_box: float = 0.9):
    """The first of small_area, sparse_fragment, giant_mask, giant_bbox that applies (order decides the one reason)."""
    pixels = width * height
    least = F.greatest(F.lit(min_area), F.bround(F.lit(pixels * min_fraction), 0).cast("long"))
    return (
        F.when(F.col("area") < least, "small_area").when(ratio(F.col("area"), bbox_area()) < min_fill, "sparse_fragment")
        .when(ratio(F.col("area"), F.lit(pixels)) > giant_mask, "giant_mask").when(ratio(bbox_area(), F.lit(pixels)) > giant_box, "giant_bbox").otherwise("")
    )


def filtered(boxes: DataFrame, width: int, height: int, **limits) -> DataFrame:
    return boxes.withColumn("reject_reason", reject_reason(width, height, **limits))


def sparse_components(rows: DataFrame, most: int = 12, fill: float = 0.18) -> DataFrame:
    """Rows with more than `most` components in a box they fill less than `fill`."""
    return rows.withColumn("tangled", (F.col("component_count") > most) & (F.col("bbox_fill") < fill))


def contained_partial(masks: DataFrame, size_ratio: float = 0.5, margin: float = 0.1, mask_cover: float = 0.9, box_cover: float = 0.9) -> DataFrame:
    """Masks that a strictly larger one of their image holds, by mask and by box, with the largest such (of equal ones the first by mask_id).

    masks: image_id, mask_id, area, score, bits, x, y, w, h.  An equi-join with a residual; areas are the masks'.
    """
    from ..functions.geometry import containment

    side = lambda p: masks.select("image_id", *[F.col(c).alias(f"{p}{c}") for c in ("mask_id", "area", "score", "bits", "x", "y", "w", "h")])
    held = ratio(F.bit_count(F.col("s_bits").bitwiseAND(F.col("l_bits"))), F.bit_count("s_bits"))
    both = side("s_").join(side("l_"), "image_id").filter("s_area < l_area").withColumns({"ratio": ratio(F.col("s_area"), F.col("l_area")), "mask_held": held, "box_held": containment("s_", "l_")})
    both = both.filter((F.col("ratio") <= size_ratio) & (F.col("l_score") >= F.col("s_score") - margin) & (F.col("mask_held") >= mask_cover) & (F.col("box_held") >= box_cover))
    best = both.groupBy("image_id", F.col("s_mask_id").alias("mask_id")).agg(F.max_by(F.struct(F.col("l_mask_id").alias("container"), "ratio", "mask_held", "box_held"), F.struct("l_area", -F.col("l_mask_id"))).alias("r"))
    return best.select("image_id", "mask_id", "r.*")


def top_per_group(rows: DataFrame, key: str, score: str, tie: str, k: int) -> DataFrame:
    """The k best of each group (planned as WindowGroupLimit; 0 keeps all)."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), tie))
    ranked = rows.withColumn("place", place)
    return ranked.filter(F.col("place") <= k) if k else ranked


def capped(rows: DataFrame, per_image: int, overall: int, order: tuple[str, ...] = ("image_id", "raw_index")) -> DataFrame:
    """The best of each image, then the best overall, numbered by `slot` in input order (`overall` rows at most)."""
    best = top_per_group(rows, "image_id", "score", "raw_index", per_image).orderBy(F.desc("score"), "image_id", "raw_index").limit(overall)
    return best.drop("place").withColumn("slot", F.row_number().over(Window.orderBy(*order)) - 1)


def greedy_nms(boxes: DataFrame, threshold: float, key: str = "image_id", order: str = "raw_index") -> DataFrame:
    """Greedy suppression by score: kept, and for the others the first kept box they overlap.

    The fold runs over each image's sorted boxes in the JVM; an image's boxes are few, whatever the table's size.
    """
    boxes_of = boxes.groupBy(key).agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("k"), F.col(order).alias("i"), "x", "y", "w", "h"))).alias("b"))
    inter = "greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y))"
    hit = f"{inter} >= {threshold}D * (a.w * a.h + b.w * b.h - {inter}) AND {inter} > 0"
    fold = f"""aggregate(b, cast(array() AS array<struct<k:double,i:int,x:int,y:int,w:int,h:int,by:int>>), (acc, b) ->
      concat(acc, array(named_struct('k', b.k, 'i', b.i, 'x', b.x, 'y', b.y, 'w', b.w, 'h', b.h,
        'by', coalesce(get(filter(acc, a -> a.by = -1 AND {hit}), 0).i, -1)))))"""
    return boxes_of.select(key, F.explode(F.expr(fold)).alias("o")).select(key, F.col("o.i").alias(order), (F.col("o.by") == -1).alias("kept"), F.col("o.by").alias("suppressed_by"))


def even_sample(rows: DataFrame, order: str, n: int) -> DataFrame:
    """n rows at even steps: places half-even(i * last / (n - 1)).  A report sampler: one sorted pass over the given rows."""
    total = rows.count()
    if total <= n:
        return rows
    places = [(int(v),) for v in dict.fromkeys(round(i * (total - 1) / max(n - 1, 1)) for i in range(n))]
    from ..plans.export import sharded

    numbered = sharded(rows, order, order, 1).drop("shard")
    return numbered.join(F.broadcast(rows.sparkSession.createDataFrame(places, "row_index long")), "row_index")  # n rows


def _contained(s, d):
    from ..functions.masks import area, word_bbox

    m = A.masks(s, d).select("image_id", "mask_id", "score", "bits", area(F.col("bits")).alias("area"), word_bbox(F.col("bits")).alias("b")).select("*", "b.x", "b.y", "b.w", "b.h")
    return contained_partial(m, 0.95, 0.2, 0.6, 0.6).select("image_id", "mask_id", "container", *[F.round(c, 6).alias(c) for c in ("ratio", "mask_held", "box_held")])


_B = f"WITH {A.BOXES}"
_HIT = "greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y))"
QUERIES = {
    "box_filter": lambda s, d: filtered(A.boxes(s, d), 64, 48, min_area=20).select("image_id", "raw_index", "reject_reason"),
    "box_contained": _contained,
    "box_top_k": lambda s, d: top_per_group(A.boxes(s, d), "image_id", "score", "raw_index", 2).select("image_id", "raw_index", "place"),
    "box_capped": lambda s, d: capped(A.boxes(s, d), 3, 500).select("image_id", "raw_index", "score", "slot"),
    "box_greedy_nms": lambda s, d: greedy_nms(A.boxes(s, d).withColumns({"x": F.expr("x % 40"), "y": F.expr("y % 30")}), 0.3),
    "even_sample": lambda s, d: even_sample(A.sources(s, d).select("source_manifest_index"), "source_manifest_index", 37),
}
ORACLES = {
    "box_filter": f"""{_B} SELECT image_id, raw_index, CASE WHEN area < greatest(20, CAST(round_even(64 * 48 * 0.0005, 0) AS BIGINT)) THEN 'small_area' WHEN area / (w * h) < 0.08 THEN 'sparse_fragment'
      WHEN area / (64 * 48) > 0.7 THEN 'giant_mask' WHEN w * h / (64 * 48) > 0.9 THEN 'giant_bbox' ELSE '' END AS reject_reason FROM boxes""",
    "box_contained": f"""WITH {A.MASKS}, p AS (SELECT mask_id, unnest(range(0, 64)) AS i, unnest(px) AS v FROM masks),
      f AS (SELECT m.*, q.* EXCLUDE (mask_id) FROM masks m JOIN (SELECT mask_id, sum(v) AS area, min(i // 8) FILTER (v = 1) AS x, min(i % 8) FILTER (v = 1) AS y, max(i // 8) FILTER (v = 1) - min(i // 8) FILTER (v = 1) + 1 AS w, max(i % 8) FILTER (v = 1) - min(i % 8) FILTER (v = 1) + 1 AS h FROM p GROUP BY 1) q USING (mask_id)),
      o AS (SELECT a.image_id, a.mask_id, b.mask_id AS container, b.area AS big, a.area / b.area AS ratio, list_sum(list_transform(range(1, 65), lambda i: a.px[i] * b.px[i])) / a.area AS mask_held, {_HIT} / (a.w * a.h) AS box_held
        FROM f a JOIN f b ON a.image_id = b.image_id AND a.area < b.area AND b.score >= a.score - 0.2)
      SELECT image_id, mask_id, container, round(ratio, 6) AS ratio, round(mask_held, 6) AS mask_held, round(box_held, 6) AS box_held FROM o WHERE ratio <= 0.95 AND mask_held >= 0.6 AND box_held >= 0.6
      QUALIFY row_number() OVER (PARTITION BY image_id, mask_id ORDER BY big DESC, container) = 1""",
    "box_top_k": f"{_B} SELECT image_id, raw_index, CAST(row_number() OVER w AS INT) AS place FROM boxes WINDOW w AS (PARTITION BY image_id ORDER BY score DESC, raw_index) QUALIFY row_number() OVER w <= 2",
    "box_capped": f"""{_B}, k AS (SELECT * FROM boxes QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY score DESC, raw_index) <= 3)
      SELECT image_id, raw_index, score, CAST(row_number() OVER (ORDER BY image_id, raw_index) - 1 AS INT) AS slot FROM (SELECT * FROM k ORDER BY score DESC, image_id, raw_index LIMIT 500)""",
    "box_greedy_nms": f"""WITH RECURSIVE {A.BOXES}, o AS (SELECT image_id, raw_index, x % 40 AS x, y % 30 AS y, w, h, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, raw_index) AS n FROM boxes),
      r AS (SELECT image_id, 1 AS n, [{{'i': raw_index, 'x': x, 'y': y, 'w': w, 'h': h}}] AS kept, raw_index, -1 AS sup FROM o WHERE n = 1
        UNION ALL SELECT b.image_id, r.n + 1, CASE WHEN h.i IS NULL THEN list_append(r.kept, {{'i': b.raw_index, 'x': b.x, 'y': b.y, 'w': b.w, 'h': b.h}}) ELSE r.kept END, b.raw_index, coalesce(h.i, -1)
        FROM r JOIN o b ON b.image_id = r.image_id AND b.n = r.n + 1,
        LATERAL (SELECT list_filter(r.kept, lambda a: {_HIT} > 0 AND {_HIT} >= 0.3 * (a.w * a.h + b.w * b.h - {_HIT}))[1].i AS i) h)
      SELECT image_id, raw_index, sup = -1 AS kept, sup AS suppressed_by FROM r""",
    "even_sample": """WITH n AS (SELECT doc_id AS source_manifest_index, row_number() OVER (ORDER BY doc_id) - 1 AS row_index, count(*) OVER () AS t FROM documents)
      SELECT source_manifest_index, row_index FROM n WHERE row_index IN (SELECT CAST(round_even(i * (t - 1) / 36.0, 0) AS BIGINT) FROM range(37) g(i), (SELECT any_value(t) AS t FROM n))""",
}
