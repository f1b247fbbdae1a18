"""Box algebra as Column functions.  A box is four integer columns x, y, w, h under a prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import adapters as A


def col(p: str, c: str) -> Column:
    return F.col(f"{p}{c}")


def bbox_area(p: str = "") -> Column:
    return (F.greatest(F.lit(0), col(p, "w")) * F.greatest(F.lit(0), col(p, "h"))).cast("long")


def intersection(p: str, q: str) -> Column:
    side = lambda s, d: F.greatest(F.lit(0), F.least(col(p, s) + col(p, d), col(q, s) + col(q, d)) - F.greatest(col(p, s), col(q, s)))
    return (side("x", "w") * side("y", "h")).cast("long")


def ratio(a: Column, b: Column) -> Column:
    """a / b; 0.0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def containment(inner: str, outer: str) -> Column:
    return ratio(intersection(inner, outer), bbox_area(inner))


def bbox_iou(p: str, q: str) -> Column:
    return ratio(intersection(p, q), bbox_area(p) + bbox_area(q) - intersection(p, q))


def same_region(p: str, q: str, least: float = 0.1) -> Column:
    """Intersection over the smaller box."""
    return ratio(intersection(p, q), F.least(bbox_area(p), bbox_area(q))) >= least


def region(width: int, height: int, p: str = "") -> Column:
    """One of nine labels for the box's centre."""
    third = lambda s, d, n: F.least(F.lit(2), F.floor(3 * (col(p, s) + col(p, d) / 2) / F.lit(max(1, n)))).cast("int")
    names = lambda *v: F.array(*map(F.lit, v))
    return F.concat_ws("-", F.element_at(names("upper", "middle", "lower"), third("y", "h", height) + 1), F.element_at(names("left", "center", "right"), third("x", "w", width) + 1))


def gaps(p: str, q: str) -> tuple[Column, Column]:
    one = lambda s, d: F.greatest(F.lit(0), F.greatest(col(p, s), col(q, s)) - F.least(col(p, s) + col(p, d), col(q, s) + col(q, d)))
    return one("x", "w"), one("y", "h")


def contact(p: str, q: str, width: int, height: int, most: float = 0.06) -> Column:
    """Gap of at most a part of the image's diagonal."""
    gx, gy = gaps(p, q)
    return F.hypot(gx.cast("double"), gy.cast("double")) <= most * (width**2 + height**2) ** 0.5


def crop_bounds(width: int, height: int, padding: int = 24, p: str = "") -> Column:
    return F.struct(
        F.greatest(F.lit(0), col(p, "x") - padding).alias("x0"), F.greatest(F.lit(0), col(p, "y") - padding).alias("y0"),
        F.least(F.lit(width), col(p, "x") + col(p, "w") + padding).alias("x1"), F.least(F.lit(height), col(p, "y") + col(p, "h") + padding).alias("y1"),
    )


def to_xywh(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Corners to a box: half-even rounding, sides of 1 at least."""
    r = lambda c: F.bround(c, 0).cast("int")
    return F.struct(r(x0).alias("x"), r(y0).alias("y"), F.greatest(F.lit(1), r(x1) - r(x0)).alias("w"), F.greatest(F.lit(1), r(y1) - r(y0)).alias("h"))


def visual_tokens(pixels: Column, low: int = 65_536, high: int = 16_777_216, patch: int = 784) -> Column:
    return F.ceil(F.greatest(F.lit(low), F.least(F.lit(high), pixels)) / patch).cast("long")


def token_budget(n: Column, cap: int, floor: int, per_mask: int) -> Column:
    return F.least(F.lit(cap), F.greatest(F.lit(floor), 1024 + per_mask * n))


def heuristic_reject(width: Column, height: Column, min_side: int = 256, min_pixels: int = 150_000) -> Column:
    return F.when(F.least(width, height) < min_side, f"image_min_side_below_{min_side}px").when(width * height < min_pixels, f"image_pixels_below_{min_pixels}").otherwise("")


def size_bucket(width: Column, height: Column) -> Column:
    """Bit length of the pixel count, then the aspect in quarters (half-even)."""
    return F.struct(F.length(F.bin((width * height).cast("long"))).alias("bits"), F.bround(4.0 * width / height, 0).cast("int").alias("aspect"))


def ordinal_suffix(n: Column) -> Column:
    return F.when((n % 100).isin(11, 12, 13), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")


def relative_descriptors(boxes: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rank along the axis on which the centres of a group spread most, as a label."""
    group = Window.partitionBy(*keys)
    spread = lambda s, d: F.max(col("", s) + col("", d) / 2).over(group) - F.min(col("", s) + col("", d) / 2).over(group)
    rows = boxes.withColumns({"_across": spread("x", "w") >= spread("y", "h"), "_n": F.count(F.lit(1)).over(group)})
    rows = rows.withColumn("_c", F.when(F.col("_across"), F.col("x") + F.col("w") / 2).otherwise(F.col("y") + F.col("h") / 2))
    rows = rows.withColumn("rank", F.row_number().over(group.orderBy("_c", order)))
    named = lambda *v: F.element_at(F.array(*map(F.lit, v)), F.col("rank"))
    label = (
        F.when((F.col("_n") == 2) & F.col("_across"), named("left-side", "right-side", "")).when(F.col("_n") == 2, named("upper", "lower", ""))
        .when((F.col("_n") == 3) & F.col("_across"), named("left-side", "central", "right-side")).when(F.col("_n") == 3, named("upper", "middle", "lower"))
        .otherwise(F.concat(F.col("rank").cast("string"), ordinal_suffix(F.col("rank")), F.lit("-from-"), F.when(F.col("_across"), "left").otherwise("top")))
    )
    return rows.withColumns({"label": label, "total": F.col("_n"), "horizontal": F.col("_across")}).drop("_across", "_n", "_c")


def pairs(boxes: DataFrame) -> DataFrame:
    """Ordered pairs of boxes of one image (an equi-join with a residual, never a cross join)."""
    named = lambda p: boxes.select("image_id", *[F.col(c).alias(f"{p}{c}") for c in boxes.columns if c != "image_id"])
    return named("a_").join(named("b_"), "image_id").filter("a_raw_index < b_raw_index")


def owners(boxes: DataFrame, least: float = 0.8, rival: float = 0.55, lead: float = 0.2) -> DataFrame:
    """Owner of each part (subject A): the only other subject's box of its image, whatever it holds; of several the one that holds
    it best, if it holds `least` of it and the runner-up holds at most `rival` or trails by `lead`.
    """
    part = boxes.filter("subject = 'A'").select("image_id", *[F.col(c).alias(f"p_{c}") for c in ("raw_index", "x", "y", "w", "h")])
    whole = boxes.filter("subject <> 'A'").select("image_id", *[F.col(c).alias(f"o_{c}") for c in ("raw_index", "x", "y", "w", "h")])
    held = part.join(whole, "image_id").select("image_id", "p_raw_index", "o_raw_index", containment("p_", "o_").alias("held"))
    top = F.slice(F.sort_array(F.collect_list(F.struct("held", F.col("o_raw_index").alias("i"))), asc=False), 1, 2)  # boxes of one image
    best = held.groupBy("image_id", "p_raw_index").agg(top.alias("top")).withColumns({"one": F.col("top")[0]["held"], "two": F.try_element_at("top", F.lit(2))["held"]})
    clear = F.col("two").isNull() | ((F.col("one") >= least) & ((F.col("two") <= rival) | (F.col("one") - F.col("two") >= lead)))
    return best.filter(clear).select("image_id", F.col("p_raw_index").alias("part"), F.col("top")[0]["i"].alias("owner"), F.round("one", 6).alias("held"))


def _pairs(s, d):
    p = pairs(A.boxes(s, d))
    gx, gy = gaps("a_", "b_")
    r6 = lambda c: F.round(c, 6)
    return p.select(
        "image_id", "a_raw_index", "b_raw_index", intersection("a_", "b_").alias("inter"), r6(bbox_iou("a_", "b_")).alias("iou"), r6(containment("a_", "b_")).alias("held"),
        same_region("a_", "b_").alias("same_region"), gx.alias("gap_x"), gy.alias("gap_y"), contact("a_", "b_", A.WIDTH, A.HEIGHT).alias("contact"),
    )


def _scalars(s, d):
    b, c = A.boxes(s, d), crop_bounds(A.WIDTH, A.HEIGHT)
    return b.select(
        "image_id", "raw_index", bbox_area().alias("bbox_area"), region(A.WIDTH, A.HEIGHT).alias("region"), c["x0"].alias("x0"), c["y0"].alias("y0"), c["x1"].alias("x1"), c["y1"].alias("y1"),
        visual_tokens(F.col("w") * F.col("h") * 100).alias("tokens"), token_budget(F.col("raw_index"), 4096, 2048, 300).alias("budget"), heuristic_reject(F.col("w") * 20, F.col("h") * 20).alias("reject"),
        size_bucket(F.col("w"), F.col("h"))["bits"].alias("bits"), size_bucket(F.col("w"), F.col("h"))["aspect"].alias("aspect"),
        to_xywh(F.col("x") + 0.5, F.col("y") + 0.5, F.col("x") + F.col("w") / 2, F.col("y") + F.col("h") / 4)["w"].alias("round_w"),
    )


def _consistency(s, d):
    return consistency(A.boxes(s, d).filter("subject = 'A'"), A.boxes(s, d).filter("subject <> 'A'"))


def consistency(queries: DataFrame, candidates: DataFrame, least: float = 0.5) -> DataFrame:
    """Each query box against the candidates of its image in the same region: first largest IoU (strictly above 0), passed, reason."""
    q = queries.select("image_id", *[F.col(c).alias(f"q_{c}") for c in ("raw_index", "x", "y", "w", "h")])
    c = candidates.select("image_id", *[F.col(c).alias(f"c_{c}") for c in ("raw_index", "x", "y", "w", "h")])
    both = q.join(c, "image_id", "left").withColumns({"iou": bbox_iou("q_", "c_"), "near": F.coalesce(same_region("q_", "c_"), F.lit(False)) & F.col("c_raw_index").isNotNull()})
    best = both.groupBy("image_id", "q_raw_index").agg(
        F.count("c_raw_index").alias("candidates"), F.count_if("near").alias("in_region"),
        F.max(F.when(F.col("near") & (F.col("iou") > 0), F.struct("iou", (-F.col("c_raw_index")).alias("i")))).alias("top"),
    )
    iou = F.coalesce("top.iou", F.lit(0.0))
    return best.select("image_id", F.col("q_raw_index").alias("raw_index"), "candidates", "in_region", F.round(iou, 6).alias("best_iou"), F.coalesce(-F.col("top.i"), F.lit(-1)).alias("best_index"), (iou >= least).alias("passed"), F.when(iou >= least, "consistent").otherwise("below_iou").alias("reason"))


_AREA = "CAST(greatest(0, {p}w) * greatest(0, {p}h) AS BIGINT)"
_I = "CAST(greatest(0, least({p}x + {p}w, {q}x + {q}w) - greatest({p}x, {q}x)) * greatest(0, least({p}y + {p}h, {q}y + {q}h) - greatest({p}y, {q}y)) AS BIGINT)"
_i = _I.format(p="a.", q="b.")
_aa, _ab = _AREA.format(p="a."), _AREA.format(p="b.")
_gx, _gy = (f"greatest(0, greatest(a.{s}, b.{s}) - least(a.{s} + a.{t}, b.{s} + b.{t}))" for s, t in (("x", "w"), ("y", "h")))
QUERIES = {
    "box_pairs": _pairs,
    "box_scalars": _scalars,
    "box_relative_labels": lambda s, d: relative_descriptors(A.boxes(s, d), ["image_id", "subject"], "raw_index").select("image_id", "raw_index", "rank", "total", "horizontal", "label"),
    "box_owners": lambda s, d: owners(A.boxes(s, d)),
    "box_consistency": _consistency,
}
ORACLES = {
    "box_pairs": f"""WITH {A.BOXES} SELECT a.image_id, a.raw_index AS a_raw_index, b.raw_index AS b_raw_index, {_i} AS inter, round(coalesce({_i} / nullif({_aa} + {_ab} - {_i}, 0), 0), 6) AS iou,
      round(coalesce({_i} / nullif({_aa}, 0), 0), 6) AS held, coalesce({_i} / nullif(least({_aa}, {_ab}), 0), 0) >= 0.1 AS same_region, {_gx} AS gap_x, {_gy} AS gap_y,
      sqrt({_gx} * {_gx} + {_gy} * {_gy}) <= 48 AS contact FROM boxes a JOIN boxes b ON a.image_id = b.image_id AND a.raw_index < b.raw_index""",
    "box_scalars": f"""WITH {A.BOXES} SELECT image_id, raw_index, CAST(w * h AS BIGINT) AS bbox_area,
      list_value('upper', 'middle', 'lower')[1 + CAST(least(2, floor(3 * (y + h / 2) / 480)) AS INT)] || '-' || list_value('left', 'center', 'right')[1 + CAST(least(2, floor(3 * (x + w / 2) / 640)) AS INT)] AS region,
      greatest(0, x - 24) AS x0, greatest(0, y - 24) AS y0, least(640, x + w + 24) AS x1, least(480, y + h + 24) AS y1, CAST(ceil(greatest(65536, least(16777216, w * h * 100)) / 784) AS BIGINT) AS tokens,
      least(4096, greatest(2048, 1024 + 300 * raw_index)) AS budget, CASE WHEN least(w, h) * 20 < 256 THEN 'image_min_side_below_256px' WHEN w * h * 400 < 150000 THEN 'image_pixels_below_150000' ELSE '' END AS reject,
      length(bin(CAST(w * h AS BIGINT))) AS bits, CAST(round_even(4.0 * w / h, 0) AS INT) AS aspect,
      greatest(1, CAST(round_even(x + w / 2, 0) AS INT) - CAST(round_even(x + 0.5, 0) AS INT)) AS round_w FROM boxes""",
    "box_relative_labels": f"""WITH {A.BOXES}, s AS (SELECT *, max(x + w / 2) OVER g - min(x + w / 2) OVER g >= max(y + h / 2) OVER g - min(y + h / 2) OVER g AS horizontal, count(*) OVER g AS total FROM boxes WINDOW g AS (PARTITION BY image_id, subject)),
      r AS (SELECT *, CAST(row_number() OVER (PARTITION BY image_id, subject ORDER BY CASE WHEN horizontal THEN x + w / 2 ELSE y + h / 2 END, raw_index) AS INT) AS rank FROM s)
      SELECT image_id, raw_index, rank, total, horizontal, CASE WHEN total = 2 AND horizontal THEN list_value('left-side', 'right-side')[rank] WHEN total = 2 THEN list_value('upper', 'lower')[rank]
      WHEN total = 3 AND horizontal THEN list_value('left-side', 'central', 'right-side')[rank] WHEN total = 3 THEN list_value('upper', 'middle', 'lower')[rank]
      ELSE rank || CASE WHEN rank % 100 IN (11, 12, 13) THEN 'th' WHEN rank % 10 = 1 THEN 'st' WHEN rank % 10 = 2 THEN 'nd' WHEN rank % 10 = 3 THEN 'rd' ELSE 'th' END || '-from-' || CASE WHEN horizontal THEN 'left' ELSE 'top' END END AS label FROM r""",
    "box_owners": f"""WITH {A.BOXES}, h AS (SELECT a.image_id, a.raw_index AS part, b.raw_index AS owner, coalesce({_i} / nullif({_aa}, 0), 0) AS held FROM boxes a JOIN boxes b ON a.image_id = b.image_id AND a.subject = 'A' AND b.subject <> 'A'),
      k AS (SELECT *, row_number() OVER w AS n, lead(held) OVER w AS second FROM h WINDOW w AS (PARTITION BY image_id, part ORDER BY held DESC, owner DESC))
      SELECT image_id, part, owner, round(held, 6) AS held FROM k WHERE n = 1 AND (second IS NULL OR held >= 0.8 AND (second <= 0.55 OR held - second >= 0.2))""",
    "box_consistency": f"""WITH {A.BOXES}, p AS (SELECT a.image_id, a.raw_index, b.raw_index AS ci, coalesce({_i} / nullif({_aa} + {_ab} - {_i}, 0), 0) AS iou, coalesce(coalesce({_i} / nullif(least({_aa}, {_ab}), 0), 0) >= 0.1, false) AND b.raw_index IS NOT NULL AS near
      FROM (SELECT * FROM boxes WHERE subject = 'A') a LEFT JOIN (SELECT * FROM boxes WHERE subject <> 'A') b ON a.image_id = b.image_id),
      g AS (SELECT image_id, raw_index, count(ci) AS candidates, count(*) FILTER (near) AS in_region, coalesce(max(iou) FILTER (near AND iou > 0), 0.0) AS best, arg_min(ci, (-iou, ci)) FILTER (near AND iou > 0) AS bi FROM p GROUP BY 1, 2)
      SELECT image_id, raw_index, candidates, in_region, round(best, 6) AS best_iou, coalesce(bi, -1) AS best_index, best >= 0.5 AS passed, CASE WHEN best >= 0.5 THEN 'consistent' ELSE 'below_iou' END AS reason FROM g""",
}
