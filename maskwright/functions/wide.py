"""Masks of any size as arrays of 64-bit words: pixel i, counted down the columns, is bit i % 64 of word i div 64.

Areas and overlaps are bit counts in the JVM; a mask's words travel, never its pixels.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .. import adapters as A
from .geometry import ratio

BOX = StructType([StructField(c, IntegerType()) for c in "xywh"])


def words_of(mask: np.ndarray) -> list[int]:
    """The words of a mask (height, width)."""
    bits = np.packbits(np.asarray(mask, bool).reshape(-1, order="F"), bitorder="little")
    return np.frombuffer(bits.tobytes() + b"\0" * (-len(bits) % 8), np.int64).tolist()


def mask_of(words, height: int, width: int) -> np.ndarray:
    bits = np.unpackbits(np.asarray(words, np.int64).view(np.uint8), bitorder="little")[: height * width]
    return bits.astype(bool).reshape((height, width), order="F")


def area(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda n, w: n + F.bit_count(w))


def _both(a: Column, b: Column, f) -> Column:
    return F.aggregate(F.zip_with(a, b, f), F.lit(0), lambda n, w: n + F.bit_count(w))


def overlaps(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """IoU, the intersection's part of the smaller mask, and the part of `a` that `b` holds; 0 where there is nothing."""
    inter = _both(a, b, lambda x, y: x.bitwiseAND(y))
    return ratio(inter, area(a) + area(b) - inter), ratio(inter, F.least(area(a), area(b))), ratio(inter, area(a))


@F.pandas_udf(BOX)
def bbox(words: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
    """The bounding box; zeros for an empty mask."""

    def one(w, h: int, v: int) -> tuple[int, int, int, int]:
        m = mask_of(w, int(h), int(v))
        xs, ys = np.flatnonzero(m.any(0)), np.flatnonzero(m.any(1))
        return (int(xs[0]), int(ys[0]), int(xs[-1] - xs[0] + 1), int(ys[-1] - ys[0] + 1)) if len(xs) else (0, 0, 0, 0)

    return pd.DataFrame([one(*x) for x in zip(words, height, width, strict=True)], columns=list("xywh"))


def deduped(masks: DataFrame, threshold: float, key: str = "image_id", order: str = "mask_id") -> DataFrame:
    """Greedy suppression by mask IoU, the best score first: key, mask, kept, and the first kept mask that suppresses it.

    Keys are dealt to tasks; a pass over an image's sorted masks holds the kept ones as a matrix of words.
    """

    def run(frames):
        last, ids, held, sizes = object(), [], None, None
        for frame in frames:
            out = []
            for k, mask, words in zip(frame["k"], frame["i"], frame["words"], strict=True):
                w = np.asarray(words, np.int64).view(np.uint64)
                n = int(np.bitwise_count(w).sum())
                if k != last:
                    last, ids, held, sizes = k, [], np.zeros((0, len(w)), np.uint64), np.zeros(0, np.int64)
                inter = np.bitwise_count(held & w).sum(1).astype(np.int64)
                hit = np.flatnonzero(inter >= threshold * np.maximum(sizes + n - inter, 1)) if n else []
                hit = [h for h in hit if inter[h] > 0]
                out.append(ids[hit[0]] if len(hit) else None)
                if not len(hit):
                    ids, held, sizes = [*ids, mask], np.vstack([held, w]), np.append(sizes, n)
            yield pd.DataFrame({"k": frame["k"], "i": frame["i"], "by": pd.array(out, "Int64")})

    kind = dict(masks.dtypes)
    dealt = masks.select(F.col(key).alias("k"), F.col(order).cast("long").alias("i"), "score", "words").repartition("k").sortWithinPartitions("k", F.desc("score"), "i")
    return dealt.mapInPandas(run, f"k {kind[key]}, i long, by long").select(F.col("k").alias(key), F.col("i").alias(order), F.col("by").isNull().alias("kept"), F.coalesce("by", F.lit(-1)).alias("suppressed_by"))


def _masks(s, d) -> DataFrame:
    """16 x 16 masks: four vectors one after another."""
    m = A.masks(s, d).select(F.expr("mask_id div 4").alias("mask_id"), (F.col("mask_id") % 4).alias("k"), "bits", "score")
    g = m.groupBy("mask_id").agg(F.array_sort(F.collect_list(F.struct("k", "bits"))).alias("w"), F.max("score").alias("score")).filter("size(w) = 4")  # four rows each
    return g.select("mask_id", F.expr("mask_id div 12").alias("image_id"), "score", F.transform("w", lambda x: x["bits"]).alias("words"))


def _pairs(s, d) -> DataFrame:
    side = lambda p: _masks(s, d).select("image_id", F.col("mask_id").alias(p), F.col("words").alias(f"{p}_w"))
    iou, small, held = overlaps(F.col("a_w"), F.col("b_w"))
    return side("a").join(side("b"), "image_id").filter("a < b").select("image_id", "a", "b", *[F.round(c, 6).alias(n) for c, n in ((iou, "iou"), (small, "smaller"), (held, "held"))])


QUERIES = {
    "mask_wide_facts": lambda s, d: _masks(s, d).select("mask_id", area(F.col("words")).alias("area"), bbox("words", F.lit(16), F.lit(16)).alias("b")).select("mask_id", "area", "b.*"),
    "mask_wide_overlaps": _pairs,
    "mask_wide_dedupe": lambda s, d: deduped(_masks(s, d), 0.34),
}
_W = f"""{A.MASKS}, g AS (SELECT mask_id // 4 AS mask_id, max(score) AS score, flatten(list(px ORDER BY mask_id)) AS px FROM masks GROUP BY 1 HAVING count(*) = 4),
  w AS MATERIALIZED (SELECT *, mask_id // 12 AS image_id, list_sum(px) AS n FROM g),
  o AS MATERIALIZED (SELECT a.image_id, a.mask_id AS a, b.mask_id AS b, a.n AS an, b.n AS bn, list_sum(list_transform(range(1, 257), lambda i: a.px[i] * b.px[i])) AS k FROM w a JOIN w b ON a.image_id = b.image_id AND a.mask_id <> b.mask_id)"""
ORACLES = {
    "mask_wide_facts": f"""WITH {_W}, p AS (SELECT mask_id, unnest(range(0, 256)) AS i, unnest(px) AS v FROM w) SELECT mask_id, CAST(sum(v) AS INT) AS area, CAST(min(i // 16) FILTER (v = 1) AS INT) AS x, CAST(min(i % 16) FILTER (v = 1) AS INT) AS y,
      CAST(max(i // 16) FILTER (v = 1) - min(i // 16) FILTER (v = 1) + 1 AS INT) AS w, CAST(max(i % 16) FILTER (v = 1) - min(i % 16) FILTER (v = 1) + 1 AS INT) AS h FROM p GROUP BY 1""",
    "mask_wide_overlaps": f"WITH {_W} SELECT image_id, a, b, round(k / (an + bn - k), 6) AS iou, round(k / least(an, bn), 6) AS smaller, round(k / an, 6) AS held FROM o WHERE a < b",
    "mask_wide_dedupe": f"""WITH RECURSIVE {_W}, r AS (SELECT image_id, mask_id, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, mask_id) AS k FROM w),
      h AS (SELECT a AS mask_id, list(b) AS near FROM o WHERE k >= 0.34 * (an + bn - k) AND k > 0 GROUP BY 1),
      t AS (SELECT image_id, k, [mask_id] AS kept, mask_id, CAST(-1 AS BIGINT) AS sup FROM r WHERE k = 1 UNION ALL
        SELECT r.image_id, r.k, CASE WHEN f IS NULL THEN list_append(t.kept, r.mask_id) ELSE t.kept END, r.mask_id, coalesce(f, -1) FROM t JOIN r ON r.image_id = t.image_id AND r.k = t.k + 1 LEFT JOIN h ON h.mask_id = r.mask_id,
          LATERAL (SELECT list_filter(t.kept, lambda x: coalesce(list_contains(h.near, x), false))[1] AS f))
      SELECT image_id, mask_id, sup = -1 AS kept, sup AS suppressed_by FROM t""",
}
