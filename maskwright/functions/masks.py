"""Mask algebra.  A mask is a packed binary (little-endian bits of column-major pixels) with height and width; masks of up
to 64 pixels also fit one word, on which areas and overlaps are plain bit counts.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from .. import adapters as A
from .geometry import ratio


def unpack(data: bytes, height: int, width: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: height * width].astype(bool).reshape(width, height).T


def pack(mask: np.ndarray) -> bytes:
    return np.packbits(np.asarray(mask, bool).T.reshape(-1), bitorder="little").tobytes()


def bbox(mask: np.ndarray) -> tuple[int, int, int, int]:
    ys, xs = np.nonzero(mask)
    return (int(xs.min()), int(ys.min()), int(xs.max() - xs.min() + 1), int(ys.max() - ys.min() + 1)) if len(xs) else (0, 0, 0, 0)


def component_sizes(mask: np.ndarray) -> list[int]:
    """Sizes of 4-connected components: minimum labels spread to neighbours until nothing changes."""
    big = mask.size
    label = np.where(mask, np.arange(big).reshape(mask.shape), big)
    while True:
        wide = np.pad(label, 1, constant_values=big)
        least = np.minimum.reduce([wide[1:-1, 1:-1], wide[:-2, 1:-1], wide[2:, 1:-1], wide[1:-1, :-2], wide[1:-1, 2:]])
        new = np.where(mask, least, big)
        if (new == label).all():
            return np.unique(label[mask], return_counts=True)[1].tolist()
        label = new


def significant_components(mask: np.ndarray) -> int:
    """Components of at least max(8, a hundredth of the area); a single one always counts."""
    sizes = component_sizes(mask)
    return len(sizes) if len(sizes) <= 1 else sum(s >= max(8, int(mask.sum()) // 100) for s in sizes)


# What the internal codec says of itself.
CODEC = {"order": "F", "bitorder": "little", "encoding": "zlib-packbits-base64-v1"}


def encode_rle(mask: np.ndarray) -> dict:
    """The internal codec: packed bits, deflated, as text."""
    return {"size": list(mask.shape), "pixel_count": int(mask.size), **CODEC, "data": base64.b64encode(zlib.compress(pack(mask), 7)).decode()}


def decode_rle(rle: dict) -> np.ndarray:
    """A mask from the internal codec, in either bit and pixel order."""
    if rle.get("encoding", CODEC["encoding"]) != CODEC["encoding"]:
        raise ValueError(f"unknown mask encoding {rle['encoding']!r}")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(base64.b64decode(rle["data"])), np.uint8), bitorder=rle.get("bitorder") or "little")
    h, w = rle["size"]
    return bits[: int(rle.get("pixel_count", h * w))].astype(bool).reshape((h, w), order=rle.get("order") or "F")


def rle_to_coco(rle: dict) -> dict:
    mask = decode_rle(rle)
    return {"size": list(mask.shape), "counts": coco_counts(mask)}


def coco_counts(mask: np.ndarray) -> str:
    """Column-major runs from zero, differences to the run two before from the fourth on, in groups of five bits."""
    flat = np.asarray(mask, bool).T.reshape(-1)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flat]).astype(np.int8))) if len(flat) else np.zeros(0, int)
    runs = np.diff(np.concatenate([[0], edges, [len(flat)]])).tolist()
    out = []
    for i, run in enumerate(runs):
        x, more = run - runs[i - 2] if i > 2 else run, True
        while more:
            low, x = x & 31, x >> 5
            more = x != (-1 if low & 16 else 0)
            out.append(chr(48 + (low | 32 * more)))
    return "".join(out)


def coco_decode(counts: str, height: int, width: int) -> np.ndarray:
    runs, at = [], 0
    while at < len(counts):
        x = shift = 0
        while True:
            c = ord(counts[at]) - 48
            x, at = x | (c & 31) << shift, at + 1
            shift += 5
            if not c & 32:
                x -= (1 << shift) if c & 16 else 0
                break
        runs.append(x + (runs[-2] if len(runs) > 2 else 0))
    return np.repeat(np.arange(len(runs)) % 2 == 1, runs).reshape(width, height).T


def _word_mask(bits: int, side: int = 8) -> np.ndarray:
    return unpack(int(bits).to_bytes(8, "little", signed=True), side, side)


@F.pandas_udf(IntegerType())
def components_of_word(bits: pd.Series) -> pd.Series:
    return bits.map(lambda b: len(component_sizes(_word_mask(b)))).astype("int32")


@F.pandas_udf(StringType())
def coco_of_word(bits: pd.Series) -> pd.Series:
    return bits.map(lambda b: coco_counts(_word_mask(b)))


def area(bits: Column) -> Column:
    return F.bit_count(bits)


def overlap(a: Column, b: Column) -> tuple[Column, Column]:
    """IoU and the intersection's part of the smaller mask; 0 for empty ones."""
    inter = F.bit_count(a.bitwiseAND(b))
    return ratio(inter, F.bit_count(a.bitwiseOR(b))), ratio(inter, F.least(F.bit_count(a), F.bit_count(b)))


def word_bbox(bits: Column, side: int = 8) -> Column:
    """Bounding box of a word mask by bit tests: x = bit div side, y = bit % side."""
    on = F.filter(F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda i: F.when(F.call_function("shiftright", bits, i).bitwiseAND(F.lit(1)) == 1, i)), lambda i: i.isNotNull())
    xs, ys = F.transform(on, lambda i: F.floor(i / side).cast("int")), F.transform(on, lambda i: (i % side).cast("int"))
    z = F.lit(0)
    return F.struct(F.coalesce(F.array_min(xs), z).alias("x"), F.coalesce(F.array_min(ys), z).alias("y"), F.coalesce(F.array_max(xs) - F.array_min(xs) + 1, z).alias("w"), F.coalesce(F.array_max(ys) - F.array_min(ys) + 1, z).alias("h"))


def color_for_index(index: int) -> tuple[int, int, int]:
    """Golden-ratio hues."""
    import colorsys

    return tuple(int(255 * c) for c in colorsys.hsv_to_rgb((index * 0.61803398875) % 1.0, 0.75, 1.0))


# Fill colours to choose from, luma factors, and what a colour's distances to the foreground weigh.
FILLS = ((0, 0, 0), (255, 255, 255), (255, 0, 0), (0, 255, 0), (0, 0, 255), (255, 255, 0), (0, 255, 255), (255, 0, 255), (255, 96, 0), (96, 0, 255))
LUMA = (0.2126, 0.7152, 0.0722)
FILL_WEIGHTS = {"distance_q10": 0.50, "distance_q25": 0.22, "distance_mean": 0.18, "luma_contrast": 0.10, "near_fraction": -80.0}


def inverse_background(pixels: np.ndarray, most: int = 32_768, near: float = 48.0) -> dict:
    """The fill colour that a foreground (RGB pixels) has least near it, with its facts; FILLS and the foreground's complements compete.

    More than `most` pixels are sampled at even steps.  No pixels: black with score 0.  Ties: the larger colour.
    """
    px = np.asarray(pixels, np.float32).reshape(-1, 3)
    if not len(px):
        return {"rgb": [0, 0, 0], "score": 0.0, "foreground_median_rgb": [0, 0, 0], "foreground_mean_rgb": [0, 0, 0], "foreground_sample_count": 0}
    if len(px) > most:
        px = px[np.linspace(0, len(px) - 1, most, dtype=np.int64)]
    whole = lambda x: tuple(np.clip(x, 0, 255).round().astype(int).tolist())
    centre, mean = np.median(px, axis=0), px.mean(axis=0)
    fills = np.array(list(dict.fromkeys([*FILLS, whole(255.0 - centre), whole(255.0 - mean)])), np.float32)
    dist = np.linalg.norm(px[:, None] - fills[None], axis=2)  # pixel, colour
    luma = np.array(LUMA, np.float32)
    facts = {
        "distance_q10": np.quantile(dist, 0.10, axis=0), "distance_q25": np.quantile(dist, 0.25, axis=0), "distance_mean": dist.mean(axis=0),
        "luma_contrast": np.abs(fills @ luma - np.median(px @ luma)), "near_fraction": (dist < near).mean(axis=0),
    }
    score = sum(w * facts[k].astype(float) for k, w in FILL_WEIGHTS.items())
    best = max(range(len(fills)), key=lambda i: (score[i], tuple(fills[i])))
    return {
        "rgb": fills[best].astype(int).tolist(), "score": float(score[best]), "foreground_median_rgb": list(whole(centre)), "foreground_mean_rgb": list(whole(mean)),
        "foreground_sample_count": len(px), **{k: float(v[best]) for k, v in facts.items()},
    }


def _pairs(s, d) -> DataFrame:
    m = A.masks(s, d)
    a, b = m.select("subject", F.col("mask_id").alias("a"), F.col("bits").alias("ab")), m.select("subject", F.col("mask_id").alias("b"), F.col("bits").alias("bb"))
    iou, small = overlap(F.col("ab"), F.col("bb"))
    return a.join(b, "subject").filter("a < b").select("a", "b", iou.alias("iou"), small.alias("held")).filter("iou >= 0.45")


def _facts(s, d):
    return A.masks(s, d).select("mask_id", area(F.col("bits")).alias("area"), word_bbox(F.col("bits")).alias("b")).select("mask_id", "area", "b.x", "b.y", "b.w", "b.h")


_N = "list_sum(list_transform(range(1, 65), lambda i: a.px[i] * b.px[i]))"
_U = "list_sum(list_transform(range(1, 65), lambda i: greatest(a.px[i], b.px[i])))"
QUERIES = {
    "mask_facts": _facts,
    "mask_overlaps": lambda s, d: _pairs(s, d).select("a", "b", F.round("iou", 6).alias("iou"), F.round("held", 6).alias("held")),
    "mask_components": lambda s, d: A.masks(s, d).select("mask_id", components_of_word("bits").alias("components")),
    "mask_coco_counts": lambda s, d: A.masks(s, d).select("mask_id", coco_of_word("bits").alias("counts")),
}
ORACLES = {
    "mask_facts": f"""WITH {A.MASKS}, p AS (SELECT mask_id, unnest(px) AS v, generate_subscripts(px, 1) - 1 AS i FROM masks)
      SELECT mask_id, CAST(sum(v) AS INT) AS area, CAST(coalesce(min(i // 8) FILTER (v = 1), 0) AS INT) AS x, CAST(coalesce(min(i % 8) FILTER (v = 1), 0) AS INT) AS y,
      CAST(coalesce(max(i // 8) FILTER (v = 1) - min(i // 8) FILTER (v = 1) + 1, 0) AS INT) AS w, CAST(coalesce(max(i % 8) FILTER (v = 1) - min(i % 8) FILTER (v = 1) + 1, 0) AS INT) AS h FROM p GROUP BY 1""",
    "mask_overlaps": f"""WITH {A.MASKS}, o AS (SELECT a.mask_id AS a, b.mask_id AS b, {_N} AS n, {_U} AS u, least(list_sum(a.px), list_sum(b.px)) AS m FROM masks a JOIN masks b ON a.subject = b.subject AND a.mask_id < b.mask_id)
      SELECT a, b, round(n / u, 6) AS iou, round(coalesce(n / nullif(m, 0), 0), 6) AS held FROM o WHERE n / u >= 0.45""",
    "mask_coco_counts": f"""WITH {A.MASKS}, p AS (SELECT mask_id, px[i] AS v, i, coalesce(px[i - 1], 0) AS b FROM (SELECT mask_id, px, unnest(range(1, 65)) AS i FROM masks)),
      e AS (SELECT mask_id, i - 1 AS z FROM p WHERE v <> b UNION ALL SELECT mask_id, 64 FROM masks),
      r AS (SELECT mask_id, z - coalesce(lag(z) OVER w, 0) AS n, row_number() OVER w AS k FROM e WINDOW w AS (PARTITION BY mask_id ORDER BY z)),
      d AS (SELECT mask_id, k, n - CASE WHEN k > 3 THEN lag(n, 2) OVER (PARTITION BY mask_id ORDER BY k) ELSE 0 END AS x FROM r),
      c AS (SELECT mask_id, k, CASE WHEN x BETWEEN -16 AND 15 THEN chr(48 + CAST(x & 31 AS INT)) ELSE chr(48 + 32 + CAST(x & 31 AS INT)) || chr(48 + CAST((x >> 5) & 31 AS INT)) END AS t FROM d)
      SELECT mask_id, string_agg(t, '' ORDER BY k) AS counts FROM c GROUP BY 1""",
    "mask_components": f"""WITH RECURSIVE {A.MASKS}, p AS (SELECT mask_id, i - 1 AS i FROM masks, range(1, 65) r(i) WHERE px[i] = 1),
      e AS (SELECT a.mask_id, a.i AS u, b.i AS v FROM p a JOIN p b ON a.mask_id = b.mask_id AND abs(a.i // 8 - b.i // 8) + abs(a.i % 8 - b.i % 8) <= 1),
      r(mask_id, u, v) AS (SELECT mask_id, u, v FROM e UNION SELECT r.mask_id, r.u, e.v FROM r JOIN e ON e.mask_id = r.mask_id AND e.u = r.v),
      l AS (SELECT mask_id, u, min(v) AS c FROM r GROUP BY 1, 2) SELECT m.mask_id, CAST(count(DISTINCT c) AS INT) AS components FROM masks m LEFT JOIN l USING (mask_id) GROUP BY 1""",
}
