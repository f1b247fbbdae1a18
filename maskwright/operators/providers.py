"""The model boundary: providers are injected functions; everything around them is ours.

A provider maps a list of requests to a list of answers.  Stages run it once per process over Arrow batches, reuse stored
answers, isolate failing inputs, and halve batches that are too large.  The deterministic stand-ins need no model.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import adapters as A

Provider = Callable[[list[str]], list[str]]


class TooLarge(RuntimeError):
    """A provider's sign that the batch doesn't fit."""


def halving(provider: Provider, start: int = 32) -> Provider:
    """Splits batches that are too large and remembers the size that worked."""
    safe = [start]

    def run(requests: list[str]) -> list[str]:
        out: list[str] = []
        while len(out) < len(requests):
            part = requests[len(out) : len(out) + safe[0]]
            try:
                out += provider(part)
            except TooLarge:
                if len(part) == 1:
                    raise
                safe[0] = max(1, len(part) // 2)
        return out

    return run


def isolating(provider: Provider, error: Callable[[Exception], str] = lambda e: json.dumps({"error": str(e)})) -> Provider:
    """A failing batch is tried one by one; what still fails becomes an error answer, so every request has one."""

    def one(request: str) -> str:
        try:
            return provider([request])[0]
        except Exception as e:  # noqa: BLE001
            return error(e)

    def run(requests: list[str]) -> list[str]:
        try:
            return provider(requests)
        except Exception:  # noqa: BLE001
            return [one(r) for r in requests]

    return run


def mock_review(requests: list[str]) -> list[str]:
    """A stand-in for image review: decided by a digest of the request."""
    out = []
    for r in requests:
        h = int(hashlib.sha256(r.encode()).hexdigest()[:8], 16)
        out.append(json.dumps({"worth_segmenting": h % 5 != 0, "estimated_maskable_entities": 8 + h % 20, "image_type": "photo", "rationale": "stand-in", "sam3_prompts": ["people", "chairs"]}))
    return out


def mock_caption(requests: list[str]) -> list[str]:
    return [json.dumps({"object": r.split(" ")[0], "caption": f"A {r}.", "attributes": ["plain"], "uncertain": False}) for r in requests]


def mock_mask_review(requests: list[str]) -> list[str]:
    """A stand-in for the review of captions: a quarter isn't kept, another gets a new object."""
    out = []
    for r in requests:
        h = int(hashlib.sha256(r.encode()).hexdigest()[:8], 16) % 4
        out.append(json.dumps({"keep": h != 0, "reason": "fits" if h else "not the mask", "failure_modes": [], "corrected_object": "thing" if h == 1 else ""}))
    return out


def mock_segments(requests: list[str]) -> list[str]:
    """A stand-in for a segmenter: for each request (image and prompt) none to three masks, decided by a digest."""
    out = []
    for r in requests:
        h = int(hashlib.sha256(r.encode()).hexdigest()[:8], 16)
        out.append(json.dumps([{"bbox": [h % 50 + k, h % 40, 10 + k, 12], "area": 60 + k, "score": round(0.5 + (h % 40) / 100 + k / 1000, 3)} for k in range(h % 4)]))
    return out


FACTORY: dict[str, Callable[[], Provider]] = {"mock-review": lambda: mock_review, "mock-caption": lambda: mock_caption, "mock-segments": lambda: mock_segments, "mock-mask-review": lambda: mock_mask_review}


def create(name: str) -> Provider:
    """The provider of a backend name."""
    if name not in FACTORY:
        raise ValueError(f"no provider {name!r}; known: {sorted(FACTORY)}")
    return FACTORY[name]()


def answered(requests: DataFrame, backend: str, key: str, prompt: str, stored: DataFrame | None = None, batch: int = 32) -> DataFrame:
    """Adds `answer`: the stored one, or the provider's where there is none (a stored answer is never asked for again)."""
    asked = requests
    if stored is not None:
        asked = requests.join(stored.select(key, F.col("answer").alias("_stored")), key, "left")
        done = asked.filter("_stored IS NOT NULL").withColumnRenamed("_stored", "answer")
        asked = asked.filter("_stored IS NULL").drop("_stored")

    @F.pandas_udf("string")
    def ask(prompts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        provider = isolating(halving(create(backend), batch))
        for p in prompts:
            yield pd.Series(provider(p.fillna("").tolist()))

    out = asked.withColumn("answer", ask(prompt))
    return out if stored is None else done.unionByName(out)


MASKS = "array<struct<bbox:array<int>,area:int,score:double>>"


def segmented(requests: DataFrame, backend: str, least: float = 0.0, batch: int = 32) -> DataFrame:
    """Masks of each image's prompts: image_id, prompt, raw_index (in order of prompt, then answer), bbox, area, score; none where a
    prompt finds nothing.  Batches that are too large are split, and a request that fails alone yields no mask but an `error`.
    requests: image_id, prompts (array).
    """
    asked = requests.select("image_id", F.posexplode("prompts").alias("at", "prompt")).withColumn("_r", F.concat_ws("\t", "image_id", "prompt"))
    found = answered(asked, backend, "image_id", "_r", batch=batch).withColumn("m", F.from_json("answer", MASKS)).withColumn("error", F.get_json_object("answer", "$.error"))
    rows = found.select("image_id", "prompt", "at", "error", F.posexplode_outer(F.filter(F.coalesce("m", F.array().cast(MASKS)), lambda x: x["score"] >= least)).alias("k", "m")).filter("m IS NOT NULL OR error IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("image_id").orderBy("at", "k")) - 1
    return rows.select("image_id", "prompt", place.alias("raw_index"), "m.bbox", "m.area", "m.score", "error")


def routed(rows: DataFrame, accepted: str = "accepted") -> tuple[DataFrame, DataFrame]:
    """A stage's accepted and rejected rows."""
    return rows.filter(F.col(accepted)), rows.filter(~F.col(accepted))


def require_emission(given: DataFrame, emitted: DataFrame) -> None:
    """A stage that got rows and gave none has failed."""
    if emitted.isEmpty() and not given.isEmpty():
        raise RuntimeError("the stage had input and emitted nothing")


def review_stage(sources: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Exactly one review a source: size rejects never reach the model."""
    from ..functions.jsonx import review

    small = sources.withColumn("small", F.col("n_chars") < 200)
    asked = answered(small.filter("NOT small"), "mock-review", "image_id", "image_id", stored)
    r = asked.select("image_id", review(F.col("answer")).alias("r")).select("image_id", "r.accepted", "r.reject_reason")
    return r.unionByName(small.filter("small").select("image_id", F.lit(False).alias("accepted"), F.lit("image_pixels_below_200").alias("reject_reason")))


def _segments(s, d):
    asked = A.sources(s, d).select("image_id", F.array(F.lit("people"), F.col("source_dataset"), F.lit("chairs")).alias("prompts"))
    return segmented(asked, "mock-segments", 0.6).select("image_id", "prompt", "raw_index", F.array_join("bbox", ",").alias("bbox"), "area", F.round("score", 6).alias("score"))


QUERIES = {"stage_review": lambda s, d: review_stage(A.sources(s, d)), "stage_segments": _segments}
ORACLES = {
    "stage_segments": f"""WITH {A.SOURCES}, p AS (SELECT image_id, unnest(['people', source_dataset, 'chairs']) AS prompt, unnest(range(0, 3)) AS z FROM sources), h AS (SELECT *, CAST('0x' || left(sha256(image_id || chr(9) || prompt), 8) AS BIGINT) AS h FROM p),
      m AS (SELECT image_id, prompt, z, h, unnest(range(0, h % 4)) AS k FROM h), t AS (SELECT *, round(0.5 + (h % 40) / 100 + k / 1000, 3) AS score FROM m)
      SELECT image_id, prompt, CAST(row_number() OVER (PARTITION BY image_id ORDER BY z, k) - 1 AS INT) AS raw_index, (h % 50 + k) || ',' || h % 40 || ',' || (10 + k) || ',12' AS bbox, CAST(60 + k AS INT) AS area, round(score, 6) AS score FROM t WHERE score >= 0.6""",
    "stage_review": f"""WITH {A.SOURCES}, h AS (SELECT image_id, n_chars < 200 AS small, CAST('0x' || left(sha256(image_id), 8) AS BIGINT) AS h FROM sources),
      r AS (SELECT image_id, CASE WHEN small THEN 'image_pixels_below_200' WHEN h % 5 = 0 THEN 'not_worth_segmenting' WHEN 8 + h % 20 < 10 THEN 'too_few_objects' ELSE '' END AS reject_reason FROM h)
      SELECT image_id, reject_reason = '' AS accepted, reject_reason FROM r"""
}
