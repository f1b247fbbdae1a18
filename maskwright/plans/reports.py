"""Reports: the funnel with its reasons, pages of captions with their links, run metadata, prompts, the model canary."""

from __future__ import annotations

import hashlib
import html
import json
import platform
import time
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import adapters as A
from ..functions.jsonx import salvaged
from ..functions.text import not_gibberish
from ..operators.providers import answered
from ..shared import text_slices


def funnel(sources: DataFrame, reviews: DataFrame, masks: DataFrame, rejected: DataFrame, captions: DataFrame, final: DataFrame) -> DataFrame:
    """(place, stage, value, detail): counts of the stages, reject reasons from the commonest on, and the final rate."""
    n = lambda df, place, stage, detail="": df.agg(F.lit(place).alias("place"), F.lit(stage).alias("stage"), F.count(F.lit(1)).cast("double").alias("value"), F.lit(detail).alias("detail"))
    reasons = rejected.groupBy(F.coalesce(F.nullif("reject_reason", F.lit("")), F.lit("unknown")).alias("r")).agg(F.count(F.lit(1)).alias("n"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "r"))), lambda x: F.concat(x["r"], F.lit("="), (-x["k"]).cast("string"))), ", ")  # a row a reason
    gone = reasons.agg(F.lit(4).alias("place"), F.lit("rejected masks").alias("stage"), F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("value"), F.when(F.count(F.lit(1)) == 0, "none").otherwise(text).alias("detail"))
    ids = final.select("image_id").distinct().withColumn("_f", F.lit(1))
    rate = sources.select("image_id").join(ids, "image_id", "left").agg(F.lit(7).alias("place"), F.lit("final rate").alias("stage"), F.coalesce(F.count("_f") / F.nullif(F.count(F.lit(1)), F.lit(0)), F.lit(0.0)).alias("value"), F.lit("final images / selected images").alias("detail"))
    rows = [n(sources, 0, "selected images"), n(reviews.filter("accepted"), 1, "initial accepted"), n(reviews.filter("NOT accepted"), 2, "initial rejected"), n(masks, 3, "kept masks"), gone, n(captions, 5, "captions"), n(final, 6, "final images"), rate]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def caption_html(caption: str, links: list[tuple[int, int, int]]) -> str:
    """A caption in HTML: each stretch between span boundaries (id, start, end) carries the ids that cover it."""
    change: dict[int, list[tuple[int, int]]] = {0: [], len(caption): []}
    for i, s, e in links:
        change.setdefault(s, []).append((i, 1))
        change.setdefault(e, []).append((i, -1))
    cuts, open_ids, out = sorted(change), Counter(), []
    for a, b in zip(cuts, cuts[1:], strict=False):
        for i, d in change[a]:
            open_ids[i] += d
            if not open_ids[i]:
                del open_ids[i]
        text = html.escape(caption[a:b])
        out.append(f'<span class="link" data-ids="{",".join(map(str, sorted(open_ids)))}">{text}</span>' if open_ids else text)
    return "".join(out)


@F.arrow_udf(StringType())
def caption_markup(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for captions, links in batches:
        for at, n in text_slices(captions):
            some = links.slice(at, n)
            flat = some.flatten()
            every, each = list(zip(*(flat.field(k).to_pylist() for k in ("id", "start", "end")), strict=True)), pc.fill_null(pc.list_value_length(some), 0).to_pylist()
            ends = list(accumulate(each))
            yield pa.array([caption_html(c or "", every[e - k : e]) for c, k, e in zip(captions.slice(at, n).to_pylist(), each, ends, strict=True)], pa.string())


@F.arrow_udf(StringType())
def tagged_markup(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The markup of tagged captions, without their links as a column on the way."""
    from ..operators.spans import _parsed

    for tagged in batches:
        for at, n in text_slices(tagged):
            yield pa.array([caption_html(*_parsed(t or "")[:2]) for t in tagged.slice(at, n).to_pylist()], pa.string())


def page(title: str, tables: dict[str, DataFrame], most: int = 1_000) -> str:
    """An HTML page of small tables; a table shows its first `most` rows and says so where it has more."""
    body = []
    for name, df in tables.items():
        rows = df.limit(most + 1).collect()
        head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
        lines = "".join("<tr>" + "".join(f"<td>{html.escape(str(v)) if v is not None else ''}</td>" for v in r) + "</tr>" for r in rows[:most])
        body.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{lines}</table>" + (f"<p>first {most} rows</p>" if len(rows) > most else ""))
    return f'<!doctype html><html><head><meta charset="utf-8"><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>{"".join(body)}</body></html>'


def gallery(title: str, rows: DataFrame, most: int = 1_000) -> str:
    """A page of images with their linked captions; rows: image_id, caption, links, image (a path or data address)."""
    some = rows.select("image_id", "image", caption_markup("caption", "links").alias("m")).limit(most + 1).collect()
    cards = "".join(f'<figure id="{html.escape(r["image_id"])}"><img loading="lazy" src="{html.escape(r["image"] or "")}"><figcaption>{r["m"]}</figcaption></figure>' for r in some[:most])
    more = f"<p>first {most} images</p>" if len(some) > most else ""
    return f'<!doctype html><html><head><meta charset="utf-8"><title>{html.escape(title)}</title></head><body>{cards}{more}</body></html>'


def run_metadata(config: dict, **facts) -> dict:
    """What a run was made with: versions, a digest of its configuration, and when."""
    import pyspark

    text = json.dumps(config, sort_keys=True, ensure_ascii=False)
    return {"created_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "python": platform.python_version(), "spark": pyspark.__version__, "config_sha256": hashlib.sha256(text.encode()).hexdigest(), "config": config, **facts}


def prompts(template: str, context: dict[str, Column]) -> Column:
    """A prompt: each {key} becomes the value, as JSON unless it is a text."""
    out = F.lit(template)
    for key, value in context.items():
        out = F.replace(out, F.lit("{" + key + "}"), value)
    return out


def canary(requests: DataFrame, backend: str, keys: list[str], prompt: str = "prompt", key: str = "image_id") -> DataFrame:
    """Whether a backend's answers can be used: key, parsed, complete (has all keys), plain (no gibberish), ok."""
    a = answered(requests, backend, key, prompt).withColumn("_j", salvaged("answer"))
    has = F.size(F.array_except(F.array(*map(F.lit, keys)), F.coalesce(F.json_object_keys("_j"), F.array()))) == 0
    parsed, plain = F.col("_j").isNotNull(), F.coalesce(not_gibberish(F.col("answer")), F.lit(False))
    return a.select(key, parsed.alias("parsed"), (parsed & has).alias("complete"), plain.alias("plain"), (parsed & has & plain).alias("ok"))


def require_canary(checked: DataFrame) -> None:
    """Raises where an answer can't be used."""
    bad = checked.filter("NOT ok").limit(3).collect()
    if bad:
        raise RuntimeError(f"the backend's answers can't be used: {[r.asDict() for r in bad]}")


def _funnel(s, d):
    masks = A.table(s, d, "conversations").select(F.col("conv_id").cast("string").alias("image_id"))
    bad = A.reviews(s, d).filter("NOT accepted").select("reject_reason")
    return funnel(A.sources(s, d), A.reviews(s, d), masks, bad, A.audits(s, d), A.audits(s, d).filter("parseable")).select("place", "stage", F.round("value", 6).alias("value"), "detail")


def _markup(s, d):
    from ..operators.spans import _tagged

    return _tagged(s, d).select("image_id", tagged_markup("tagged").alias("m")).select("image_id", F.size(F.split("m", '<span class="link"')).alias("pieces"), F.length(F.regexp_replace("m", "<[^>]*>", "")).alias("length"))


def _prompts(s, d):
    t = prompts("Image {id}: {facts}\n{text}", {"id": F.col("image_id"), "facts": F.to_json(F.struct("source_split", "n_chars")), "text": F.col("text")})
    docs = A.table(s, d, "documents").select(F.col("doc_id").cast("string").alias("image_id"), "text")
    return A.sources(s, d).join(docs, "image_id").select("image_id", F.sha2(t, 256).alias("prompt_sha256"))


from ..operators.spans import _T as _TAGS  # noqa: E402

QUERIES = {
    "report_funnel": _funnel,
    "report_markup": _markup,
    "report_prompts": _prompts,
    "report_canary": lambda s, d: canary(A.sources(s, d).withColumn("prompt", F.col("source_pair_key")), "mock-review", ["image_type", "sam3_prompts"]),
}
ORACLES = {
    "report_funnel": f"""WITH {A.SOURCES}, {A.REVIEWS}, {A.AUDITS}, b AS (SELECT coalesce(nullif(reject_reason, ''), 'unknown') AS r, count(*) AS n FROM reviews WHERE NOT accepted GROUP BY 1)
      SELECT 0 AS place, 'selected images' AS stage, CAST(count(*) AS DOUBLE) AS value, '' AS detail FROM sources UNION ALL SELECT 1, 'initial accepted', count(*), '' FROM reviews WHERE accepted UNION ALL SELECT 2, 'initial rejected', count(*), '' FROM reviews WHERE NOT accepted
      UNION ALL SELECT 3, 'kept masks', count(*), '' FROM conversations UNION ALL SELECT 4, 'rejected masks', coalesce(sum(n), 0), coalesce(string_agg(r || '=' || n, ', ' ORDER BY n DESC, r), 'none') FROM b
      UNION ALL SELECT 5, 'captions', count(*), '' FROM audits UNION ALL SELECT 6, 'final images', count(*), '' FROM audits WHERE parseable UNION ALL SELECT 7, 'final rate', round((SELECT count(*) FROM audits WHERE parseable) / (SELECT count(*) FROM sources), 6), 'final images / selected images'""",
    "report_markup": f"""WITH {_TAGS}, n AS (SELECT image_id, count(*) AS k, sum(length(raw) + 1) - 1 AS length FROM q GROUP BY 1) SELECT image_id, CAST(4 * k + 1 AS INT) AS pieces, CAST(length AS INT) AS length FROM n""",
    "report_prompts": f"""WITH {A.SOURCES} SELECT image_id, sha256('Image ' || image_id || ': {{"source_split":"' || source_split || '","n_chars":' || s.n_chars || '}}' || chr(10) || text) AS prompt_sha256 FROM sources s JOIN documents d ON CAST(d.doc_id AS VARCHAR) = image_id""",
    "report_canary": f"WITH {A.SOURCES} SELECT image_id, true AS parsed, true AS complete, true AS plain, true AS ok FROM sources",
}
