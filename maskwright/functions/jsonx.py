"""JSON out of model text: salvage, repair, schema checks, never-fail normalisation."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import adapters as A

_FENCE = re.compile(r"^\s*```[A-Za-z]*\s*|\s*```\s*$")
_DECODER = json.JSONDecoder()


def closed(tail: str, most: int = 2) -> dict | None:
    """A truncated object with its one or two open containers closed; None where that can't be (inside a string, mismatched)."""
    stack, text, escape = [], False, False
    for c in tail:
        if text:
            escape, text = (c == "\\" and not escape), text if escape or c != '"' else False
        elif c == '"':
            text = True
        elif c in "{[":
            stack.append("}" if c == "{" else "]")
        elif c in "}]" and (not stack or stack.pop() != c):
            return None
    if text or not 1 <= len(stack) <= most or stack[0] != "}":
        return None
    try:
        found = json.loads(tail.rstrip() + "".join(reversed(stack)))
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def salvage(text: str) -> dict | None:
    """The whole text if it is an object; else the object that ends last (the earliest start of these); a repaired tail ends after all."""
    text = _FENCE.sub("", text or "")
    try:
        whole = json.loads(text)
        if isinstance(whole, dict):
            return whole
    except ValueError:
        pass
    best: tuple[tuple[int, int], dict] | None = None
    for m in re.finditer(r"\{", text):
        i = m.start()
        try:
            found, end = _DECODER.raw_decode(text, i)
        except ValueError:
            found, end = closed(text[i:]), len(text) + 1
        if isinstance(found, dict) and (best is None or (end, -i) > best[0]):
            best = (end, -i), found
    return best[1] if best else None


@F.pandas_udf(StringType())
def salvaged(texts: pd.Series) -> pd.Series:
    """The salvaged object as canonical text (sorted keys), null if there is none."""
    one = lambda t: None if (f := salvage(t)) is None else json.dumps(f, sort_keys=True, ensure_ascii=False)
    return texts.map(one)


def portable(value):
    """Absolute paths anywhere inside become base names."""
    if isinstance(value, dict):
        return {k: portable(v) for k, v in value.items()}
    if isinstance(value, list):
        return [portable(v) for v in value]
    return value.rsplit("/", 1)[-1] if isinstance(value, str) and value.startswith("/") else value


@F.pandas_udf(StringType())
def portable_text(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else json.dumps(portable(json.loads(t)), sort_keys=True, ensure_ascii=False))


# Lists of a visual audit and what stands for one that can't be read.
SEVERITIES, DECISIONS = ("fatal", "rewrite", "style"), ("keep", "drop", "add_if_natural")
UNREADABLE = {
    "audit_unparseable": ("The audit response was unparseable; the rewrite must independently recheck the draft.", "Recheck the full visual packet and rulebook independently."),
    "audit_wrong_json_shape": ("The audit response had the wrong JSON shape; the rewrite must independently recheck the draft.", "Recheck the full visual packet and rulebook independently."),
}
REBUILD = "Independently rebuild a valid natural tagged caption."
AUDIT = "audit_parseable boolean, audit_parse_error string, audit_pass boolean, task_accuracy_percent double, summary string, issues array<struct<code:string,severity:string,caption_evidence:string,mask_ids:array<int>,explanation:string,rewrite_instruction:string>>, mask_decisions array<struct<id:int,decision:string,reason:string>>, rewrite_plan string"


def visual_audit(raw: str, masks: int) -> dict:
    """A visual audit in normal form; it never fails: what can't be read is a failed audit with one finding that asks for a rewrite.

    Severities and decisions outside the lists become rewrite and drop, mask numbers out of 1..masks go, accuracy lies in 0..100.
    """
    found = salvage(raw or "")
    if not isinstance(found, dict):
        code = "audit_unparseable" if found is None else "audit_wrong_json_shape"
        summary, todo = UNREADABLE[code]
        issue = {"code": code, "severity": "rewrite", "caption_evidence": "", "mask_ids": [], "explanation": "no JSON object in the answer", "rewrite_instruction": todo}
        return {"audit_parseable": False, "audit_parse_error": "no JSON object in the answer", "audit_pass": False, "task_accuracy_percent": 0.0, "summary": summary, "issues": [issue], "mask_decisions": [], "rewrite_plan": REBUILD}
    text = lambda x, k, other="": str(x.get(k) or other)
    pick = lambda value, known, other: value if value in known else other
    objects = lambda k: [x for x in found.get(k) or [] if isinstance(x, dict)]
    number = lambda v: isinstance(v, (int, float)) and 1 <= int(v) <= masks

    def link(x) -> int:
        try:
            return int(x.get("id"))
        except (TypeError, ValueError):
            return 0

    try:
        accuracy = float(found.get("task_accuracy_percent") or 0.0)
    except (TypeError, ValueError):
        accuracy = 0.0
    return {
        "audit_parseable": True, "audit_parse_error": "", "audit_pass": found.get("audit_pass") is True, "task_accuracy_percent": min(100.0, max(0.0, accuracy)), "summary": text(found, "summary"),
        "issues": [
            {
                "code": text(x, "code", "model_audit_finding"), "severity": pick(text(x, "severity", "rewrite"), SEVERITIES, "rewrite"), "caption_evidence": text(x, "caption_evidence"),
                "mask_ids": [int(v) for v in x.get("mask_ids") or [] if number(v)], "explanation": text(x, "explanation"), "rewrite_instruction": text(x, "rewrite_instruction"),
            }
            for x in objects("issues")
        ],
        "mask_decisions": [{"id": link(x), "decision": pick(text(x, "decision", "drop"), DECISIONS, "drop"), "reason": text(x, "reason")} for x in objects("mask_decisions") if 1 <= link(x) <= masks],
        "rewrite_plan": text(found, "rewrite_plan"),
    }


@F.pandas_udf(StringType())
def _audit_text(texts: pd.Series, masks: pd.Series) -> pd.Series:
    return pd.Series([json.dumps(visual_audit(t, int(m)), ensure_ascii=False) for t, m in zip(texts, masks, strict=True)])


def audit(text: Column, masks: Column) -> Column:
    """struct as AUDIT of a model's text about `masks` masks."""
    return F.from_json(_audit_text(text, masks), AUDIT)


# The keys that make up what an answer says.
CONTENT = ("keep", "reject", "tagged_caption", "caption", "links", "groups")


@F.pandas_udf(StringType())
def fingerprint(texts: pd.Series) -> pd.Series:
    """What an answer says, as canonical text: answers that differ in other keys only are alike."""

    def one(t: str | None) -> str | None:
        found = salvage(t or "")
        return json.dumps({k: found[k] for k in CONTENT if k in found}, ensure_ascii=False, sort_keys=True, separators=(",", ":")) if isinstance(found, dict) else None

    return texts.map(one)


def closed_keys(text: Column, allowed: list[str]) -> Column:
    """Whether an object has no key but the allowed ones."""
    return F.size(F.array_except(F.coalesce(F.json_object_keys(text), F.array()), F.array(*map(F.lit, allowed)))) == 0


def review(text: Column, minimum: int = 10, borderline: int = 24, reject_types: tuple[str, ...] = ("diagram", "screenshot", "text"), reject_terms: tuple[str, ...] = ("blurry", "collage")) -> Column:
    """Ordered accept/reject decision on an image review; prompts are texts or objects, each once, blank unless accepted."""
    kind = "worth_segmenting BOOLEAN, estimated_maskable_entities INT, estimated_distinct_objects INT, image_type STRING, rationale STRING, reject_reason STRING, sam3_prompts ARRAY<STRING>"
    j = F.from_json(text, kind)
    prompt = lambda p: F.left(F.trim(F.regexp_replace(F.coalesce(F.get_json_object(p, "$.prompt"), p), r"\s+", " ")), F.lit(120))
    prompts = F.array_distinct(F.filter(F.transform(F.coalesce(j["sam3_prompts"], F.array()), prompt), lambda p: p != ""))
    n = F.coalesce(F.nullif(j["estimated_maskable_entities"], F.lit(0)), j["estimated_distinct_objects"], F.lit(0))
    has = lambda c, words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(F.coalesce(c, F.lit(""))), w))
    reason = (
        F.when(has(j["image_type"], reject_types), "reject_type").when(~F.coalesce(j["worth_segmenting"], F.lit(False)), "not_worth_segmenting").when(n < minimum, "too_few_objects")
        .when(F.size(prompts) == 0, "missing_sam3_prompts").when((n <= borderline) & has(j["rationale"], reject_terms), "borderline_rationale").otherwise("")
    )
    shown = F.when(reason == "", "").otherwise(F.coalesce(F.nullif(j["reject_reason"], F.lit("")), reason))
    return F.struct((reason == "").alias("accepted"), shown.alias("reject_reason"), n.alias("estimated"), F.when(reason == "", prompts).otherwise(F.array()).alias("prompts"))


def _texts(s, d) -> DataFrame:
    e = A.table(s, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    obj = F.concat(F.lit('{"k": '), F.col("k").cast("string"), F.lit(', "in": {"a": [1, 2]}}'))
    m = F.col("event_id") % 5
    return e.select("event_id", "k", F.when(m == 0, obj).when(m == 1, F.concat(F.lit("```json\n"), obj, F.lit("\n```"))).when(m == 2, F.concat(F.lit('note {"x": 1} then '), obj, F.lit(" end"))).when(m == 3, F.expr("substring(concat('so: {\"k\": ', k, ', \"in\": {\"a\": [1, 2]}}'), 1, length(concat('so: {\"k\": ', k, ', \"in\": {\"a\": [1, 2]}}')) - 1)")).otherwise("nothing here").alias("raw"))


def _audits(s, d):
    e = A.table(s, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    t = F.when(F.col("event_id") % 7 == 0, "not json").otherwise(
        F.format_string('so {"audit_pass": %s, "task_accuracy_percent": %s, "issues": [{"severity": "%s", "mask_ids": [%s, "x", 99]}, 5], "mask_decisions": [{"id": %s, "decision": "%s"}, {"id": "z"}], "rewrite_plan": "p"}',
                        (F.col("k") % 2 == 0).cast("string"), (F.col("k") * 3 - 20).cast("string"), F.when(F.col("k") % 3 == 0, "odd").otherwise("style"), (F.col("k") % 9).cast("string"), (F.col("k") % 11).cast("string"), F.when(F.col("k") % 4 == 0, "burn").otherwise("keep"))
    )
    a = e.select("event_id", audit(t, F.lit(6)).alias("a"))
    one = F.col("a.issues")[0]
    return a.select("event_id", "a.audit_parseable", "a.audit_pass", F.col("a.task_accuracy_percent").alias("accuracy"), one["code"].alias("code"), one["severity"].alias("severity"), F.array_join(one["mask_ids"], ",").alias("masks"), F.array_join(F.transform("a.mask_decisions", lambda x: x["decision"]), ",").alias("decisions"), "a.rewrite_plan")


def _fingerprints(s, d):
    k = F.get_json_object("props", "$.k").cast("int")
    t = F.format_string('x {"note": %s, "keep": %s, "caption": "%s"} y', F.col("event_id").cast("string"), (k % 2 == 0).cast("string"), F.col("event_type"))
    return A.table(s, d, "events").select(fingerprint(t).alias("said")).groupBy("said").agg(F.count(F.lit(1)).alias("n"))


def _reviews(s, d):
    e = A.table(s, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
    t = F.format_string('{"worth_segmenting": %s, "estimated_maskable_entities": %s, "image_type": "%s", "rationale": "%s", "sam3_prompts": ["a  b", {"prompt": "c"}, "a b"]}', (F.col("k") % 7 != 0).cast("string"), F.col("k").cast("string"), F.when(F.col("k") % 5 == 0, "a diagram").otherwise("photo"), F.when(F.col("k") % 2 == 0, "Blurry").otherwise("fine"))
    r = e.select("event_id", review(t).alias("r"))
    return r.select("event_id", "r.accepted", "r.reject_reason", "r.estimated", F.array_join("r.prompts", "|").alias("prompts"))


_K = "e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"
QUERIES = {"json_salvage": lambda s, d: _texts(s, d).select("event_id", F.coalesce(F.get_json_object(salvaged("raw"), "$.k").cast("int"), F.lit(-1)).alias("k")), "json_audit": _audits, "json_fingerprint": _fingerprints, "json_review": _reviews}
ORACLES = {
    "json_salvage": f"WITH {_K} SELECT event_id, CASE WHEN event_id % 5 = 4 THEN -1 ELSE k END AS k FROM e",
    "json_audit": f"""WITH {_K} SELECT event_id, event_id % 7 <> 0 AS audit_parseable, event_id % 7 <> 0 AND k % 2 = 0 AS audit_pass, CAST(CASE WHEN event_id % 7 = 0 THEN 0 ELSE greatest(0, least(100, k * 3 - 20)) END AS DOUBLE) AS accuracy,
      CASE WHEN event_id % 7 = 0 THEN 'audit_unparseable' ELSE 'model_audit_finding' END AS code, CASE WHEN event_id % 7 = 0 OR k % 3 = 0 THEN 'rewrite' ELSE 'style' END AS severity, CASE WHEN event_id % 7 <> 0 AND k % 9 BETWEEN 1 AND 6 THEN CAST(k % 9 AS VARCHAR) ELSE '' END AS masks,
      CASE WHEN event_id % 7 = 0 OR k % 11 NOT BETWEEN 1 AND 6 THEN '' WHEN k % 4 = 0 THEN 'drop' ELSE 'keep' END AS decisions, CASE WHEN event_id % 7 = 0 THEN '{REBUILD}' ELSE 'p' END AS rewrite_plan FROM e""",
    "json_fingerprint": f"""WITH {_K.replace('SELECT event_id,', 'SELECT event_id, event_type,')} SELECT '{{"caption":"' || event_type || '","keep":' || CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END || '}}' AS said, count(*) AS n FROM e GROUP BY 1""",
    "json_review": f"""WITH {_K}, r AS (SELECT event_id, k, CASE WHEN k % 5 = 0 THEN 'reject_type' WHEN k % 7 = 0 THEN 'not_worth_segmenting' WHEN k < 10 THEN 'too_few_objects' WHEN k <= 24 AND k % 2 = 0 THEN 'borderline_rationale' ELSE '' END AS w FROM e)
      SELECT event_id, w = '' AS accepted, w AS reject_reason, k AS estimated, CASE WHEN w = '' THEN 'a b|c' ELSE '' END AS prompts FROM r""",
}
