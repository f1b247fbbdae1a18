"""Findings: issue codes and records, before/after comparison, tiers and corpus aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import adapters as A

# Substrings that decide a message's code, in order, and the checker version that ids are made with.
CHECKER_VERSION = "bcc-deterministic-audit-v4-oewn-onehop-2026-08-25"
RULES = [
    ("unmasked_entity", "fatal", ["unmasked concrete noun phrase", "unsupported-object evasion"]),
    ("unknown_entity_id", "fatal", ["unknown mask", "unknown link", "unknown id", "output no unknown"]),
    ("identity_mismatch", "fatal", ["semantically incompatible", "identity noun", "body-part identity phrase", "identity phrase is incompatible", "incompatible with mask subject", "subject anchor", "wrong mask"]),
    ("style_possessive_boundary", "nonfatal", ["fused or repeated possessive", "word boundaries"]),
    ("coreference", "fatal", ["pronoun", "possessive", "reflexive", "corefer"]),
    ("unsupported_relation", "fatal", ["contact relation", "hold/carry", "grasp", "clutch", "unsupported relation", "spatial relation"]),
    ("model_decision", "fatal", ["pass-one reject", "pass-two keep", "model decision"]),
    ("missing_mask_link", "nonfatal", ["accepted masks are missing", "required link ids", "missing group", "unlinked"]),
    ("style_stock_predicate", "nonfatal", ["stock", "is visible", "is shown", "is present", "appears"]),
    ("style_ordinal_catalog", "nonfatal", ["ordinal", "first ", "second ", "third "]),
    ("style_inventory", "nonfatal", ["inventory", "one-sentence-per-mask", "jointly describe"]),
    ("malformed_punctuation", "nonfatal", ["punctuation", "malformed"]),
    ("composite_link", "nonfatal", ["composite mask", "composite outer", "child id", "collective span"]),
    ("instance_number", "nonfatal", ["grammatical number", "plural collection", "singular", "same-type instance"]),
    ("span_alignment", "nonfatal", ["span", "occurrence", "overlap", "nested", "tag", "text entry"]),
    ("style_naturalness", "nonfatal", ["caption cleanup", "caption quality", "style", "natural"]),
]
COMPLETENESS = ["accepted masks are missing groups", "required link IDs", "only "]
REPAIR = ["same-type instance links share", "inventory", "caption mention coverage", "composite mask", "grammatical number"]


def _any(text: Column, needles: list[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(text, F.lit(n))
    return out


def issue_code(message: Column) -> Column:
    """struct(code, severity): the first rule with a needle in the lower-cased message."""
    lower, out = F.lower(message), None
    for code, severity, needles in RULES:
        out = (F if out is None else out).when(_any(lower, needles), F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity")))
    return out.otherwise(F.struct(F.lit("other_checker_finding").alias("code"), F.lit("nonfatal").alias("severity")))


def issue_records(rows: DataFrame, messages: str, mask_ids: str, scope: str = "caption") -> DataFrame:
    """Adds `issues`: one struct for each distinct (code, message), blank ones dropped, in order."""
    numbers = lambda m: F.transform(F.regexp_extract_all(m, F.lit(r"(?i)(?:mask|link|group|ID)\s+(?:ID\s+)?(\d+)"), F.lit(1)), lambda n: n.cast("int"))
    linked = lambda m: F.array_distinct(F.transform(F.filter(numbers(m), lambda n: (n >= 1) & (n <= F.size(mask_ids))), lambda n: F.element_at(mask_ids, n)))
    spans = lambda m: F.arrays_zip(F.transform(F.regexp_extract_all(m, F.lit(r"\[(\d+)\s*,\s*(\d+)\)"), F.lit(1)), lambda n: n.cast("int")).alias("start"), F.transform(F.regexp_extract_all(m, F.lit(r"\[(\d+)\s*,\s*(\d+)\)"), F.lit(2)), lambda n: n.cast("int")).alias("end"))

    def record(m: Column) -> Column:
        code = issue_code(m)
        return F.struct(
            F.substring(F.sha1(F.concat(F.lit(CHECKER_VERSION + "\0"), code["code"], F.lit("\0"), m)), 1, 16).alias("issue_id"), code["code"].alias("code"), code["severity"].alias("severity"),
            F.lit(scope).alias("scope"), m.alias("message"), linked(m).alias("mask_ids"), spans(m).alias("spans"),
        )

    tidy = F.array_distinct(F.filter(F.transform(messages, lambda m: F.trim(m)), lambda m: m != ""))
    return rows.withColumn("issues", F.transform(tidy, record))


def prioritized(messages: Column, limit: int = 24) -> Column:
    """Completeness messages first, then repairs, then the rest; `limit` of them, in order."""
    keyed = F.transform(messages, lambda m, i: F.struct(F.when(_any(m, COMPLETENESS), 0).when(_any(m, REPAIR), 1).otherwise(2).alias("p"), i.alias("i"), m.alias("m")))
    return F.slice(F.transform(F.array_sort(keyed), lambda x: x["m"]), 1, limit)


def compared(before: Column, after: Column, before_ok: Column, after_ok: Column) -> Column:
    """Set differences of findings keyed by (code, message), outcome and deltas.  Arrays of struct(code, message, severity)."""
    fatal = lambda a: F.size(F.filter(a, lambda x: x["severity"] == "fatal"))
    key = lambda a: F.transform(a, lambda x: F.struct(x["code"].alias("code"), x["message"].alias("message")))
    outcome = F.when(~before_ok & after_ok, "recovered_parse").when(before_ok & ~after_ok, "lost_parse").when(F.size(after) < F.size(before), "improved").when(F.size(after) > F.size(before), "worsened").otherwise("same")
    return F.struct(
        outcome.alias("outcome"), F.size(F.array_except(key(before), key(after))).alias("resolved"), F.size(F.array_intersect(key(before), key(after))).alias("persisting"), F.size(F.array_except(key(after), key(before))).alias("new"),
        (F.size(after) - F.size(before)).alias("issue_delta"), (fatal(after) - fatal(before)).alias("fatal_delta"),
    )


def quality_tier(issues: Column) -> Column:
    return F.when(F.exists(issues, lambda x: x["severity"] == "fatal"), "fatal_flagged").when(F.size(issues) > 0, "nonfatal_flagged").otherwise("clean")


def composite_statistics(groups: Column) -> Column:
    """Per record: composites (groups with children or of several components), children, components, and mean union IoU and coverage
    of composites that have them (null if none has).  Groups: struct(children, components, union_iou, coverage).
    """
    one = lambda g: F.coalesce(F.nullif(g["components"], F.lit(0)), F.lit(1))
    composite = F.filter(groups, lambda g: (g["children"] > 0) | (one(g) > 1))
    total = lambda of, f: F.aggregate(of, F.lit(0.0), lambda a, g: a + f(g).cast("double"))
    known = lambda c: F.filter(composite, lambda g: g[c].isNotNull())
    mean = lambda c: F.try_divide(total(known(c), lambda g: g[c]), F.size(known(c)).cast("double"))
    return F.struct(
        F.size(composite).alias("composites"), total(composite, lambda g: g["children"]).cast("int").alias("children"), total(groups, one).cast("int").alias("components"),
        mean("union_iou").alias("mean_iou"), mean("coverage").alias("mean_coverage"),
    )


def aggregate_audits(rows: DataFrame) -> DataFrame:
    """Corpus totals as (metric, value): counts and rates of outcomes and tiers, means, medians, fatal sums, code counts before and
    after, and totals of omitted masks and composites.

    rows: included, parseable, before_n, after_n, outcome, tier, fatal, codes_before, codes_after, omitted, composites, children,
    components, mean_iou, mean_coverage.
    """
    n, d = F.count(F.lit(1)), lambda c: c.cast("double")
    one = rows.agg(
        d(n).alias("records"), d(F.count_if("included")).alias("included"), d(F.count_if(~F.col("included"))).alias("excluded"), d(F.count_if("parseable")).alias("after_parseable"),
        F.avg("before_n").alias("before_mean"), F.avg("after_n").alias("after_mean"), F.median("before_n").alias("before_median"), F.median("after_n").alias("after_median"),
        F.avg(F.col("after_n") - F.col("before_n")).alias("mean_delta"), d(F.sum("fatal")).alias("fatal_sum"), d(F.sum("omitted")).alias("omitted"),
        d(F.sum("composites")).alias("composites"), d(F.sum("children")).alias("children"), d(F.sum("components")).alias("components"), F.avg("mean_iou").alias("union_iou_mean"), F.avg("mean_coverage").alias("coverage_mean"),
    )
    scalars = one.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, one.columns)), F.array(*one.columns))).alias("metric", "value"))
    by = lambda df, c, p: df.groupBy(F.concat(F.lit(p), F.col(c)).alias("metric")).agg(n.cast("double").alias("value"))
    outcome, total = by(rows, "outcome", "outcome:"), one.select(F.col("records").alias("_n"))
    rates = outcome.crossJoin(F.broadcast(total)).select(F.replace("metric", F.lit("outcome:"), F.lit("rate:")).alias("metric"), (F.col("value") / F.col("_n")).alias("value"))  # total: one row
    codes = [by(rows.select(F.explode(f"codes_{w}").alias("c")), "c", f"{w}:") for w in ("before", "after")]
    out = scalars.unionByName(outcome).unionByName(rates).unionByName(by(rows, "tier", "tier:"))
    for c in codes:
        out = out.unionByName(c)
    return out


#: Messages in the style of checkers, for the test queries.
MESSAGES = [
    "unmasked concrete noun phrase at [3, 9)", "mask 2 is an unknown mask", "identity noun of link 1 differs", "word boundaries broken", "pronoun without antecedent near mask ID 3",
    "contact relation lacks support", "pass-one reject overruled", "accepted masks are missing groups: only 2", "the lamp is visible", "ordinal catalog", "inventory listing",
    "malformed selector", "composite mask 4 without child", "plural collection [0,4) [7,12)", "span overlap", "style", "anything else", "  ",
]


def _rows(s, d):
    m = F.array(*map(F.lit, MESSAGES))
    t = A.table(s, d, "labels")
    pick = lambda step, off: F.transform(F.sequence(F.lit(0), F.pmod(F.col("doc_id") + off, F.lit(5)).cast("int")), lambda i: F.element_at(m, (F.pmod(F.col("doc_id") + off + i * step, F.lit(len(MESSAGES))) + 1).cast("int")))
    return t.select("doc_id", "quality", "toxic", pick(5, 0).alias("before"), pick(7, 1).alias("after"), F.array(F.lit("a"), F.lit("b"), F.lit("c")).alias("mask_ids"))


def _records(s, d):
    r = issue_records(_rows(s, d), "before", "mask_ids").select("doc_id", F.explode("issues").alias("i"))
    spans = F.array_join(F.transform("i.spans", lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string"))), ",")
    return r.select("doc_id", "i.issue_id", "i.code", "i.severity", "i.message", F.array_join("i.mask_ids", ",").alias("mask_ids"), spans.alias("spans"))


def _both(s, d):
    r = issue_records(issue_records(_rows(s, d), "before", "mask_ids").withColumnRenamed("issues", "bi"), "after", "mask_ids")
    cut = lambda c: F.transform(c, lambda x: F.struct(x["code"].alias("code"), x["message"].alias("message"), x["severity"].alias("severity")))
    return r.withColumn("c", compared(cut(F.col("bi")), cut(F.col("issues")), F.col("quality") == 1, F.col("toxic") == 0))


def _totals(s, d):
    g = A.boxes(s, d).groupBy((F.col("image_id") % 997).alias("doc_id")).agg(F.collect_list(_group()).alias("g")).select("doc_id", composite_statistics(F.col("g")).alias("s"))
    codes = lambda c: F.transform(c, lambda x: x["code"])
    r = _both(s, d).join(g, "doc_id", "left").select(
        (F.col("quality") == 1).alias("included"), (F.col("toxic") == 0).alias("parseable"), F.size("bi").alias("before_n"), F.size("issues").alias("after_n"), F.col("c.outcome").alias("outcome"), quality_tier(F.col("issues")).alias("tier"),
        F.size(F.filter("issues", lambda x: x["severity"] == "fatal")).alias("fatal"), codes(F.col("bi")).alias("codes_before"), codes(F.col("issues")).alias("codes_after"), (F.col("doc_id") % 4).alias("omitted"),
        "s.composites", "s.children", "s.components", "s.mean_iou", "s.mean_coverage",
    )
    return aggregate_audits(r).select("metric", F.round("value", 6).alias("value"))


def _composites(s, d):
    """Each image's groups in the table's row order, so that sums don't hang on the shuffle; six decimals by scaling first, as SQL's round
    does: a half falls where the product of doubles does.
    """
    six = lambda c: (F.round(F.col(c) * 1e6) / 1e6).alias(c.split(".")[1])
    g = A.boxes(s, d).select("image_id", F.struct(F.monotonically_increasing_id().alias("i"), _group().alias("g")).alias("x"))
    g = g.groupBy("image_id").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["g"]).alias("g")).select("image_id", composite_statistics(F.col("g")).alias("s"))
    return g.select("image_id", "s.composites", "s.children", "s.components", six("s.mean_iou"), six("s.mean_coverage"))


def _group() -> Column:
    """A group of each box: children, components, and union IoU and coverage where it has children."""
    some = F.col("w") % 4 >= 2
    return F.struct(F.when(some, F.col("w") % 4).otherwise(0).alias("children"), (F.col("h") % 3).alias("components"), F.when(some, F.col("h") / 50).alias("union_iou"), F.when(some & (F.col("x") % 2 == 0), F.col("x") / 640).alias("coverage"))


_LIST = "[" + ", ".join(f"'{m}'" for m in MESSAGES) + "]"
_CODE = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(lower(m), '{n}')" for n in needles) + f" THEN '{code}'" for code, _, needles in RULES) + " ELSE 'other_checker_finding' END"
_FATAL = ", ".join(f"'{c}'" for c, s, _ in RULES if s == "fatal")
_MSG = f"""src AS (SELECT doc_id, quality, toxic, list_transform(range(0, doc_id % 5 + 1), lambda i: {_LIST}[(doc_id + i * 5) % {len(MESSAGES)} + 1]) AS bl, list_transform(range(0, (doc_id + 1) % 5 + 1), lambda i: {_LIST}[(doc_id + 1 + i * 7) % {len(MESSAGES)} + 1]) AS al FROM labels),
  e AS (SELECT DISTINCT doc_id, side, trim(m) AS m FROM (SELECT doc_id, 'b' AS side, unnest(bl) AS m FROM src UNION ALL SELECT doc_id, 'a', unnest(al) FROM src) WHERE trim(m) <> ''),
  c AS (SELECT *, {_CODE} AS code FROM e), f AS (SELECT *, code IN ({_FATAL}) AS fatal FROM c)"""
_CMP = f"""{_MSG}, n AS (SELECT s.doc_id, s.quality, s.toxic, coalesce(x.bn, 0) AS bn, coalesce(x.an, 0) AS an, coalesce(x.bf, 0) AS bf, coalesce(x.af, 0) AS af FROM src s LEFT JOIN (SELECT doc_id, count(*) FILTER (side = 'b') AS bn, count(*) FILTER (side = 'a') AS an, count(*) FILTER (side = 'b' AND fatal) AS bf, count(*) FILTER (side = 'a' AND fatal) AS af FROM f GROUP BY 1) x USING (doc_id)),
  o AS (SELECT *, CASE WHEN quality = 0 AND toxic = 0 THEN 'recovered_parse' WHEN quality = 1 AND toxic = 1 THEN 'lost_parse' WHEN an < bn THEN 'improved' WHEN an > bn THEN 'worsened' ELSE 'same' END AS outcome,
    CASE WHEN af > 0 THEN 'fatal_flagged' WHEN an > 0 THEN 'nonfatal_flagged' ELSE 'clean' END AS tier FROM n)"""
_COMP = f"""{A.BOXES}, cg AS (SELECT {{key}} AS k, CASE WHEN w % 4 >= 2 THEN w % 4 ELSE 0 END AS c, CASE WHEN h % 3 = 0 THEN 1 ELSE h % 3 END AS n, CASE WHEN w % 4 >= 2 THEN h / 50 END AS iou, CASE WHEN w % 4 >= 2 AND x % 2 = 0 THEN x / 640 END AS cov FROM boxes),
  cs AS (SELECT k, CAST(count(*) FILTER (c > 0 OR n > 1) AS INT) AS composites, CAST(sum(c) AS INT) AS children, CAST(sum(n) AS INT) AS components, avg(iou) AS mean_iou, avg(cov) AS mean_coverage FROM cg GROUP BY 1)"""
QUERIES = {
    "issue_records": _records,
    "issue_comparison": lambda s, d: _both(s, d).select("doc_id", "c.*", quality_tier(F.col("issues")).alias("tier")),
    "audit_totals": _totals,
    "issue_priority": lambda s, d: _rows(s, d).select("doc_id", F.array_join(prioritized(F.col("after"), 3), "|").alias("first")),
    "composite_statistics": _composites,
}
ORACLES = {
    "issue_records": f"""WITH {_MSG} SELECT doc_id, left(sha1('{CHECKER_VERSION}' || chr(0) || code || chr(0) || m), 16) AS issue_id, code, CASE WHEN fatal THEN 'fatal' ELSE 'nonfatal' END AS severity, m AS message,
      array_to_string(list_transform(list_filter(regexp_extract_all(m, '(?i)(?:mask|link|group|ID)\\s+(?:ID\\s+)?(\\d+)', 1), lambda n: CAST(n AS INT) BETWEEN 1 AND 3), lambda n: ['a', 'b', 'c'][CAST(n AS INT)]), ',') AS mask_ids,
      array_to_string(list_transform(regexp_extract_all(m, '\\[(\\d+)\\s*,\\s*(\\d+)\\)'), lambda x: regexp_replace(replace(replace(x, '[', ''), ')', ''), '\\s*,\\s*', '-')), ',') AS spans FROM f WHERE side = 'b'""",
    "issue_comparison": f"""WITH {_CMP}, k AS (SELECT doc_id, m, bool_or(side = 'b') AS b, bool_or(side = 'a') AS a FROM f GROUP BY 1, 2)
      SELECT o.doc_id, outcome, CAST(count(*) FILTER (b AND NOT a) AS INT) AS resolved, CAST(count(*) FILTER (b AND a) AS INT) AS persisting, CAST(count(*) FILTER (a AND NOT b) AS INT) AS new,
      CAST(an - bn AS INT) AS issue_delta, CAST(af - bf AS INT) AS fatal_delta, tier FROM o LEFT JOIN k USING (doc_id) GROUP BY ALL""",
    "audit_totals": f"""WITH {_CMP}, {_COMP.format(key="image_id % 997")}, y AS (SELECT o.*, doc_id % 4 AS omitted, composites, children, components, mean_iou, mean_coverage FROM o LEFT JOIN cs ON cs.k = doc_id)
      SELECT metric, round(value, 6) AS value FROM (
      SELECT unnest(['records', 'included', 'excluded', 'after_parseable', 'before_mean', 'after_mean', 'before_median', 'after_median', 'mean_delta', 'fatal_sum', 'omitted', 'composites', 'children', 'components', 'union_iou_mean', 'coverage_mean']) AS metric,
        unnest([count(*), count(*) FILTER (quality = 1), count(*) FILTER (quality <> 1), count(*) FILTER (toxic = 0), avg(bn), avg(an), median(bn), median(an), avg(an - bn), sum(af), sum(omitted), sum(composites), sum(children), sum(components), avg(mean_iou), avg(mean_coverage)]) AS value FROM y
      UNION ALL SELECT 'outcome:' || outcome, count(*) FROM o GROUP BY 1 UNION ALL SELECT 'rate:' || outcome, count(*) / (SELECT count(*) FROM o) FROM o GROUP BY 1 UNION ALL SELECT 'tier:' || tier, count(*) FROM o GROUP BY 1
      UNION ALL SELECT CASE side WHEN 'a' THEN 'after:' ELSE 'before:' END || code, count(*) FROM f GROUP BY 1)""",
    "issue_priority": f"""WITH {_MSG}, p AS (SELECT doc_id, unnest(al) AS m, generate_subscripts(al, 1) AS i FROM src),
      k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN {' OR '.join(f"contains(m, '{n}')" for n in COMPLETENESS)} THEN 0 WHEN {' OR '.join(f"contains(m, '{n}')" for n in REPAIR)} THEN 1 ELSE 2 END, i) AS r FROM p)
      SELECT doc_id, string_agg(m, '|' ORDER BY r) AS first FROM k WHERE r <= 3 GROUP BY 1""",
    "composite_statistics": f"WITH {_COMP.format(key='image_id')} SELECT k AS image_id, composites, children, components, round(mean_iou, 6) AS mean_iou, round(mean_coverage, 6) AS mean_coverage FROM cs",
}
