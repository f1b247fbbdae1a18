"""Small operators over stage records: predicates, locators, barriers, recovery orders, identity rules."""

from __future__ import annotations

from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import adapters as A
from .keyed import counts, last_wins, remaining

# Fragments of tag errors, the wordings that quote a phrase to avoid, ordinals, and which stages each stage may follow.
TAG_ERRORS = ("has an unclosed opening tag", "has a closing tag without an opening tag", "inline tags are crossed", "has nested self-overlap", "has an empty inline mention")
_Q = r"(['\"])(.*?)"
FORBIDDEN = (
    rf"unmasked concrete noun phrase {_Q}\1 at ",
    rf"unsupported-object evasion {_Q}\1;",
    rf"adjacent duplicate linked phrase {_Q}\1;",
    rf"plural collection mask ID \d+ needs a descriptive phrase, not {_Q}\1",
)
ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth")
PREREQUISITES = {"sam3": ["image-review"], "mask-captions": ["sam3"], "mask-qa": ["mask-captions"], "consistency": ["mask-qa", "mask-captions"], "bcc-draft": ["consistency"], "bcc-audit": ["bcc-draft"], "bcc-rewrite": ["bcc-audit"]}


def same_manifest(stored: Column, current: Column) -> Column:
    """A stored answer fits only the same masks in the same order (role manifests: struct(role, mask_id))."""
    return F.transform(F.filter(stored, lambda x: x["role"] == "mask"), lambda x: x["mask_id"]) == current


def qa_eligible(minimum: int = 10) -> Column:
    """Drafts that have errors, weren't rejected, and hold a caption and enough groups."""
    return (F.size("errors") > 0) & ~F.coalesce("rejected", F.lit(False)) & (F.trim(F.coalesce("caption", F.lit(""))) != "") & (F.col("groups") >= minimum)


def decision_error(keep: Column, reject: Column) -> Column:
    return F.when(~F.coalesce(keep, F.lit(False)), "keep must be true").when(F.coalesce(reject, F.lit(False)), "reject must be false").otherwise("")


def tag_errors(errors: Column) -> Column:
    return F.filter(errors, lambda e: F.exists(F.array(*map(F.lit, TAG_ERRORS)), lambda t: F.contains(e, t)))


def forbidden_phrases(errors: Column) -> Column:
    """Quoted phrases by the known wordings, each once, in order."""
    every = F.flatten(F.transform(errors, lambda e: F.array(*[F.when(e.rlike(p), F.regexp_extract(e, p, 2)) for p in FORBIDDEN])))
    return F.array_distinct(F.filter(every, lambda x: x.isNotNull()))


def located(groups: Column, archive: Column) -> Column:
    """Groups with the archive member of their mask."""
    return F.transform(groups, lambda g: F.struct(g["mask_id"].alias("mask_id"), F.concat(archive, F.lit("::masks/"), g["mask_id"], F.lit(".png")).alias("locator")))


def overlay_numbers(groups: Column, ids: Column) -> Column:
    """1-based overlay number of each group's mask; 0 where it has none."""
    return F.transform(groups, lambda g: F.array_position(ids, g["mask_id"]).cast("int"))


def first_terms(*fields: Column) -> Column:
    """The first field that has terms."""
    out = None
    for f in fields:
        out = (F if out is None else out).when(F.size(F.coalesce(f, F.array())) > 0, f)
    return out.otherwise(F.array().cast("array<string>"))


def allowed_nouns(expected: Column, alternatives: Column, anchor: Column) -> Column:
    return F.array_sort(F.array_union(F.array_union(expected, alternatives), anchor))


def selector(index: Column, total: Column) -> Column:
    """one / the other for two, an ordinal for more (in words up to twelve), nothing for one."""
    suffix = F.when((index % 100).isin(11, 12, 13), "th").otherwise(F.coalesce(F.try_element_at(F.array(*map(F.lit, ("st", "nd", "rd"))), F.nullif(index % 10, F.lit(0))), F.lit("th")))
    word = F.when(index.between(1, len(ORDINALS)), F.try_element_at(F.array(*map(F.lit, ORDINALS)), F.nullif(index, F.lit(0)))).otherwise(F.concat(index.cast("string"), suffix))
    pair = (total == 2) & index.isin(1, 2)
    return F.when(total <= 1, "").when(pair, F.when(index == 1, "one").otherwise("the other")).otherwise(F.concat(F.lit("the "), word))


def packet(source: Column, crops: Column) -> Column:
    """Image list of a request: source, overlay, crops numbered from 3; an empty path is an error."""
    path = lambda p: F.when(F.coalesce(p, F.lit("")) == "", F.raise_error(F.lit("missing image path"))).otherwise(p)
    row = lambda n, role, p: F.struct(n.cast("int").alias("n"), F.lit(role).alias("role"), path(p).alias("path"))
    return F.concat(F.array(row(F.lit(1), "source", source), row(F.lit(2), "overlay", F.concat(source, F.lit(".overlay")))), F.transform(crops, lambda c, i: row(i + 3, "crop", c)))


def prerequisite_met(done: Column, stage: str) -> Column:
    return F.lit(True) if stage not in PREREQUISITES else F.arrays_overlap(done, F.array(*map(F.lit, PREREQUISITES[stage])))


def contiguous(rows: DataFrame, index: str) -> DataFrame:
    """Rows whose index isn't one more than the row's before (the first must be 0); compares neighbours within ranges of the index."""
    before = rows.select((F.col(index) + 1).alias(index))
    start = rows.filter(F.col(index) == 0).select(index)
    return rows.join(before.union(start).distinct(), index, "left_anti")


def one_review_each(selected: DataFrame, reviews: DataFrame) -> DataFrame:
    """Problems of a review set: selected images without review, reviews of images not selected."""
    r = last_wins(reviews, "image_id").select("image_id")
    missing = remaining(selected.select("image_id"), [r], "image_id").withColumn("problem", F.lit("missing"))
    return missing.unionByName(remaining(r, [selected.select("image_id")], "image_id").withColumn("problem", F.lit("extra")))


def barrier(units: DataFrame, done: DataFrame, quarantine: DataFrame) -> DataFrame:
    """State of each unit before a merge: done, quarantined or missing."""
    d, q = done.select("unit").distinct().withColumn("_d", F.lit(1)), quarantine.select("unit").distinct().withColumn("_q", F.lit(1))
    return units.join(d, "unit", "left").join(q, "unit", "left").select("unit", F.when(F.col("_d").isNotNull(), "done").when(F.col("_q").isNotNull(), "quarantined").otherwise("missing").alias("state"))


def require_merged(states: DataFrame) -> None:
    """Raises where a unit isn't done: names quarantined ones, else says how many are missing."""
    bad = states.filter("state = 'quarantined'").orderBy("unit").limit(10).collect()
    if bad:
        raise RuntimeError(f"quarantined units: {[r['unit'] for r in bad]}")
    if n := states.filter("state = 'missing'").count():
        raise RuntimeError(f"{n} units aren't done yet")


def recovery_order(rows: DataFrame) -> DataFrame:
    """Place in a recovery run of each image: those with a candidate first, then fewest masks, manifest order, id."""
    w = Window.partitionBy("campaign").orderBy(F.col("has_candidate").desc(), "n_masks", "source_manifest_index", "image_id")
    return rows.withColumn("place", F.row_number().over(w))


def repeated_phrases(links: DataFrame) -> DataFrame:
    """Wordings that two or more groups of an image share (an aggregate instead of all pairs)."""
    return links.groupBy("image_id", F.lower("surface").alias("phrase")).agg(F.count_distinct("id").alias("groups")).filter("groups >= 2")


def smallest_cover(mentions: DataFrame, links: DataFrame) -> DataFrame:
    """The group of the smallest span that covers each mention (of equal ones the least).

    One pass over an image's spans in order of their starts.  Of the links begun, those with a farther end than all smaller ones
    are kept, by end; the first that reaches a mention's end is its smallest cover.
    """
    of = links.select("image_id", "start", "end", F.col("id").alias("group"), F.lit(0).alias("_k"))
    return _smallest_cover(of.unionByName(mentions.select("image_id", "start", "end", F.lit(None).cast(of.schema["group"].dataType).alias("group"), F.lit(1).alias("_k"))))


def _smallest_cover(both: DataFrame) -> DataFrame:
    """`smallest_cover` of links (_k = 0) and mentions (_k = 1) in one table."""
    both = both.filter("image_id IS NOT NULL AND start IS NOT NULL AND `end` IS NOT NULL")

    def run(batches):
        image, ends, keys, last = None, [], [], None
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                i, s, e, g, mention = row
                if i != image:
                    image, ends, keys, last = i, [], [], None
                k = bisect_left(ends, e)
                if mention:
                    if (s, e) != last and k < len(ends):
                        out.append((i, s, e, keys[k][1]))
                    last = s, e
                    continue
                key = e - s, g
                if k < len(ends) and keys[k] <= key:
                    continue
                to = k + (k < len(ends) and ends[k] == e)
                while k and keys[k - 1] >= key:
                    k -= 1
                ends[k:to], keys[k:to] = [e], [key]
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, batch.schema, strict=False)], batch.schema.names[:4])

    kinds = both.schema
    return both.repartition("image_id").sortWithinPartitions("image_id", "start", "_k", "end").mapInArrow(run, StructType([kinds[c] for c in ("image_id", "start", "end", "group")]))


def _barrier(s, d):
    u = A.sources(s, d).select(F.col("campaign_unit").alias("unit")).distinct()
    return barrier(u, u.filter("unit % 3 = 0"), u.filter("unit % 5 = 0"))


def _recovery(s, d):
    n = counts(A.table(s, d, "conversations").select(F.col("conv_id").cast("string").alias("image_id")), "image_id", "n_masks")
    r = A.sources(s, d).join(n, "image_id", "left").select((F.col("campaign_unit") % 10).alias("campaign"), "image_id", "source_manifest_index", F.coalesce("n_masks", F.lit(0)).alias("n_masks"), (F.col("n_chars") % 2 == 0).alias("has_candidate"))
    return recovery_order(r).select("campaign", "image_id", "place")


def _errors(s, d):
    """Messages around the words of each labelled document's text."""
    t = A.table(s, d, "labels").join(A.table(s, d, "documents").select("doc_id", F.regexp_replace("text", "[^a-z ]", "").alias("t")), "doc_id")
    q = lambda c, a, b: F.concat(F.lit(a), F.lit("'"), c, F.lit("'"), F.lit(b))
    e = F.array(
        F.concat(F.lit("mask ID "), F.col("doc_id").cast("string"), F.lit(" has an unclosed opening tag")), q(F.col("t"), "unmasked concrete noun phrase ", " at 3"),
        F.when(F.col("toxic") == 1, q(F.lit("the thing"), "unsupported-object evasion ", "; name it")).otherwise(q(F.lit("a b"), "plural collection mask ID 7 needs a descriptive phrase, not ", "")),
        F.lit("other"), q(F.col("t"), "adjacent duplicate linked phrase ", "; say it once"), F.lit("inline tags are crossed: 1 and 2"),
    )
    t = t.withColumn("e", e)
    return t.select("doc_id", F.array_join(tag_errors(F.col("e")), "|").alias("tags"), F.array_join(forbidden_phrases(F.col("e")), "|").alias("phrases"), selector((F.col("doc_id") % 130 + 1).cast("int"), (F.col("doc_id") % 7).cast("int")).alias("selector"))


def _packets(s, d):
    t = A.table(s, d, "labels").select("doc_id", F.posexplode(packet(F.concat(F.lit("img/"), F.col("doc_id").cast("string")), F.transform(F.sequence(F.lit(1), (F.col("doc_id") % 3 + 1).cast("int")), lambda i: F.concat(F.lit("c"), i.cast("string"))))).alias("k", "p"))
    return t.select("doc_id", "p.n", "p.role", "p.path")


def _drafts(s, d):
    """Drafts of the audits: two errors at most, a stored and a current list of masks, two fields of terms."""
    a = A.audits(s, d)
    errors = F.slice(F.array(F.lit("x"), F.lit("y")), 1, F.col("issues") % 3)
    stored = F.transform("linked", lambda m: F.struct(F.lit("mask").alias("role"), m.alias("mask_id")))
    other = F.struct(F.lit("overlay").alias("role"), F.lit("o").alias("mask_id"))
    return a.select(
        "image_id", "caption", errors.alias("errors"), (F.col("issues") == 3).alias("rejected"), F.size("linked").alias("groups"), F.array_append(stored, other).alias("stored"),
        F.when(F.col("issues") == 1, F.reverse("linked")).otherwise(F.col("linked")).alias("current"), F.when(F.col("issues") == 2, F.col("linked")).alias("first"), F.array(F.lit("z"), F.lit("m3")).alias("second"), F.col("parseable"),
        F.array_distinct("linked").alias("linked"),
    )


def _draft_rules(s, d):
    return _drafts(s, d).select(
        "image_id", qa_eligible().alias("eligible"), decision_error(F.col("parseable"), F.col("rejected")).alias("error"), same_manifest(F.col("stored"), F.col("current")).alias("same"),
        F.array_join(first_terms(F.col("first"), F.col("second")), ",").alias("terms"), F.array_join(allowed_nouns(F.coalesce("first", F.array().cast("array<string>")), F.col("second"), F.array(F.lit("a"))), ",").alias("allowed"),
    )


def _locators(s, d):
    t = _drafts(s, d).withColumn("g", F.transform("linked", lambda m: F.struct(m.alias("mask_id"))))
    where = F.transform(located(F.col("g"), F.concat(F.lit("u/"), F.col("image_id"), F.lit(".tar"))), lambda x: x["locator"])
    return t.select("image_id", F.array_join(where, ",").alias("locators"), F.array_join(overlay_numbers(F.col("g"), F.array(F.lit("m3"), F.lit("m1"), F.lit("m5"))), ",").alias("numbers"))


def _prerequisites(s, d):
    t = A.table(s, d, "conversations").groupBy("conv_id").agg(F.collect_set(F.element_at(F.array(*map(F.lit, ["image-review", "sam3", "mask-captions", "mask-qa"])), (F.col("turn") % 4 + 1).cast("int"))).alias("done"))
    return t.select("conv_id", *[prerequisite_met(F.col("done"), stage).alias(stage.replace("-", "_")) for stage in ("image-review", "sam3", "consistency", "bcc-draft")])


def _links(s, d):
    from .spans import QUERIES as S

    return S["tag_links"](s, d)


from .spans import _T as _TAGGED  # noqa: E402

_S = f"WITH {A.SOURCES}, {A.REVIEWS}"
QUERIES = {
    "index_gaps": lambda s, d: contiguous(A.reviews(s, d).select(F.col("_ord").alias("source_manifest_index")), "source_manifest_index"),
    "review_completeness": lambda s, d: one_review_each(A.sources(s, d), A.reviews(s, d).unionByName(A.table(s, d, "conversations").select(F.concat(F.lit("c"), F.col("conv_id")).alias("image_id"), F.lit(1).alias("_ord")), allowMissingColumns=True)),
    "merge_barrier": _barrier,
    "draft_rules": _draft_rules,
    "draft_locators": _locators,
    "stage_prerequisites": _prerequisites,
    "recovery_order": _recovery,
    "error_fragments": _errors,
    "image_packets": _packets,
    "phrases_repeated": lambda s, d: repeated_phrases(_links(s, d)),
    "smallest_cover": lambda s, d: _smallest_cover(_links(s, d).select("image_id", "start", "end", F.col("id").alias("group"), F.explode(F.when(F.col("id") == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_k"))),  # the mentions are links
}
ORACLES = {
    "index_gaps": "WITH k AS (SELECT doc_id AS source_manifest_index, lag(doc_id) OVER (ORDER BY doc_id) AS b FROM labels) SELECT source_manifest_index FROM k WHERE source_manifest_index <> coalesce(b, -1) + 1",
    "review_completeness": f"{_S} SELECT image_id, 'missing' AS problem FROM sources WHERE image_id NOT IN (SELECT image_id FROM reviews) UNION ALL SELECT DISTINCT 'c' || conv_id, 'extra' FROM conversations",
    "draft_rules": f"""WITH {A.SOURCES}, {A.AUDITS} SELECT image_id, issues % 3 > 0 AND issues <> 3 AND trim(caption) <> '' AND len(linked) >= 10 AS eligible, CASE WHEN NOT parseable THEN 'keep must be true' WHEN issues = 3 THEN 'reject must be false' ELSE '' END AS error,
      issues <> 1 OR list_reverse(linked) = linked AS same, CASE WHEN issues = 2 THEN array_to_string(linked, ',') ELSE 'z,m3' END AS terms, array_to_string(list_sort(list_distinct(list_concat(CASE WHEN issues = 2 THEN linked ELSE [] END, ['z', 'm3', 'a']))), ',') AS allowed FROM audits""",
    "draft_locators": f"""WITH {A.SOURCES}, {A.AUDITS}, u AS (SELECT image_id, list_filter(linked, lambda m, i: list_position(linked, m) = i) AS l FROM audits)
      SELECT image_id, array_to_string(list_transform(l, lambda m: 'u/' || image_id || '.tar::masks/' || m || '.png'), ',') AS locators, array_to_string(list_transform(l, lambda m: coalesce(list_position(['m3', 'm1', 'm5'], m), 0)), ',') AS numbers FROM u""",
    "stage_prerequisites": """SELECT conv_id, true AS image_review, bool_or(turn % 4 = 0) AS sam3, bool_or(turn % 4 IN (2, 3)) AS consistency, false AS bcc_draft FROM conversations GROUP BY 1""",
    "merge_barrier": "SELECT DISTINCT doc_id // 8 AS unit, CASE WHEN doc_id // 8 % 3 = 0 THEN 'done' WHEN doc_id // 8 % 5 = 0 THEN 'quarantined' ELSE 'missing' END AS state FROM documents",
    "recovery_order": f"""{_S}, n AS (SELECT CAST(conv_id AS VARCHAR) AS image_id, count(*) AS n FROM conversations GROUP BY 1)
      SELECT campaign_unit % 10 AS campaign, image_id, CAST(row_number() OVER (PARTITION BY campaign_unit % 10 ORDER BY n_chars % 2, coalesce(n, 0), source_manifest_index, image_id) AS INT) AS place FROM sources LEFT JOIN n USING (image_id)""",
    "error_fragments": f"""WITH t AS (SELECT doc_id, toxic, regexp_replace(text, '[^a-z ]', '', 'g') AS t, doc_id % 130 + 1 AS i, doc_id % 7 AS n FROM labels JOIN documents USING (doc_id))
      SELECT doc_id, 'mask ID ' || doc_id || ' has an unclosed opening tag|inline tags are crossed: 1 and 2' AS tags, t || '|' || CASE WHEN toxic = 1 THEN 'the thing' ELSE 'a b' END AS phrases,
      CASE WHEN n <= 1 THEN '' WHEN n = 2 AND i = 1 THEN 'one' WHEN n = 2 AND i = 2 THEN 'the other' WHEN i <= 12 THEN 'the ' || {list(ORDINALS)}[i]
      ELSE 'the ' || i || CASE WHEN i % 100 IN (11, 12, 13) THEN 'th' WHEN i % 10 = 1 THEN 'st' WHEN i % 10 = 2 THEN 'nd' WHEN i % 10 = 3 THEN 'rd' ELSE 'th' END END AS selector FROM t""",
    "image_packets": """SELECT doc_id, CAST(n AS INT) AS n, CASE n WHEN 1 THEN 'source' WHEN 2 THEN 'overlay' ELSE 'crop' END AS role, CASE n WHEN 1 THEN 'img/' || doc_id WHEN 2 THEN 'img/' || doc_id || '.overlay' ELSE 'c' || (n - 2) END AS path
      FROM labels, LATERAL (SELECT unnest(range(1, doc_id % 3 + 4)) AS n)""",
    "phrases_repeated": f"WITH {_TAGGED} SELECT image_id, lower(surface) AS phrase, count(DISTINCT id) AS groups FROM links GROUP BY 1, 2 HAVING count(DISTINCT id) >= 2",
    "smallest_cover": f"""WITH {_TAGGED}, m AS (SELECT image_id, start, "end" FROM links WHERE id = 2) SELECT m.image_id, m.start, m."end", arg_min(l.id, (l."end" - l.start, l.id)) AS "group" FROM m JOIN links l ON l.image_id = m.image_id AND l.start <= m.start AND l."end" >= m."end" GROUP BY 1, 2, 3""",
}
