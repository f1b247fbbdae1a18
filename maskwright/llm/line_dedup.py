"""Line dedup over windows of three lines (native: DataFrame functions only).

Each line is hashed once; three consecutive hashes make a window (two 64-bit hashes of each).  Windows are counted globally;
every occurrence but the first (by id, then position) covers its lines, and covered lines are removed.  Each line removed
stays in an earlier place: the first occurrence of its window, or what that one repeats.

Nulls: a null text counts as empty and is returned as it is; a null id sorts first.  Repeated rows (same id, same text)
count as one document and are treated alike.  Texts with fewer than three lines have no window and stay whole.  Empty table:
empty result.  Extra columns are returned unchanged; names that start with `_ld_` are reserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

LINES = 3

#: of one document: the windows as (position, two 64-bit halves of the hash); `hs` holds the hashes of its lines
_WINDOWS = f"""
explode(flatten(transform(array(transform(split(_ld_body, '\\n', -1), x -> struct(xxhash64(x) AS a, xxhash64(7, x) AS b))), hs ->
  IF(size(hs) < {LINES}, array(), transform(sequence(0, size(hs) - {LINES}), i ->
    struct(i AS p, xxhash64(hs[i].a, hs[i+1].a, hs[i+2].a) AS a, xxhash64(hs[i].b, hs[i+1].b, hs[i+2].b) AS b)))))) AS _ld_w
"""


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """`docs` with covered lines taken out of `text_col`; with `counts`, n_lines and n_removed (long) take the place of columns of these names."""
    key = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)))
    keyed = docs.withColumns({"_ld_body": F.coalesce(F.col(text_col), F.lit("")), "_ld_id": F.col(id_col), "_ld_key": F.substring(key, 1, 32)})
    windows = keyed.selectExpr("_ld_id", "_ld_key", _WINDOWS).selectExpr("_ld_w.a", "_ld_w.b", "struct(_ld_id, _ld_key, _ld_w.p) AS at")
    repeated = windows.groupBy("a", "b").agg(F.min("at").alias("first"), F.max("at").alias("last")).filter("first < last").drop("last")
    covered = (
        windows.join(repeated, ["a", "b"])
        .filter("at > first")
        .groupBy(F.col("at._ld_key").alias("_ld_key"))
        .agg(F.flatten(F.collect_set(F.expr(f"sequence(at.p, at.p + {LINES - 1})"))).alias("_ld_covered"))
    )
    kept = """transform(array(split(_ld_body, '\\n', -1)), ls -> transform(array(
        IF(_ld_covered IS NULL, sequence(0, size(ls) - 1), array_except(sequence(0, size(ls) - 1), _ld_covered))), at ->
        struct(size(ls) AS n, size(ls) - size(at) AS gone, array_join(transform(at, i -> ls[i]), '\\n') AS text))[0])[0] AS _ld"""
    out = keyed.join(covered, "_ld_key", "left").selectExpr("*", kept)
    text = F.when(F.col(text_col).isNull() | (F.col("_ld.gone") == 0), F.col(text_col)).otherwise(F.col("_ld.text"))
    added = [F.col("_ld.n").cast("long").alias("n_lines"), F.col("_ld.gone").cast("long").alias("n_removed")] if counts else []
    names = [c for c in docs.columns if not (counts and c in ("n_lines", "n_removed"))]
    return out.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in names], *added)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.coalesce("text", F.lit("")).alias("text"))


ORACLE = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM d),
w AS (SELECT a.doc_id, a.p, a.line || chr(10) || b.line || chr(10) || c.line AS t
  FROM l a JOIN l b ON b.doc_id = a.doc_id AND b.p = a.p + 1 JOIN l c ON c.doc_id = a.doc_id AND c.p = a.p + 2),
o AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, p) AS k FROM w),
c AS (SELECT DISTINCT doc_id, p + unnest(range(3)) AS p FROM o WHERE k > 1)
SELECT l.doc_id, count(*) AS n_lines, count(c.p) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY l.p) FILTER (c.p IS NULL), '') AS text
FROM l LEFT JOIN c ON c.doc_id = l.doc_id AND c.p = l.p GROUP BY l.doc_id
"""
