"""Text functions: SQL expressions where they suffice, vectorised Python where positions or case rules need it."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .. import adapters as A

# Word lists and patterns that decide results.
IRREGULAR = {"children": "child", "feet": "foot", "men": "man", "people": "person", "teeth": "tooth", "women": "woman"}
PLURAL_ONLY = ("eyeglasses", "glasses", "jeans", "pants", "shorts", "sunglasses", "trousers")
PLURALS = {"child": "children", "foot": "feet", "man": "men", "mouse": "mice", "person": "people", "tooth": "teeth", "woman": "women"}
BACKGROUND = ("background", "backdrop", "foreground", "scene", "setting", "surrounding", "surroundings")
VIEWS = ("close-up", "closeup", "frame", "image", "photo", "photograph", "picture", "view")
MASK_TERMS = ("black area", "masked area", "removed area", "silhouette")
LEADING_VIEW = r"^\s*(?:an?\s+|the\s+)?(?:close[- ]?up(?:\s+view)?|cropped\s+view|detailed\s+view|image|photo(?:graph)?|picture|view)\s+(?:of|showing|depicting)\s+"
CLAUSES = (
    r"\s*,?\s*(?:set|shown|seen|standing|sitting|placed|positioned|displayed)?\s*(?:against|before|on|over|in\s+front\s+of)\s+(?:(?:an?|the)\s+)?[^,.;]{0,64}?\b(?:background|backdrop)\b[^,.;]*",
    r"\s*,?\s*(?:with|featuring|showing)\s+(?:(?:an?|the)\s+)?[^,.;]{0,64}?\b(?:background|backdrop)\b[^,.;]*",
    r"\s*,?\s*(?:surrounded\s+by|amid|among)\s+[^,.;]+",
    r"\s*,?\s*(?:shown|seen|viewed|pictured)\s+(?:from|in|at)\s+[^,.;]{0,48}?\bview\b[^,.;]*",
    r"\s*,?\s*(?:in|within)\s+(?:(?:an?|the|this)\s+)?(?:image|photo(?:graph)?|picture|frame|scene)\b[^,.;]*",
)
PUNCTUATION = ((r"\s+([,.;:!?])", "$1"), (r",\s*([.;])", "$1"), (r"\s*,\s*$", ""), (r"(?i)\b(?:and|with|while|against)\s*$", ""))
OWNERS = {"her": ("woman", "girl"), "his": ("man", "boy")}
INPUT_LIMITS = (r"at most\s+\d+\s+image\(s\) may be provided", r"maximum context length", r"longer than the maximum model length")


def _case(pairs: dict[str, str], value: Column, other: Column) -> Column:
    out = None
    for k, v in pairs.items():
        out = (F if out is None else out).when(value == k, v)
    return out.otherwise(other)


def term(value: Column) -> Column:
    """A noun in a lookup form: lower case, single blanks, singular at its end."""
    v = F.regexp_replace(F.replace(F.regexp_replace(F.lower(F.trim(value)), r"[_\s]+", " "), F.lit("-"), F.lit(" ")), r"\s+", " ")
    stem = F.when(v.isin(*PLURAL_ONLY), v).when(v.endswith("ies") & (F.length(v) > 4), F.concat(F.left(v, F.length(v) - 3), F.lit("y"))).when(v.endswith("s") & (F.length(v) > 3) & ~v.endswith("ss"), F.left(v, F.length(v) - 1)).otherwise(v)
    return _case(IRREGULAR, v, stem)


def head(value: Column) -> Column:
    return F.substring_index(value, " ", -1)


def pluralized(noun: Column) -> Column:
    """The plural of a noun phrase's last word."""
    h = head(noun)
    regular = (
        F.when(h.rlike("(?:s|x|z|ch|sh)$"), F.concat(h, F.lit("es"))).when(h.rlike("[^aeiou]y$"), F.concat(F.left(h, F.length(h) - 1), F.lit("ies"))).otherwise(F.concat(h, F.lit("s")))
    )
    return F.concat(F.left(noun, F.length(noun) - F.length(h)), _case(PLURALS, h, regular))


def is_plural(surface: Column) -> Column:
    s, h = F.lower(surface), head(F.lower(surface))
    return s.isin(*PLURAL_ONLY) | h.isin(*IRREGULAR) | (h.endswith("s") & ~h.rlike("(?:ss|us|is)$"))


def punctuated(text: Column) -> Column:
    """White space, punctuation, a trailing connective, capital and final period put right."""
    t = F.trim(F.regexp_replace(text, r"\s+", " "))
    for pattern, to in PUNCTUATION:
        t = F.regexp_replace(t, pattern, to)
    return _sentence(F.regexp_replace(t, r"^[ ,]+|[ ,]+$", ""))


def _sentence(t: Column) -> Column:
    return F.when(t == "", "").otherwise(F.concat(F.upper(F.left(t, F.lit(1))), F.substr(t, F.lit(2)), F.when(t.rlike(r"[.!?]$"), "").otherwise(".")))


def tidied(text: str) -> str:
    """`punctuated` before capital and final period, in Python, where a column would be worked out for each time it is named."""
    text = _BLANKS.sub(" ", text).strip(" ")
    for pattern, to in _TIDY:
        text = pattern.sub(to, text)
    return _ENDS.sub("", text)


def _java(pattern: str) -> re.Pattern:
    """A pattern as Java reads it: blanks and cases of ASCII, word bounds of Unicode, the end before a last line separator too."""
    return re.compile(pattern.replace(r"\b", r"(?<![^\W_]|_)" if pattern.startswith("(?i)") else r"\b").replace(r"\s", r"[ \t\n\x0b\f\r]").replace("$", "(?=[\u0085\u2028\u2029]?\\Z)").replace("(?:and|with|while|against)", "(?:[aA][nN][dD]|[wW][iI][tT][hH]|[wW][hH][iI][lL][eE]|[aA][gG][aA][iI][nN][sS][tT])").removeprefix("(?i)"))


_BLANKS, _ENDS = _java(r"\s+"), _java(r"^[ ,]+|[ ,]+$")
_TIDY = [(_java(p), to.replace("$", "\\")) for p, to in PUNCTUATION]


def _clauses(flags: int) -> list[tuple]:
    """Of each clause pattern: the words before its core that may belong to it, the core, and words of which it needs one."""
    words, out = r"(?:set|shown|seen|standing|sitting|placed|positioned|displayed)", []
    for c, need in zip(CLAUSES, (("back",), ("back",), ("surrounded", "amid", "among"), ("view",), ("image", "photo", "picture", "frame", "scene")), strict=True):
        core = c.removeprefix(r"\s*,?\s*")
        own = core.startswith(words + r"?\s*")
        out.append((re.compile(words + r"\Z", flags) if own else None, re.compile(core.removeprefix(words + r"?\s*") if own else core, flags), need))
    return out


def _blank_before(text: str, at: int) -> int:
    while at and text[at - 1].isspace():
        at -= 1
    return at


def without_clauses(text: str) -> tuple[str, list[str]]:
    """A caption without view preamble and background clauses, each pattern applied until it is gone; and what was taken out, in order.

    A clause is found by its core; the blanks, comma and word before it are looked for to its left.  After a cut the search goes on
    at the last of [,.;] before it, which no core contains.  ASCII texts are searched in lower case, if a needed word is in them.
    """
    out = []
    if m := _LEAD.match(text):
        out, text = [f"removed crop/view preamble: {m[0].strip()}"], text[m.end() :]
    plain = text.isascii()
    hay = text.lower() if plain else text
    for word, core, need in _PLAIN if plain else _ANY_CASE:
        if plain and not any(w in hay for w in need):
            continue
        at = 0
        while m := core.search(hay, at):
            start = _blank_before(hay, m.start())
            if word and (w := word.search(hay, max(0, start - 10), start)):
                start = _blank_before(hay, w.start())
            if start and hay[start - 1] == ",":
                start = _blank_before(hay, start - 1)
            out.append(f"removed background/view clause: {text[start : m.end()].strip()}")
            text, hay = text[:start] + text[m.end() :], hay[:start] + hay[m.end() :]
            at = max(hay.rfind(c, 0, start) for c in ",.;") + 1
    return text, out


_LEAD, _PLAIN, _ANY_CASE = re.compile(LEADING_VIEW, re.I), _clauses(0), _clauses(re.I)


@F.pandas_udf(StructType([StructField("caption", StringType()), StructField("corrections", ArrayType(StringType()))]))
def _without_clauses(texts: pd.Series) -> pd.DataFrame:
    cut = [without_clauses(t or "") for t in texts]
    return pd.DataFrame([(tidied(t), out) for t, out in cut], columns=["caption", "corrections"])


def cleaned_caption(text: Column) -> Column:
    """struct(original, caption, changed, corrections, valid): view preamble and background clauses removed (no parser: pattern core only)."""
    original = F.trim(F.coalesce(text, F.lit("")))
    cut = _without_clauses(original)
    caption = _sentence(cut["caption"])
    return F.struct(original.alias("original"), caption.alias("caption"), (caption != original).alias("changed"), cut["corrections"].alias("corrections"), (caption != "").alias("valid"))


def cleaned_attributes(values: Column) -> Column:
    """Attributes without banned terms, trimmed, each once."""
    banned = F.array(*map(F.lit, BACKGROUND + VIEWS + MASK_TERMS))
    return F.array_distinct(F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: (v != "") & ~F.exists(banned, lambda b: F.contains(F.lower(v), b))))


def safe_id(value: Column) -> Column:
    v = F.regexp_replace(F.regexp_replace(value, r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when(v == "", "item").otherwise(v)


def sanitized_id(value: Column) -> Column:
    return F.regexp_replace(value, r"[^\p{L}\p{N}_-]", "_")


def identifier_variants(value: Column) -> Column:
    """raw, slashes put right, base name, stem, path without suffix; none is empty."""
    raw = F.trim(F.coalesce(value, F.lit("")))
    path = F.replace(raw, F.lit("\\"), F.lit("/"))
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    stem = F.regexp_replace(name, r"(?<=[^.])\.[^.]+$", "")
    bare = F.when(stem != name, F.left(path, F.length(path) - (F.length(name) - F.length(stem))))
    return F.filter(F.array_distinct(F.array(raw, path, name, stem, bare)), lambda v: v.isNotNull() & (v != ""))


def member_key(path: Column) -> Column:
    return F.struct(F.regexp_replace(path, r"\.[^./]*$", "").alias("stem"), F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1)).alias("suffix"))


def tokens(value: Column, stop: tuple[str, ...] = ("a", "an", "and", "in", "of", "on", "the", "with")) -> Column:
    return F.array_except(F.regexp_extract_all(F.lower(value), F.lit("[a-z]+"), F.lit(0)), F.array(*map(F.lit, stop)))


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.size(F.array_union(a, b)))


def possessive(owner: Column) -> Column:
    words = F.regexp_extract_all(F.lower(owner), F.lit("[a-z]+"), F.lit(0))
    out = F
    for pronoun, nouns in OWNERS.items():
        out = out.when(F.arrays_overlap(words, F.array(*map(F.lit, nouns))), pronoun)
    return out.otherwise("their")


def not_gibberish(text: Column) -> Column:
    """Not blank, eight characters or more, printable but for 2 % (line feeds and tabs are not), and no word that dominates."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    runs = F.aggregate(
        F.array_sort(words), F.struct(F.lit("").alias("w"), F.lit(0).alias("n"), F.lit(0).alias("most")),
        lambda acc, x: F.struct(x.alias("w"), F.when(x == acc["w"], acc["n"] + 1).otherwise(1).alias("n"), F.greatest(acc["most"], F.when(x == acc["w"], acc["n"] + 1).otherwise(1)).alias("most")),
    )
    printable = F.length(F.regexp_replace(text, r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Zs}\p{Zl}\p{Zp}&&[^ ]]", "")) / F.greatest(F.lit(1), F.length(text))
    return text.rlike(r"[^\s]") & (F.length(text) >= 8) & (printable >= 0.98) & (runs["most"] < F.greatest(F.lit(20.0), 0.55 * F.size(words)))


def input_limit_error(error: Column, cause: Column | None = None) -> Column:
    """The error's text if it, or what caused it, says that a request is too large; else null."""
    both = F.concat_ws("\n", error, cause) if cause is not None else F.coalesce(error, F.lit(""))
    return F.when(both.rlike("(?i)" + "|".join(INPUT_LIMITS)), error)


@F.pandas_udf(ArrayType(IntegerType()))
def occurrences(texts: pd.Series, needles: pd.Series) -> pd.Series:
    """All 0-based places of a substring, overlapping ones too (code points); none where either is null or empty."""

    def places(text: str | None, needle: str | None) -> list[int]:
        out, at = [], text.find(needle) if text and needle else -1
        while at >= 0:
            out.append(at)
            at = text.find(needle, at + 1)
        return out

    return pd.Series([places(t, n) for t, n in zip(texts, needles, strict=True)], dtype=object)


@F.pandas_udf(StringType())
def sentence_case(texts: pd.Series) -> pd.Series:
    """Upper-case sentence starts without moving offsets."""
    start = re.compile(r"(^\s*|[.!?]\s+)(\w)")
    up = lambda m: m[1] + (m[2].upper() if len(m[2].upper()) == 1 else m[2])
    return texts.map(lambda t: None if t is None else start.sub(up, t))


def fill(template: str, values: dict[str, Column]) -> Column:
    """Literal {key} substitution."""
    out = F.lit(template)
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), F.coalesce(v.cast("string"), F.lit("")))
    return out


def paired_text(values: Column) -> Column:
    """Captions in key order: blanks put right, each once, eight at most."""
    tidy = F.transform(F.filter(values, lambda v: v.isNotNull()), lambda v: F.trim(F.regexp_replace(v, r"\s+", " ")))
    return F.slice(F.array_distinct(F.filter(tidy, lambda v: v != "")), 1, 8)


def _words(s, d) -> DataFrame:
    """First and last word of each document, and its whole text."""
    w = F.split(F.col("text"), " ")
    return A.table(s, d, "documents").select("doc_id", F.lower(F.regexp_replace(F.slice(w, 1, 1)[0], "[^A-Za-z]", "")).alias("w1"), F.regexp_replace(F.element_at(w, -1), "[^A-Za-z]", "").alias("w2"), F.col("text").alias("t"))


def _every_word(s, d) -> DataFrame:
    """Each word of each text, letters only, with its place; `p` is a phrase of it."""
    w = F.split(F.regexp_replace("text", "[^A-Za-z ]", ""), " +")
    t = A.table(s, d, "documents").select("doc_id", F.posexplode(w).alias("at", "word")).filter("word <> ''")
    noun = F.when(F.col("at") % 7 == 0, "children").when(F.col("at") % 7 == 1, "Puppies").when(F.col("at") % 7 == 2, "glass").when(F.col("at") % 7 == 3, "old man").otherwise(F.col("word"))
    return t.withColumn("p", F.concat_ws(" ", "word", noun))


def _terms(s, d):
    last = head(F.col("p"))
    return _every_word(s, d).select("doc_id", "at", term(F.col("p")).alias("term"), term(last).alias("head_term"), pluralized(F.lower("p")).alias("plural"), is_plural(F.col("p")).alias("is_plural"), possessive(F.col("p")).alias("owner"))


def _captions(s, d):
    t = F.concat(F.lit("a photo of "), F.regexp_replace("t", "[^A-Za-z ]", ""), F.when(F.col("doc_id") % 2 == 0, " standing against a plain background").otherwise(" , and"))
    return _words(s, d).select("doc_id", cleaned_caption(t).alias("c")).select("doc_id", "c.caption", "c.changed", "c.valid", F.size("c.corrections").alias("corrections"))


def _tokens(s, d):
    both = tokens(F.concat("w1", F.lit(" "), "w2"))
    return _words(s, d).select("doc_id", F.array_join(F.array_sort(tokens(F.col("t"))), " ").alias("tokens"), F.round(jaccard(tokens(F.col("t")), both), 6).alias("jaccard"))


def _occurrences(s, d):
    return _words(s, d).select("doc_id", F.array_join(occurrences(F.col("t"), F.left("t", F.lit(2))), ",").alias("at"))


def _paired(s, d):
    return _words(s, d).select("doc_id", F.array_join(paired_text(F.array("t", F.concat("t", F.lit("  ")), "w1", F.lit(None).cast("string"), "w2")), "|").alias("texts"))


def _idents(s, d):
    url = F.regexp_replace("url", "[?#].*$", "")
    t = A.table(s, d, "pages")
    return t.select("page_id", F.array_join(F.array_sort(identifier_variants(url)), "|").alias("variants"), safe_id(url).alias("safe"), member_key(url)["suffix"].alias("suffix"))


def _limits(s, d):
    """Errors that quote each document's text; every third is a limit, some only by what caused them."""
    t = F.col("text")
    error = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("At most "), F.col("doc_id").cast("string"), F.lit(" image(s) may be provided: "), t)).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("failed on "), t)).otherwise(F.concat(F.lit("model load: "), t))
    cause = F.when(F.col("doc_id") % 6 == 1, F.lit("the prompt is LONGER than the maximum model length"))
    return A.table(s, d, "documents").select("doc_id", F.coalesce(F.length(input_limit_error(error, cause)), F.lit(-1)).alias("length"))


_W = """w AS (SELECT doc_id, lower(regexp_replace(string_split(text, ' ')[1], '[^A-Za-z]', '', 'g')) AS w1, regexp_replace(string_split(text, ' ')[-1], '[^A-Za-z]', '', 'g') AS w2, text AS t FROM documents)"""


def _sql_term(v: str) -> str:
    irregular = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
    plural = ", ".join(f"'{x}'" for x in PLURAL_ONLY)
    v = f"regexp_replace(replace(regexp_replace(lower(trim({v})), '[_\\s]+', ' ', 'g'), '-', ' '), '\\s+', ' ', 'g')"
    return f"CASE {v} {irregular} ELSE CASE WHEN {v} IN ({plural}) THEN {v} WHEN {v} LIKE '%ies' AND length({v}) > 4 THEN left({v}, length({v}) - 3) || 'y' WHEN {v} LIKE '%s' AND length({v}) > 3 AND {v} NOT LIKE '%ss' THEN left({v}, length({v}) - 1) ELSE {v} END END"


def _sql_clean(t: str) -> str:
    for p in (LEADING_VIEW, *CLAUSES):
        t = f"regexp_replace({t}, '{p}', '', 'gi')"
    t = f"trim(regexp_replace({t}, '\\s+', ' ', 'g'))"
    for p, to in (("\\s+([,.;:!?])", "\\1"), (",\\s*([.;])", "\\1"), ("\\s*,\\s*$", ""), ("\\b(?:and|with|while|against)\\s*$", "")):
        t = f"regexp_replace({t}, '{p}', '{to}', 'gi')"
    return f"regexp_replace({t}, '^[ ,]+|[ ,]+$', '', 'g')"


QUERIES = {
    "text_terms": _terms,
    "text_captions": _captions,
    "text_identifiers": _idents,
    "text_tokens": _tokens,
    "text_occurrences": _occurrences,
    "text_fill": lambda s, d: A.table(s, d, "labels").select("doc_id", fill("doc {doc_id}: q={quality} t={toxic}", {c: F.col(c) for c in ("doc_id", "quality", "toxic")}).alias("prompt")),
    "text_attributes": lambda s, d: A.table(s, d, "documents").select("doc_id", F.array_join(cleaned_attributes(F.split("text", r"[,.\n]")), "|").alias("attributes")),
    "text_paired": _paired,
    "text_gibberish": lambda s, d: A.table(s, d, "documents").select("doc_id", not_gibberish(F.col("text")).alias("ok")),
    "text_input_limits": _limits,
}
_L = "regexp_extract(lower(p), '([^ ]*)$', 1)"
ORACLES = {
    "text_terms": f"""WITH t AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS "at" FROM (SELECT doc_id, string_split_regex(regexp_replace(text, '[^A-Za-z ]', '', 'g'), ' +') AS w FROM documents)),
      q AS (SELECT doc_id, CAST("at" AS INT) AS "at", word || ' ' || CASE "at" % 7 WHEN 0 THEN 'children' WHEN 1 THEN 'Puppies' WHEN 2 THEN 'glass' WHEN 3 THEN 'old man' ELSE word END AS p FROM t WHERE word <> '') SELECT doc_id, "at", {_sql_term('p')} AS term, {_sql_term("regexp_extract(p, '([^ ]*)$', 1)")} AS head_term,
      left(lower(p), length(p) - length({_L})) || CASE {_L} {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in PLURALS.items())} ELSE CASE WHEN regexp_matches({_L}, '(s|x|z|ch|sh)$') THEN {_L} || 'es'
      WHEN regexp_matches({_L}, '[^aeiou]y$') THEN left({_L}, length({_L}) - 1) || 'ies' ELSE {_L} || 's' END END AS plural,
      lower(p) IN ({', '.join(f"'{x}'" for x in PLURAL_ONLY)}) OR {_L} IN ({', '.join(f"'{x}'" for x in IRREGULAR)}) OR ({_L} LIKE '%s' AND NOT regexp_matches({_L}, '(ss|us|is)$')) AS is_plural,
      CASE WHEN list_has_any(regexp_extract_all(lower(p), '[a-z]+'), ['woman', 'girl']) THEN 'her' WHEN list_has_any(regexp_extract_all(lower(p), '[a-z]+'), ['man', 'boy']) THEN 'his' ELSE 'their' END AS owner FROM q""",
    "text_captions": f"""WITH {_W}, q AS (SELECT doc_id, trim('a photo of ' || regexp_replace(t, '[^A-Za-z ]', '', 'g') || CASE WHEN doc_id % 2 = 0 THEN ' standing against a plain background' ELSE ' , and' END) AS o FROM w),
      c AS (SELECT doc_id, o, {_sql_clean('o')} AS t, 1 + (doc_id % 2 = 0)::INT AS n FROM q), f AS (SELECT doc_id, o, n, CASE WHEN t = '' THEN '' ELSE upper(left(t, 1)) || substr(t, 2) || CASE WHEN regexp_matches(t, '[.!?]$') THEN '' ELSE '.' END END AS caption FROM c)
      SELECT doc_id, caption, caption <> o AS changed, caption <> '' AS valid, CAST(n AS INT) AS corrections FROM f""",
    "text_identifiers": """WITH u AS (SELECT page_id, trim(regexp_replace(url, '[?#].*$', '')) AS raw FROM pages), n AS (SELECT *, regexp_extract(raw, '([^/]*)/*$', 1) AS name FROM u),
      s AS (SELECT *, CASE WHEN regexp_matches(name, '[^.]\\.[^.]+$') THEN regexp_replace(name, '\\.[^.]+$', '') ELSE name END AS stem FROM n)
      SELECT page_id, array_to_string(list_sort(list_filter(list_distinct([raw, name, stem, CASE WHEN stem <> name THEN left(raw, length(raw) - (length(name) - length(stem))) END]), lambda v: v <> '')), '|') AS variants,
      coalesce(nullif(regexp_replace(regexp_replace(raw, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'item') AS safe, lower(regexp_extract(raw, '(\\.[^./]*)$', 1)) AS suffix FROM s""",
    "text_tokens": f"""WITH {_W}, q AS (SELECT doc_id, list_distinct(list_filter(regexp_extract_all(lower(t), '[a-z]+'), lambda x: x NOT IN ('a', 'an', 'and', 'in', 'of', 'on', 'the', 'with'))) AS a,
      list_distinct(list_filter(regexp_extract_all(lower(w1 || ' ' || w2), '[a-z]+'), lambda x: x NOT IN ('a', 'an', 'and', 'in', 'of', 'on', 'the', 'with'))) AS b FROM w)
      SELECT doc_id, array_to_string(list_sort(a), ' ') AS tokens, round(len(list_intersect(a, b)) / greatest(1, len(list_distinct(list_concat(a, b)))), 6) AS jaccard FROM q""",
    "text_occurrences": f"""WITH {_W} SELECT doc_id, array_to_string(list_filter(range(0, length(t) - 1), lambda i: substr(t, i + 1, 2) = left(t, 2)), ',') AS at FROM w""",
    "text_fill": "SELECT doc_id, 'doc ' || doc_id || ': q=' || quality || ' t=' || toxic AS prompt FROM labels",
    "text_attributes": f"""WITH a AS (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '[,.\\n]'), lambda v: trim(v)), lambda v: v <> '' AND NOT regexp_matches(lower(v), '{"|".join(BACKGROUND + VIEWS + MASK_TERMS)}')) AS v FROM documents)
      SELECT doc_id, array_to_string(list_filter(v, lambda x, i: list_position(v, x) = i), '|') AS attributes FROM a""",
    "text_input_limits": """SELECT doc_id, CAST(CASE WHEN doc_id % 3 = 0 THEN length('At most ' || doc_id || ' image(s) may be provided: ' || text) WHEN doc_id % 6 = 1 THEN length('failed on ' || text) ELSE -1 END AS INT) AS length FROM documents""",
    "text_paired": f"""WITH {_W}, q AS (SELECT doc_id, list_filter([trim(regexp_replace(t, '\\s+', ' ', 'g')), w1, w2], lambda v: v <> '') AS v FROM w)
      SELECT doc_id, array_to_string(list_filter(v, lambda x, i: list_position(v, x) = i), '|') AS texts FROM q""",
    "text_gibberish": """WITH t AS (SELECT doc_id, text, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS w FROM documents), c AS (SELECT doc_id, w, count(*) AS n FROM t GROUP BY 1, 2),
      m AS (SELECT doc_id, max(n) AS most, sum(n) AS total FROM c GROUP BY 1)
      SELECT d.doc_id, regexp_matches(text, '\\S') AND length(text) >= 8 AND length(regexp_replace(replace(text, ' ', 'x'), '[\\p{C}\\p{Z}]', '', 'g')) / greatest(1, length(text)) >= 0.98 AND coalesce(most, 0) < greatest(20.0, 0.55 * coalesce(total, 0)) AS ok FROM documents d LEFT JOIN m USING (doc_id)""",
}
