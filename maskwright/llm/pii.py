"""Personal data: patterns propose spans, checksums confirm them, context words near by adjust the score.

Base kinds (email, ip, card, phone) are fixed patterns with fixed checks; they always stay.  Added kinds start from a
score of their own: iban needs a mod-97 checksum; national (three-two-four digits) and local (a phone number without
country code) need a context word within CONTEXT characters.  An added span that overlaps a base span is dropped.

All patterns run in time linear in the text.  Nulls: a null text counts as empty and stays null when redacted.  Repeated
rows and ties are separate rows.  Empty table: empty result.  The operator adds one column to the frame, under a name
that the caller may choose.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import body, table

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "national", "local")
KINDS = BASE + ADDED
CONTEXT = 40
THRESHOLD = 0.5

_HOST = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NUMBER = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_NEAR = {
    "iban": re.compile(r"iban|bank|account|konto|compte|cuenta", re.I),
    "national": re.compile(r"ssn|social security|national id|tax id|passport", re.I),
    "local": re.compile(r"phone|call|tel\b|tel:|mobile|fax|telefon|téléphone|teléfono", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _iban_end(code: str) -> int:
    """Length of the longest cut of `code`, at a blank or its end, that the checksum confirms; 0 if there is none.

    15 to 34 characters without blanks, as the pattern has it.
    """
    while len(code.replace(" ", "")) >= 15:
        if mod97(code):
            return len(code)
        code = code[: max(code.rfind(" "), 0)]
    return 0


def _ibans(text: str):
    """Spans that the checksum confirms; after one, or one character after a place without, the search goes on."""
    at = 0
    while m := _IBAN.search(text, at):
        end = m.start() + _iban_end(m[0])
        if end > m.start():
            yield m.start(), end
        at = max(end, m.start() + 1)


def _spans_of(pattern: re.Pattern):
    return lambda text: ((m.start(), m.end()) for m in pattern.finditer(text))


def _emails(text: str):
    end = 0
    for m in _HOST.finditer(text):
        at = start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            end = m.end()
            yield start, end


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _digits(m: str) -> str:
    return "".join(c for c in m if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if "." in text:
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def added_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, float]]:
    out, taken = [], []  # base spans, joined where they overlap
    for _, s, e in sorted(base, key=lambda x: x[1]):
        if taken and s < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
        else:
            taken.append((s, e))
    for kind, spans, score, check in (("iban", _ibans, 0.3, True), ("national", _spans_of(_NATIONAL), 0.2, False), ("local", _spans_of(_NUMBER), 0.2, False)):
        for s, e in spans(text):
            i = bisect.bisect_left(taken, (e,)) - 1  # the last that starts before e
            if i >= 0 and taken[i][1] > s:
                continue
            near = bool(_NEAR[kind].search(text, max(0, s - CONTEXT), s) or _NEAR[kind].search(text, e, e + CONTEXT))
            if (total := score + 0.4 * check + 0.4 * near) >= THRESHOLD:
                out.append((kind, s, e, total))
    return out


def find(text: str) -> list[tuple[str, int, int, float]]:
    """All spans (kind, start, end, score) by kind as in KINDS, then start; code points, end exclusive."""
    base = base_spans(text)
    return [(*x, 1.0) for x in base] + added_spans(text, base)


@F.pandas_udf(StringType())
def _spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([",".join(f"{k}:{s}:{e}:{x:.2f}" for k, s, e, x in find(t)) for t in texts])


def redacted(text: str) -> str:
    """Each span becomes [KIND]; of overlapping spans the first by start, then the longest, is taken first."""
    out, at = [], 0
    for kind, s, e, _ in sorted(find(text), key=lambda x: (x[1], -x[2])):
        if e > at:
            out += [text[at:s], f"[{kind.upper()}]"] if s >= at else []
            at = e
    return "".join(out) + text[at:] if out else text


@F.pandas_udf(StringType())
def _redacted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([None if t is None else redacted(t) for t in texts], dtype=object)


def find_pii(docs: DataFrame, text_col: str = "text", into: str = "pii") -> DataFrame:
    """`docs` with a column `into`: array<struct<kind, start, end, score>>, by kind, then start."""
    raw = F.transform(F.filter(F.split(_spans(body(text_col)), ","), lambda x: x != ""), lambda x: F.split(x, ":"))
    return docs.withColumn(into, F.transform(raw, lambda x: F.struct(x[0].alias("kind"), x[1].cast("long").alias("start"), x[2].cast("long").alias("end"), x[3].cast("double").alias("score"))))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return docs.withColumn(text_col, _redacted(F.col(text_col)))


def query(spark, sf_dir):
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda x: x["kind"].isin(*BASE))
    names = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(names(base), 256).alias("base_sha256"), names(F.col("pii")).alias("spans"))
