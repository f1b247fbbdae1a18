"""Toxicity by a support vector machine over a subsequence string kernel with Nystroem landmarks.

Token kernel: the gap-weighted subsequence kernel.  A token, between a start and an end mark, has a feature for each
subsequence of three characters that lies within SPAN places, weighted DECAY for each place skipped and summed over its
occurrences; k(s, t) is the cosine of two tokens' features.  Gaps tolerate inserted and dropped characters; look-alike digits
count as letters, other characters are left out, and runs of single characters are read as one token.
Text kernel: K(X, Y) = sum of k(s, t) ** POWER over the distinct tokens s of X and t of Y.  Powers and sums of a positive
semidefinite kernel are positive semidefinite, so K is.

Nystroem: landmarks Z are texts of one token each: tokens that stand in toxic training rows far more than in clean ones, the
clean tokens nearest to these, and the commonest clean tokens.  The features of a text are K(Z, Z) ** -1/2 K(Z, X), without
directions whose eigenvalue is under EIGEN of the largest.  The machine has squared hinge loss on them and is solved by
Newton steps; a sigmoid fitted on out-of-fold margins turns margins into scores.  A text's margin is a sum over its distinct
tokens, so a worker resolves each distinct token once in its life; sums are of whole numbers (2**-32), in any order alike.

Training uses at most MOST labelled rows of either class, the first in hash order, in one task; landmarks, weights and
sigmoid are all that reaches the driver.  Rows whose crc32(id as text) mod 3 is 1 are never trained on.  Conflicting labels
of an id: toxic wins.  Without both classes the score is 0 for all.  Nulls: a null text counts as empty and is scored; null
labels don't count.  Repeated rows are scored alike.  Empty table: empty result.  Only id and text are read.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import body, table, text_batches
from .words import SPACE, Values, classes, code_points, lifelong, ranges

SPAN, DECAY, POWER = 5, 0.6, 3
TOXIC, NEAR, COMMON = 128, 64, 64
RIDGE, EIGEN = 100.0, 1e-6
MOST = 3_000
SLICE = 700_000
#: Distinct tokens whose parts a worker process keeps.
KEPT = 600_000
UNIT = float(1 << 32)
START, END = "\x01", "\x02"
_GAPS = [(a, b, b - 2) for b in range(2, SPAN) for a in range(1, b)]
_WEIGHTS = DECAY ** np.arange(4)
_LIKE = str.maketrans("013457@$", "oieastas")


def clean(token: str) -> str:
    """Lower-case letters of a token, look-alikes read as letters unless it has no letter at all."""
    token = token.lower()
    if token.isalpha():
        return token
    return "".join(c for c in token.translate(_LIKE) if c.isalpha()) if any(c.isalpha() for c in token) else ""


def spans(cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens between white space, and runs of three or more tokens of one character as tokens of their own."""
    space = np.concatenate([[True], classes()[cps] == SPACE])
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return starts, ends
    one = ends - starts == 1
    joined = one.copy()
    joined[1:] &= one[:-1] & (starts[1:] - ends[:-1] == 1) & (cps[np.maximum(starts[1:] - 1, 0)] != 10)
    joined[0] = False
    head = np.flatnonzero(~joined)
    length = np.diff(np.append(head, len(joined)))
    run = head[length >= 3]
    last = (head + length - 1)[length >= 3]
    s, e = np.concatenate([starts, starts[run]]), np.concatenate([ends, ends[last]])
    order = np.argsort(s, kind="stable")
    return s[order], e[order]


def features(tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens' features of length 1: token number, code (three code points), weight; by token, then code."""
    text = "".join(START + t + END for t in tokens)
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    alphabet, small = np.unique(cps, return_inverse=True)
    n, bits = len(cps), max(int(len(alphabet) - 1).bit_length(), 1)
    owner = np.repeat(np.arange(len(tokens), dtype=np.uint64), [len(t) + 2 for t in tokens])
    if 3 * bits + 2 + int(len(tokens)).bit_length() > 64:  # too many different characters for one key
        half = len(tokens) // 2
        parts = features(tokens[:half]), features(tokens[half:])
        return tuple(np.concatenate([p, q + half if k == 0 else q]) for k, (p, q) in enumerate(zip(*parts, strict=True)))
    small, b = small.astype(np.uint64), np.uint64(bits)
    keys = []
    for x, y, w in _GAPS:  # one number a feature: token, code, weight
        if n > y:
            ok = owner[: n - y] == owner[y:]
            keys.append(((((owner[: n - y] << b | small[: n - y]) << b | small[x : n - y + x]) << b | small[y:]) << np.uint64(2) | np.uint64(w))[ok])
    key = np.sort(np.concatenate(keys))
    weight, key = _WEIGHTS[(key & np.uint64(3)).astype(np.int64)], key >> np.uint64(2)
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    weight, key = np.add.reduceat(weight, at) if len(at) else weight, key[at]
    low = np.uint64((1 << bits) - 1)
    owner = (key >> (b * np.uint64(3))).astype(np.int64)
    a, c, d = (alphabet[(key >> (b * np.uint64(k)) & low).astype(np.int64)].astype(np.int64) for k in (2, 1, 0))
    norm = np.sqrt(np.bincount(owner, weight * weight, len(tokens)))
    return owner, a << 42 | c << 21 | d, weight / norm[owner]


_MIX, _SLOTS = np.uint64(0x9E3779B97F4A7C15), 20


def _slot(code: np.ndarray) -> np.ndarray:
    return (code.view(np.uint64) * _MIX >> np.uint64(64 - _SLOTS)).astype(np.int64)


class Landmarks:
    """Token kernels with fixed landmarks."""

    def __init__(self, tokens: list[str]) -> None:
        self.tokens = tokens
        owner, code, weight = features(tokens)
        order = np.lexsort((owner, code))
        self.codes, first = np.unique(code[order], return_index=True)
        self.first, self.many = first, np.diff(np.append(first, len(order)))  # each code's places in the lists below
        self.owner, self.weight = owner[order], weight[order]
        self.seen = np.zeros(1 << _SLOTS, bool)
        self.seen[_slot(self.codes)] = True

    def kernel(self, tokens: list[str]) -> np.ndarray:
        """k(token, landmark) ** POWER."""
        m, out = len(self.tokens), np.zeros((len(tokens), len(self.tokens)))
        for k in range(0, len(tokens), 1024):
            owner, code, weight = features(tokens[k : k + 1024])
            hit = np.flatnonzero(self.seen[_slot(code)])
            at = np.minimum(np.searchsorted(self.codes, code[hit]), len(self.codes) - 1)
            same = self.codes[at] == code[hit]
            hit, at = hit[same], at[same]
            many = self.many[at]
            to = ranges(self.first[at], many)
            n = min(1024, len(tokens) - k)
            sums = np.bincount(np.repeat(owner[hit] * m, many) + self.owner[to], np.repeat(weight[hit], many) * self.weight[to], n * m)
            out[k : k + n] = sums.reshape(n, m)
        return out**POWER


def _tokens(text: str) -> set[str]:
    joined, cps, _ = code_points([text])
    return {t for t in (clean(joined[s:e]) for s, e in zip(*map(np.ndarray.tolist, spans(cps)), strict=True)) if len(t) > 2}


def choose(sets: list[set[str]], toxic: np.ndarray) -> list[str]:
    """Landmarks: TOXIC tokens by toxic texts less four times the clean ones (in proportion), the NEAR clean tokens nearest
    to them, and the COMMON commonest of the others.
    """
    dirty, clear = Counter(), Counter()
    for tokens, y in zip(sets, toxic, strict=True):
        (dirty if y else clear).update(tokens)
    scale = max(int(toxic.sum()), 1) / max(int((~toxic).sum()), 1)
    good = {t for t, k in dirty.items() if k > 1 and k > 4 * scale * clear[t] + 1}
    chosen = sorted(good, key=lambda t: (4 * scale * clear[t] - dirty[t], -len(t), t))[:TOXIC]
    if not chosen:
        return []
    others = sorted(t for t, k in clear.items() if t not in good and dirty[t] <= 2 * scale * k + 1)
    land = Landmarks(chosen)
    like = np.concatenate([land.kernel(others[k : k + 8192]).max(1) for k in range(0, len(others), 8192)]) if others else np.zeros(0)
    near = [others[i] for i in np.argsort(-like, kind="stable")[:NEAR]]
    rest = sorted(set(others) - set(near), key=lambda t: (-clear[t], t))
    return chosen + near + rest[:COMMON]


def text_kernel(land: Landmarks, sets: list[set[str]]) -> np.ndarray:
    """K(text, landmark) of texts given as sets of tokens."""
    number: dict[str, int] = {}
    pairs = [(number.setdefault(t, len(number)), i) for i, tokens in enumerate(sets) for t in sorted(tokens)]
    word, text = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
    order = np.argsort(word, kind="stable")
    word, text, every = word[order], text[order], list(number)
    out = np.zeros((len(sets), len(land.tokens)))
    for k in range(0, len(every), 8192):
        kernel = land.kernel(every[k : k + 8192])
        a, b = np.searchsorted(word, [k, k + 8192])
        part = np.argsort(text[a:b], kind="stable") + a
        for c in range(0, len(part), 8192):
            some = part[c : c + 8192]
            who, first = np.unique(text[some], return_index=True)
            out[who] += np.add.reduceat(kernel[word[some] - k], first)
    return out


def root_inverse(kernel: np.ndarray) -> np.ndarray:
    """K ** -1/2 on the directions whose eigenvalue is at least EIGEN of the largest."""
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    on = values >= EIGEN * values[-1]
    return (vectors[:, on] / np.sqrt(values[on])) @ vectors[:, on].T


def solve(x: np.ndarray, y: np.ndarray, ridge: float | None = None, rounds: int = 30) -> np.ndarray:
    """Squared-hinge machine with bias (the last weight) by Newton steps; classes weigh alike.  y: +1, -1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y > 0, 1 / max((y > 0).sum(), 1), 1 / max((y < 0).sum(), 1)) * len(y) / 2
    keep = np.full(x.shape[1], RIDGE if ridge is None else ridge)
    keep[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        on = y * (x @ w) < 1
        a = x[on] * weight[on, None]
        then = np.linalg.solve(a.T @ x[on] + np.diag(keep), a.T @ y[on])
        if np.abs(then - w).max() < 1e-7:
            break
        w = then
    return w


def sigmoid_fit(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's scale and shift for margins, by Newton steps with his smoothed targets."""
    up, down = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * m + b, -35, 35)))
        g = np.array([((p - t) * m).sum(), (p - t).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * m * m).sum() + 1e-6, (v * m).sum()], [(v * m).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        a, b = a - step[0], b - step[1]
    return max(a, 1e-3), b


class Model:
    """Landmark tokens, their weights, bias and sigmoid; without tokens every score is 0."""

    def __init__(self, texts: list[str], toxic: list[int]) -> None:
        y, sets = np.array(toxic, bool), [_tokens(t) for t in texts]
        self.tokens = choose(sets, y) if y.any() and not y.all() else []
        if not self.tokens:
            return
        land = Landmarks(self.tokens)
        root = root_inverse(land.kernel(self.tokens))
        x, sign = text_kernel(land, sets) @ root, np.where(y, 1.0, -1.0)
        fold = np.arange(len(y)) % 5
        margins = np.zeros(len(y))
        for k in range(5):
            if y[fold != k].any() and not y[fold != k].all():
                w = solve(x[fold != k], sign[fold != k])
                margins[fold == k] = x[fold == k] @ w[:-1] + w[-1]
        w = solve(x, sign)
        self.weights, self.bias = root @ w[:-1], float(w[-1])
        self.scale, self.shift = map(float, sigmoid_fit(margins, sign))


class Scorer:
    """Scores of whole texts; keeps the parts that distinct tokens add to a margin."""

    def __init__(self, model: Model) -> None:
        self.model = model
        if model.tokens:
            self.land, self.words = Landmarks(model.tokens), Values(np.int64, KEPT, 12 * KEPT)

    def parts(self, tokens: list[str]) -> np.ndarray:
        """What each token adds, in units of 1 / UNIT; tokens of less than three letters nothing."""
        plain = [clean(t) for t in tokens]
        some = np.flatnonzero(np.fromiter(map(len, plain), np.int64, len(plain)) > 2)
        out = np.zeros(len(tokens), np.int64)
        for k in range(0, len(some), 8192):
            at = some[k : k + 8192]
            out[at] = np.rint(self.land.kernel([plain[i] for i in at]) @ self.model.weights * UNIT)
        return out

    def __call__(self, texts: list[str]) -> np.ndarray:
        m = self.model
        if not m.tokens:
            return np.zeros(len(texts))
        joined, cps, at = code_points(texts)
        starts, ends = spans(cps)
        total = np.zeros(len(texts), np.int64)
        if len(starts):
            resolve = lambda new: self.parts([joined[s:e] for s, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            numbers = self.words.find(cps, starts, ends, resolve)
            text = np.searchsorted(at, starts, "right") - 1
            some = np.flatnonzero(self.words.values[numbers])
            pairs = np.unique(text[some] << 32 | numbers[some])
            np.add.at(total, pairs >> 32, self.words.values[pairs & 0xFFFFFFFF])
        return 1 / (1 + np.exp(-np.clip(m.scale * (total / UNIT + m.bias) + m.shift, -35, 35)))


def _scorer(model: bytes) -> Scorer:
    """One for the life of a worker process."""
    return lifelong(model, lambda: Scorer(pickle.loads(model)))  # noqa: S301  made by `fit`


def _fit(batches):
    import pyarrow as pa

    rows = sorted(((i, text, y) for b in batches for i, text, y in zip(*map(pa.Array.to_pylist, b.columns), strict=True)), key=lambda r: (str(r[0]), r[1]))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Model([r[1] for r in rows], [r[2] for r in rows]))], pa.binary())], names=["model"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most: int = MOST) -> bytes:
    """A pickled Model from at most `most` labelled rows of either class, fitted in one task."""
    ids = F.col(id_col)
    known = labels.select(ids.alias("_id"), F.col(label_col).cast("int").alias("_y")).filter("_id IS NOT NULL AND _y IN (0, 1)").filter(F.crc32(F.col("_id").cast("string")) % 3 != 1)
    known = known.groupBy("_id").agg(F.max("_y").alias("_y"))
    up, down = (known.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(most) for y in (1, 0))
    found = docs.select(ids.alias("_id"), body(text_col).alias("_text")).join(F.broadcast(up.union(down)), "_id")  # 2 * most rows
    made = found.select("_id", "_text", "_y").coalesce(1).mapInArrow(_fit, "model binary").first()
    return made["model"] if made else pickle.dumps(Model([], []))


def score(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id and score (0 to 1)."""

    def run(batches):
        import pyarrow as pa

        scorer = _scorer(model)
        for batch in text_batches(batches, "text", SLICE):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer(batch.column(1).to_pylist()), pa.float64())], names=["_id", "score"])

    rows = docs.select(F.col(id_col).alias("_id"), body(text_col).alias("text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, score double").withColumnRenamed("_id", id_col)


def with_score(docs: DataFrame, model: bytes, into: str = "toxicity", text_col: str = "text") -> DataFrame:
    """`docs` with a column `into`: the score of each row's text."""

    @F.pandas_udf(DoubleType())
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _scorer(model)
        for texts in batches:
            cut = np.cumsum(texts.str.len().to_numpy()) // SLICE
            yield pd.concat([pd.Series(scorer(part.tolist())) for _, part in texts.groupby(cut)], ignore_index=True) if len(texts) else pd.Series([], dtype=float)

    return docs.withColumn(into, scores(body(text_col)))


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
