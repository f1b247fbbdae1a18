"""Vectorised pre-tokenization: character classes, word spans and word hashes of whole slices of text in numpy.

Texts with characters whose class depends on the Unicode version, or with special-token strings, are told apart (`odd`);
callers send these through the tokenizer library's own splitter.  Words are looked up by a 64-bit hash; on each hit the word
itself is compared, character by character, so that words which share a hash are never taken for one another.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np

SPACE, LETTER, NUMBER, OTHER = range(4)
_WIDE = 0x110000


@functools.cache
def classes() -> np.ndarray:
    import regex

    out = np.full(_WIDE, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x30000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            lo, hi = ord(m[0][0]), ord(m[0][-1])
            out[lo : hi + 1] = kind
    return out


@functools.cache
def stable() -> np.ndarray:
    """Code points whose class is the same in every Unicode version in use; 03A3 has a lower case that depends on its place."""
    out = np.zeros(_WIDE, bool)
    for lo, hi in ((1, 0x530), (0x1E00, 0x1F00), (0x2010, 0x2030), (0x20A0, 0x20AD), (0x3041, 0x3095), (0x30A1, 0x30FB), (0x4E00, 0x9FA6), (0xAC00, 0xD7A4)):
        out[lo:hi] = True
    out[0x300:0x370] = False  # combining marks
    out[[0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0x3A3, 0x130]] = False
    return out


class Hash:
    """Hashes of spans: (H[end] - H[start]) / P**start over running sums H, modulo 2**64."""

    def __init__(self, alphabet: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.value = rng.integers(1, 1 << 63, alphabet, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.p = int(rng.integers(1 << 40, 1 << 62)) * 8 + 5
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            for name, base in (("up", self.p), ("down", pow(self.p, -1, 1 << 64))):
                row = np.full(n + n // 4 + 1, base & (1 << 64) - 1, np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))

    def spans(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(symbols) + 1)
        sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(self.value[symbols] * self.up[: len(symbols)], out=sums[1:])
        out = (sums[ends] - sums[starts]) * self.down[starts]
        return mixed(out + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def room(row: np.ndarray, n: int) -> np.ndarray:
    """`row`, or a longer copy of it with at least `n` places."""
    if n <= len(row):
        return row
    out = np.zeros(n + n // 2, row.dtype)
    out[: len(row)] = row
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range in turn."""
    return np.repeat(starts - (np.cumsum(lengths, dtype=np.int64) - lengths), lengths) + np.arange(int(lengths.sum()))


@functools.cache
def char_hash() -> Hash:
    return Hash(_WIDE)


def code_points(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts after one another, each followed by a line feed; their code points; where each text starts."""
    joined = "\n".join(texts) + "\n"
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return joined, cps, np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])


def odd_texts(cps: np.ndarray, at: np.ndarray) -> np.ndarray:
    bad = np.concatenate([[0], np.cumsum(~stable()[cps])])
    return bad[at[1:]] > bad[at[:-1]]


def _contractions(cps, kind, begin) -> tuple[np.ndarray, np.ndarray]:
    """Places of 's 't 'm 'd 're 've 'll that start a token: start, length."""
    i = np.flatnonzero((cps == 39) & begin)
    i = i[i + 2 < len(cps)]
    one = np.isin(cps[i + 1], [115, 116, 109, 100])
    a, b = cps[i + 1], cps[i + 2]
    two = ((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108))
    return i[one | two], np.where(one, 2, 3)[one | two]


def _cut(begin: np.ndarray, at: np.ndarray, length: np.ndarray) -> None:
    begin[at + 1] = False
    begin[at + length - 1] = False  # the second letter isn't a start
    begin[at + length] = True


def clip_spans(cps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of 's|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+ in lower-cased text."""
    kind = classes()[cps]
    begin = np.ones(len(cps) + 1, bool)
    begin[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    i, n = _contractions(cps, kind, begin[:-1])
    _cut(begin, i, n)
    edges = np.flatnonzero(begin)
    starts, ends = edges[:-1], edges[1:]
    words = kind[starts] != SPACE
    return starts[words], ends[words]


def byte_level_spans(cps: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ in each text, but for the line feeds after the texts."""
    kind = classes()[cps].copy()
    n = len(cps)
    stops = at[1:] - 1  # the line feed after each text
    kind[stops] = 9
    begin = np.ones(n + 1, bool)
    begin[1:-1] = kind[1:] != kind[:-1]
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & (kind[1:] < 9) & ~space[1:])  # of a run with a token after it
    begin[last] = True
    joins = last[cps[last] == 32]
    alone = np.ones(n + 1, bool)
    alone[joins + 1] = False
    i, length = _contractions(cps, kind, begin[:-1] & alone[:-1])
    begin &= alone
    if len(i):
        _cut(begin, i, length)
    edges = np.flatnonzero(begin)
    starts, ends = edges[:-1], edges[1:]
    real = kind[starts] < 9
    return starts[real], ends[real]


class Words:
    """Numbers of distinct words, each with a payload that `resolve` gives.  Bounded: beyond `most` words, or `most_chars`
    characters in them, it starts anew.
    """

    def __init__(self, most: int = 500_000, most_chars: int = 16_000_000) -> None:
        self.most, self.most_chars = most, most_chars
        self.clear()

    def clear(self) -> None:
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes, ascending, and their words
        self.others: dict[bytes, int] = {}  # words whose hash another word holds
        self.count, self.used = 0, 0
        self.chars = np.zeros(1 << 16, np.uint32)
        self.at, self.size = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    def add(self, places: np.ndarray, payload) -> None:
        """Takes the payload of new words, whose numbers follow those known; subclasses keep it."""
        raise NotImplementedError

    def _keep(self, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray, payload) -> np.ndarray:
        """Numbers of new words."""
        size, first = ends - starts, self.count
        total = int(size.sum())
        self.chars = room(self.chars, self.used + total)
        self.at, self.size = room(self.at, first + len(size)), room(self.size, first + len(size))
        self.chars[self.used : self.used + total] = cps[ranges(starts, size)]
        self.at[first : first + len(size)] = self.used + np.cumsum(size) - size
        self.size[first : first + len(size)] = size
        self.used, self.count = self.used + total, first + len(size)
        self.add(np.arange(first, self.count), payload)
        return np.arange(first, self.count)

    def find(self, cps: np.ndarray, starts: np.ndarray, ends: np.ndarray, resolve) -> np.ndarray:
        """Numbers of the words cps[start:end]; resolve(places) gives the payload of the new ones among them."""
        unique, first, inverse = np.unique(char_hash().spans(cps, starts, ends), return_index=True, return_inverse=True)
        if self.count and (self.count + len(unique) > self.most or self.used > self.most_chars):
            self.clear()
        at = np.searchsorted(self.keys, unique)
        there = np.flatnonzero(at < len(self.keys))
        there = there[self.keys[at[there]] == unique[there]]
        known = np.full(len(unique), -1, np.int64)
        known[there] = self.numbers[at[there]]
        if len(new := np.flatnonzero(known < 0)):
            known[new] = self._keep(cps, starts[first[new]], ends[first[new]], resolve(first[new]))
            self.keys, self.numbers = np.insert(self.keys, at[new], unique[new]), np.insert(self.numbers, at[new], known[new])
        numbers, size = known[inverse], ends - starts
        other = self.size[numbers] != size
        even = np.flatnonzero(~other)
        if not len(size):
            return numbers
        unlike = self.chars[ranges(self.at[numbers[even]], size[even])] != cps[ranges(starts[even], size[even])]
        if unlike.any():
            other[even[np.repeat(np.arange(len(even)), size[even])[unlike]]] = True
        for i in np.flatnonzero(other).tolist():
            word = cps[starts[i] : ends[i]].tobytes()
            if word not in self.others:
                self.others[word] = int(self._keep(cps, starts[i : i + 1], ends[i : i + 1], resolve(np.array([i])))[0])
            numbers[i] = self.others[word]
        return numbers


class Pieces(Words):
    """Words with a list of ids each."""

    def clear(self) -> None:
        super().clear()
        self.flat, self.filled = np.zeros(1 << 16, np.uint32), 0
        self.offset, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def add(self, places: np.ndarray, payload: list) -> None:
        lengths = np.fromiter(map(len, payload), np.int64, len(payload))
        total, stop = int(lengths.sum()), int(places[-1]) + 1
        self.flat, self.offset, self.length = room(self.flat, self.filled + total), room(self.offset, stop), room(self.length, stop)
        self.flat[self.filled : self.filled + total] = np.fromiter(itertools.chain.from_iterable(payload), np.uint32, total)
        self.offset[places], self.length[places] = self.filled + np.cumsum(lengths) - lengths, lengths
        self.filled += total

    def ids(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words in turn, and how many each word has."""
        lengths = self.length[words]
        return self.flat[ranges(self.offset[words], lengths)], lengths


_held: dict = {}


def lifelong(owner, make):
    """What a worker process keeps for `owner` as long as it works for it alone: with another owner what was kept before goes."""
    if owner not in _held:
        _held.clear()
        _held[owner] = make()
    return _held[owner]


class Values(Words):
    """Words with one number each."""

    def __init__(self, kind, most: int = 500_000, most_chars: int = 16_000_000) -> None:
        self.kind = kind
        super().__init__(most, most_chars)

    def clear(self) -> None:
        super().clear()
        self.values = np.zeros(1 << 14, self.kind)

    def add(self, places: np.ndarray, payload: np.ndarray) -> None:
        self.values = room(self.values, int(places[-1]) + 1)
        self.values[places] = payload
