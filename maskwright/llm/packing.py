"""Sum-of-squares online packing.

A level array N holds how many open windows are filled to each level.  A document first fills whole windows; what is left
goes, as it comes, where the sum of the squares of N gets smallest: into an open level that it fits, or into a new window
while fewer than OPEN are open.  Where neither is possible it is cut: it fills a window up, chosen by the same measure, and
the rest goes on as an item of its own.  At the end of a task its last open windows (OPEN at most) are poured together,
cutting where a window is full, so a task leaves one partly filled window at most; `poured` marks the pieces of this step.
Each scan task packs its own rows: no shuffle, and a lost task repeats itself exactly.

Token ids: byte-level BPE as the tokenizers library gives them (a special-token string in a text is that token), then
id 1.  Texts are split in numpy; each distinct word is merged once by tiktoken's core with the same vocabulary.

Nulls: a null text counts as empty (its only id is 1); a null id is kept.  Repeated rows are separate documents.  Very
long texts fill many windows.  Empty table: empty result.  Other columns aren't read.
"""

from __future__ import annotations

import functools
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, table, text_batches
from .words import Pieces, byte_level_spans, code_points, odd_texts

WINDOW = 2048
#: Open windows a task may hold.
OPEN = 32
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, poured boolean"


class LevelPacker:
    """The level array and, for each level, the open windows filled to it."""

    def __init__(self, window: int = WINDOW, most: int = OPEN) -> None:
        self.window, self.most, self.next, self.held = window, most, 0, 0
        self.count = [0] * (window + 1)
        self.open: dict[int, list[int]] = {}  # levels with windows

    def place(self, size: int) -> list[tuple[int, int, int]]:
        """(window, offset, length) of the pieces of an item of `size` < window."""
        out, n, full = [], self.count, self.window
        while True:
            fits = [(2 * (n[h + size] if h + size < full else -0.5) - 2 * n[h] + 2, -h, h) for h in self.open if h + size <= full]
            if self.held < self.most:
                fits.append((2 * n[size] + 1, 0, 0))
            if fits:
                h = min(fits)[2]
                return [*out, (self._put(h, size), h, size)]
            h = max(self.open, key=lambda h: (n[h], h))
            out.append((self._put(h, full - h), h, full - h))
            size -= full - h

    def _put(self, level: int, size: int) -> int:
        """Moves a window (level 0: a new one) up by `size`."""
        if level:
            where = self.open[level].pop()
            self.count[level] -= 1
            self.held -= 1
            if not self.open[level]:
                del self.open[level]
        else:
            where = self.fresh()
        if level + size < self.window:
            self.count[level + size] += 1
            self.held += 1
            self.open.setdefault(level + size, []).append(where)
        return where

    def fresh(self) -> int:
        self.next += 1
        return self.next - 1


@functools.cache
def _encoder(path: str, ranks: str):
    import base64

    import tiktoken
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    with open(ranks, "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    core = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=merges, special_tokens={})._core_bpe
    return library, core, [t.content for t in library.get_added_tokens_decoder().values()]


class ByteLevel:
    """Ids of whole texts."""

    def __init__(self, path: str | None = None, ranks: str | None = None) -> None:
        import public_tokenizers

        self.library, self.core, self.special = _encoder(path or public_tokenizers.path("byte_bpe_50k.json"), ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"))
        self.pieces = Pieces()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        joined, cps, at = code_points(texts)
        odd = odd_texts(cps, at)
        for i, t in enumerate(texts):
            odd[i] |= any(s in t for s in self.special)
        starts, ends = byte_level_spans(cps, at)
        if odd.any():
            use = ~odd[np.searchsorted(at, starts, "right") - 1]
            starts, ends = starts[use], ends[use]

        def resolve(new):
            one = self.core.encode_single_piece
            return [one(joined[s:e].encode()) for s, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]

        words = self.pieces.find(cps, starts, ends, resolve)
        ids, lengths = self.pieces.ids(words)
        cut = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, at)]
        out = [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd):
            out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return out


def _pack(batches, window: int, end: int):
    import pyarrow as pa
    from pyspark import TaskContext

    code, packer = ByteLevel(), LevelPacker(window)
    base = TaskContext.get().partitionId() << 40
    held: dict[int, list] = {}  # the rows of open windows
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def done(rows, poured):
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array([poured] * len(rows), pa.bool_())], names=names)

    crc = lambda ids: zlib.crc32(ids.astype("<u4").tobytes())
    for batch in text_batches(batches, "text", 1_200_000):
        rows = []
        for doc, ids in zip(batch.column(0).to_pylist(), code.encode(batch.column(1).to_pylist()), strict=True):
            ids = np.append(ids, np.uint32(end))
            n = len(ids)
            start = n - n % window
            for s in range(0, start, window):
                rows.append((doc, s, window, crc(ids[s : s + window]), n, base + packer.fresh(), 0))
            for where, level, size in packer.place(n - start) if start < n else ():
                held.setdefault(where, []).append((doc, start, ids[start : start + size], n, level))
                start += size
                if level + size == window:
                    rows += [(d, a, len(x), crc(x), t, base + where, o) for d, a, x, t, o in held.pop(where)]
        yield done(rows, False)
    rows, where, level = [], packer.fresh(), 0  # pours what is open together, fullest windows first
    for k in sorted(held, key=lambda k: (-sum(len(x[2]) for x in held[k]), k)):
        for doc, start, ids, n, _ in held.pop(k):
            while len(ids):
                take = ids[: window - level]
                rows.append((doc, start, len(take), crc(take), n, base + where, level))
                ids, start, level = ids[len(take) :], start + len(take), level + len(take)
                if level == window:
                    where, level = packer.fresh(), 0
    yield done(rows, True)


def pack(docs: DataFrame, window: int = WINDOW, end: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in windows: see SCHEMA; sequence ids are unique over all tasks."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), body(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: _pack(batches, window, end), SCHEMA)


def query(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"))
