"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

A pass over all documents counts words (lossy counting a task, then exact sums) and keeps the LEXICON most frequent, but for
those of more than LONGEST bytes.  Their ids come from exact merges once; the words are compiled into a minimal acyclic
automaton, whose arcs carry numbers that add up to the word's number and so to its ids.  The automaton is one file, sent to each executor and memory-mapped by its
workers.  New words of a slice walk the automaton together; words that it doesn't hold are merged exactly.

Encoding equals the tokenizers library on the same file with add_special_tokens=False (special-token strings in a text are
their tokens); decoding equals its decode without skipping.  Nulls: a null text counts as empty.  Repeated rows are
separate rows.  Empty table: empty result.  Other columns aren't read.
"""

from __future__ import annotations

import atexit
import functools
import hashlib
import heapq
import json
import os
import shutil
import tempfile
import unicodedata
import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import body, table, text_batches
from .words import Pieces, char_hash, clip_spans, code_points, odd_texts

LEXICON = 32_768
#: Longer words (in bytes) are merged each time: the lexicon's size is bounded by words, not by their lengths.
LONGEST = 64
SLICE = 1_200_000


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merges:
    """A BPE vocabulary with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merge = {}
        for rank, (a, b) in enumerate(pairs):
            self.merge.setdefault(vocab[a] << 20 | vocab[b], (rank, vocab[a + b]))
        chars = byte_characters()
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + end] for c in chars]

    def encode(self, word: bytes) -> list[int]:
        """Merges the pair of the lowest rank, the leftmost first, until none is left; n log n in the word's length."""
        ids = [self.inner[b] for b in word[:-1]]
        ids.append(self.last[word[-1]])
        n, get = len(ids), self.merge.get
        ahead, back = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := get(ids[i] << 20 | ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = ahead[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two has been merged
            ids[i], ids[j], k, h = made, -1, ahead[j], back[i]
            ahead[i] = k
            if k >= 0:
                back[k] = i
                if m := get(made << 20 | ids[k]):
                    heapq.heappush(heap, (m[0], i, made, ids[k], m[1]))
            if h >= 0 and (m := get(ids[h] << 20 | made)):
                heapq.heappush(heap, (m[0], h, ids[h], made, m[1]))
        return [i for i in ids if i >= 0]


def compile_lexicon(words: list[bytes]) -> dict[str, np.ndarray]:
    """A minimal acyclic automaton of `words` (sorted, distinct, not empty), built a word at a time with shared suffixes.

    target, output: [state, class of the byte]; final: [state]; klass: [byte].  Outputs along a word add up to its place.
    """
    arcs: list[dict[int, int]] = [{}]
    final, register, path = [False], {}, [0]
    previous = b""

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            sign = (final[state], tuple(arcs[state].items()))
            arcs[path[-1]][previous[len(path) - 1]] = register.setdefault(sign, state)

    for word in words:
        common = os.path.commonprefix([previous, word])
        settle(len(common))
        previous = word
        for b in word[len(common) :]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][b] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
    settle(0)
    order, number = [0], {0: 0}
    for s in order:
        for t in arcs[s].values():
            if t not in number:
                number[t] = len(order)
                order.append(t)
    size, todo = {}, [0]  # words that end in or below a state
    while todo:
        s = todo[-1]
        if s not in size and (below := [t for t in arcs[s].values() if t not in size]):
            todo += below
            continue
        size[todo.pop()] = final[s] + sum(size[t] for t in arcs[s].values())
    used = sorted({b for s in order for b in arcs[s]})
    klass = np.zeros(256, np.uint8)
    klass[used] = np.arange(1, len(used) + 1)
    target, output = np.full((len(order), len(used) + 1), -1, np.int32), np.zeros((len(order), len(used) + 1), np.int32)
    for s in order:
        before = int(final[s])
        for b, t in sorted(arcs[s].items()):
            target[number[s], klass[b]], output[number[s], klass[b]] = number[t], before
            before += size[t]
    return {"target": target, "output": output, "final": np.array([final[s] for s in order]), "klass": klass}


def save_arrays(arrays: dict[str, np.ndarray], path: str) -> None:
    at, head = 0, {}
    for k, v in arrays.items():
        head[k] = (str(v.dtype), v.shape, at)
        at += -(-v.nbytes // 64) * 64
    line = json.dumps(head).encode()
    with open(path, "wb") as f:
        f.write(len(line).to_bytes(8, "little") + line)
        f.seek(base := -(-(8 + len(line)) // 64) * 64)
        for v in arrays.values():
            f.write(v.tobytes())
            f.seek(base + -(-(f.tell() - base) // 64) * 64)
        f.truncate()


@functools.cache
def map_arrays(path: str) -> dict[str, np.ndarray]:
    with open(path, "rb") as f:
        n = int.from_bytes(f.read(8), "little")
        head = json.loads(f.read(n))
    base = -(-(8 + n) // 64) * 64
    return {k: np.memmap(path, np.dtype(d), "r", base + at, tuple(shape)) if int(np.prod(shape)) else np.zeros(shape, d) for k, (d, shape, at) in head.items()}


class Lexicon:
    """The mapped automaton with the ids of its words."""

    def __init__(self, path: str) -> None:
        a = map_arrays(path)
        self.target, self.output, self.final, self.klass = a["target"].reshape(-1), a["output"].reshape(-1), a["final"], a["klass"]
        self.width, self.ids, self.cut = a["target"].shape[1], a["ids"], a["cut"]

    def places(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for those that the lexicon doesn't hold; all words walk together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(lengths) - lengths
        symbols = self.klass[np.frombuffer(b"".join(words), np.uint8)]
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        live, k = np.arange(len(words)), 0
        while len(live):
            on = lengths[live] > k
            live = live[on]
            arc = state[live] * self.width + symbols[start[live] + k]
            to = self.target[arc]
            state[live], total[live] = to, total[live] + self.output[arc]
            live, k = live[to >= 0], k + 1
        good = state >= 0
        good[good] = self.final[state[good]]
        return np.where(good, total, -1)


@functools.cache
def _library(path: str):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
    names = [library.id_to_token(i) or "" for i in range(library.get_vocab_size(with_added_tokens=True))]
    return library, special, names, Merges(path)


class Coder:
    """Encodes and decodes whole texts; without a lexicon every word is merged."""

    def __init__(self, path: str, lexicon: str | None = None) -> None:
        import regex

        self.library, self.special, self.names, self.merges = _library(path)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.lexicon, self.pieces = Lexicon(lexicon) if lexicon else None, Pieces()
        self.bytes_of = {c: b for b, c in enumerate(byte_characters())}

    def word_ids(self, words: list[bytes]) -> list[list[int]]:
        if not self.lexicon or len(self.lexicon.cut) < 2 or not words:  # no lexicon, or one without words
            return list(map(self.merges.encode, words))
        places = self.lexicon.places(words)
        cut = self.lexicon.cut
        lo, hi = cut[np.maximum(places, 0)].tolist(), cut[np.maximum(places, 0) + 1].tolist()
        held, merge = self.lexicon.ids, self.merges.encode
        return [held[a:b].tolist() if p >= 0 else merge(w) for w, p, a, b in zip(words, places.tolist(), lo, hi, strict=True)]

    def _odd(self, text: str) -> np.ndarray:
        """A text with special tokens or rare characters: the library splits it, the words go the same way."""
        out: list[int] = []
        for part in self.split.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part))
                for ids in self.word_ids([bytes(self.bytes_of[c] for c in w) for w, _ in words if w]):
                    out += ids
        return np.array(out, np.uint32)

    def spans(self, texts: list[str]):
        texts = [unicodedata.normalize("NFC", t).lower() for t in texts]
        joined, cps, at = code_points(texts)
        odd = odd_texts(cps, at)
        return joined, cps, at, odd, *clip_spans(cps)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        joined, cps, at, odd, starts, ends = self.spans(texts)
        for i, t in enumerate(texts):
            odd[i] |= any(s in t for s in self.special) or "Σ" in t or "İ" in t
        if odd.any():
            use = ~odd[np.searchsorted(at, starts, "right") - 1]
            starts, ends = starts[use], ends[use]

        def resolve(new):
            return self.word_ids([joined[s:e].encode() for s, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])

        ids, lengths = self.pieces.ids(self.pieces.find(cps, starts, ends, resolve))
        cut = np.concatenate([[0], np.cumsum(lengths)])[np.searchsorted(starts, at)]
        out = [ids[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        for i in np.flatnonzero(odd):
            out[i] = self._odd(texts[i])
        return out

    def decode(self, ids: np.ndarray) -> str:
        """As the library's decode for a file without decoder: the tokens, with blanks between them."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def _counts(batches, path: str, most: int):
    """Lossy counting: after slice b, words seen at most b times less what came before are forgotten.

    Words are counted by hash; it only matters for which words the lexicon holds, not for ids.
    """
    import pyarrow as pa

    coder, words, counts, b = Coder(path), {}, {}, 0
    for batch in text_batches(batches, "text", SLICE):
        joined, cps, at, odd, starts, ends = coder.spans(batch.column(0).to_pylist())
        b += 1
        unique, first, n = np.unique(char_hash().spans(cps, starts, ends), return_index=True, return_counts=True)
        for h, k, i in zip(unique.tolist(), n.tolist(), first.tolist(), strict=True):
            if h in counts:
                counts[h][0] += k
            elif k > 1:
                counts[h], words[h] = [k, b - 1], joined[starts[i] : ends[i]]
        if len(counts) > 4 * most or b % 16 == 0:
            for h in [h for h, (k, missed) in counts.items() if k + missed <= b]:
                del counts[h], words[h]
    top = sorted(counts, key=lambda h: (-counts[h][0], words[h]))[: 2 * most]
    yield pa.RecordBatch.from_arrays([pa.array([words[h] for h in top], pa.string()), pa.array([counts[h][0] for h in top], pa.int64())], names=["word", "n"])


def frequent_words(docs: DataFrame, path: str, most: int = LEXICON, text_col: str = "text") -> list[str]:
    """The `most` words with the highest counts over all documents (`most` rows reach the driver)."""
    counted = docs.select(body(text_col).alias("text")).mapInArrow(lambda batches: _counts(batches, path, most), "word string, n long")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most).collect()
    return [r["word"] for r in rows if r["word"]]


def build_lexicon(words: list[str], path: str) -> bytes:
    merges, raw = Merges(path), sorted({b for w in words if 0 < len(b := w.encode()) <= LONGEST})
    ids = [merges.encode(w) for w in raw]
    arrays = compile_lexicon(raw) | {"ids": np.array([x for i in ids for x in i], np.uint32), "cut": np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)}
    with tempfile.TemporaryDirectory() as folder:
        save_arrays(arrays, f"{folder}/lexicon")
        with open(f"{folder}/lexicon", "rb") as f:
            return f.read()


def ship(spark, data: bytes) -> str:
    """Sends a file to every executor; its name there (SparkFiles.get)."""
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:16]}-{uuid.uuid4().hex[:8]}.bin"
    folder = tempfile.mkdtemp(prefix="maskwright-")  # the driver's own; Spark serves the file from it
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with open(path := f"{os.path.realpath(folder)}/{name}", "wb") as f:
        f.write(data)
    spark.sparkContext.addFile(path)
    return name


def _encode(batches, path: str, lexicon: str):
    import pyarrow as pa
    from pyspark import SparkFiles

    coder = Coder(path, SparkFiles.get(lexicon))
    for batch in text_batches(batches, "text", SLICE):
        ids = coder.encode(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array([coder.decode(x) for x in ids], pa.string())], names=["_id", "ids", "decoded"]
        )


def encode_decode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", most: int = LEXICON) -> DataFrame:
    """Per document: its id, `ids` (binary: little-endian unsigned 32-bit) and `decoded` text.  `path`: the tokenizer file on every machine."""
    import public_tokenizers

    path = path or public_tokenizers.path("word_bpe_49k.json")
    name = ship(docs.sparkSession, build_lexicon(frequent_words(docs, path, most, text_col), path))
    rows = docs.select(F.col(id_col).alias("_id"), body(text_col).alias("text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _encode(batches, path, name), f"_id {kind}, ids binary, decoded string").withColumnRenamed("_id", id_col)


def query(spark, sf_dir):
    return encode_decode(table(spark, sf_dir, "documents")).select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
