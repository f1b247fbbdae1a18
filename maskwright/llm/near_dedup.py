"""MinHash near-dedup with odd sketches.

1. One scan shingles each whole text (five words; fewer words: the sequence), and writes the set's size and fingerprint,
   BANDS band keys of ROWS MinHash samples each, and the odd sketch: the samples' parity bitmap.
2. Equal sets collapse to the smallest id.  In each band bucket the set that shares buckets with most others leads.  Each set
   and its most central lead are confirmed on full sets if sizes and the sketches' XOR population count allow a link; confirmed
   links give first components.
3. Buckets that still hold several components are searched across components: sizes and sketches leave candidates, which join
   sets into groups; within a group all pairs across components that sizes and sketches allow are confirmed on full sets.
   Buckets and groups are dealt out as pairs of blocks, bounded in rows and bytes, and a block returns at most one edge a row.
   Pairs inside the largest component need no look, as they can't change the result.
A pair at the threshold of 0.75 shares no bucket with a chance of 5e-6.  Of pairs that share one, a link at 0.75 is lost with a
chance under 1e-6, when the sketches differ in more than CUT bits.  `recall` measures what is found against all sets.

Words are compared in full and stand in shingles as keyed 64-bit hashes; a set holds 64-bit hashes of its shingles.  Two given
shingles of different words have one hash with a chance of 2**-64.

Nulls: a null or blank text has an empty set and no links; a null id links with nothing.  Repeated rows (one id) are one
document.  Empty table: empty result.  Only `id_col` and `text_col` are read.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .common import body, parallelism, table, text_batches, written
from .words import Values, code_points, lifelong, mixed, ranges

WORDS = 5
BANDS, ROWS = 32, 4
BITS = 512
#: Sketches of sets at 0.75 differ in 57 bits on average; more than CUT differ with a chance under 1e-6.
CUT = 98
#: Up to so many ids are sent to every executor to pick texts; beyond, texts are shuffled to them.
BROADCAST_ROWS = 1_000_000
#: A block holds some BLOCK sets, or less if they come to more than BLOCK_BYTES.
BLOCK, BLOCK_BYTES = 1024, 8_000_000
SLICE = 800_000
#: Distinct words a worker process keeps.
KEPT = 250_000


@functools.cache
def _tables():
    blank = np.zeros(1 << 7, bool)
    blank[[32, 9, 10, 11, 12, 13]] = True
    rng = np.random.default_rng(11)
    odd = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return blank, odd(WORDS), odd(BANDS * ROWS), rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64), odd(ROWS), odd(1 << 9)


def _words() -> Values:
    """Of a worker process: its words with keyed 64-bit hashes of theirs."""
    return lifelong("shingles", lambda: Values(np.uint64, KEPT, 12 * KEPT))


def _word_hash(word: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(word.tobytes(), digest_size=8, key=b"shingles").digest(), "little")


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' distinct shingles, text by text and ascending, and where each text's begin."""
    blank, powers, *_ = _tables()
    _, cps, at = code_points(texts)
    cps = np.where((cps > 64) & (cps < 91), cps + np.uint32(32), cps)
    space = np.concatenate([[True], blank[np.minimum(cps, 127)]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edge[0::2], edge[1::2]
    words = _words()
    resolve = lambda new: np.array([_word_hash(cps[s:e]) for s, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)], np.uint64)
    found = words.find(cps, starts, ends, resolve)
    word = words.values[found]
    first = np.searchsorted(starts, at)  # each text's first word
    n, words = np.diff(first), WORDS
    doc = np.repeat(np.arange(len(texts)), n)
    total = len(word)
    rolled = np.zeros(max(total - words + 1, 0), np.uint64)
    for k in range(words):
        rolled += word[k : k + len(rolled)] * powers[k]
    inside = doc[: len(rolled)] == doc[words - 1 :] if len(rolled) else np.zeros(0, bool)
    h, d = mixed(rolled[inside]), doc[: len(rolled)][inside]
    short = np.flatnonzero((n > 0) & (n < words))
    if len(short):
        whole = []
        for i in short.tolist():
            x = np.uint64(n[i])
            for w in word[first[i] : first[i + 1]]:
                x = mixed(np.array([x ^ w], np.uint64))[0]
            whole.append(x)
        h, d = np.concatenate([h, np.array(whole, np.uint64)]), np.concatenate([d, short])
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[new], d[new]
    return h, np.searchsorted(d, np.arange(len(texts) + 1))


def signatures(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each set: fingerprint (two words), band keys, odd sketch.  Empty sets give zeros."""
    _, _, mult, add, rows, parity = _tables()
    n = np.diff(at)
    full = np.flatnonzero(n > 0)
    starts = at[:-1][full]
    finger = np.zeros((len(n), 2), np.uint64)
    samples = np.zeros((BANDS * ROWS, len(full)), np.uint64)
    if len(full):
        finger[full, 0] = np.add.reduceat(mixed(h), starts)
        finger[full, 1] = np.add.reduceat(mixed(h ^ np.uint64(0x5DEECE66D)), starts)
        for k in range(BANDS * ROWS):
            samples[k] = np.minimum.reduceat((h * mult[k] + add[k]) >> np.uint64(24), starts)
    keys = np.zeros((len(n), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(full), b + 1, np.uint64)
        for r in range(ROWS):
            key = mixed(key + samples[b * ROWS + r] * rows[r])
        keys[full, b] = key
    bits = np.zeros((len(n), BITS), np.uint8)
    place = (mixed(samples.T + parity[: BANDS * ROWS]) % np.uint64(BITS)).astype(np.int64)
    np.bitwise_xor.at(bits, (full[:, None], place), 1)
    return finger, keys, np.packbits(bits, axis=1)


def _lists(rows: np.ndarray):
    """Rows of a matrix as an Arrow column of lists of 64-bit words."""
    import pyarrow as pa

    words = np.ascontiguousarray(rows).view(np.int64).reshape(len(rows), -1)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, words.size + 1, words.shape[1], dtype=np.int32)), pa.array(words.reshape(-1)))


def _sign(batches):
    import pyarrow as pa

    for batch in text_batches(batches, "text", SLICE):
        h, at = shingles(batch.column(1).to_pylist())
        finger, keys, sketch = signatures(h, at)
        flat = lambda a: pa.array(np.ascontiguousarray(a).view(np.int64))
        bands = _lists(keys)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(at)), flat(finger[:, 0]), flat(finger[:, 1]), bands, _lists(sketch)], names=["id", "n", "f1", "f2", "bands", "sketch"]
        )


def _sets(batches):
    import pyarrow as pa

    for batch in text_batches(batches, "text", SLICE):
        h, at = shingles(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["id", "words"])


def _linked(percent: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                same = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * same >= percent * (len(p) + len(q) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place in each place's component under edges a-b."""
    lab = np.arange(n)
    while True:
        least = np.minimum(lab[a], lab[b])
        new = lab.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def _candidates(rows, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs (left, right) in different components whose sizes and sketches allow a link."""
    side = rows.side.to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(left) or not len(right):
        return left[:0], right[:0]
    comp, n = rows.comp.to_numpy(), rows.n.to_numpy()
    sketch = np.stack(rows.sketch.to_list()).astype(np.int64).view(np.uint64)
    x, y = n[left][:, None], n[right][None, :]
    i, j = np.nonzero((comp[left][:, None] != comp[right][None, :]) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y)))
    near = np.bitwise_count(sketch[left[i]] ^ sketch[right[j]]).sum(1) <= CUT
    return left[i[near]], right[j[near]]


def _overlapping(rows, a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs a-b those whose full sets overlap by `percent`."""
    if not len(a):
        return a, b
    sets = [np.frombuffer(w, np.uint64) for w in rows.words]
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    flat, cut = np.concatenate(sets), np.concatenate([[0], np.cumsum(size)])
    _, number = np.unique(flat, return_inverse=True)
    mark, keep = np.zeros(int(number.max()) + 1, bool), np.zeros(len(a), bool)
    order = np.argsort(a, kind="stable")
    for run in np.split(order, np.flatnonzero(np.diff(a[order])) + 1):
        own, others = a[run[0]], b[run]
        mine = number[cut[own] : cut[own + 1]]
        mark[mine] = True
        lengths = size[others]
        where = np.repeat(cut[others] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        same = np.add.reduceat(mark[number[where]].astype(np.int64), np.cumsum(lengths) - lengths)
        keep[run] = 100 * same >= percent * (size[own] + lengths - same)
        mark[mine] = False
    return a[keep], b[keep]


def _in_groups(percent: int, exact: bool):
    """For rows sorted by (group, i, j): edges (u, v) that join what candidates, or with `exact` links, connect in a group.

    At most one edge a row comes out, however many pairs there are.
    """

    def edges(rows):
        import pandas as pd

        a, b = _candidates(rows, percent)
        if exact:
            a, b = _overlapping(rows, a, b, percent)
        if not len(a):
            return None
        lab, ids = _labels(len(rows), a, b), rows.id.to_numpy()
        on = lab != np.arange(len(rows))
        out = pd.DataFrame({"u": ids[on], "v": ids[lab[on]]})
        return out[out.u != out.v]

    def run(frames):
        import pandas as pd

        held = None
        for frame in frames:
            held = frame if held is None or not len(held) else pd.concat([held, frame], ignore_index=True)
            if not len(held):
                continue
            key = held[["group", "i", "j"]].to_numpy()
            cut = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1])
            found = [x for x in (edges(held.iloc[s:e].reset_index(drop=True)) for s, e in zip(cut[:-1], cut[1:], strict=True)) if x is not None]
            if found:
                yield pd.concat(found)
            held = held.iloc[cut[-1] :].reset_index(drop=True)
        if held is not None and len(held) and (last := edges(held)) is not None:
            yield last

    return run


def _blocks(rows: DataFrame, carry: list[str]) -> DataFrame:
    """Deals rows (group, id, comp, n, ...) out as pairs of blocks: all rows (side 0) against those outside the group's largest component (side 1)."""
    parts = rows.groupBy("group", "comp").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("size"))
    open_groups = parts.groupBy("group").agg(F.sum("k").alias("all"), F.sum("size").alias("whole"), F.max(F.struct("k", "comp", "size")).alias("top")).filter("all > top.k")
    rows = rows.join(open_groups, "group")
    cut = lambda k, size: F.ceil(F.greatest(k / BLOCK, 8 * size / BLOCK_BYTES))
    blocks, minor = cut(F.col("all"), F.col("whole")), cut(F.col("all") - F.col("top.k"), F.col("whole") - F.col("top.size"))
    rows = rows.withColumns({"bi": F.pmod(F.xxhash64("id"), blocks), "bj": F.pmod(F.xxhash64("id"), minor), "blocks": blocks, "minors": minor})
    out = [F.col(c) for c in ["group", "id", "comp", *carry]]
    left = rows.select(*out, F.lit(0).alias("side"), F.col("bi").alias("i"), F.explode(F.expr("sequence(0L, minors - 1)")).alias("j"))
    right = rows.filter("comp <> top.comp").select(*out, F.lit(1).alias("side"), F.explode(F.expr("sequence(0L, blocks - 1)")).alias("i"), F.col("bj").alias("j"))
    return left.unionByName(right).repartition(parallelism(rows.sparkSession), "group", "i", "j").sortWithinPartitions("group", "i", "j")


def near_dedup(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_shingles, component_id (smallest id reachable over links), kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), body(text_col).alias("text"))
    signed = written(rows.mapInArrow(_sign, "id long, n long, f1 long, f2 long, bands array<long>, sketch array<long>"), "signed")
    heads = signed.filter("n > 0 AND id IS NOT NULL").groupBy("f1", "f2", "n").agg(F.min("id").alias("id"))
    sets = signed.join(heads, ["id", "f1", "f2", "n"], "left_semi").select("id", "n", "bands", "sketch").dropDuplicates(["id", "n"])
    banded = sets.select("id", F.explode("bands").alias("band"))
    counts = banded.groupBy("band").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    members = written(banded.join(counts, "band"), "members")
    degree = members.groupBy("id").agg(F.sum("k").alias("degree"))
    ranked = members.join(degree, "id")
    leads = ranked.groupBy("band").agg(F.max(F.struct("degree", F.col("id").alias("lead"))).alias("top"))
    pairs = members.join(leads, "band").groupBy("id").agg(F.max("top").alias("top")).select("id", F.col("top.lead").alias("lead")).filter("id <> lead")
    facts = lambda p: sets.select(F.col("id").alias(p), F.col("n").alias(f"{p}_n"), F.col("sketch").alias(f"{p}_sketch"))
    apart = "aggregate(zip_with(u_sketch, v_sketch, (x, y) -> bit_count(x ^ y)), 0, (a, b) -> a + b)"
    near = pairs.select(F.col("id").alias("u"), F.col("lead").alias("v")).join(facts("u"), "u").join(facts("v"), "v")
    near = written(near.filter(f"100 * least(u_n, v_n) >= {percent} * greatest(u_n, v_n) AND {apart} <= {CUT}").select("u", "v"), "leads")
    full = written(_read_sets(rows, near.select(F.col("u").alias("id")).union(near.select("v"))), "sets")
    links = written(near.join(full.select(F.col("id").alias("u"), F.col("words").alias("a")), "u").join(full.select(F.col("id").alias("v"), F.col("words").alias("b")), "v").select("u", "v", "a", "b").mapInArrow(_linked(percent), "u long, v long"), "links")
    found = components(links)
    comp_of = lambda ids: ids.join(found.select(F.col("u").alias("id"), F.col("v").alias("comp")), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    in_bands = comp_of(members.select(F.col("band").alias("group"), "id"))
    few_in_bands = _open(in_bands).join(sets.select("id", "n", "sketch"), "id")
    hints = components(_blocks(few_in_bands, ["n", "sketch"]).mapInPandas(_in_groups(percent, False), "u long, v long"))
    groups = written(hints.select(F.col("u").alias("id"), F.col("v").alias("group")).union(hints.select("v", "v").distinct()), "groups")
    if not groups.isEmpty():
        at_hand = comp_of(groups).join(sets.select("id", "n", "sketch"), "id").join(_read_sets(rows, groups.select("id")), "id")
        more = _blocks(written(at_hand, "grouped"), ["n", "sketch", "words"]).mapInPandas(_in_groups(percent, True), "u long, v long")
        found = components(more.union(found.select("u", "v")))
    of_set = heads.join(found.select(F.col("u").alias("id"), F.col("v").alias("c")), "id", "left").select("f1", "f2", "n", F.coalesce("c", "id").alias("c"))
    out = signed.select("id", "n", "f1", "f2").join(of_set, ["f1", "f2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("c", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _read_sets(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """id and words (the full set) of some documents, from their whole texts, which stay where they are while the ids are few."""
    ids = written(ids.distinct(), "ids")
    few = ids.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(ids) if few else ids, "id", "left_semi").mapInArrow(_sets, "id long, words binary")


def recall(docs: DataFrame, found: DataFrame, asked: int = 200, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> tuple[int, int]:
    """(links of `asked` documents, in hash order, to all others; those of them within one component of `found`), by comparing full sets."""
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), body(text_col).alias("text"))
    some = [(r["id"], r["text"]) for r in rows.orderBy(F.xxhash64("id"), "id").limit(asked).collect()]  # `asked` rows

    def run(batches):
        import pyarrow as pa

        own, cut = shingles([t for _, t in some])
        holder, size = np.repeat(np.arange(len(some)), np.diff(cut)), np.diff(cut)
        order = np.argsort(own, kind="stable")
        keys, holder = own[order], holder[order]
        for batch in text_batches(batches, "text", SLICE):
            h, at = shingles(batch.column(1).to_pylist())
            lo, hi = np.searchsorted(keys, h), np.searchsorted(keys, h, "right")
            doc = np.repeat(np.repeat(np.arange(len(at) - 1), np.diff(at)), hi - lo)
            who = holder[ranges(lo, hi - lo)]
            pair, same = np.unique(doc * len(some) + who, return_counts=True)
            d, w = pair // max(len(some), 1), pair % max(len(some), 1)
            ids = np.array(batch.column(0).to_pylist(), np.int64)
            asked_ids = np.array([i for i, _ in some], np.int64)
            on = (100 * same >= percent * (np.diff(at)[d] + size[w] - same)) & (ids[d] != asked_ids[w])
            yield pa.RecordBatch.from_arrays([pa.array(ids[d[on]]), pa.array(asked_ids[w[on]])], names=["u", "v"])

    true = rows.mapInArrow(run, "u long, v long").distinct()
    of = lambda p: found.select(F.col(id_col).alias(p), F.col("component_id").alias(f"{p}_c")).distinct()
    r = true.join(of("u"), "u").join(of("v"), "v").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("u_c") == F.col("v_c")).alias("k")).first()
    return r["n"], r["k"]


def _open(rows: DataFrame) -> DataFrame:
    """The rows (group, id, comp) of groups that hold more than one component."""
    mixed_groups = rows.groupBy("group").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a < b").select("group")
    return rows.join(mixed_groups, "group", "left_semi")


def query(spark, sf_dir):
    return near_dedup(table(spark, sf_dir, "documents"))


ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh FROM w),
x AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS sh FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v FROM x a JOIN x b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r(u, v) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.u, p.v FROM r JOIN p ON r.v = p.u)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, min(r.v) AS component_id, s.doc_id = min(r.v) AS kept FROM s JOIN r ON r.u = s.doc_id GROUP BY s.doc_id, len(sh)
"""
