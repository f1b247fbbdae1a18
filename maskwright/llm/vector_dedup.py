"""Embedding near-dedup by NN-descent within labels.

1. Vectors are normalised in double precision; equal directions collapse to the smallest id with a multiplicity.
2. Each of TREES random hyperplane trees deals the vectors of a label to leaves (large leaves to random parts); all pairs
   in a part start each vector's list of its K nearest.
3. Rounds of neighbours of neighbours: around each vector its neighbours and those that name it meet, and a pair enters a
   list if it beats the list's last place.  Hubs are dealt out in parts.
4. Pairs at the threshold are edges.  A vector whose places are all edges is saturated: its list is enlarged, twice as long each
   time up to WIDEST, from neighbours of neighbours around the saturated ones.  What is saturated then is compared exactly, in
   double precision, with all vectors of its label, block against block; links to other components become edges.  Within
   components all pairs of blocks are compared once the same way; only counts come out.
5. Audit: AUDIT vectors in hash order are compared with all vectors of their labels; while under LEAST of their links lie
   within components, trees with new hyperplanes join in.  If the last try stays under it, all vectors are compared as the
   saturated ones are.  The recall of each try is logged.

Nulls: vectors that are null, empty, zero or hold null or non-finite components, and rows without label or id, link with
nothing.  Repeated rows (equal id and vector) count once each as links of one another.  Vectors of different length never
link.  Empty table: empty result.  Only id, vector and label are read.
"""

from __future__ import annotations

import logging

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .common import drop_written, parallelism, table, written

log = logging.getLogger(__name__)

K, WIDEST, TREES, LEAF, PART = 12, 48, 6, 128, 384
ROUNDS, BLOCK = 2, 1024
AUDIT, LEAST = 200, 0.98


def _units(batches):
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        lists = batch.column(2)
        dim = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls as NaN
        at, out, short, size = np.cumsum(dim) - dim, [None] * len(dim), [None] * len(dim), np.zeros(len(dim), np.int64)
        for d in np.unique(dim[dim > 0]).tolist():
            on = np.flatnonzero(dim == d)
            v = flat[at[on][:, None] + np.arange(d)]
            with np.errstate(all="ignore"):
                top = np.abs(v).max(1)
                good = np.isfinite(v).all(1) & (top > 0)
                on, v = on[good], v[good] / top[good][:, None]
                v = v / np.linalg.norm(v, axis=1)[:, None] + 0.0  # no negative zeros
            size[on] = d
            for i, x, y in zip(on.tolist(), v, v.astype(np.float32), strict=True):
                out[i], short[i] = x.tobytes(), y.tobytes()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary()), pa.array(short, pa.binary()), pa.array(size)], names=["id", "label", "vec", "short", "dim"])


def _codes(trees: int, seed: int):
    """Adds to each vector 30 hyperplane signs for each tree."""

    def run(batches):
        import pyarrow as pa

        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = [np.frombuffer(x.as_buffer(), np.float32) for x in batch.column(1)]
            out = np.zeros((len(rows), trees), np.int64)
            dims = np.fromiter(map(len, rows), np.int64, len(rows))
            for d in np.unique(dims).tolist():
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, d]).standard_normal((d, trees * 30)).astype(np.float32)
                on = np.flatnonzero(dims == d)
                signs = (np.stack([rows[i] for i in on]) @ planes[d] > 0).reshape(len(on), trees, 30)
                out[on] = signs @ (1 << np.arange(30, dtype=np.int64))
            codes = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, trees, dtype=np.int32)), pa.array(out.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), codes], names=["id", "codes"])

    return run


def _runs(frames, keys: list[str]):
    """The groups of rows that come sorted by `keys`."""
    import pandas as pd

    held = None
    for frame in frames:
        held = frame if held is None or not len(held) else pd.concat([held, frame], ignore_index=True)
        if not len(held):
            continue
        key = held[keys].to_numpy()
        cut = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1])
        for s, e in zip(cut[:-1], cut[1:], strict=True):
            yield held.iloc[s:e]
        held = held.iloc[cut[-1] :].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _nearest(k: int, keys: list[str]):
    """In each group, for each vector its k nearest that beat `floor`: u, v, cos."""

    def run(frames):
        import pandas as pd

        parts, held = [], 0
        for rows in _runs(frames, keys):
            ids, floor = rows.id.to_numpy(), rows.floor.to_numpy()
            ids, first = np.unique(ids, return_index=True)
            if len(ids) < 2:
                continue
            floor, x = floor[first], np.stack([np.frombuffer(b, np.float32) for b in rows.short.iloc[first]])
            sim = x @ x.T
            np.fill_diagonal(sim, -2)
            sim[sim <= floor[:, None]] = -2
            top = np.argpartition(-sim, min(k, len(ids) - 1) - 1, axis=1)[:, :k]
            i, j = np.repeat(np.arange(len(ids)), top.shape[1]), top.reshape(-1)
            good = sim[i, j] > -2
            parts.append(pd.DataFrame({"u": ids[i[good]], "v": ids[j[good]], "cos": sim[i, j][good].astype(float)}))
            held += len(parts[-1])
            if held > 50_000:
                yield pd.concat(parts)
                parts, held = [], 0
        if parts:
            yield pd.concat(parts)

    return run


def _merged(pairs: DataFrame, lists: DataFrame | None, k: int) -> DataFrame:
    """Lists (u, near: array of (cos, v), the nearest first) of k places."""
    if lists is not None:
        pairs = pairs.union(lists.select("u", F.explode("near").alias("x")).select("u", F.col("x.v").alias("v"), F.col("x.cos").alias("cos")))
    best = pairs.groupBy("u", "v").agg(F.max("cos").alias("cos")).groupBy("u").agg(F.collect_list(F.struct("cos", "v")).alias("near"))
    return written(best.select("u", F.slice(F.sort_array("near", asc=False), 1, k).alias("near")), "lists")


def start(units: DataFrame, k: int, trees: int, seed: int) -> DataFrame:
    """Pairs (u, v, cos) from the parts of the leaves of `trees` trees.  `units`: id, label, dim, short."""
    coded = units.select("id", "short").mapInArrow(_codes(trees, seed), "id long, codes array<long>")
    sizes = units.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("k"))
    depth = F.greatest(F.lit(0), F.least(F.lit(30), F.ceil(F.log2(F.col("k") / LEAF)))).cast("int")
    rows = units.join(coded, "id").join(sizes.select("label", "dim", depth.alias("depth")), ["label", "dim"])
    rows = rows.select("id", "label", "dim", "short", "depth", F.posexplode("codes").alias("tree", "code")).withColumn("leaf", F.expr("code % shiftleft(1L, depth)"))
    leaf = ["label", "dim", "tree", "leaf"]
    parts = rows.groupBy(*leaf).agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    rows = rows.join(parts, leaf).withColumns({"part": F.pmod(F.xxhash64("id", "tree"), "parts"), "floor": F.lit(-1.0)})
    keys = [*leaf, "part"]
    dealt = rows.select(*keys, "id", "short", "floor").repartition(parallelism(units.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(_nearest(k, keys), "u long, v long, cos double")


def descend(units: DataFrame, lists: DataFrame, k: int, around: DataFrame | None = None) -> DataFrame:
    """Pairs that enter a list of k places, from neighbours of neighbours; `around`: only from those of these lists."""
    centres = lists if around is None else around
    edges = centres.select(F.col("u").alias("w"), F.explode("near.v").alias("m"))
    back = edges.select(F.col("m").alias("w"), F.col("w").alias("m"))
    hubs = back.groupBy("w").agg(F.ceil(F.count(F.lit(1)) / (2 * k)).alias("parts"))
    back = back.join(hubs, "w").select("w", "m", F.pmod(F.xxhash64("m", "w"), "parts").alias("part"))
    ahead = edges.union(centres.select("u", "u")).join(hubs, "w", "left").select("w", "m", F.explode(F.expr("sequence(0L, coalesce(parts, 1L) - 1)")).alias("part"))
    known = units.select("id", "short").join(lists.select(F.col("u").alias("id"), F.when(F.size("near") < k, -1.0).otherwise(F.element_at("near", -1)["cos"]).alias("floor")), "id")
    rows = back.unionByName(ahead).withColumnRenamed("m", "id").join(known, "id")
    keys = ["w", "part"]
    dealt = rows.repartition(parallelism(units.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(_nearest(k, keys), "u long, v long, cos double")


def _degrees(threshold: float):
    def run(frames):
        import pandas as pd

        parts, held = [], 0
        for rows in _runs(frames, ["comp", "i", "j"]):
            side, many, ids = rows.side.to_numpy(), rows.many.to_numpy(), rows.id.to_numpy()
            x = np.stack([np.frombuffer(b, np.float64) for b in rows.vec])
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if rows.i.iloc[0] == rows.j.iloc[0]:  # a block with itself
                near = x[left] @ x[left].T >= threshold
                np.fill_diagonal(near, False)
                parts.append(pd.DataFrame({"id": ids[left], "links": near @ many[left]}))
            elif len(left) and len(right):
                near = x[left] @ x[right].T >= threshold
                parts.append(pd.DataFrame({"id": np.concatenate([ids[left], ids[right]]), "links": np.concatenate([near @ many[right], many[left] @ near])}))
            held += len(rows)
            if held > 50_000 and parts:
                yield pd.concat(parts)
                parts, held = [], 0
        if parts:
            yield pd.concat(parts)

    return run


def degrees(units: DataFrame, comps: DataFrame, threshold: float) -> DataFrame:
    """For each vector of a component: links to other vectors of it (id, links), multiplicities counted.

    Each pair of blocks is compared once and counts for both sides: n * n / 2 comparisons in a component of n vectors.
    """
    found = comps.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(comps.select("v", "v").distinct())
    rows = units.select("id", "vec", "many").join(found, "id")
    sizes = found.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    rows = rows.join(sizes, "comp").withColumn("at", F.pmod(F.xxhash64("id"), "blocks"))
    left = rows.select("comp", "id", "vec", "many", F.lit(0).alias("side"), F.col("at").alias("i"), F.explode(F.expr("sequence(at, blocks - 1)")).alias("j"))
    right = rows.filter("at > 0").select("comp", "id", "vec", "many", F.lit(1).alias("side"), F.explode(F.expr("sequence(0L, at - 1)")).alias("i"), F.col("at").alias("j"))
    keys = ["comp", "i", "j"]
    dealt = left.unionByName(right).repartition(parallelism(units.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(_degrees(threshold), "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def _across(threshold: float):
    def run(frames):
        import pandas as pd

        parts, held = [], 0
        for rows in _runs(frames, ["label", "dim", "i", "j"]):
            side = rows.side.to_numpy()
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                continue
            x, ids, comp = np.stack([np.frombuffer(b, np.float64) for b in rows.vec]), rows.id.to_numpy(), rows.comp.to_numpy()
            i, j = np.nonzero((x[left] @ x[right].T >= threshold) & (comp[left][:, None] != comp[right][None, :]))
            _, one = np.unique(np.stack([comp[left[i]], comp[right[j]]]), axis=1, return_index=True)
            parts.append(pd.DataFrame({"u": ids[left[i[one]]], "v": ids[right[j[one]]]}))
            held += len(one)
            if held > 50_000:
                yield pd.concat(parts)
                parts, held = [], 0
        if parts:
            yield pd.concat(parts)

    return run


def across(units: DataFrame, asked: DataFrame, comps: DataFrame, threshold: float) -> DataFrame:
    """Links (u, v) of the vectors `asked` (id) to vectors of other components of their label: all pairs are compared, one link
    for each two components comes out of a block.
    """
    rows = units.select("id", "label", "dim", "vec").join(comps.select(F.col("u").alias("id"), F.col("v").alias("comp")), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    some, on = rows.join(asked.select("id").distinct(), "id", "left_semi"), ["label", "dim"]
    sizes = lambda df, name: df.groupBy(*on).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias(name))
    blocks = sizes(some, "lefts").join(sizes(rows, "rights"), on)
    every, at = (lambda c: F.explode(F.expr(f"sequence(0L, {c} - 1)"))), (lambda c: F.pmod(F.xxhash64("id"), c))
    left = some.join(blocks, on).select(*on, "id", "vec", "comp", F.lit(0).alias("side"), at("lefts").alias("i"), every("rights").alias("j"))
    right = rows.join(blocks, on).select(*on, "id", "vec", "comp", F.lit(1).alias("side"), every("lefts").alias("i"), at("rights").alias("j"))
    keys = [*on, "i", "j"]
    dealt = left.unionByName(right).repartition(parallelism(units.sparkSession), *keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(_across(threshold), "u long, v long")


def audit(units: DataFrame, comps: DataFrame, threshold: float, most: int = AUDIT) -> float:
    """Recall of links of `most` vectors against all vectors of their label; 1 if they have none."""
    asked = units.orderBy(F.xxhash64(F.lit(5), "id"), "id").limit(most).select("id", "label", "vec").collect()
    held = units.sparkSession.sparkContext.broadcast([tuple(r) for r in asked])

    def run(frames):
        import pandas as pd

        by: dict = {}
        for i, label, vec in held.value:
            by.setdefault((label, len(vec)), []).append((i, np.frombuffer(vec)))
        for rows in frames:
            out = []
            for key, part in rows.groupby(["label", rows.vec.map(len)]):
                if key in by:
                    near = np.stack([v for _, v in by[key]]) @ np.stack([np.frombuffer(b) for b in part.vec]).T >= threshold
                    i, j = np.nonzero(near)
                    out.append(pd.DataFrame({"u": np.array([q for q, _ in by[key]])[i], "v": part.id.to_numpy()[j]}))
            if out:
                both = pd.concat(out)
                yield both[both.u != both.v]

    true = units.select("id", "label", "vec").mapInPandas(run, "u long, v long")
    of = lambda c: comps.select(F.col("u").alias(c), F.col("v").alias(f"{c}_comp"))
    same = F.coalesce("u_comp", "u") == F.coalesce("v_comp", "v")
    r = true.join(of("u"), "u", "left").join(of("v"), "v", "left").agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("k")).first()
    return r["k"] / r["n"] if r["n"] else 1.0


def vector_dedup(vectors: DataFrame, threshold: float = 0.93, k: int = K, trees: int = TREES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", most_tries: int = 4, widest: int = WIDEST) -> DataFrame:
    """Per vector: id, n_links, component_id (smallest id reachable over links), kept."""
    kind = dict(vectors.dtypes)[label_col]
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("x"))
    rows = written(given.mapInArrow(_units, f"id long, label {kind}, vec binary, short binary, dim long"), "units").withColumn("key", F.when(F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("id").isNotNull(), F.sha2("vec", 256)))
    heads = rows.filter("key IS NOT NULL").groupBy("label", "dim", "key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("many"))
    units = written(rows.filter("key IS NOT NULL").select("id", "label", "dim", "key", "vec", "short").join(heads, ["id", "label", "dim", "key"]).dropDuplicates(["id", "label", "key"]), "vectors")
    lists = None
    for attempt in range(most_tries):
        lists = _merged(start(units, k, trees, attempt), lists, k)
        for _ in range(rounds):
            better = written(descend(units, lists, k), "better")
            gained = better.count()
            lists = _merged(better, lists, k)
            drop_written(better)
            if gained <= 0.01 * k * max(lists.count(), 1):
                break
        full_at = lambda places: lists.filter((F.size("near") >= places) & (F.element_at("near", -1)["cos"] >= threshold - 1e-5)).select(F.col("u").alias("id"))  # noqa: B023, E731
        places = k
        while places < widest and not (full := full_at(places)).isEmpty():
            places *= 2
            some = lists.join(full.select(F.col("id").alias("u")), "u", "left_semi")
            lists = _merged(descend(units, lists, places, some), lists, places)
        near = lists.select("u", F.explode("near").alias("x")).filter(F.col("x.cos") >= threshold - 1e-5).select("u", F.col("x.v").alias("v"))
        vec = units.select("id", "vec")
        exact = near.join(vec.select(F.col("id").alias("u"), F.col("vec").alias("a")), "u").join(vec.select(F.col("id").alias("v"), F.col("vec").alias("b")), "v").select("u", "v", "a", "b")
        comps = components(exact.mapInArrow(_at_least(threshold), "u long, v long"))
        if not (full := full_at(places)).isEmpty():
            comps = components(comps.union(across(units, full, comps, threshold)))
        found = audit(units, comps, threshold)
        log.info("audit of try %d: %.4f of the links lie within components", attempt, found)
        if found >= LEAST:
            break
    else:
        comps = components(comps.union(across(units, units, comps, threshold)))
    counts = degrees(units, comps, threshold)
    of_key = heads.join(comps.select(F.col("u").alias("id"), F.col("v").alias("c")), "id", "left").join(counts, "id", "left")
    of_key = of_key.select("label", "dim", "key", F.coalesce("c", "id").alias("c"), (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"))
    out = rows.select("id", "label", "dim", "key").join(of_key, ["label", "dim", "key"], "left")
    component = F.coalesce("c", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _at_least(threshold: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = [float(np.frombuffer(a.as_buffer()) @ np.frombuffer(b.as_buffer())) >= threshold for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def query(spark, sf_dir):
    return vector_dedup(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS MATERIALIZED (SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
r(u, v) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.u, p.v FROM r JOIN p ON r.v = p.u),
c AS (SELECT u, min(v) AS component_id FROM r GROUP BY 1), n AS (SELECT u, count(*) AS n FROM p GROUP BY 1)
SELECT c.u AS vec_id, coalesce(n, 0) AS n_links, component_id, c.u = component_id AS kept FROM c LEFT JOIN n ON n.u = c.u
"""
