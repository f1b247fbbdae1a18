"""Sharding by a k-d tree over metadata.

One scan makes a metadata row for each document: its size, the CRC of its text and its place on a grid of DIMS (id, size,
language, source).  The tree starts with all rows and `shards` leaves to come; each node splits along the
widest side of its box, at the weighted quantile that gives either side its part of the leaves (the weighted median
where the leaves halve).  Quantiles come from distributed histograms that narrow down to single rows; ties on a grid value
are ordered by a hash of the row, so a node splits between any two rows and a group of copies never has to stay whole.
The driver holds a tree node for each leaf and at most COLLECT histogram bins a pass, never rows of documents.

Copies of a text are rows like others: neither law could hold if a group that makes up a third of all rows stayed whole.

Nulls: a null text has size 8 and CRC 0; null metadata lies at 0.  Repeated rows are separate rows.  Empty table: empty
result.  Other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import body, drop_written, parallelism, table, written

GRID = 1 << 20
TIES = 1 << 32
COLLECT = 1 << 16


def _code(name: str, kind: str):
    """A number that orders a metadata column: itself, or for strings their CRC."""
    return F.col(name).cast("double") if kind not in ("string", "binary") else F.crc32(F.col(name).cast("string")).cast("double")


def metadata(docs: DataFrame, id_col: str, text_col: str, dims: list[str]) -> DataFrame:
    kinds = dict(docs.dtypes)
    rows = docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(body(text_col)) + 8).cast("long").alias("_size"),
        F.crc32(body(text_col)).alias("_crc"),
        F.array(*[F.coalesce(_code(d, kinds[d]), F.lit(0.0)) for d in dims if d in kinds], (F.octet_length(body(text_col)) + 8).cast("double")).alias("_at"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return written(rows.withColumn("_tie", F.pmod(F.xxhash64("_row", "_id"), F.lit(TIES))), "kd-metadata")


def _small(spark, names: list[str], rows: list[tuple]) -> DataFrame:
    """A few rows of numbers as a local relation: no job, no Python worker."""
    import pyarrow as pa

    return spark.createDataFrame(pa.table({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)}))


def _node(rows: DataFrame, splits: list[tuple]) -> DataFrame:
    """Moves each row one level down: `splits` has (node, dimension, last key on the left, left child, right child)."""
    if not splits:
        return rows
    moves = F.broadcast(_small(rows.sparkSession, ["_node", "_d", "_last", "_l", "_r"], splits))
    key = F.expr("element_at(_grid, cast(_d + 1 AS int))") * TIES + F.col("_tie")
    return rows.join(moves, "_node", "left").withColumn("_node", F.when(F.col("_d").isNull(), F.col("_node")).when(key <= F.col("_last"), F.col("_l")).otherwise(F.col("_r"))).drop("_d", "_last", "_l", "_r")


def _quantiles(rows: DataFrame, weight, aims: dict[int, tuple], tolerance: float) -> dict[int, tuple[int, float]]:
    """For each node of `aims` (node: dimension, low key, high key, weight wanted on the left): the last key on the left, and the weight there."""
    found: dict[int, tuple[int, float]] = {}
    state = {k: (d, lo, hi, 0.0, aim) for k, (d, lo, hi, aim) in aims.items()}
    while state:
        bins = max(16, COLLECT // len(state))
        asked = [(k, d, lo, hi, max(1, -(-(hi - lo) // bins))) for k, (d, lo, hi, _, _) in state.items()]
        look = F.broadcast(_small(rows.sparkSession, ["_node", "_d", "_lo", "_hi", "_w"], asked))
        key = F.expr("element_at(_grid, cast(_d + 1 AS int))") * TIES + F.col("_tie")
        counts = (
            rows.join(look, "_node").withColumn("_key", key).filter("_key >= _lo AND _key < _hi")
            .groupBy("_node", F.expr("(_key - _lo) div _w").alias("_bin")).agg(F.sum(weight).alias("_sum")).collect()
        )
        by: dict[int, dict[int, float]] = {}
        for r in counts:
            by.setdefault(r["_node"], {})[r["_bin"]] = float(r["_sum"])
        for k, d, lo, hi, width in asked:
            before, aim = state[k][3], state[k][4]
            last = lo - 1
            del state[k]
            for b in sorted(by.get(k, {})):
                held = by[k][b]
                if before + held <= aim:
                    before, last = before + held, lo + (b + 1) * width - 1
                elif width == 1 or held <= tolerance:
                    if aim - before >= held / 2:
                        before, last = before + held, lo + (b + 1) * width - 1
                    break
                else:
                    state[k] = (d, lo + b * width, min(hi, lo + (b + 1) * width), before, aim)
                    break
            if k not in state:
                found[k] = (last, before)
    return found


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, law: str = "bytes", dims: tuple[str, ...] = ("doc_id", "lang", "source"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot (gapless from 0 in each shard).

    `shards` or, from `target_bytes`, as many as hold the total.  `law`: "bytes" weighs rows by size, "rows" by one.
    """
    if law not in ("bytes", "rows") or (shards is None) == (target_bytes is None):
        raise ValueError("law: bytes or rows; give shards or target_bytes")
    spark = docs.sparkSession
    meta = metadata(docs, id_col, text_col, list(dims))
    weight = F.col("_size") if law == "bytes" else F.lit(1)
    n = len([d for d in dims if d in docs.columns]) + 1
    ends = meta.agg(*[f(F.col("_at")[i]).alias(f"{f.__name__}{i}") for i in range(n) for f in (F.min, F.max)], F.sum(weight).alias("w"), F.sum("_size").alias("b")).first()
    shards = shards or max(1, -(-int(ends["b"] or 0) // target_bytes))
    scale = [(ends[f"min{i}"] or 0.0, max((ends[f"max{i}"] or 0.0) - (ends[f"min{i}"] or 0.0), 1e-300)) for i in range(n)]
    grid = F.array(*[F.least(F.floor((F.col("_at")[i] - lo) / width * (GRID - 1)), F.lit(GRID - 1)).cast("long") for i, (lo, width) in enumerate(scale)])
    rows = meta.select("_id", "_size", "_crc", "_row", "_tie", grid.alias("_grid"), F.lit(0).cast("long").alias("_node"))
    leaves, boxes, made, tolerance = {0: shards}, {0: [(0, GRID)] * n}, 1, float(ends["w"] or 0) / shards / 2_000
    weights, held = {0: float(ends["w"] or 0)}, None
    while any(k > 1 for k in leaves.values()) and ends["w"]:
        live = [k for k, c in leaves.items() if c > 1]
        aims = {}
        for k in live:
            d = max(range(n), key=lambda i: (boxes[k][i][1] - boxes[k][i][0], -i))
            aims[k] = (d, boxes[k][d][0] * TIES, boxes[k][d][1] * TIES, weights[k] * (leaves[k] // 2) / leaves[k])
        found, splits = _quantiles(rows, weight, aims, tolerance), []
        for k in live:
            c, box, d, (last, left) = leaves.pop(k), boxes.pop(k), aims[k][0], found[k]
            leaves |= {made: c // 2, made + 1: c - c // 2}
            boxes[made], boxes[made + 1] = list(box), list(box)
            boxes[made][d] = (box[d][0], min(box[d][1], last // TIES + 1))
            boxes[made + 1][d] = (max(box[d][0], (last + 1) // TIES), box[d][1])
            weights |= {made: left, made + 1: weights[k] - left}
            splits.append((k, d, last, made, made + 1))
            made += 2
        level = written(_node(rows, splits), "kd-level")  # the next passes read each row's node instead of all joins so far
        if held is not None:
            drop_written(held)
        rows = held = level
    order = {k: i for i, k in enumerate(sorted(leaves))}
    names = F.broadcast(_small(spark, ["_node", "shard"], list(order.items())))
    pieces = parallelism(spark)
    placed = rows.join(names, "_node").withColumn("_piece", F.pmod(F.xxhash64("_row"), F.lit(pieces)))
    counts = placed.groupBy("shard", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    numbered = placed.withColumn("_k", F.row_number().over(Window.partitionBy("shard", "_piece").orderBy("_id", "_row")))
    return numbered.join(F.broadcast(before), ["shard", "_piece"]).select(  # shards x pieces rows
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").cast("long").alias("text_crc32"), F.lit(law).alias("law"),
        F.col("shard").cast("int").alias("shard"), (F.col("_before") + F.col("_k") - 1).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Writes `docs` (whose ids are distinct) as one folder per shard, rows in slot order."""
    both = docs.join(placed.select(id_col, "shard", "slot"), id_col)
    both.repartitionByRange(parallelism(docs.sparkSession), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def query(spark, sf_dir):
    placed = kd_shards(table(spark, sf_dir, "documents"), shards=24)
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))
