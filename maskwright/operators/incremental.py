"""Append extents, prefix-ordered publication, milestones, quarantine, packing under ceilings, integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import adapters as A
from ..shared import written
from .keyed import counts, duplicates, last_wins


def running(rows: DataFrame, order: list[str], pieces: int, **sums) -> DataFrame:
    """Adds running sums (inclusive) in `order` over all rows without one task that sees them all: sums within ranges plus the
    sums of the ranges before.  `order` is a total order.

    The rows are written once, each with its range: bounds are sampled, so a second evaluation could deal them otherwise.
    """
    ranged = written(rows.repartitionByRange(pieces, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = ranged.groupBy("_p").agg(*[F.sum(c).alias(f"_t_{k}") for k, c in sums.items()])
    ahead = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_p", *[F.coalesce(F.sum(f"_t_{k}").over(ahead), F.lit(0)).alias(f"_b_{k}") for k in sums])  # one row a range
    out = ranged.withColumns({f"_w_{k}": F.sum(c).over(within) for k, c in sums.items()}).join(F.broadcast(before), "_p")
    return out.withColumns({k: F.col(f"_w_{k}") + F.col(f"_b_{k}") for k in sums}).drop("_p", *[f"_{x}_{k}" for k in sums for x in ("w", "b")])


def extend(known: DataFrame, candidates: DataFrame, excluded: DataFrame, target: int, unit_size: int, start_index: int, start_unit: int, order: str = "_ord") -> DataFrame:
    """The next `target` new rows of a manifest in order: not excluded, key and id not known; index and unit continue, units start fresh.

    Raises when fewer are there.
    """
    fresh = candidates.filter(F.coalesce("pair_key", F.lit("")) != "")
    for key in ("image_id", "pair_key"):
        fresh = fresh.join(known.select(key).distinct(), key, "left_anti")
    fresh = fresh.join(excluded.select(F.col("identifier").alias("image_id")), "image_id", "left_anti")
    first = fresh.groupBy("pair_key").agg(F.min_by(F.struct("image_id", order), order).alias("r")).select("pair_key", "r.*")
    placed = running(first.withColumn("_one", F.lit(1)), [order, "pair_key"], 16, _k="_one").withColumn("_k", F.col("_k") - 1)
    taken = placed.filter(F.col("_k") < target)
    found = taken.count()
    if found < target:
        raise ValueError(f"{target} new rows asked for, {found} found")
    return taken.select("image_id", "pair_key", order, (F.col("_k") + start_index).alias("source_manifest_index"), (F.expr(f"_k div {unit_size}") + start_unit).alias("campaign_unit"))


def completed_prefix(units: DataFrame, done: str = "done") -> DataFrame:
    """Units before the first that isn't complete (a bound from one aggregate, no ordered scan)."""
    gap = units.agg(F.min(F.when(~F.col(done), F.col("unit"))).alias("gap"))
    return units.crossJoin(F.broadcast(gap)).filter("gap IS NULL OR unit < gap").drop("gap")  # gap: one row


def publish(pairs: DataFrame, units: DataFrame, base: int = 0, per_milestone: int = 100) -> DataFrame:
    """Pairs of the completed prefix in (unit, source index) order with dense pair_index and milestone; first of an id wins."""
    ready = pairs.join(completed_prefix(units).select("unit"), "unit")
    first = ready.groupBy("image_id").agg(F.min(F.struct("unit", "source_manifest_index")).alias("r")).select("image_id", "r.*")
    numbered = running(first.withColumn("_one", F.lit(1)), ["unit", "source_manifest_index", "image_id"], 16, pair_index="_one").drop("_one")
    numbered = numbered.withColumn("pair_index", F.col("pair_index") - 1 + base)
    return numbered.withColumn("milestone", F.expr(f"pair_index div {per_milestone}"))


def full_milestones(published: DataFrame, per_milestone: int = 100) -> DataFrame:
    return counts(published, "milestone").filter(F.col("n") == per_milestone).select("milestone")


def quarantined(failures: DataFrame, done: DataFrame, most: int = 3) -> DataFrame:
    """Units with `most` failed attempts and no success."""
    return counts(failures, "unit", "attempts").filter(F.col("attempts") >= most).join(done.select("unit").distinct(), "unit", "left_anti")


def packed(rows: DataFrame, key: str, most: int, budget: int) -> DataFrame:
    """Batches under two ceilings within each key: sorted by (rows, tokens, id); an oversize item is its own batch.

    Keys are dealt to tasks and sorted there; one pass carries the open batch (its number, items and tokens) along.
    """

    def run(frames):
        last, batch, n, held = object(), 0, 0, 0
        for frame in frames:
            out = []
            for k, tokens in zip(frame["k"], frame["tokens"], strict=True):
                if k != last:
                    last, batch, n, held = k, 0, 0, 0
                elif n >= most or held + tokens > budget:
                    batch, n, held = batch + 1, 0, 0
                n, held = n + 1, held + tokens
                out.append(batch)
            yield frame[["k", "id"]].assign(batch=out)

    kind = dict(rows.dtypes)
    dealt = rows.select(F.col(key).alias("k"), "rows", "tokens", "id").repartition("k").sortWithinPartitions("k", "rows", "tokens", "id")
    return dealt.mapInPandas(run, f"k {kind[key]}, id {kind['id']}, batch int").withColumnRenamed("k", key)


def byte_shards(rows: DataFrame, limit: int) -> DataFrame:
    """Shard of each unit in unit order: a shard closes after the unit with which it reaches `limit`, and the next starts from 0.

    Where a shard ends depends on where the one before ended, so one task runs through (unit, bytes), a row a unit, in order;
    its state is two numbers.
    """

    def run(frames):
        shard, held = 0, 0
        for frame in frames:
            out = []
            for size in frame["bytes"]:
                out.append(shard)
                held += size
                if held >= limit:
                    shard, held = shard + 1, 0
            yield frame.assign(shard=out)

    units = rows.select(F.col("unit").cast("long"), F.col("bytes").cast("long"))
    return units.coalesce(1).sortWithinPartitions("unit").mapInPandas(run, "unit long, bytes long, shard long")


def integrity(masks: DataFrame, rle: DataFrame) -> DataFrame:
    """Issues of each unit: empty or duplicate ids, rle rows that don't match the manifest."""
    empty = masks.filter("coalesce(mask_id, '') = ''").groupBy("unit").agg(F.count(F.lit(1)).alias("n")).select("unit", F.lit("empty_mask_ids").alias("code"), "n")
    twice = lambda df, code: df.filter("coalesce(mask_id, '') <> ''").groupBy("unit", "mask_id").count().filter("count > 1").groupBy("unit").agg(F.count(F.lit(1)).alias("n")).select("unit", F.lit(code).alias("code"), "n")
    left, right = masks.filter("coalesce(mask_id, '') <> ''").select("unit", "mask_id").distinct().withColumn("_m", F.lit(1)), rle.select("unit", "mask_id").distinct().withColumn("_r", F.lit(1))
    off = left.join(right, ["unit", "mask_id"], "full_outer").filter("_m IS NULL OR _r IS NULL").groupBy("unit").agg(F.count(F.lit(1)).alias("n")).select("unit", F.lit("manifest_rle_mismatch").alias("code"), "n")
    return empty.unionByName(twice(masks, "duplicate_mask_ids")).unionByName(twice(rle, "duplicate_rle_ids")).unionByName(off)


def archive_issues(masks: DataFrame, members: DataFrame, folder: str = "masks") -> DataFrame:
    """Members of each unit's archive against its masks: lost_members and stray_members with their number.

    masks: unit, mask_id.  members: unit, member, of which those below `folder` are compared.
    """
    want = masks.filter("coalesce(mask_id, '') <> ''").select("unit", F.concat(F.lit(f"{folder}/"), "mask_id", F.lit(".png")).alias("member")).distinct().withColumn("_w", F.lit(1))
    have = members.filter(F.col("member").startswith(f"{folder}/")).select("unit", "member").distinct().withColumn("_h", F.lit(1))
    off = want.join(have, ["unit", "member"], "full_outer").filter("_w IS NULL OR _h IS NULL")
    return off.groupBy("unit", F.when(F.col("_h").isNull(), "lost_members").otherwise("stray_members").alias("code")).agg(F.count(F.lit(1)).alias("n"))


def replay_claims(log: DataFrame) -> DataFrame:
    """Owner of each unit from an ordered claim log: a claim wins if the unit is free or its lease (the event's `value` seconds past) ran out.

    Generation counts the claims that won.  The fold runs per unit over its own few events, in the JVM.
    """
    events = F.array_sort(F.collect_list(F.struct(F.col("_ord").alias("o"), "kind", "worker", "at", "lease")))
    fold = """aggregate(ev, named_struct('worker', cast(NULL AS bigint), 'until', 0L, 'generation', 0), (s, e) ->
      CASE WHEN e.kind = 'claim' AND (s.worker IS NULL OR e.at >= s.until) THEN named_struct('worker', e.worker, 'until', e.at + e.lease, 'generation', s.generation + 1)
           WHEN e.kind = 'renew' AND s.worker = e.worker THEN named_struct('worker', s.worker, 'until', e.at + e.lease, 'generation', s.generation)
           WHEN e.kind = 'release' AND s.worker = e.worker THEN named_struct('worker', cast(NULL AS bigint), 'until', 0L, 'generation', s.generation) ELSE s END)"""
    return log.groupBy("unit").agg(events.alias("ev")).select("unit", F.expr(fold).alias("s")).select("unit", "s.worker", "s.generation")


def _units(s, d):
    """A unit is done when its eight rows are there."""
    return A.sources(s, d).groupBy(F.col("campaign_unit").alias("unit")).agg((F.count_distinct("image_id") == 8).alias("done"))


def _publish(s, d):
    return publish(A.sources(s, d).withColumnRenamed("campaign_unit", "unit").select("image_id", "unit", "source_manifest_index"), _units(s, d))


def _claims(s, d):
    e = A.table(s, d, "events")
    kind = F.when(F.col("event_type") == "purchase", "claim").when(F.col("event_type") == "signup", "claim").when(F.col("event_type") == "error", "release").otherwise("renew")
    return e.select((F.col("user_id") % 50).alias("unit"), (F.col("user_id") % 7).alias("worker"), kind.alias("kind"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"), F.lit(3600).cast("long").alias("lease"), F.struct("ts", "event_id").alias("_ord"))


def _integrity(s, d):
    m = A.table(s, d, "lineitem").select((F.col("l_orderkey") % 97).alias("unit"), F.when(F.col("l_partkey") % 50 == 0, "").otherwise(F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("mask_id"))
    r = A.table(s, d, "lineitem").filter("l_suppkey % 10 <> 0").select((F.col("l_orderkey") % 97).alias("unit"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("mask_id"))
    return integrity(m, r)


def _archives(s, d):
    t = A.table(s, d, "lineitem").select((F.col("l_orderkey") % 97).alias("unit"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("mask_id"), "l_returnflag", "l_linestatus")
    members = t.filter("l_returnflag <> 'R'").select("unit", F.concat(F.when(F.col("l_returnflag") == "A", "masks/").otherwise("crops/"), F.when(F.col("l_linestatus") == "O", "x").otherwise(""), "mask_id", F.lit(".png")).alias("member"))
    return archive_issues(t, members)


def _extend(s, d):
    """Labelled documents are known, those of toxic label excluded; every other one is wanted."""
    src = A.sources(s, d).select("image_id", F.col("source_pair_key").alias("pair_key"), F.col("source_manifest_index").alias("_ord"))
    known = src.join(A.reviews(s, d).filter("accepted").select("image_id"), "image_id", "left_semi")
    gone = A.reviews(s, d).filter("NOT accepted AND reject_reason = 'toxic'").select(F.col("image_id").alias("identifier"))
    n = src.count() - A.reviews(s, d).filter("accepted OR reject_reason = 'toxic'").count()
    return extend(known, src, gone, n, 8, 250, 32).drop("_ord")


def _change_keys(s, d):
    return A.changes(s, d).withColumn("key", F.when(F.col("key") % 13 == 0, None).otherwise(F.col("key")))


_S = f"WITH {A.SOURCES}"
_U = f"{_S}, u AS (SELECT campaign_unit AS unit, count(DISTINCT image_id) = 8 AS done FROM sources GROUP BY 1), g AS (SELECT coalesce(min(unit) FILTER (NOT done), 1000000000) AS gap FROM u)"
QUERIES = {
    "log_last_wins": lambda s, d: last_wins(_change_keys(s, d), "key").select("key", "event_id", "event_type"),
    "log_duplicates": lambda s, d: duplicates(A.table(s, d, "documents"), "text").select("text", "n"),
    "log_quarantined": lambda s, d: quarantined(A.changes(s, d).filter("event_type = 'error'").select(F.col("key").alias("unit")), A.changes(s, d).filter("event_type = 'signup' AND value > 50").select(F.col("key").alias("unit")), 3),
    "extent_extend": _extend,
    "prefix_units": lambda s, d: completed_prefix(_units(s, d)).select("unit"),
    "publish_pairs": _publish,
    "pack_batches": lambda s, d: packed(A.boxes(s, d).select(F.expr("image_id % 500").alias("g"), (F.col("h") / 7).cast("int").alias("rows"), (F.col("w") * 100).cast("long").alias("tokens"), (F.col("image_id") * 100 + F.col("raw_index")).alias("id")), "g", 8, 20_000),
    "merge_byte_shards": lambda s, d: byte_shards(A.sources(s, d).groupBy(F.col("campaign_unit").alias("unit")).agg(F.sum("n_chars").alias("bytes")), 60_000),
    "unit_integrity": _integrity,
    "unit_archives": _archives,
    "claim_replay": lambda s, d: replay_claims(_claims(s, d)),
}
ORACLES = {
    "log_last_wins": "SELECT user_id AS key, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events WHERE user_id % 13 <> 0 GROUP BY 1",
    "log_duplicates": "SELECT text, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "log_quarantined": "SELECT user_id AS unit, count(*) AS attempts FROM events WHERE event_type = 'error' AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 50) GROUP BY 1 HAVING count(*) >= 3",
    "extent_extend": f"""WITH {A.SOURCES}, {A.REVIEWS}, c AS (SELECT image_id, source_pair_key AS pair_key, row_number() OVER (ORDER BY source_manifest_index) - 1 AS k FROM sources WHERE image_id NOT IN (SELECT image_id FROM reviews WHERE accepted OR reject_reason = 'toxic'))
      SELECT image_id, pair_key, k + 250 AS source_manifest_index, k // 8 + 32 AS campaign_unit FROM c""",
    "prefix_units": f"{_U} SELECT unit FROM u, g WHERE unit < gap",
    "publish_pairs": f"""{_S}, u AS (SELECT campaign_unit AS unit, count(DISTINCT image_id) = 8 AS done FROM sources GROUP BY 1), g AS (SELECT min(unit) FILTER (NOT done) AS gap FROM u),
      f AS (SELECT image_id, min(campaign_unit) AS unit, min(source_manifest_index) AS source_manifest_index FROM sources, g WHERE gap IS NULL OR campaign_unit < gap GROUP BY 1),
      p AS (SELECT *, row_number() OVER (ORDER BY unit, source_manifest_index) - 1 AS pair_index FROM f) SELECT *, pair_index // 100 AS milestone FROM p""",
    "pack_batches": f"""WITH RECURSIVE {A.BOXES}, i AS (SELECT image_id % 500 AS g, image_id * 100 + raw_index AS id, CAST(w * 100 AS BIGINT) AS tokens, row_number() OVER (PARTITION BY image_id % 500 ORDER BY (h - 1) // 7, w * 100, image_id * 100 + raw_index) AS k FROM boxes),
      r AS (SELECT g, id, k, 0 AS batch, 1 AS n, tokens AS t FROM i WHERE k = 1 UNION ALL SELECT i.g, i.id, i.k, CASE WHEN r.n >= 8 OR r.t + i.tokens > 20000 THEN r.batch + 1 ELSE r.batch END, CASE WHEN r.n >= 8 OR r.t + i.tokens > 20000 THEN 1 ELSE r.n + 1 END,
        CASE WHEN r.n >= 8 OR r.t + i.tokens > 20000 THEN i.tokens ELSE r.t + i.tokens END FROM r JOIN i ON i.g = r.g AND i.k = r.k + 1) SELECT g, id, batch FROM r""",
    "merge_byte_shards": f"""WITH RECURSIVE {A.SOURCES}, u AS (SELECT unit, bytes, row_number() OVER (ORDER BY unit) AS k FROM (SELECT campaign_unit AS unit, CAST(sum(n_chars) AS BIGINT) AS bytes FROM sources GROUP BY 1)),
      r AS (SELECT unit, bytes, k, 0 AS shard, bytes AS held FROM u WHERE k = 1
        UNION ALL SELECT u.unit, u.bytes, u.k, r.shard + CAST(r.held >= 60000 AS INT), CASE WHEN r.held >= 60000 THEN u.bytes ELSE r.held + u.bytes END FROM r JOIN u ON u.k = r.k + 1)
      SELECT unit, bytes, CAST(shard AS BIGINT) AS shard FROM r""",
    "unit_archives": """WITH t AS (SELECT l_orderkey % 97 AS unit, l_orderkey || '-' || l_linenumber AS id, l_returnflag AS r, l_linestatus AS o FROM lineitem), w AS (SELECT DISTINCT unit, 'masks/' || id || '.png' AS m FROM t),
      h AS (SELECT DISTINCT unit, 'masks/' || CASE WHEN o = 'O' THEN 'x' ELSE '' END || id || '.png' AS m FROM t WHERE r = 'A')
      SELECT unit, 'lost_members' AS code, count(*) AS n FROM w WHERE (unit, m) NOT IN (SELECT (unit, m) FROM h) GROUP BY 1 UNION ALL SELECT unit, 'stray_members', count(*) FROM h WHERE (unit, m) NOT IN (SELECT (unit, m) FROM w) GROUP BY 1""",
    "claim_replay": """WITH RECURSIVE e AS (SELECT user_id % 50 AS unit, user_id % 7 AS worker, CASE event_type WHEN 'purchase' THEN 'claim' WHEN 'signup' THEN 'claim' WHEN 'error' THEN 'release' ELSE 'renew' END AS kind,
        CAST(floor(epoch(ts)) AS BIGINT) AS at, row_number() OVER (PARTITION BY user_id % 50 ORDER BY ts, event_id) AS k FROM events),
      r AS (SELECT unit, 0 AS k, CAST(NULL AS BIGINT) AS worker, CAST(0 AS BIGINT) AS until, 0 AS generation FROM (SELECT DISTINCT unit FROM e)
        UNION ALL SELECT e.unit, CAST(e.k AS INT), CASE WHEN won THEN e.worker WHEN own AND e.kind = 'release' THEN NULL ELSE r.worker END,
          CASE WHEN won OR own AND e.kind = 'renew' THEN e.at + 3600 WHEN own AND e.kind = 'release' THEN 0 ELSE r.until END, r.generation + CAST(won AS INT)
        FROM r JOIN e ON e.unit = r.unit AND e.k = r.k + 1, LATERAL (SELECT e.kind = 'claim' AND (r.worker IS NULL OR e.at >= r.until) AS won, coalesce(r.worker = e.worker, false) AS own))
      SELECT unit, worker, generation FROM r QUALIFY row_number() OVER (PARTITION BY unit ORDER BY k DESC) = 1""",
    "unit_integrity": """WITH m AS (SELECT l_orderkey % 97 AS unit, CASE WHEN l_partkey % 50 = 0 THEN '' ELSE l_orderkey || '-' || l_linenumber END AS id FROM lineitem), r AS (SELECT l_orderkey % 97 AS unit, l_orderkey || '-' || l_linenumber AS id FROM lineitem WHERE l_suppkey % 10 <> 0)
      SELECT unit, 'empty_mask_ids' AS code, count(*) AS n FROM m WHERE id = '' GROUP BY 1 UNION ALL SELECT unit, 'duplicate_mask_ids', count(*) FROM (SELECT unit, id FROM m WHERE id <> '' GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1
      UNION ALL SELECT unit, 'duplicate_rle_ids', count(*) FROM (SELECT unit, id FROM r GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1
      UNION ALL SELECT coalesce(x.unit, y.unit), 'manifest_rle_mismatch', count(*) FROM (SELECT DISTINCT unit, id FROM m WHERE id <> '') x FULL JOIN (SELECT DISTINCT unit, id FROM r) y ON x.unit = y.unit AND x.id = y.id WHERE x.id IS NULL OR y.id IS NULL GROUP BY 1""",
}
