"""Campaign control: registry and extensions, unit claims, the worker's scan, status, finalising quarantines, repair plans."""

from __future__ import annotations

import fcntl
import json
import os
import threading
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import adapters as A
from ..functions.text import input_limit_error
from ..sources.sinks import read_json, write_json
from .keyed import counts
from .records import PREREQUISITES

# The version of this registry; fixed values: reasons that recovery writes.
SCHEMA = "campaign-v1"
TOO_LARGE, TAIL = "bcc_input_too_large", "bcc_input_too_large_or_interrupted_batch_tail"


# ---- registry and extensions
def load_registry(spark: SparkSession, root: str, now: Callable[[], float] = time.time) -> dict:
    """The campaign's registry; a new one where there is none."""
    fresh = {"schema_version": SCHEMA, "created_at": stamp(now()), "updated_at": stamp(now()), "unit_size": 100, "source_count": 0, "unit_count": 0, "extensions": [], "selection": {}}
    return read_json(spark, f"{root}/registry.json", fresh)


def stamp(seconds: float) -> str:
    return time.strftime("%Y-%m-%dT%H:%M:%S+00:00", time.gmtime(seconds))


def initialize(spark: SparkSession, root: str, unit_size: int = 100, **facts) -> dict:
    """Writes a registry, or returns the one there; the unit size can't change once sources are committed."""
    registry = load_registry(spark, root)
    if read_json(spark, f"{root}/registry.json") is not None:
        if registry["source_count"] and registry["unit_size"] != unit_size:
            raise ValueError("the unit size can't change after sources have been committed")
        return registry
    registry |= {"unit_size": unit_size, **facts}
    write_json(spark, registry, f"{root}/registry.json")
    return registry


def start_extension(spark: SparkSession, root: str, count: int, kind: str) -> tuple[dict, dict]:
    """(registry, extension) after what was left in progress is marked as superseded; what is committed must be without gaps."""
    registry = load_registry(spark, root)
    if registry.get("schema_version") != SCHEMA:
        raise ValueError(f"unknown campaign registry {registry.get('schema_version')!r}")
    for e in registry["extensions"]:
        if e["status"] == "in_progress":
            e |= {"status": "interrupted_superseded", "finished_at": stamp(time.time())}
    check_manifest(spark, root, registry)
    extension = {
        "extension_id": len(registry["extensions"]), "started_at": stamp(time.time()), "source_kind": kind, "requested_add_count": count,
        "start_source_index": registry["source_count"], "start_unit_index": registry["unit_count"], "status": "in_progress",
    }
    registry["extensions"].append(extension)
    write_json(spark, registry | {"updated_at": stamp(time.time())}, f"{root}/registry.json")
    return registry, extension


def manifest(spark: SparkSession, root: str, registry: dict | None = None) -> DataFrame | None:
    """Rows of all committed extensions."""
    registry = registry or load_registry(spark, root)
    shards = [f"{root}/{e['manifest_shard']}" for e in registry["extensions"] if e["status"] == "complete"]
    return spark.read.parquet(*shards) if shards else None


def check_manifest(spark: SparkSession, root: str, registry: dict) -> None:
    """Raises unless source indexes of the committed shards are 0 .. source_count-1, each once (from counts, no sort)."""
    rows = manifest(spark, root, registry)
    n, distinct, low, high = (0, 0, None, None) if rows is None else rows.agg(F.count(F.lit(1)), F.count_distinct("source_manifest_index"), F.min("source_manifest_index"), F.max("source_manifest_index")).first()
    if n != registry["source_count"] or (n and (distinct, low, high) != (n, 0, n - 1)):
        raise RuntimeError(f"committed shards hold {n} rows with indexes {low} to {high}; the registry says {registry['source_count']}")


def commit_extension(spark: SparkSession, root: str, registry: dict, extension: dict, rows: DataFrame) -> dict:
    """Writes the extension's shard, then makes it count in the registry.  rows: source_manifest_index, campaign_unit and more."""
    shard = f"extensions/extension-{extension['extension_id']:06d}"
    rows.write.mode("overwrite").parquet(f"{root}/{shard}")
    got = spark.read.parquet(f"{root}/{shard}").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("campaign_unit").alias("u")).first()
    mine = next(e for e in registry["extensions"] if e["extension_id"] == extension["extension_id"])
    registry |= {"source_count": registry["source_count"] + got["n"], "unit_count": registry["unit_count"] + got["u"], "updated_at": stamp(time.time())}
    mine |= {"status": "complete", "finished_at": stamp(time.time()), "added_count": got["n"], "end_source_index": registry["source_count"] - 1, "end_unit_index": registry["unit_count"] - 1, "manifest_shard": shard}
    check_manifest(spark, root, registry)
    write_json(spark, registry, f"{root}/registry.json")
    return registry


def extend_cursor(members: DataFrame, registry: dict, archives: list[str], requested: int, known: DataFrame, excluded: DataFrame) -> tuple[DataFrame, dict]:
    """The next rows of a list of archives from a cursor (archive, place in its key order): (rows in order, new selection).

    members: archive, key, place (from a stable order of the archive's keys).  Known keys and excluded ones are passed over.
    """
    from .incremental import running

    spark = members.sparkSession
    selection = registry.get("selection") or {}
    at, key = selection.get("tar_index", 0), selection.get("key_index", 0)
    order = spark.createDataFrame([(a, i) for i, a in enumerate(archives)], "archive string, tar_index long")
    rows = members.join(F.broadcast(order), "archive").filter((F.col("tar_index") > at) | ((F.col("tar_index") == at) & (F.col("place") >= key)))  # a row an archive
    rows = rows.join(known.select("key"), "key", "left_anti").join(excluded.select(F.col("identifier").alias("key")), "key", "left_anti")
    taken = running(rows.withColumn("_one", F.lit(1)), ["tar_index", "place"], 16, _k="_one").drop("_one").filter(F.col("_k") <= requested)
    last = taken.agg(F.max(F.struct("tar_index", "place")).alias("r"), F.count(F.lit(1)).alias("n")).first()
    if not last["n"]:
        return taken, selection | {"tar_paths": archives, "tar_index": len(archives), "key_index": 0}
    size = members.join(F.broadcast(order), "archive").filter(F.col("tar_index") == last["r"]["tar_index"]).count()
    tar, place = last["r"]["tar_index"], last["r"]["place"] + 1
    if last["n"] < requested:
        tar, place = len(archives), 0
    elif place >= size:
        tar, place = tar + 1, 0
    return taken, selection | {"tar_paths": archives, "tar_index": tar, "key_index": place}


# ---- claims as a rule over rows
def allocation(worker: Column) -> Column:
    return F.regexp_replace(worker, r":[^:]*$", "")


def scheduler_job(worker: Column) -> Column:
    """The job that a worker runs in: "local", "" for none, else job or job_task."""
    a = allocation(worker)
    local = (a == "local") | a.startswith("local:")
    return F.when(a == "", "").when(local, "local").otherwise(F.regexp_replace(a, r"^([^:]*):(.+)$", "$1_$2"))


def claim_outcome(worker: Column, now: Column, lease: int, grace: int = 120) -> Column:
    """struct(won, generation) of a claim on a unit, from the columns success, prior_worker (null: unclaimed), heartbeat, generation,
    local_active (null: on another host) and job_state (active, inactive, unknown) of the claim before.

    A requeued job takes over at once; an orphan of the same host or of a job that has ended after `grace`; any other local claim
    when `lease` has run out; a worker never takes its own claim.
    """
    prior, mine = F.col("prior_worker"), allocation(worker)
    age = F.greatest(F.lit(0.0), now - F.col("heartbeat"))
    requeued = (mine != "") & ~((mine == "local") | mine.startswith("local:")) & (allocation(prior) == mine)
    orphan = age >= max(0, grace)
    local = scheduler_job(prior).isin("", "local")
    late = F.when(local, (orphan & (F.coalesce("local_active", F.lit(True)) == F.lit(False))) | (F.col("local_active").isNull() & (age >= max(1, lease)))).otherwise(orphan & (F.coalesce("job_state", F.lit("unknown")) == "inactive"))
    free = prior.isNull()
    won = ~F.col("success") & (free | ((prior != worker) & (requeued | late)))
    return F.struct(won.alias("won"), F.when(free, F.lit(0)).otherwise(F.coalesce("generation", F.lit(0)) + won.cast("int")).alias("generation"))


# ---- claims as files: one folder on storage with locks
class Lost(RuntimeError):
    """A claim that another worker holds now."""


@dataclass
class Claim:
    stage: str
    unit: int
    token: str
    generation: int
    worker: str


class Claims:
    """Fenced claims of units.  A lock a stage covers each decision and what follows from it; the token decides who may commit."""

    def __init__(self, root: str | Path, lease: float = 21_600, grace: float = 120, now: Callable[[], float] = time.time, job_state: Callable[[str], str] = lambda job: "unknown") -> None:
        self.root, self.lease, self.grace, self.now, self.job_state = Path(root), lease, grace, now, job_state

    @contextmanager
    def _locked(self, stage: str):
        folder = self.root / "claims" / stage
        folder.mkdir(parents=True, exist_ok=True)
        with open(folder / ".lock", "w") as f:
            fcntl.flock(f, fcntl.LOCK_EX)
            yield folder

    def _read(self, path: Path) -> dict:
        try:
            return json.loads(path.read_text())
        except (OSError, json.JSONDecodeError):
            return {}

    def _put(self, path: Path, value: dict) -> None:
        beside = path.with_name(f"{path.name}.{uuid.uuid4().hex}")
        beside.write_text(json.dumps(value, sort_keys=True))
        os.replace(beside, path)

    def take(self, stage: str, unit: int, worker: str, success: bool = False) -> Claim | None:
        with self._locked(stage) as folder:
            path = folder / f"{unit:06d}.claim"
            prior = self._read(path)
            if success or (path.exists() and not self._stale(prior, worker)):
                return None
            made = Claim(stage, unit, uuid.uuid4().hex, prior.get("generation", -1) + 1 if path.exists() else 0, worker)
            self._put(path, {"worker": worker, "token": made.token, "generation": made.generation, "claimed_at": self.now(), "heartbeat_at": self.now(), "pid": os.getpid()})
            return made

    def _stale(self, prior: dict, worker: str) -> bool:
        old = prior.get("worker", "")
        home = lambda w: w.rsplit(":", 1)[0] if ":" in w else w
        local = lambda a: a == "local" or a.startswith("local:")
        age = max(0.0, self.now() - float(prior.get("heartbeat_at", 0)))
        if old == worker:
            return False
        if home(worker) == home(old) and home(worker) and not local(home(worker)):
            return True
        if not home(old) or local(home(old)):
            return (age >= self.grace and not self._alive(prior.get("pid"))) or age >= max(1, self.lease)
        job, _, task = home(old).partition(":")
        return age >= self.grace and self.job_state(f"{job}_{task}" if task else job) == "inactive"

    @staticmethod
    def _alive(pid) -> bool:
        try:
            os.kill(int(pid or 0), 0)
        except (ProcessLookupError, TypeError, ValueError):
            return False
        except PermissionError:
            return True
        return bool(pid)

    @contextmanager
    def owned(self, claim: Claim):
        """What runs inside holds the stage's lock and the claim; raises Lost if another worker has it."""
        with self._locked(claim.stage) as folder:
            path = folder / f"{claim.unit:06d}.claim"
            held = self._read(path)
            if (held.get("token"), held.get("worker")) != (claim.token, claim.worker):
                raise Lost(f"{claim.stage} unit {claim.unit:06d}")
            yield path, held

    def renew(self, claim: Claim) -> bool:
        try:
            with self.owned(claim) as (path, held):
                self._put(path, held | {"heartbeat_at": self.now()})
        except Lost:
            return False
        return True

    def release(self, claim: Claim, cleanup: Callable[[], None] = lambda: None) -> bool:
        """Ends a claim after `cleanup`, without a gap in which another worker could take it."""
        try:
            with self.owned(claim) as (path, _):
                try:
                    cleanup()
                finally:
                    path.unlink(missing_ok=True)
        except Lost:
            return False
        return True

    def commit(self, claim: Claim, marker: str | Path, value: dict) -> None:
        """Puts a commit marker in place while the claim is held; never over another."""
        with self.owned(claim):
            if Path(marker).exists():
                raise FileExistsError(str(marker))
            Path(marker).parent.mkdir(parents=True, exist_ok=True)
            self._put(Path(marker), value)

    @contextmanager
    def heartbeat(self, claim: Claim, every: float = 60.0):
        """Renews a claim while the block runs; raises Lost at its end if a renewal failed."""
        stop, lost = threading.Event(), threading.Event()

        def beat() -> None:
            while not stop.wait(every):
                if not self.renew(claim):
                    lost.set()
                    return

        thread = threading.Thread(target=beat, daemon=True)
        thread.start()
        try:
            yield lost
        finally:
            stop.set()
            thread.join(5)
        if lost.is_set():
            raise Lost(f"{claim.stage} unit {claim.unit:06d}")


def work(claims: Claims, stage: str, units: list[int], worker: str, run: Callable[[int], dict], root: str | Path, most_attempts: int = 3, stop_at: float | None = None) -> dict[str, list[int]]:
    """A worker's scan: units in order that aren't done or quarantined are claimed, run and committed; failures are counted and
    after `most_attempts` quarantine the unit.  From `stop_at` on no further unit is claimed.
    """
    out: dict[str, list[int]] = {"done": [], "failed": [], "skipped": []}
    for unit in units:
        if stop_at is not None and claims.now() >= stop_at:
            break
        folder = Path(root) / "units" / f"{unit:06d}" / "stages" / stage
        if (folder / "_SUCCESS.json").exists() or (folder / "_QUARANTINED.json").exists() or (claim := claims.take(stage, unit, worker)) is None:
            out["skipped"].append(unit)
            continue
        folder.mkdir(parents=True, exist_ok=True)
        try:
            with claims.heartbeat(claim):
                details = run(unit)
            claims.commit(claim, folder / "_SUCCESS.json", {"stage": stage, "unit": unit, "worker": worker, "details": details, "completed_at": claims.now()})
            out["done"].append(unit)
        except Exception as e:  # noqa: BLE001  one unit's failure is the unit's
            attempts = len(list(folder.glob("attempt-*.error.json"))) + 1
            (folder / f"attempt-{attempts:03d}.error.json").write_text(json.dumps({"error": str(e), "worker": worker}))
            if attempts >= most_attempts:
                (folder / "_QUARANTINED.json").write_text(json.dumps({"stage": stage, "unit_id": unit, "attempt_count": attempts, "error": str(e)}))
            out["failed"].append(unit)
        claims.release(claim)
    return out


# ---- the campaign's state as tables
def claimable(units: DataFrame, done: DataFrame, quarantined: DataFrame, active: DataFrame, stage: str) -> DataFrame:
    """Units that a worker of `stage` may claim: not done, quarantined or claimed, and past one of the stage's prerequisites."""
    of = lambda df: df.filter(F.col("stage") == stage).select("unit")
    out = units.select("unit")
    if stage in PREREQUISITES:
        out = out.join(done.filter(F.col("stage").isin(*PREREQUISITES[stage])).select("unit").distinct(), "unit", "left_semi")
    return out.join(of(done).unionByName(of(quarantined)).unionByName(of(active)), "unit", "left_anti")


def status(units: DataFrame, stages: list[str], done: DataFrame, failures: DataFrame, active: DataFrame, quarantined: DataFrame) -> DataFrame:
    """One row a stage: complete, total, claimed and quarantined units, failed attempts."""
    spark = units.sparkSession
    base = spark.createDataFrame([(i, s) for i, s in enumerate(stages)], "place int, stage string").crossJoin(F.broadcast(units.agg(F.count_distinct("unit").alias("total_units"))))  # stages x one row
    distinct = lambda df, name: df.groupBy("stage").agg(F.count_distinct("unit").alias(name))
    for side in (distinct(done, "complete_units"), counts(failures, "stage", "failed_attempts"), distinct(active, "active_claims"), distinct(quarantined, "quarantined_units")):
        base = base.join(side, "stage", "left")
    zero = ["complete_units", "failed_attempts", "active_claims", "quarantined_units"]
    return base.select("stage", "total_units", *[F.coalesce(c, F.lit(0)).alias(c) for c in zero])


def finalised(quarantined: DataFrame, done: DataFrame, active: DataFrame, masks: DataFrame, terminal: DataFrame, minimum: int = 10) -> DataFrame:
    """Exclusions that end units quarantined for an input limit: their images with enough masks that no audit or exclusion ends.

    quarantined: unit, error.  masks: unit, image_id.  terminal: image_id.  Raises while such a unit is claimed.
    """
    open_units = quarantined.join(done.select("unit"), "unit", "left_anti").filter(input_limit_error(F.col("error")).isNotNull())
    if not open_units.join(active.select("unit"), "unit", "left_semi").isEmpty():
        raise RuntimeError("a unit to finalise has an active claim")
    enough = masks.filter("coalesce(image_id, '') <> ''").groupBy("unit", "image_id").agg(F.count(F.lit(1)).alias("mask_count")).filter(F.col("mask_count") >= minimum)
    rest = enough.join(open_units.select("unit", F.col("error").alias("diagnostic")), "unit").join(terminal.select("image_id"), "image_id", "left_anti")
    return rest.select("unit", "image_id", F.lit(TAIL).alias("reason_code"), F.lit(TOO_LARGE).alias("trigger_reason_code"), "mask_count", "diagnostic")


def repair_plan(issues: DataFrame, done: DataFrame, stages: list[str]) -> DataFrame:
    """Stages of each damaged unit that must run again: the first damaged one and all after it that were done."""
    place = F.array_position(F.array(*map(F.lit, stages)), F.col("stage"))
    first = issues.select("unit", place.alias("p")).filter("p > 0").groupBy("unit").agg(F.min("p").alias("first"))
    redo = done.select("unit", "stage", place.alias("p")).distinct().join(first, "unit").filter("p >= first")
    return redo.select("unit", "stage")


def _events(s, d) -> dict[str, DataFrame]:
    e = A.table(s, d, "events").select((F.col("user_id") % 64).alias("unit"), "event_type", "event_id", "value", F.element_at(F.array(*map(F.lit, STAGES)), (F.col("event_id") % len(STAGES) + 1).cast("int")).alias("stage"))
    of = lambda kind: e.filter(F.col("event_type") == kind)
    return {"units": e.select("unit").distinct(), "done": of("purchase"), "failures": of("error"), "active": of("signup").filter("value > 90"), "quarantined": of("error").filter("value > 95")}


def _claim_rows(s, d) -> DataFrame:
    """Each event claims what the event before it of its user holds."""
    from pyspark.sql import Window

    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    worker = F.concat(F.element_at(F.array(*map(F.lit, ("local", "7", "7:3", "8", ""))), (F.col("event_id") % 5 + 1).cast("int")), F.lit(":"), (F.col("event_id") % 3).cast("string"))
    t = A.table(s, d, "events").withColumns({"worker": worker, "now": F.unix_micros(F.col("ts").cast("timestamp")) / 1e6})
    return t.select(
        "event_id", "worker", "now", (F.col("event_type") == "purchase").alias("success"), F.lag("worker").over(w).alias("prior_worker"), F.lag("now").over(w).alias("heartbeat"), (F.col("event_id") % 4).cast("int").alias("generation"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 2 == 0).alias("local_active"), F.when(F.col("event_id") % 2 == 0, "inactive").otherwise("active").alias("job_state"),
    )


def _finalised(s, d):
    q = _events(s, d)["quarantined"].select("unit", F.when(F.col("event_id") % 2 == 0, "exceeds the Maximum Context Length").otherwise("out of memory").alias("error")).groupBy("unit").agg(F.max("error").alias("error"))
    masks = A.table(s, d, "lineitem").select((F.col("l_partkey") % 64).alias("unit"), (F.col("l_partkey") % 320).cast("string").alias("image_id"))
    none = s.createDataFrame([], "unit long")
    return finalised(q, none, none, masks, A.audits(s, d))


STAGES = ["image-review", "sam3", "mask-captions", "mask-qa", "consistency", "bcc-draft", "bcc-audit", "bcc-rewrite"]
QUERIES = {
    "claim_outcomes": lambda s, d: _claim_rows(s, d).select("event_id", claim_outcome(F.col("worker"), F.col("now"), 7200, 600).alias("c")).select("event_id", "c.won", "c.generation"),
    "campaign_status": lambda s, d: status(_events(s, d)["units"], STAGES, *[_events(s, d)[k] for k in ("done", "failures", "active", "quarantined")]),
    "campaign_claimable": lambda s, d: claimable(*[_events(s, d)[k] for k in ("units", "done", "quarantined", "active")], "consistency"),
    "campaign_finalised": _finalised,
    "campaign_repair": lambda s, d: repair_plan(_events(s, d)["quarantined"], _events(s, d)["done"], STAGES),
}
_E = f"e AS (SELECT user_id % 64 AS unit, event_type, event_id, value, {STAGES}[event_id % {len(STAGES)} + 1] AS stage, event_id % {len(STAGES)} AS p FROM events)"
ORACLES = {
    "claim_outcomes": """WITH e AS (SELECT *, ['local', '7', '7:3', '8', ''][event_id % 5 + 1] AS home, ['local', '7', '7:3', '8', ''][event_id % 5 + 1] || ':' || (event_id % 3) AS worker, epoch_us(ts) / 1e6 AS now FROM events),
      l AS (SELECT *, lag(worker) OVER w AS pw, lag(home) OVER w AS ph, now - lag(now) OVER w AS age FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
      c AS (SELECT event_id, pw, event_type <> 'purchase' AND (pw IS NULL OR (pw <> worker AND ((home = ph AND home NOT IN ('', 'local')) OR CASE WHEN ph IN ('', 'local') THEN (age >= 600 AND event_id % 3 = 0 AND event_id % 2 = 1) OR (event_id % 3 <> 0 AND age >= 7200) ELSE age >= 600 AND event_id % 2 = 0 END))) AS won FROM l)
      SELECT event_id, won, CAST(CASE WHEN pw IS NULL THEN 0 ELSE event_id % 4 + CAST(won AS INT) END AS INT) AS generation FROM c""",
    "campaign_status": f"""WITH {_E}, s AS (SELECT unnest({STAGES}) AS stage) SELECT s.stage, (SELECT count(DISTINCT unit) FROM e) AS total_units, count(DISTINCT unit) FILTER (event_type = 'purchase') AS complete_units, count(*) FILTER (event_type = 'error') AS failed_attempts,
      count(DISTINCT unit) FILTER (event_type = 'signup' AND value > 90) AS active_claims, count(DISTINCT unit) FILTER (event_type = 'error' AND value > 95) AS quarantined_units FROM s LEFT JOIN e USING (stage) GROUP BY 1""",
    "campaign_claimable": f"""WITH {_E} SELECT DISTINCT unit FROM e WHERE unit IN (SELECT unit FROM e WHERE event_type = 'purchase' AND stage IN ('mask-qa', 'mask-captions'))
      AND unit NOT IN (SELECT unit FROM e WHERE stage = 'consistency' AND (event_type = 'purchase' OR event_type = 'signup' AND value > 90 OR event_type = 'error' AND value > 95))""",
    "campaign_finalised": f"""WITH {_E}, {A.SOURCES}, {A.AUDITS}, q AS (SELECT unit, max(CASE WHEN event_id % 2 = 0 THEN 'exceeds the Maximum Context Length' ELSE 'out of memory' END) AS error FROM e WHERE event_type = 'error' AND value > 95 GROUP BY 1),
      m AS (SELECT l_partkey % 64 AS unit, CAST(l_partkey % 320 AS VARCHAR) AS image_id, count(*) AS mask_count FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 10)
      SELECT unit, image_id, '{TAIL}' AS reason_code, '{TOO_LARGE}' AS trigger_reason_code, mask_count, error AS diagnostic FROM m JOIN q USING (unit) WHERE error LIKE 'exceeds%' AND image_id NOT IN (SELECT image_id FROM audits)""",
    "campaign_repair": f"WITH {_E}, f AS (SELECT unit, min(p) AS first FROM e WHERE event_type = 'error' AND value > 95 GROUP BY 1) SELECT DISTINCT unit, stage FROM e JOIN f USING (unit) WHERE event_type = 'purchase' AND p >= first",
}
