"""Append logs as streams: last row wins, running counts, prefix publication; each equals its batch form on the same files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import adapters as A
from ..shared import drop_written, remove, shared_dir, written


def read_log(spark: SparkSession, path: str, schema, files_per_trigger: int = 8, fmt: str = "parquet") -> DataFrame:
    """A folder of immutable files as a stream; the checkpoint remembers what was read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory():
        return stream.load(path)
    return stream.option("pathGlobFilter", where.getName()).load(str(where.getParent()))  # one file


#: Parts of a keyed state; a batch rewrites only those that it touches.
BUCKETS = 64


def upsert_latest(batch: DataFrame, batch_id: int, state: str, key: str, order: str, buckets: int = BUCKETS) -> None:
    """Folds a micro-batch into a keyed table in `state`: one folder a version of a bucket, and for each batch a list of the
    versions that count, written last.

    A crash before the list leaves folders that nothing reads; the batch then comes again and writes others.  A repeated batch
    gives the same table.  Only buckets with rows in the batch are rewritten; versions that the last two lists don't name are deleted.
    """
    spark = batch.sparkSession
    from ..operators.keyed import last_wins

    known = _lists(spark, state)
    now = known[-1][1] if known else {}
    rows = batch.withColumn("_b", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))
    rows = held = written(rows, "batch")
    touched = sorted(r["_b"] for r in rows.select("_b").distinct().collect())  # buckets at most
    if touched:
        old = [f"{state}/{now[b]}" for b in touched if b in now]
        if old:
            rows = rows.unionByName(spark.read.parquet(*old).withColumn("_b", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")), allowMissingColumns=True)
        name = f"v={batch_id}-{uuid.uuid4().hex[:12]}"
        last_wins(rows, key, order).repartition("_b").write.partitionBy("_b").parquet(f"{state}/{name}")
        there = {r["_b"] for r in spark.read.parquet(f"{state}/{name}").select("_b").distinct().collect()}
        now = {b: v for b, v in now.items() if b not in touched} | {b: f"{name}/_b={b}" for b in there}
    spark.createDataFrame([(b, v) for b, v in now.items()], "bucket int, folder string").coalesce(1).write.mode("overwrite").json(f"{state}/lists/{batch_id:012d}")
    drop_written(held)
    alive = {v.split("/")[0] for _, m in _lists(spark, state)[-2:] for v in m.values()}
    for f in _names(spark, state):
        if f.startswith("v=") and f not in alive:
            remove(spark, f"{state}/{f}")


def _names(spark: SparkSession, path: str) -> list[str]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def _lists(spark: SparkSession, state: str) -> list[tuple[int, dict[int, str]]]:
    """The complete lists of a state by batch: bucket to folder."""
    out = []
    for name in _names(spark, f"{state}/lists"):
        if "_SUCCESS" in _names(spark, f"{state}/lists/{name}"):
            rows = spark.read.schema("bucket int, folder string").json(f"{state}/lists/{name}").collect()
            out.append((int(name), {r["bucket"]: r["folder"] for r in rows}))
    return out


def state_table(spark: SparkSession, state: str) -> DataFrame | None:
    """The keyed table as of the last complete batch; None before the first row."""
    known = _lists(spark, state)
    folders = [f"{state}/{v}" for v in known[-1][1].values()] if known else []
    return spark.read.parquet(*folders) if folders else None


def latest_by_key(spark: SparkSession, source: str, schema, key: str, order: str, folder: str, prepare=lambda df: df) -> DataFrame:
    """Drains a log folder with AvailableNow and returns the last row of each key."""
    stream = prepare(read_log(spark, source, schema))
    run = stream.writeStream.foreachBatch(lambda batch, i: upsert_latest(batch, i, f"{folder}/state", key, order)).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    found = state_table(spark, f"{folder}/state")
    return found if found is not None else spark.createDataFrame([], stream.schema)


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events of each type in tumbling windows, late ones within the watermark included."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def q_latest(spark, sf_dir):
    """The change log drained as a stream equals log_last_wins over the file."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    prep = lambda df: df.select(F.col("user_id").alias("key"), F.struct("ts", "event_id").alias("_ord"), "event_id", "event_type")
    return latest_by_key(spark, path, schema, "key", "_ord", _folder(spark), prep).select("key", "event_id", "event_type")


def q_windows(spark, sf_dir):
    """Windowed counts as a stream: the log is drained in event-time order of its files, closed windows are appended; the window that the
    watermark has not closed at the end is taken from the same aggregation in batch.
    """
    folder, path = _folder(spark), f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    shaped = lambda e: windowed_counts(e.withColumn("ts", F.col("ts").cast("timestamp"))).select(F.unix_seconds("window.start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))
    run = shaped(read_log(spark, path, schema)).writeStream.outputMode("append").format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    closed = spark.read.schema("start long, event_type string, n long, total double").parquet(f"{folder}/out")
    batch = shaped(A.table(spark, sf_dir, "events"))
    return closed.unionByName(batch.join(closed.select("start", "event_type"), ["start", "event_type"], "left_anti"))


QUERIES = {"stream_latest": q_latest, "stream_windows": q_windows}
ORACLES = {
    "stream_latest": "SELECT user_id AS key, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1",
    "stream_windows": "SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
}
