"""Sinks: atomic JSON lines, fixed-row shards with reuse, pair tables, checksums, reports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.export import shard_manifest, sharded
from ..shared import remove, written


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    """One JSON object a line, keys sorted; the job's committer makes the write atomic."""
    df.select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", False).option("compression", compression).json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.select(*sorted(df.columns)).write.mode("append").option("ignoreNullFields", False).json(path)


def write_json(spark: SparkSession, value, path: str) -> None:
    """A small JSON document, keys sorted; written beside and renamed, so a reader sees the old one or the new one."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    to, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    fs = to.getFileSystem(conf)
    out = fs.create(beside, True)
    try:
        out.write(bytearray((json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2) + "\n").encode()))
    finally:
        out.close()
    if fs.exists(to):
        fs.delete(to, False)
    if not fs.rename(beside, to):
        raise OSError(f"could not put {path} in place")


def read_json(spark: SparkSession, path: str, default=None):
    """A JSON document; `default` where there is none."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return default
    return json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))


def write_csv(df: DataFrame, path: str, fields: list[str]) -> None:
    """Fixed columns with a header; a ledger report of the driver's size is one file."""
    df.select(*fields).write.mode("overwrite").option("header", True).csv(path)


def write_parquet_shards(df: DataFrame, path: str, key: str, order: str, rows: int) -> DataFrame:
    """Shards of `rows` rows in stable order, one folder each; returns the manifest with a digest of each shard's content.

    Shards whose digest on disk is that of the manifest are left as they are; others are written anew, and folders of shards
    that the table no longer has are deleted.
    """
    spark = df.sparkSession
    numbered = sharded(df, key, order, rows)
    manifest = shard_manifest(numbered).join(_digests(numbered, df.columns), "shard")
    old = _shards_on_disk(spark, path)
    if old is None:
        todo = numbered
    else:
        same = _digests(old, df.columns).join(manifest.select("shard", "digest"), ["shard", "digest"], "left_semi") if set(df.columns) <= set(old.columns) else None
        todo = numbered.join(same.select("shard"), "shard", "left_anti") if same is not None else numbered
        gone = old.select("shard").distinct().join(manifest, "shard", "left_anti").collect()  # a number a shard
        todo = written(todo, "shards")
        for r in gone:
            remove(spark, f"{path}/shard={r['shard']}")
    todo.repartitionByRange("shard").sortWithinPartitions("shard", "row_index").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("shard").parquet(path)
    return manifest


def _digests(rows: DataFrame, columns: list[str]) -> DataFrame:
    """A digest of each shard: its rows' digests, added up; a row's is over its place and values."""
    row = F.sha2(F.to_json(F.struct("row_index", *sorted(columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda k: F.sum(F.conv(F.substring(row, 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    return rows.groupBy("shard").agg(F.concat_ws("-", F.count(F.lit(1)).cast("string"), *[part(k) for k in range(4)]).alias("digest"))


def _shards_on_disk(spark: SparkSession, path: str) -> DataFrame | None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    there = spark.read.parquet(path)
    return there.withColumn("shard", F.col("shard").cast("long")) if {"shard", "row_index"} <= set(there.columns) else None


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """sha256 of each file below a path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.sha2("content", 256).alias("sha256"), "path", "length")


def source_signature(spark: SparkSession, path: str) -> str:
    """One digest over the files' names, sizes and times: what invalidates a checkpoint."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    return files.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws("|", "path", "length", F.unix_micros("modificationTime")))), "\n"), 256).alias("s")).first()["s"]


def histogram_svg(bins: DataFrame, title: str) -> str:
    """A bar chart of a small histogram (value, frequency)."""
    rows = sorted((r["value"], r["frequency"]) for r in bins.collect())
    top = max((n for _, n in rows), default=1)
    bars = "".join(f'<rect x="{30 + 14 * i}" y="{120 - 100 * n / top:.1f}" width="12" height="{100 * n / top:.1f}"><title>{v}: {n}</title></rect>' for i, (v, n) in enumerate(rows))
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{60 + 14 * len(rows)}" height="140"><text x="8" y="14">{title}</text>{bars}</svg>'
