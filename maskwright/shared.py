"""The folder that driver and executors share, and tables written to it to cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir.  Where the session has none, a local folder in local mode (tests), an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="maskwright-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def remove(spark: SparkSession, path: str) -> None:
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    except Exception:  # the session has ended; the folder goes with its cluster  # noqa: BLE001
        pass


def written(df: DataFrame, what: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: lineage ends here and survives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(texts, most: int = 1_000_000):
    """(start, length) of slices of an Arrow text array that hold about `most` bytes, one text at least."""
    import pyarrow.compute as pc

    at = held = 0
    for i, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if i > at and held + size > most:
            yield at, i - at
            at, held = i, 0
        held += size
    if at < len(texts):
        yield at, len(texts) - at


def drop_written(df: DataFrame) -> None:
    """Deletes the files of a table of `written` that no later plan reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, folder)
