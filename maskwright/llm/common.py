"""Helpers that the training-data operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import drop_written, shared_dir, written

__all__ = ["body", "drop_written", "parallelism", "shared_dir", "table", "text_batches", "unused", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)


def unused(docs: DataFrame, name: str) -> str:
    """`name`, with underscores before it until no column has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def body(col: str = "text"):
    """The text, empty where it is null."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_batches(batches, text: str, most: int = 4_000_000):
    """Slices of Arrow record batches that hold about `most` bytes of text, so that memory doesn't follow batch size."""
    import pyarrow.compute as pc

    for batch in batches:
        n, at = batch.num_rows, 0
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_pylist()
        held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += size
        yield batch.slice(at)
