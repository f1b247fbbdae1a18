"""Keyed idioms of append logs: last row wins, counts, resume, differences (all map-side combined)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keyless(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit("")) == ""


def last_wins(df: DataFrame, key: str, order: str = "_ord") -> DataFrame:
    """The last row of each key by position; rows without key are dropped."""
    rest = [c for c in df.columns if c != key]
    best = df.filter(~keyless(key)).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def compact(df: DataFrame, key: str, order: str = "_ord") -> DataFrame:
    """Last row of each key at the place of its first, rows without key as they are; sort by `first_ord`."""
    rest = [c for c in df.columns if c != key]
    best = df.filter(~keyless(key)).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_row"), F.min(order).alias("first_ord"))
    kept = best.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest], "first_ord")
    return kept.unionByName(df.filter(keyless(key)).withColumn("first_ord", F.col(order)))


def counts(df: DataFrame, key: str, into: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(into))


def grouped(df: DataFrame, key: str, value: str, order: str = "_ord") -> DataFrame:
    """Each key's values in order, keys numbered by first appearance through `first_ord`."""
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("v")))), lambda x: x["v"]).alias("values"), F.min(order).alias("first_ord"))


def duplicates(df: DataFrame, value: str) -> DataFrame:
    return counts(df.filter(F.col(value).isNotNull()), value).filter("n > 1")


def remaining(df: DataFrame, done: list[DataFrame], key: str) -> DataFrame:
    """Rows whose key none of the outputs holds."""
    seen = done[0].select(key)
    for d in done[1:]:
        seen = seen.unionByName(d.select(key))
    return df.join(seen.filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def set_mismatch(expected: DataFrame, actual: DataFrame, key: str, examples: int = 10) -> DataFrame:
    """One row: how many keys are missing and extra, with the first few in order."""
    both = expected.select(key).distinct().withColumn("_e", F.lit(1)).join(actual.select(key).distinct().withColumn("_a", F.lit(1)), key, "full_outer")
    off = both.filter("_e IS NULL OR _a IS NULL").select(key, F.when(F.col("_a").isNull(), "missing").otherwise("extra").alias("kind"))
    first = off.withColumn("_k", F.row_number().over(Window.partitionBy("kind").orderBy(key))).filter(F.col("_k") <= examples)
    shown = first.groupBy("kind").agg(F.array_sort(F.collect_list(key)).alias("examples"))
    return counts(off, "kind").join(shown, "kind")


def first_seen_distinct(df: DataFrame, key: str, order: str = "_ord") -> DataFrame:
    return df.groupBy(key).agg(F.min(order).alias("first_ord"))
