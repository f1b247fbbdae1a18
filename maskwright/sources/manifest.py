"""Sources: JSON lines, CSV manifests, exclusion lists, tar archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions.text import identifier_variants
from ..operators.incremental import running

# Headers of an exclusion list.
EXCLUSION_HEADERS = ("identifier", "id", "image_id", "file", "file_name", "filename", "pair_key", "source_key")


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Strict JSON lines: a bad line fails the job, blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def positioned(df: DataFrame, into: str = "_ord") -> DataFrame:
    """Adds each row's place over all files: 0, 1, 2, ... by file name, then the order in the file."""
    at = df.withColumns({"_f": F.col("_metadata.file_path"), "_b": F.col("_metadata.file_block_start"), "_i": F.monotonically_increasing_id(), "_one": F.lit(1)})
    return running(at, ["_f", "_b", "_i"], 16, **{into: "_one"}).withColumn(into, F.col(into) - 1).drop("_f", "_b", "_i", "_one")


def read_source_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A CSV or JSON-lines manifest: empty cells as missing; image_id from id, the file name's stem or the place; pair_key from image_id."""
    if path.lower().endswith(".csv"):
        raw = spark.read.option("header", True).option("multiLine", True).option("encoding", "UTF-8").csv(path)
        rows = positioned(raw)
        rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
    else:
        rows = positioned(spark.read.option("mode", "FAILFAST").json(path))
        if "source_context" in rows.columns:
            inner = [f.name for f in rows.schema["source_context"].dataType.fields]
            rows = rows.select(*[c for c in rows.columns if c not in inner and c != "source_context"], "source_context.*")
    have = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) if c in rows.columns else F.lit(None).cast("string")
    stem = F.regexp_replace(F.regexp_extract(have("file_name"), r"([^/\\]*)$", 1), r"(?<=[^.])\.[^.]+$", "")
    place = F.format_string("image_%09d", F.col("_ord"))
    image_id = F.coalesce(have("image_id"), have("id"), F.nullif(stem, F.lit("")), place)
    meta = have("metadata_json")
    metadata = F.when(meta.isNotNull() & (F.try_parse_json(meta).isNull() | ~meta.rlike(r"^\s*\{")), F.raise_error(F.concat(F.lit("metadata_json is no object: "), meta))).otherwise(meta)
    return rows.select(
        "_ord", image_id.alias("image_id"), F.coalesce(have("image_path"), have("file_name")).alias("image_path"), F.coalesce(have("source_dataset"), F.lit("local")).alias("source_dataset"),
        F.coalesce(have("split"), F.lit("train")).alias("split"), F.coalesce(have("pair_key"), image_id).alias("pair_key"), F.coalesce(have("paired_text"), F.lit("")).alias("paired_text"), metadata.alias("metadata_json"),
    )


def load_exclusions(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """All variants of a one-column identifier list (header or not) and its provenance: base name, checksum, count."""
    head = spark.read.text(path).limit(1).collect()
    cells = [c.strip().lower() for c in head[0][0].lstrip("﻿").split(",")] if head else []
    at = next((i for i, c in enumerate(cells) if c in EXCLUSION_HEADERS), None)
    raw = spark.read.option("header", at is not None).csv(path) if head else spark.createDataFrame([], "c string")
    values = raw.select(F.trim(F.col(f"`{raw.columns[at or 0]}`")).alias("v")).filter("v <> ''")
    content = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("s")).first()
    facts = {"file_name": path.rsplit("/", 1)[-1], "sha256": content["s"] if content else None, "identifier_count": values.count()}
    return values.select(F.explode(identifier_variants(F.col("v"))).alias("identifier")).distinct(), facts


def without_excluded(rows: DataFrame, exclusions: DataFrame, columns: list[str]) -> DataFrame:
    """Rows none of whose columns' variants is on the list."""
    every = F.flatten(F.array(*[identifier_variants(F.col(c).cast("string")) for c in columns]))
    values = rows.select(*columns).distinct()
    hit = values.select(*columns, F.explode(every).alias("identifier")).join(exclusions, "identifier", "left_semi").select(*[F.col(c).alias(f"_x_{c}") for c in columns]).distinct()
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_x_{c}"))
    return rows.join(hit, same, "left_anti")


def sliced(rows: DataFrame, start: int, limit: int, order: str = "_ord") -> DataFrame:
    """Rows from a start place in order."""
    return rows.orderBy(order).offset(start).limit(limit)


def shard_of(rows: DataFrame, index: int, count: int, order: str = "_row_index") -> DataFrame:
    return rows.filter(F.pmod(F.col(order), F.lit(count)) == index)


class TarSource(DataSource):
    """Members of tar archives: archive, member, offset, size, bytes (null with option bytes=false).  One partition an archive; it is read once, in place."""

    @classmethod
    def name(cls) -> str:
        return "tar"

    def schema(self) -> str:
        return "archive string, member string, offset long, size long, bytes binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return TarReader(self.options)


class TarReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.paths = [p for p in options.get("paths", options.get("path", "")).split(",") if p]
        self.bytes = options.get("bytes", "true").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition):
        import tarfile

        with tarfile.open(partition.value) as tar:
            for m in tar:
                if m.isfile() and not m.name.startswith("/") and ".." not in m.name.split("/"):
                    yield partition.value, m.name, m.offset_data, m.size, tar.extractfile(m).read() if self.bytes else None


def read_tars(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Archives on storage that every executor mounts."""
    spark.dataSource.register(TarSource)
    return spark.read.format("tar").option("paths", ",".join(paths)).load()


def paired_members(members: DataFrame) -> DataFrame:
    """Images joined with their JSON on (archive, stem)."""
    stem, suffix = F.regexp_replace("member", r"\.[^./]*$", ""), F.lower(F.regexp_extract("member", r"(\.[^./]*)$", 1))
    m = members.withColumns({"stem": stem, "suffix": suffix})
    images = m.filter(F.col("suffix").isin(".jpg", ".jpeg", ".png", ".webp")).select("archive", "stem", F.col("member").alias("image_member"), F.col("bytes").alias("image"))
    texts = m.filter("suffix = '.json'").select("archive", "stem", F.decode("bytes", "UTF-8").alias("json"))
    return images.join(texts, ["archive", "stem"])


def candidate_archives(files: DataFrame, split: str) -> DataFrame:
    """Archives of a split by name; all of them where none matches."""
    tars = files.filter(F.col("path").rlike(r"(?i)\.(?:tar|tar\.gz|tgz)$"))
    of_split = tars.filter(F.contains(F.regexp_extract("path", r"([^/]*)$", 1), F.lit(split)) | F.contains("path", F.lit(f"/{split}")))
    any_of = of_split.agg(F.count(F.lit(1)).alias("n"))
    return tars.crossJoin(F.broadcast(any_of)).filter((F.col("n") == 0) | F.contains(F.regexp_extract("path", r"([^/]*)$", 1), F.lit(split)) | F.contains("path", F.lit(f"/{split}"))).drop("n")  # any_of: one row


def stable_order(rows: DataFrame, seed: int, columns: list[str]) -> DataFrame:
    """Adds a hash order: the contract that stands in for a seeded shuffle."""
    return rows.withColumn("_shuffle", F.sha2(F.concat_ws("\0", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]), 256))
