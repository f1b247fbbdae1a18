"""Tar archives by member: an index of headers, keyed reads by offset, extraction, packing, source units.

Archives lie on storage that every executor mounts.  Whole archives are only read where all members are wanted.
"""

from __future__ import annotations

import hashlib
import io
import os
import tarfile
import uuid
from pathlib import Path, PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import safe_id
from ..operators.incremental import running
from .manifest import TarSource


def member_index(spark: SparkSession, paths: list[str]) -> DataFrame:
    """archive, member, offset, size of every regular member; only headers are read."""
    spark.dataSource.register(TarSource)
    return spark.read.format("tar").option("paths", ",".join(paths)).option("bytes", "false").load().drop("bytes")


def read_members(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` (archive, member, place) with bytes: read in the order of offsets, to be shown in the order of `place`.

    Raises on an unsafe name and on a member that isn't there, before anything is read.
    """
    name = F.coalesce("member", F.lit(""))
    unsafe = (name == "") | name.startswith("/") | name.rlike(r"(^|/)\.\.(/|$)")
    asked = wanted.select("archive", "member", "place").join(index, ["archive", "member"], "left")
    bad = asked.filter(unsafe | F.col("offset").isNull()).limit(3).collect()
    if bad:
        raise FileNotFoundError(f"no such members: {[(r['archive'], r['member']) for r in bad]}")

    def run(frames):
        path, file = None, None
        for frame in frames:
            out = []
            for row in frame.itertuples():
                if row.archive != path:
                    if file:
                        file.close()
                    path, file = row.archive, open(row.archive, "rb")  # noqa: SIM115  closed with the next archive
                file.seek(row.offset)
                out.append(file.read(row.size))
            yield frame.assign(bytes=out)
        if file:
            file.close()

    dealt = asked.select("archive", "member", "place", "offset", "size").repartition("archive").sortWithinPartitions("archive", "offset")
    kind = dict(wanted.dtypes)["place"]
    return dealt.mapInPandas(run, f"archive string, member string, place {kind}, offset long, size long, bytes binary").select("archive", "member", "place", "bytes")


def json_members(members: DataFrame) -> DataFrame:
    """Members ending in .json with their text; one that is no JSON object is an error."""
    text = F.decode("bytes", "UTF-8")
    good = F.try_parse_json(text).isNotNull() & text.rlike(r"^\s*\{")
    return members.filter(F.lower("member").endswith(".json")).withColumn("json", F.when(good, text).otherwise(F.raise_error(F.concat(F.lit("no JSON object: "), "member")).cast("string")))


def hydrated(members: DataFrame, folder: str) -> DataFrame:
    """Writes members below a folder; one row for each file made.  Files that are there stay; links are refused."""

    def run(frames):
        for frame in frames:
            made = []
            for name, data in zip(frame["member"], frame["bytes"], strict=True):
                parts = PurePosixPath(name)
                if parts.is_absolute() or ".." in parts.parts or not parts.parts:
                    raise ValueError(f"unsafe member {name!r}")
                target = Path(folder, *parts.parts)
                if target.is_symlink():
                    raise ValueError(f"refusing the link {target}")
                if target.exists():
                    continue
                target.parent.mkdir(parents=True, exist_ok=True)
                beside = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
                beside.write_bytes(data)
                os.replace(beside, target)
                made.append(str(target))
            yield pd.DataFrame({"path": made}, dtype=object)

    return members.select("member", "bytes").mapInPandas(run, "path string")


def packed_archives(files: DataFrame) -> DataFrame:
    """Writes each archive from its files (archive, member, bytes), members by name, and puts it in place whole.

    Returns archive, sha256, member_count.  An archive is a unit's artifacts; one task writes it.
    """

    def run(frames):
        held: list = []
        for frame in frames:
            for row in frame.itertuples():
                if held and held[0].archive != row.archive:
                    yield _pack(held)
                    held = []
                held.append(row)
        if held:
            yield _pack(held)

    dealt = files.select("archive", "member", "bytes").repartition("archive").sortWithinPartitions("archive", "member")
    return dealt.mapInPandas(run, "archive string, sha256 string, member_count long")


def _pack(rows: list) -> pd.DataFrame:
    path = Path(rows[0].archive)
    path.parent.mkdir(parents=True, exist_ok=True)
    beside = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    try:
        with tarfile.open(beside, "w") as tar:
            for r in rows:
                info = tarfile.TarInfo(r.member)
                info.size, info.mtime, info.mode = len(r.bytes), 0, 0o644
                tar.addfile(info, io.BytesIO(r.bytes))
        digest = hashlib.sha256(beside.read_bytes()).hexdigest()
        os.replace(beside, path)
    finally:
        beside.unlink(missing_ok=True)
    return pd.DataFrame([(str(path), digest, len(rows))], columns=["archive", "sha256", "member_count"])


def source_units(rows: DataFrame, root: str, unit_size: int, start_index: int = 0, start_unit: int = 0, order: str = "_ord") -> tuple[DataFrame, DataFrame]:
    """(manifest rows, archives) of new source images (image_id, suffix, bytes) in order: units of `unit_size`, each with its archive."""
    placed = running(rows.withColumn("_one", F.lit(1)), [order, "image_id"], 16, _k="_one").withColumn("_k", F.col("_k") - 1)
    suffix = F.lower(F.coalesce(F.nullif("suffix", F.lit("")), F.lit(".jpg")))
    named = placed.withColumns({
        "source_manifest_index": F.col("_k") + start_index, "campaign_unit": F.expr(f"_k div {unit_size}") + start_unit,
        "source_member": F.concat(F.lit("source_images/"), safe_id(F.col("image_id")), F.when(suffix == ".jpeg", ".jpg").otherwise(suffix)),
    }).withColumn("source_archive", F.format_string(f"{root}/units/%06d/artifacts/source.tar", "campaign_unit"))
    archives = packed_archives(named.select(F.col("source_archive").alias("archive"), F.col("source_member").alias("member"), "bytes"))
    return named.drop("_one", "_k", "bytes", "suffix", order), archives
