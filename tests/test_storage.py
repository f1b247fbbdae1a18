"""Archives, configuration, registries, claims, the publisher's store, exports and pictures on real folders."""

import json
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from maskwright.functions import masks, render, wide
from maskwright.operators import campaign, captions, publisher
from maskwright.plans import release, reports
from maskwright.sources import archives, config, sinks


# ---- archives
def test_archives(spark, tmp_path):
    path = str(tmp_path / "u" / "a.tar")
    files = spark.createDataFrame([(path, "b.jpg", b"two"), (path, "a.json", b'{"k": 1}'), (path, "c/d.jpg", b"three")], "archive string, member string, bytes binary")
    made = archives.packed_archives(files).first()
    assert made["member_count"] == 3 and len(made["sha256"]) == 64 and archives.packed_archives(files).first()["sha256"] == made["sha256"]
    index = archives.member_index(spark, [path])
    assert sorted((r["member"], r["size"]) for r in index.collect()) == [("a.json", 8), ("b.jpg", 3), ("c/d.jpg", 5)]
    wanted = spark.createDataFrame([(path, "c/d.jpg", 0), (path, "b.jpg", 1)], "archive string, member string, place int")
    got = archives.read_members(index, wanted)
    assert [(r["member"], bytes(r["bytes"])) for r in got.orderBy("place").collect()] == [("c/d.jpg", b"three"), ("b.jpg", b"two")]
    for name in ("gone.jpg", "../b.jpg", "/b.jpg", ""):
        with pytest.raises(FileNotFoundError):
            archives.read_members(index, spark.createDataFrame([(path, name, 0)], "archive string, member string, place int"))
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "b.jpg").write_bytes(b"old")
    assert [r["path"] for r in archives.hydrated(got, str(tmp_path / "out")).collect()] == [str(tmp_path / "out" / "c" / "d.jpg")]
    assert (tmp_path / "out" / "b.jpg").read_bytes() == b"old" and (tmp_path / "out" / "c" / "d.jpg").read_bytes() == b"three"
    both = archives.read_members(index, index.select("archive", "member", F.lit(0).alias("place")))
    assert [r["json"] for r in archives.json_members(both).collect()] == ['{"k": 1}']


def test_source_units(spark, tmp_path):
    rows = spark.createDataFrame([(f"i {k}", k, [".JPEG", ".png", ""][k % 3], bytes([k])) for k in range(7)], "image_id string, _ord int, suffix string, bytes binary")
    manifest, made = archives.source_units(rows, str(tmp_path), 3, 10, 4)
    got = sorted((r["source_manifest_index"], r["campaign_unit"], r["source_member"]) for r in manifest.collect())
    assert got[0] == (10, 4, "source_images/i_0.jpg") and got[1][2] == "source_images/i_1.png" and got[-1][:2] == (16, 6)
    assert sorted(r["member_count"] for r in made.collect()) == [1, 3, 3]
    assert archives.member_index(spark, [str(tmp_path / "units" / "000004" / "artifacts" / "source.tar")]).count() == 3


# ---- configuration and JSON
def test_config(spark, tmp_path):
    (tmp_path / "base.json").write_text('{"a": {"x": 1, "y": 2}, "l": [1], "model": {"backend": "HF", "n": 1}}')
    (tmp_path / "top.yaml").write_text("extends: base.json\na: {y: 3}\nl: [2]\ncaption: {model: {n: 2}}\n")
    found = config.load_config(spark, str(tmp_path / "top.yaml"))
    assert found["a"] == {"x": 1, "y": 3} and found["l"] == [2] and config.stage_settings(found, "caption") == {"backend": "hf", "n": 2}
    (tmp_path / "loop.json").write_text('{"extends": "loop.json"}')
    with pytest.raises(ValueError):
        config.load_config(spark, str(tmp_path / "loop.json"))
    sinks.write_json(spark, {"b": "é", "a": 1}, str(tmp_path / "x" / "v.json"))
    sinks.write_json(spark, {"b": 2}, str(tmp_path / "x" / "v.json"))
    assert sinks.read_json(spark, str(tmp_path / "x" / "v.json")) == {"b": 2} and sinks.read_json(spark, str(tmp_path / "no.json"), 5) == 5


# ---- registry
def test_extensions(spark, tmp_path):
    root = str(tmp_path)
    campaign.initialize(spark, root, 2)
    assert campaign.initialize(spark, root, 2)["unit_size"] == 2
    rows = lambda a, b: spark.range(a, b).selectExpr("id AS source_manifest_index", "id div 2 AS campaign_unit", "cast(id AS string) AS image_id")
    registry, extension = campaign.start_extension(spark, root, 3, "local")
    registry, extension = campaign.start_extension(spark, root, 3, "local")  # the first was interrupted
    assert [e["status"] for e in registry["extensions"]] == ["interrupted_superseded", "in_progress"] and extension["start_source_index"] == 0
    registry = campaign.commit_extension(spark, root, registry, extension, rows(0, 3))
    assert (registry["source_count"], registry["unit_count"]) == (3, 2) and campaign.manifest(spark, root).count() == 3
    registry, extension = campaign.start_extension(spark, root, 2, "local")
    assert extension["start_source_index"] == 3 and extension["start_unit_index"] == 2
    with pytest.raises(RuntimeError):  # a gap
        campaign.commit_extension(spark, root, dict(registry), extension, rows(4, 6))
    assert campaign.load_registry(spark, root)["source_count"] == 3
    with pytest.raises(ValueError):
        campaign.initialize(spark, root, 5)


def test_archive_cursor(spark):
    members = spark.createDataFrame([(a, f"{a}{i}", i) for a in "xy" for i in range(4)], "archive string, key string, place long")
    none, gone = spark.createDataFrame([], "key string"), spark.createDataFrame([("x1",)], "identifier string")
    rows, cursor = campaign.extend_cursor(members, {}, ["y", "x"], 5, none, gone)
    assert [r["key"] for r in rows.orderBy("_k").collect()] == ["y0", "y1", "y2", "y3", "x0"] and (cursor["tar_index"], cursor["key_index"]) == (1, 1)
    rows, cursor = campaign.extend_cursor(members, {"selection": cursor}, ["y", "x"], 9, none, gone)
    assert [r["key"] for r in rows.orderBy("_k").collect()] == ["x2", "x3"] and cursor["tar_index"] == 2


# ---- claims
def test_claims_have_one_winner(tmp_path):
    won, claims = [], campaign.Claims(tmp_path)
    threads = [threading.Thread(target=lambda k=k: won.append(claims.take("s", 1, f"9:{k}"))) for k in range(1)] + [threading.Thread(target=lambda k=k: won.append(claims.take("s", 1, f"{k}:0"))) for k in range(20, 36)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sum(c is not None for c in won) == 1


def test_claim_rules(tmp_path):
    now, state = [1000.0], ["active"]
    claims = campaign.Claims(tmp_path, 100, 10, lambda: now[0], lambda job: state[0])
    first = claims.take("s", 1, "77:0")
    assert claims.take("s", 1, "77:0") is None and claims.take("s", 1, "88:0") is None and claims.take("s", 2, "x", success=True) is None
    again = claims.take("s", 1, "77:1")  # the job was queued again
    assert again.generation == first.generation + 1 and not claims.renew(first) and claims.renew(again)
    now[0] += 11
    assert claims.take("s", 1, "88:0") is None
    state[0] = "inactive"
    other = claims.take("s", 1, "88:0")
    with pytest.raises(campaign.Lost):
        claims.commit(again, tmp_path / "m.json", {})
    claims.commit(other, tmp_path / "m.json", {"ok": 1})
    with pytest.raises(FileExistsError):
        claims.commit(other, tmp_path / "m.json", {"ok": 2})
    assert json.loads((tmp_path / "m.json").read_text()) == {"ok": 1} and not claims.release(again) and claims.release(other) and claims.take("s", 1, "99:0").generation == 0
    local = claims.take("s", 3, "local:1")
    assert claims.take("s", 3, "local:2") is None
    now[0] += 101
    assert claims.take("s", 3, "local:2").generation == local.generation + 1
    with pytest.raises(campaign.Lost), claims.heartbeat(local, 0.05) as lost:
        lost.wait(2)


def test_worker_scan(tmp_path):
    claims = campaign.Claims(tmp_path)

    def run(unit):
        if unit == 2:
            raise ValueError("bad unit")
        return {"n": unit}

    units = [1, 2, 3]
    assert campaign.work(claims, "s", units, "w:0", run, tmp_path) == {"done": [1, 3], "failed": [2], "skipped": []}
    for _ in range(2):
        assert campaign.work(claims, "s", units, "w:0", run, tmp_path)["failed"] == [2]
    assert campaign.work(claims, "s", units, "w:0", run, tmp_path) == {"done": [], "failed": [], "skipped": [1, 2, 3]}
    assert json.loads((tmp_path / "units" / "000002" / "stages" / "s" / "_QUARANTINED.json").read_text())["attempt_count"] == 3
    assert campaign.work(claims, "s", [9], "w:0", run, tmp_path, stop_at=0) == {"done": [], "failed": [], "skipped": []}


# ---- the publisher's store
def test_publish_runs(spark, tmp_path):
    store = str(tmp_path)
    pairs = spark.range(250).selectExpr("cast(id AS string) AS image_id", "id div 50 AS unit", "id AS source_manifest_index")
    pairs = pairs.union(spark.createDataFrame([("3", 4, 999)], "image_id string, unit long, source_manifest_index long"))  # published before
    audits = pairs.selectExpr("image_id", "unit", "source_manifest_index AS _ord", "'a' AS v")
    done = lambda k: spark.range(5).selectExpr("id AS unit", f"id < {k} AS done")
    assert publisher.publish_run(pairs, audits, done(3), store, 0) == {"run": 0, "base": 0, "pairs": 150, "units": 3, "milestones": [0]}
    (tmp_path / "pairs" / "run=1").mkdir(parents=True)  # what a crash leaves behind
    assert publisher.publish_run(pairs, audits, done(5), store, 1) == {"run": 1, "base": 150, "pairs": 100, "units": 2, "milestones": [1]}
    assert publisher.publish_run(pairs, audits, done(5), store, 1)["pairs"] == 100  # the run comes again
    got = publisher.published_pairs(spark, store)
    assert sorted(r["pair_index"] for r in got.collect()) == list(range(250)) and got.filter("image_id = '3'").first()["unit"] == 0
    assert publisher.published_audits(spark, store).count() == 250
    assert publisher.milestone_records(got, 1).count() == 100
    with pytest.raises(ValueError):
        publisher.milestone_records(got, 2)
    assert publisher.repaired_log(got, None).count() == 250 and publisher.repaired_log(got, got.filter("pair_index > 9")).count() == 10


# ---- records
def _structured(spark, spans, ids=("m1",), code="m1"):
    rle = json.dumps(masks.encode_rle(np.eye(4, 3, dtype=bool)), sort_keys=True)
    schema = "image_id string, source_manifest_index long, source_dataset string, source_split string, source_pair_key string, source_member string, bcc_parseable boolean, final_linked_mask_count long, caption string, groups array<struct<mask_id:string,instance_ids:array<string>,char_spans:array<array<int>>>>, codes array<struct<mask_id:string,rle:string>>"
    return spark.createDataFrame([("i", 0, "long/name", "", "", "x/f.png", True, 1, "a cup", [("m1", list(ids), spans)], [(code, rle)])], schema)


def test_caption_record(spark):
    r = release.training(_structured(spark, [[0, 5], [2, 5]]), {"long/name": "short"}).first()
    assert (r["dataset"], r["split"], r["image_key"], r["height"], r["width"]) == ("short", "train", "f.png", 4, 3)
    assert json.loads(r["groups_json"]) == [{"char_spans": [[0, 5], [2, 5]], "text": ["a cup", "cup"], "instance_ids": ["m1"]}]
    assert json.loads(r["masks_json"]) == {"m1": {"size": [4, 3], "counts": masks.coco_counts(np.eye(4, 3, dtype=bool))}}
    for bad in (_structured(spark, [[0, 6]]), _structured(spark, [[3, 3]]), _structured(spark, []), _structured(spark, [[0, 5]], code="m2")):
        with pytest.raises(Exception, match="span outside|no linked groups|without code"):
            release.training(bad).collect()


def test_codec_orders():
    m = np.random.default_rng(3).random((5, 7)) > 0.5
    import base64
    import zlib

    big = {"size": [5, 7], "pixel_count": 35, "order": "C", "bitorder": "big", "encoding": "zlib-packbits-base64-v1", "data": base64.b64encode(zlib.compress(np.packbits(m.reshape(-1)).tobytes())).decode()}
    assert (masks.decode_rle(big) == m).all() and masks.encode_rle(m)["encoding"] == "zlib-packbits-base64-v1"
    with pytest.raises(ValueError):
        masks.decode_rle(big | {"encoding": "other"})


def test_wide_masks(spark):
    rng = np.random.default_rng(5)
    made = [rng.random((23, 17)) > 0.4 for _ in range(3)] + [np.zeros((23, 17), bool)]
    assert all((wide.mask_of(wide.words_of(m), 23, 17) == m).all() for m in made)
    df = spark.createDataFrame([(i, "a", 1.0 - i / 10, wide.words_of(m), wide.words_of(made[0])) for i, m in enumerate(made)], "mask_id long, image_id string, score double, words array<bigint>, first array<bigint>")
    iou, small, held = wide.overlaps(F.col("words"), F.col("first"))
    for r in df.select("mask_id", wide.area(F.col("words")).alias("n"), wide.bbox("words", F.lit(23), F.lit(17)).alias("b"), iou.alias("iou"), held.alias("held")).collect():
        m = made[r["mask_id"]]
        assert r["n"] == m.sum() and abs(r["iou"] - (m & made[0]).sum() / max((m | made[0]).sum(), 1)) < 1e-12
        assert r["mask_id"] == 3 or (r["b"]["w"], r["b"]["h"]) == (np.ptp(np.flatnonzero(m.any(0))) + 1, np.ptp(np.flatnonzero(m.any(1))) + 1)
    two = df.union(df.withColumn("mask_id", F.col("mask_id") + 10).withColumn("score", F.col("score") - 0.5))
    assert {r["mask_id"]: r["suppressed_by"] for r in wide.deduped(two, 0.9).collect() if not r["kept"]} == {10: 0, 11: 1, 12: 2}


def test_pictures():
    image = np.random.default_rng(1).integers(0, 255, (40, 60, 3), np.uint8)
    assert (render.read_png(render.png(image)) == image).all() and (render.read_png(render.png(image[:, :, 0])) == image[:, :, 0]).all()
    mask = np.zeros((40, 60), bool)
    mask[10:20, 10:30] = True
    assert (render.overlay(image, mask)[~mask] == image[~mask]).all()
    crop, facts = render.inverse_crop(image, mask, 4)
    assert crop.shape == (18, 28, 3) and (crop[0, 0] == facts["rgb"]).all() and (crop[4:14, 4:24] == image[10:20, 10:30]).all()
    out = render.correspondence_overlay(image, [mask, mask[::2, ::2]], [(10, 10, 20, 10), (55, 35, 5, 5)])
    assert out.shape == image.shape and (out[10, 10] == masks.color_for_index(0)).all()
    assert (render.all_masks(image, [mask])[~mask] == 0).all()


def test_reports(spark):
    assert reports.caption_html("a <b> c", [(1, 0, 3), (2, 2, 7)]) == '<span class="link" data-ids="1">a </span><span class="link" data-ids="1,2">&lt;</span><span class="link" data-ids="2">b&gt; c</span>'
    text = reports.page("T", {"t": spark.range(3)}, 2)
    assert "first 2 rows" in text and text.count("<tr>") == 3
    rows = spark.createDataFrame([("i", "x.png", "a cup", [(1, 2, 5)])], "image_id string, image string, caption string, links array<struct<id:int,start:int,end:int>>")
    assert '<span class="link" data-ids="1">cup</span>' in reports.gallery("G", rows)
    assert len(reports.run_metadata({"a": 1})["config_sha256"]) == 64
    with pytest.raises(RuntimeError):
        reports.require_canary(reports.canary(spark.createDataFrame([("i", "dog")], "image_id string, prompt string"), "mock-caption", ["no such key"]))


def test_merged_shards(spark, tmp_path):
    (tmp_path / "captions.shard0.jsonl").write_text('{"_row_index": 2, "image_id": "a", "mask_id": "m"}\n{"image_id": "z", "mask_id": "m"}\n')
    (tmp_path / "captions.shard1.jsonl").write_text('{"_row_index": 1, "image_id": "b", "mask_id": "m"}\n')
    got = captions.merged_shards(spark, str(tmp_path), "caption", 2)
    assert list(got) == ["captions"] and [r["image_id"] for r in got["captions"].collect()] == ["b", "a", "z"]
    with pytest.raises(ValueError):
        captions.merged_shards(spark, str(tmp_path), "other", 2)


def test_barrier_and_sample(spark):
    from maskwright.operators.records import require_merged
    from maskwright.operators.selection import sampled

    states = lambda *s: spark.createDataFrame(list(enumerate(s)), "unit int, state string")
    require_merged(states("done", "done"))
    for bad, text in ((states("done", "quarantined"), r"\[1\]"), (states("missing", "done"), "1 units")):
        with pytest.raises(RuntimeError, match=text):
            require_merged(bad)
    with pytest.raises(ValueError):
        sampled(spark.range(5).withColumnRenamed("id", "k"), 6, 1, "k")


def test_segments_split_and_isolated(spark, monkeypatch):
    from maskwright.operators import providers

    def small(requests):
        if len(requests) > 2:
            raise providers.TooLarge
        if any("bad" in r for r in requests):
            raise ValueError("no image")
        return ['[{"bbox": [0, 0, 1, 1], "area": 1, "score": 0.9}]' for _ in requests]

    assert len(providers.isolating(providers.halving(small))(["a\tx", "b\tbad", "c\ty", "d\tz"])) == 4
    got = providers.segmented(spark.createDataFrame([("i", ["people", "cups"])], "image_id string, prompts array<string>"), "mock-segments")
    assert [r["raw_index"] for r in got.orderBy("raw_index").collect()] == list(range(got.count()))


def test_checkpointed_run(spark, tmp_path):
    from maskwright.plans.runner import purged, run_checkpointed

    calls = []

    def stage(name, step):
        def run(_, rows):
            calls.append(name)
            return rows.withColumn("n", F.col("n") + step)

        return name, run

    rows = spark.createDataFrame([(1,), (2,)], "n int")
    go = lambda stages, sign: sorted(r["n"] for r in run_checkpointed(spark, str(tmp_path), stages, rows, sign).collect())
    assert go([stage("a", 1), stage("b", 10)], "s") == [12, 13] and calls == ["a", "b"]
    assert go([stage("a", 1), stage("b", 10)], "s") == [12, 13] and calls == ["a", "b"]
    assert go([stage("a", 1), stage("c", 5)], "s") == [7, 8] and calls == ["a", "b", "c"]
    assert go([stage("a", 2)], "changed") == [3, 4] and calls[-1] == "a"
    some = spark.createDataFrame([("x", 1), ("y", 2)], "image_id string, v int")
    assert [r["v"] for r in purged({"s": some}, some.filter("v = 1"))["s"].collect()] == [2]


def test_command_line(spark, tmp_path, capsys):
    from maskwright.__main__ import main

    assert main(["list"]) == 0 and "ledger" in capsys.readouterr().out.split()
    assert main(["run", "nothing", "x"]) == 2
    assert main(["run", "ledger_summary", "/root/testdata/sf0.001", "--out", str(tmp_path / "o")]) == 0 and spark.read.parquet(str(tmp_path / "o")).count() > 0
    assert main(["signature", str(tmp_path / "o")]) == 0 and len(capsys.readouterr().out.strip()) == 64
    (tmp_path / "c.json").write_text('{"a": 1}')
    assert main(["config", str(tmp_path / "c.json")]) == 0 and json.loads(capsys.readouterr().out) == {"a": 1}
