"""Fixed examples of the operators that fold, parse or encode."""

import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from maskwright.functions import jsonx, masks
from maskwright.operators import canonical, incremental, keyed, spans
from maskwright.sources import manifest, sinks


def test_coco_counts_golden():
    m = np.zeros((23, 17), bool)
    m[1:8, 3:9] = True
    m[10:22, 0:2] = True
    assert masks.coco_counts(m) == ":<;0>KG000000000g5"


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 12), st.integers(0, 2**32 - 1))
def test_mask_codecs_round_trip(h, w, seed):
    m = np.random.default_rng(seed).random((h, w)) > 0.5
    assert (masks.unpack(masks.pack(m), h, w) == m).all()
    assert (masks.decode_rle(masks.encode_rle(m)) == m).all()
    assert (masks.coco_decode(masks.coco_counts(m), h, w) == m).all()


def test_components():
    m = np.array([[1, 1, 0], [0, 0, 0], [1, 0, 1]], bool)
    assert sorted(masks.component_sizes(m)) == [1, 1, 2]
    assert masks.component_sizes(np.zeros((2, 2), bool)) == []
    assert masks.significant_components(np.ones((3, 3), bool)) == 1


def _word(m):
    return int.from_bytes(masks.pack(m), "little", signed=True)


def test_composite_of_two_children(spark):
    a, b, c = np.zeros((8, 8), bool), np.zeros((8, 8), bool), np.zeros((8, 8), bool)
    a[:, :4], b[:, 4:], c[:, 1:5] = True, True, True
    rows = spark.createDataFrame([(1, 0, "x", _word(a)), (2, 0, "x", _word(b)), (3, 0, "x", _word(a | b)), (4, 0, "x", _word(c)), (5, 1, "x", _word(a)), (6, 0, None, _word(a))], "mask_id long, image_id long, subject string, bits long")
    assert [(r["container"], r["children"]) for r in canonical.composite_masks(rows).collect()] == [(3, "1,2")]


def test_inverse_background_is_far():
    px = np.full((500, 3), 10) + np.arange(500)[:, None] % 5
    r = masks.inverse_background(px)
    assert r["distance_q10"] > 150 and r["rgb"] == [255, 255, 255] and r["foreground_sample_count"] == 500
    assert masks.inverse_background(np.zeros((0, 3)))["rgb"] == [0, 0, 0] and masks.inverse_background(np.zeros((40_000, 3)))["foreground_sample_count"] == 32_768
    assert masks.color_for_index(0) == (255, 63, 63)


def test_contained_partial_names_the_largest(spark):
    from maskwright.operators.suppress import contained_partial

    small, mid, big, far = (np.zeros((8, 8), bool) for _ in range(4))
    small[2:4, 2:4], mid[1:5, 1:5], big[0:7, 0:7], far[7:8, 7:8] = True, True, True, True
    rows = [(i, _word(m), int(m.sum()), sc, *box) for i, (m, sc, box) in enumerate([(mid, 0.5, (1, 1, 4, 4)), (big, 0.5, (0, 0, 7, 7)), (small, 0.5, (2, 2, 2, 2)), (far, 0.9, (7, 7, 1, 1))])]
    df = spark.createDataFrame(rows, "mask_id int, bits long, area int, score double, x int, y int, w int, h int").withColumn("image_id", F.lit(1))
    assert {r["mask_id"]: r["container"] for r in contained_partial(df).collect()} == {0: 1, 2: 1}
    assert contained_partial(df.withColumn("score", F.when(F.col("mask_id") == 1, 0.1).otherwise(F.col("score")))).collect()[0]["container"] == 0


def test_owner_rules(spark):
    from maskwright.functions.geometry import owners

    box = lambda img, i, sub, x, w: (img, i, sub, x, 0, w, 10)
    rows = [box(1, 0, "A", 0, 10), box(1, 1, "B", 50, 10), box(2, 0, "A", 0, 10), box(2, 1, "B", 0, 10), box(2, 2, "C", 0, 7), box(3, 0, "A", 0, 10), box(3, 1, "B", 0, 10), box(3, 2, "B", 0, 9), box(4, 0, "A", 0, 10), box(4, 1, "B", 0, 7), box(4, 2, "B", 50, 9)]
    df = spark.createDataFrame(rows, "image_id int, raw_index int, subject string, x int, y int, w int, h int")
    assert sorted((r["image_id"], r["owner"]) for r in owners(df).collect()) == [(1, 1), (2, 1)]


def test_text_rules(spark):
    from maskwright.functions import text
    from maskwright.operators import records

    df = spark.createDataFrame([("a close-up of a cat seen against a wall background set on a red background, in a photo",), ("line one\nabc\ndefgh\n",), ("Women and a girlish man",), ("At most 4 image(s) may be provided",)], "t string")
    r = df.select(text.cleaned_caption(F.col("t")).alias("c"), text.not_gibberish(F.col("t")).alias("ok"), text.possessive(F.col("t")).alias("p"), text.input_limit_error(F.col("t")).alias("e")).collect()
    assert r[0]["c"]["caption"] == "A cat." and len(r[0]["c"]["corrections"]) == 3 and r[0]["c"]["corrections"][0] == "removed crop/view preamble: a close-up of"
    assert [x["ok"] for x in r] == [True, False, True, True] and r[2]["p"] == "his" and r[3]["e"] == "At most 4 image(s) may be provided" and r[0]["e"] is None
    one = spark.range(1)
    pick = lambda i, n: one.select(records.selector(F.lit(i), F.lit(n))).first()[0]
    assert [pick(1, 1), pick(1, 2), pick(2, 2), pick(3, 2), pick(11, 20), pick(12, 20), pick(13, 20), pick(21, 30), pick(111, 200)] == ["", "one", "the other", "the third", "the eleventh", "the twelfth", "the 13th", "the 21st", "the 111th"]


def test_places_at_size(spark, tmp_path):
    """A million rows in eight files: places are 0 .. n-1, each once."""
    from maskwright.plans.export import sharded

    spark.range(1_000_000).select(((F.col("id") * 7919) % 1_000_003).alias("k")).repartition(8).write.parquet(str(tmp_path / "k"))
    r = sharded(spark.read.parquet(str(tmp_path / "k")), "k", "k", 1000)
    f = r.agg(F.count_distinct("row_index").alias("n"), F.min("row_index").alias("a"), F.max("row_index").alias("b"), F.count_distinct("shard").alias("s")).first()
    assert tuple(f) == (1_000_000, 0, 999_999, 1000)
    ordered = r.select("k", "row_index", F.lag("row_index").over(__import__("pyspark").sql.Window.partitionBy("shard").orderBy("k")).alias("before"))
    assert ordered.filter("before IS NOT NULL AND before <> row_index - 1").isEmpty()


def test_byte_shards_start_anew(spark):
    rows = spark.createDataFrame([(i, b) for i, b in enumerate([50, 50, 50, 50, 70, 10])], "unit long, bytes long")
    assert [r["shard"] for r in incremental.byte_shards(rows.repartition(3), 60).orderBy("unit").collect()] == [0, 0, 1, 1, 2, 3]


def test_manifest_places_over_files(spark, tmp_path):
    (tmp_path / "m.csv").mkdir()
    for k in range(3):
        (tmp_path / "m.csv" / f"p{k}.csv").write_text("image_id,file_name\n" + ",\n" * 0 + "".join(f",\nx{k}{i},\n" for i in range(2)))
    ids = [r["image_id"] for r in manifest.read_source_manifest(spark, str(tmp_path / "m.csv")).orderBy("_ord").collect()]
    assert ids[::2] == [f"image_{i:09d}" for i in range(0, 12, 2)] and ids[1::2] == ["x00", "x01", "x10", "x11", "x20", "x21"]


def test_stream_state_survives_a_crash(spark, tmp_path):
    from maskwright.streaming import logs

    state = str(tmp_path / "s")
    batch = lambda rows: spark.createDataFrame(rows, "k int, _ord int, v string")
    logs.upsert_latest(batch([(i, 1, "a") for i in range(200)]), 0, state, "k", "_ord", 8)
    broken = spark.createDataFrame([(5, 2, "b")], "k int, _ord int, v string")
    (tmp_path / "s" / "v=1-dead").mkdir()  # what a crash in the write leaves behind
    (tmp_path / "s" / "lists" / "000000000001").mkdir()
    for _ in range(2):  # the batch comes again, also a second time
        logs.upsert_latest(broken, 1, state, "k", "_ord", 8)
    logs.upsert_latest(batch([(5, 1, "late"), (7, 3, "c")]), 2, state, "k", "_ord", 8)
    got = {r["k"]: r["v"] for r in logs.state_table(spark, state).collect()}
    assert got == {i: "a" for i in range(200)} | {5: "b", 7: "c"}
    assert not (tmp_path / "s" / "v=1-dead").exists()
    logs.upsert_latest(batch([]), 3, state, "k", "_ord", 8)
    assert logs.state_table(spark, state).count() == 200


def test_tags():
    r = spans.parse_tags("[1]a [2]dog[/2][/1] runs")
    assert r["caption"] == "A dog runs" and r["links"] == [{"id": 1, "start": 0, "end": 5, "surface": "A dog"}, {"id": 2, "start": 2, "end": 5, "surface": "dog"}] and not r["errors"]
    assert spans.parse_tags("[1]a [2]b[/1][/2]")["errors"][0] == "inline tags are crossed: expected [/2], got [/1]"
    assert spans.parse_tags("[/3]x")["errors"] and spans.parse_tags("[1]x")["errors"] and spans.parse_tags("[1][/1]x")["errors"] == ["link ID 1 has an empty inline mention"]
    assert spans.parse_tags("é [1]😀x[/1]")["links"] == [{"id": 1, "start": 2, "end": 4, "surface": "😀x"}]


def test_span_repair():
    cap = "the cat and the cat"
    assert spans.repair_span(cap, "cat", (4, 7), []) == (4, 7)
    assert spans.repair_span(cap, "cat", (5, 8), [(4, 7)]) == (16, 19)
    assert spans.repair_span(cap, "Cat", None, []) == (4, 7)
    assert spans.repair_span(cap, "dog", None, []) is None


def test_json_salvage():
    assert jsonx.salvage('```json\n{"a": 1}\n```') == {"a": 1}
    assert jsonx.salvage('x {"a": 1} y {"b": 2} z') == {"b": 2}
    assert jsonx.salvage('first {"a": 1} then {"b": [1, 2') == {"b": [1, 2]}
    assert jsonx.salvage('{"a": "open') is None and jsonx.salvage("nothing") is None
    assert jsonx.portable({"p": ["/x/y/z.png", "rel/a"]}) == {"p": ["z.png", "rel/a"]}


def test_keyed_null_and_order(spark):
    df = spark.createDataFrame([("a", 1, 10), (None, 2, 20), ("", 3, 30), ("a", 4, 40), ("b", 5, 50)], "k string, _ord int, v int")
    assert sorted(map(tuple, keyed.last_wins(df, "k").select("k", "v").collect())) == [("a", 40), ("b", 50)]
    assert [r["v"] for r in keyed.compact(df, "k").orderBy("first_ord").collect()] == [40, 20, 30, 50]


def test_extend_shortfall(spark):
    src = spark.createDataFrame([("a", "p", 1)], "image_id string, pair_key string, _ord int")
    none = spark.createDataFrame([], "identifier string")
    with pytest.raises(ValueError):
        incremental.extend(src.limit(0), src, none, 2, 8, 0, 0)


def test_claims(spark):
    log = spark.createDataFrame([(1, "claim", 5, 0, 10, 1), (1, "claim", 6, 5, 10, 2), (1, "claim", 6, 11, 10, 3), (1, "release", 5, 12, 10, 4)], "unit int, kind string, worker long, at long, lease long, _ord int")
    assert tuple(incremental.replay_claims(log).first()) == (1, 6, 2)


def test_manifest_and_exclusions(spark, tmp_path):
    (tmp_path / "m.csv").write_text("﻿image_id,file_name,pair_key\na,one.jpg,\n,skip-me.jpg,k\n,,x\n")
    (tmp_path / "x.csv").write_text("identifier\nskip-me.jpg\n")
    rows = manifest.read_source_manifest(spark, str(tmp_path / "m.csv"))
    assert [r["image_id"] for r in rows.orderBy("_ord").collect()] == ["a", "skip-me", "image_000000002"]
    gone, facts = manifest.load_exclusions(spark, str(tmp_path / "x.csv"))
    assert facts["file_name"] == "x.csv" and facts["identifier_count"] == 1
    assert {r["image_id"] for r in manifest.without_excluded(rows, gone, ["image_id", "image_path"]).collect()} == {"a", "image_000000002"}


def test_tar_source(spark, tmp_path):
    import io
    import tarfile

    with tarfile.open(tmp_path / "t.tar", "w") as tar:
        for name, data in (("s1.jpg", b"img"), ("s1.json", json.dumps({"caption": "c"}).encode()), ("s2.jpg", b"x"), ("../evil.jpg", b"e")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    got = manifest.paired_members(manifest.read_tars(spark, [str(tmp_path / "t.tar")])).collect()
    assert [(r["stem"], bytes(r["image"]), json.loads(r["json"])) for r in got] == [("s1", b"img", {"caption": "c"})]


def test_shards_are_reused(spark, tmp_path):
    df = spark.range(25).withColumnRenamed("id", "k")
    m = sinks.write_parquet_shards(df, str(tmp_path / "s"), "k", "k", 10)
    assert [(r["shard"], r["rows"]) for r in m.orderBy("shard").collect()] == [(0, 10), (1, 10), (2, 5)]
    stamp = {p: p.stat().st_mtime_ns for p in (tmp_path / "s").rglob("*.parquet")}
    sinks.write_parquet_shards(df, str(tmp_path / "s"), "k", "k", 10)
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "s").rglob("*.parquet")} == stamp
    assert spark.read.parquet(str(tmp_path / "s")).count() == 25
    new = df.withColumn("v", F.lit("new"))
    for label in ("old", "new"):
        sinks.write_parquet_shards(new.withColumn("v", F.when(F.col("k") < 10, "same").otherwise(label)), str(tmp_path / "t"), "k", "k", 10)
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet") if "shard=0" in str(p)}
    sinks.write_parquet_shards(new.filter("k < 15").withColumn("v", F.when(F.col("k") < 10, "same").otherwise("newer")), str(tmp_path / "t"), "k", "k", 10)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 15 and {r["v"] for r in back.select("v").distinct().collect()} == {"same", "newer"}
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet") if "shard=0" in str(p)} == kept


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "é")], "b int, a string")
    sinks.write_jsonl(df, str(tmp_path / "j"))
    back = manifest.read_jsonl(spark, str(tmp_path / "j"), "a string, b int")
    assert sorted(map(tuple, back.select("b", "a").collect()), key=str) == [(1, None), (2, "é")]
    assert sinks.checksums(spark, str(tmp_path / "j")).count() >= 1


def test_nms_is_partition_invariant(spark):
    from maskwright import adapters
    from maskwright.operators.suppress import greedy_nms

    b = adapters.boxes(spark, "/root/testdata/sf0.001").withColumns({"x": F.expr("x % 40"), "y": F.expr("y % 30")})
    one, two = greedy_nms(b.repartition(1), 0.3), greedy_nms(b.repartition(7, "raw_index"), 0.3)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_whole_texts(spark, tmp_path):
    from maskwright.functions import text

    long = "ab " + "x" * 70 + " ab zebra ab"
    spark.createDataFrame([(1, long), (2, "aaa"), (3, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = lambda name, col: {r["doc_id"]: r[col] for r in text.QUERIES[name](spark, str(tmp_path)).collect()}
    assert rows("text_occurrences", "at") == {1: "0,74,83", 2: "0,1", 3: ""}
    assert rows("text_tokens", "tokens")[1] == "ab " + "x" * 70 + " zebra"
    assert rows("text_paired", "texts")[1] == f"{long}|ab"
    assert "zebra ab" in rows("text_captions", "caption")[1]


def test_publish_all_units(spark, tmp_path):
    from maskwright.operators import incremental

    docs = spark.range(1603).selectExpr("id AS doc_id", "'t' AS text", "'en' AS lang", "'s' AS source", "3L AS n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = incremental.QUERIES["publish_pairs"](spark, str(tmp_path)).collect()
    assert sorted(r["pair_index"] for r in rows) == list(range(1600)) and max(r["unit"] for r in rows) == 199


def test_canonical_long_chain(spark):
    from maskwright.operators.canonical import canonical

    masks = spark.range(60).selectExpr("id AS mask_id", "cast(id AS double) AS score", "IF(id = 7, 0.5, null) AS best_iou", "1 AS area")
    rows = canonical(masks, spark.range(59).selectExpr("id AS u", "id + 1 AS v")).collect()
    assert {(r["canonical_id"], r["members"]) for r in rows} == {(7, 60)} and sum(r["kept"] for r in rows) == 1


# ---- the validator
def _case(raw, masks, known=("dog", "cup", "cups", "man", "woman", "hand", "hat", "person", "shoe", "sneaker", "hair"), **kw):
    from maskwright.operators import validate as v
    from maskwright.operators.context import Mask
    from maskwright.operators.lexicon import Lexicon, PlainParser

    lex = Lexicon([("man", "man"), ("woman", "woman"), ("person", "person"), ("dog", "dog"), ("puppy", "puppy"), ("cup", "cup"), ("hand", "hand")], [("man", "person"), ("woman", "person"), ("puppy", "dog")])
    made = [Mask(f"a_p000_m{i:04d}", **m) if isinstance(m, dict) else Mask(f"a_p000_m{i:04d}", m) for i, m in enumerate(masks)]
    return v.normalise(raw, made, lex, PlainParser(known), **{"all_masks": False, **kw})


def test_validator_composites():
    a, b, both = "a_p000_m0000", "a_p000_m0001", {"main_candidate": "cups", "children": ("a_p000_m0000", "a_p000_m0001")}
    masks = ["cup", "cup", both]
    r = _case({"tagged_caption": "[3][1]one cup[/1] and [2]the other cup[/2] stand"}, masks)
    assert r["composite_close_repairs"][0]["child_ids"] == [1, 2] and r["caption"] == "One cup and the other cup stand" and not r["composite_errors"]
    assert [g["char_spans"] for g in r["groups"]] == [[[0, 7]], [[12, 25]], [[0, 25]]]
    for broken in ("[3][1]one cup[/1] beside [2]the other cup[/2] stand", "[3][1]one cup[/1] stands", "[3][1]one cup[/2] and [2]x[/1]"):
        assert not _case({"tagged_caption": broken}, masks)["composite_close_repairs"]
    r = _case({"tagged_caption": "[1]one cup[/1], [2]the other cup[/2], [3]cups[/3]"}, masks)
    assert r["composite_errors"][0].startswith("composite mask ID 3 must link one collective span") and a != b
    r = _case({"tagged_caption": "[3][1]one cup[/1] and [2]the other cup[/2][/3], [1]one cup[/1] and [2]the other cup[/2] stand"}, masks)
    assert any("repeats every child immediately outside" in e for e in r["composite_errors"])


def test_validator_mentions():
    r = _case({"caption": "A red dog and the man rest. The dog sleeps.", "groups": [{"mask_id": "other_p000_m0000", "text": ["dog", "a red dog", "the dog"]}, {"id": 2, "text": "a man"}, {"id": 9, "text": ["x"]}, 5, {"id": 2, "text": "man"}, {"id": 1}]}, ["dog", "man"])
    assert [(g["overlay_number"], g["text"]) for g in r["groups"]] == [(1, ["A red dog", "The dog"]), (2, ["the man"])]
    assert r["mask_id_repairs"] == [{"provided": "other_p000_m0000", "resolved": "a_p000_m0000"}]
    assert {x["reason"] for x in r["link_repairs"]} == {"unknown_extra_link_dropped", "redundant_lexically_nested_model_mention"}
    assert r["findings"] == ["link list position 4 is not an object", "link ID 2 appears more than once", "link ID 1 appears more than once"]
    assert r["mention_completion_repairs"] == [{"overlay_number": 2, "text": "the man", "char_span": [14, 21], "reason": "unambiguous_spacy_mention_completion"}]
    r = _case({"tagged_caption": "the shiny [1]cup[/1] and [2]another cup[/2]"}, ["cup", "cup"])
    assert r["noun_phrase_span_repairs"] == [{"overlay_number": 1, "text": "The shiny cup", "char_span": [0, 13], "replaced_spans": [[10, 13]], "reason": "tagged_identity_expanded_to_full_noun_phrase"}]
    r = _case({"tagged_caption": "[1]a puppy[/1] sits near a man"}, ["dog", "man"])
    assert [g["text"] for g in r["groups"]] == [["A puppy"], ["a man"]] and r["mention_completion_repairs"][0]["text"] == "a man" and not r["findings"]


def test_validator_rules():
    say = lambda raw, masks, **kw: _case({"tagged_caption": raw}, masks, **kw)["findings"]
    assert say("[1]A dog[/1] sleeps in the background.", ["dog"]) == [] and _case({"tagged_caption": "[1]A dog[/1] sleeps in the background."}, ["dog"])["caption"] == "A dog sleeps."
    assert say("", ["dog"])[:2] == ["caption is empty", "only 0 valid groups; need at least 1"]
    assert say("[1]A dog[/1] shown in the image.", ["dog"]) == ["caption contains forbidden image/background wording: 'shown in the image'"]
    assert say("[1]A dog[/1]", ["dog", "cup", "hat"], all_masks=True) == ["2 accepted masks are missing groups; required link IDs: 2:cup, 3:hat"]
    four = say("[1]A dog[/1] is visible. [2]A cup[/2] is shown. [3]A hat[/3] appears. [4]A man[/4] is seen.", ["dog", "cup", "hat", "man"])
    assert [f.split(";")[0].split("(")[0] for f in four] == ["caption quality: one-sentence-per-mask inventory", "caption quality: repeated stock visibility/presence predicates "]
    assert say("[1]The dog[/1] [1]the dog[/1] rests.", ["dog"])[0].startswith("caption quality: adjacent duplicate linked phrase 'The dog the dog'")
    assert any(f.startswith("grammatical number: single-component repeated mask ID 1 needs singular identity 'cup', not 'Cups'") for f in say("[1]cups[/1] and [2]the other cup[/2]", ["cup", "cup"]))
    assert any("mechanical ordinal catalog for ['cup'] across link IDs [1, 2]" in f for f in say("[1]the first cup[/1], [2]the second cup[/2]", ["cup", "cup"]))
    assert any("ordinal body-part identity for link ID 1: 'The first hand'" in f for f in say("[1]the first hand[/1]", ["hand"]))
    assert any("conflicting concrete compound noun ['hat']" in f for f in say("[1]a hat hand[/1]", ["hand"]))
    assert any(f.startswith("caption mention coverage: unlinked referring expression 'She'") for f in say("[1]A dog[/1] and [2]a cup[/2]. She rests.", ["dog", "cup"]))


def test_mask_context():
    from maskwright.operators.context import Mask, mask_context, model_context
    from maskwright.operators.lexicon import Lexicon, PlainParser

    lex, parser = Lexicon([("man", "m"), ("person", "p"), ("hand", "h")], [("m", "p")]), PlainParser(("man", "hand", "cup", "cups"))
    masks = [Mask("a", "man", bbox=(0, 0, 50, 100)), Mask("b", "hand", bbox=(0, 40, 10, 10)), Mask("c", "hand", bbox=(40, 40, 10, 10)), Mask("d", "cup", bbox=(80, 0, 5, 5)), Mask("e", "cup", bbox=(90, 0, 5, 5)), Mask("f", "cups", bbox=(80, 0, 15, 5), children=("d", "e"))]
    c = mask_context([m.name(parser) for m in masks], lex, parser)
    assert [x["required_owner_id"] for x in c] == [None, 1, 1, None, None, None]
    assert c[1]["safe_tagged_phrase"] == "[2]one of [1]his[/1] hands[/2]" and c[2]["safe_tag_phrase"] == "the other hand" and c[2]["safe_tagged_phrase"] == "[3][1]his[/1] other hand[/3]"
    assert c[3]["same_subject_total"] == 3 and c[3]["safe_tag_phrase"] == "the first cup"
    assert c[5]["composite_link_example"] == "[6][4]the first cup[/4] and [5]the second cup[/5][/6]"
    assert model_context(masks, lex, parser)[1]["collective_candidate_ids"] == [2, 3] and "safe_tag_phrase" not in model_context(masks, lex, parser)[0]


def test_rewrite_findings_and_audit():
    from maskwright.operators import validate as v
    from maskwright.operators.context import Mask
    from maskwright.operators.lexicon import Lexicon, PlainParser

    parser, masks = PlainParser(("dog", "hat")), [Mask("a", "dog")]
    audit = v.mention_audit("A dog wears a hat. The dog sleeps. A dog!", masks, Lexicon(), parser)
    assert [(m["text"], m["occurrence"], m["instruction"]) for m in audit] == [("A dog", 1, "link_exact_occurrence"), ("a hat", 1, "remove_unmasked_concrete_noun_phrase"), ("The dog", 1, "link_exact_occurrence"), ("A dog", 2, "link_exact_occurrence")]
    got = v.rewrite_findings(["caption quality: malformed punctuation '.,'", "style only", "link ID 1 has an unclosed opening tag", "unknown link x", "unknown link x"], "a hat", masks, Lexicon(), parser)
    assert [g["code"] for g in got] == ["malformed_punctuation", "schema_or_tag_structure", "unknown_mask_id", "unmasked_noun_phrase_candidate"]
    assert v.check_raw("no json", masks, Lexicon(), parser, True)["parseable"] is False
    assert v.check_raw('{"reject": true, "tagged_caption": "[1]a dog[/1]"}', masks, Lexicon(), parser, False)["findings"] == ["model decision reject must be false after the one rewrite"]
