"""Memory and work of single steps, and their results against plain ones."""

import random
import re
import time
import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from maskwright.functions import text
from maskwright.operators import canonical, lexicon, records, spans, taxonomy


def _peak(run) -> int:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_tag_links_hold_a_slice_of_a_batch():
    captions = pa.array(["[1]a [2]dog[/2][/1] and [3]cat[/3]. " * 100] * 1_000)
    links = 0

    def run():
        nonlocal links
        for part in spans.expand_tags.func(iter([captions])):
            links += len(part.field("links").flatten())

    assert _peak(run) < 60_000_000 and links == 300_000


def test_links_of_equals_parse_tags(spark):
    texts = ["[1]a [2]dog[/2][/1] runs. [3]x[/3]", "", None, "[1][1]b[/1][/1] [2]c", "é [7]😀x[/7]! [7]y[/7]", "[2]a[/1][/2]", "a [1][/1]"]
    df = spark.createDataFrame(list(enumerate(texts)), "image_id long, tagged string")
    want = sorted((i, k["id"], k["start"], k["end"], k["surface"]) for i, t in enumerate(texts) for k in spans.parse_tags(t or "")["links"])
    assert sorted(map(tuple, spans.links_of(df).collect())) == want
    assert sorted((r[0], *k) for r in df.select("image_id", spans.expand_tags("tagged")["links"].alias("l")).collect() for k in r["l"]) == want
    assert spans.parse_tags("[1][1]b[/1][/1]")["errors"] == ["link ID 1 has nested self-overlap"]
    assert spans.parse_tags("a. b! c")["caption"] == "A. B! C"


def test_smallest_cover_of_crossing_spans(spark):
    rng = random.Random(5)
    span = lambda: (s := rng.randrange(60), s + rng.randrange(1, 25))
    links = [(rng.randrange(4), rng.randrange(9), *span()) for _ in range(300)]
    mentions = [(rng.randrange(5), *span()) for _ in range(300)]
    want = {(i, s, e, min((b - a, g) for j, g, a, b in links if j == i and a <= s and b >= e)[1]) for i, s, e in mentions if any(j == i and a <= s and b >= e for j, _, a, b in links)}
    df = records.smallest_cover(spark.createDataFrame(mentions, "image_id long, start int, end int"), spark.createDataFrame(links, "image_id long, id int, start int, end int"))
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(want) and set(got) == want
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()  # pairs of an image's spans grow with their square


def test_clauses_equal_whole_patterns():
    lead, rest = re.compile(text.LEADING_VIEW, re.I), [re.compile(c, re.I) for c in text.CLAUSES]

    def plain(t):
        out = []
        if m := lead.match(t):
            out, t = [f"removed crop/view preamble: {m[0].strip()}"], t[m.end() :]
        for p in rest:
            while m := p.search(t):
                out.append(f"removed background/view clause: {m[0].strip()}")
                t = t[: m.start()] + t[m.end() :]
        return t, out

    rng = random.Random(3)
    words = ["against", "before", "On", "over", "in", "front", "of", "a", "the", "background", "Backdrop", "backgroundon", "set", "standing", "positioned", "shown", "seen", "with", "amid", "surrounded", "by", "from", "view", "within", "this", "image", "scene", "season", "dog", "K", "ſet", "bacKdrop", ",", ".", ";", " ", "  ", "\n", "x" * 30, "a photo of"]
    for _ in range(20_000):
        t = "".join(rng.choice(words) + rng.choice(["", " ", " ", " "]) for _ in range(rng.randrange(1, 25)))
        assert text.without_clauses(t) == plain(t), t


def test_clauses_are_cut_in_linear_time():
    t = "a dog, standing on a background, seen in a view. " * 20_000
    began = time.process_time()
    assert len(text.without_clauses(t)[1]) == 40_000
    assert time.process_time() - began < 20  # from the start of the text after each cut: minutes
    began = time.process_time()
    text.without_clauses("word " * 400_000)
    assert time.process_time() - began < 0.5


def test_tidied_equals_columns(spark):
    rng = random.Random(4)
    parts = [" ", "  ", "\n", "\t", "\u2028", "\u00a0", "\x1f", ",", ".", ";", "!", ":", "and", "With", "while", "against", "dog", "é", "éand", "_and", "1and", "ßx", "AND", "ſ", "K", "Ж", "😀"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(4_000)]
    df = spark.createDataFrame([(t, text.tidied(t)) for t in texts], "t string, p string")
    assert [tuple(r) for r in df.select("t", text.punctuated(F.col("t")).alias("a"), text._sentence(F.col("p")).alias("b")).filter("a <> b").take(3)] == []
    plan = spark.range(1).select(text.cleaned_caption(F.col("id").cast("string")).alias("c")).select("c.*")._jdf.queryExecution().optimizedPlan().toString()
    assert "while" not in plan


def test_backgrounds_of_texts_without_letters(spark, tmp_path):
    import duckdb
    from maskwright.operators import nouns

    spark.createDataFrame([(1, ""), (2, "123 45"), (3, "Привет"), (4, "a b")], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("caption_backgrounds", "caption_mentions", "caption_nouns"):
        a, b = nouns.QUERIES[name](spark, str(tmp_path)).toPandas(), con.sql(nouns.ORACLES[name]).df()
        assert sorted(map(str, a[sorted(a)].values.tolist())) == sorted(map(str, b[sorted(a)].values.tolist()))


def test_mask_pairs_in_blocks(spark, monkeypatch):
    rng, monkey = random.Random(6), monkeypatch.setattr
    base = [rng.getrandbits(63) for _ in range(6)]
    rows = [(i, i % 2, rng.choice(["x", "y", " X", "", None]), rng.choice(base) ^ (1 << rng.randrange(63)) if i % 9 else 0, rng.choice([None, "red dog", "red cat", "blue cat runs"])) for i in range(120)]
    df = spark.createDataFrame(rows, "mask_id long, image_id long, subject string, bits long, description string")
    words = lambda t: set((t or "").split())
    want = set()
    for u, i, s, a, x in rows:
        for v, j, t, b, y in rows:
            if u < v and i == j and (s or "").strip().lower() == (t or "").strip().lower() != "":
                k, both, least = (a & b).bit_count(), (a | b).bit_count(), min(a.bit_count(), b.bit_count())
                iou, held, alike = k / max(1, both), k / max(1, least), len(words(x) & words(y)) / max(1, len(words(x) | words(y)))
                if held >= 0.6 and iou >= 0.45 and (iou >= 0.7 or alike >= 0.3):
                    want.add((i, u, v, round(iou, 9), round(held, 9), round(alike, 9)))
    made = []
    for size in (4_096, 7):
        monkey(canonical, "_BLOCK", size)
        found = canonical.duplicate_edges(df, 0.6, 0.45, 0.7, 0.3)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "bits" not in "".join(x for x in plan.splitlines() if "Join" in x and "Condition" in x) and "array_intersect" not in plan
        got = [(r[0], r[1], r[2], *(round(x, 9) for x in r[3:])) for r in found.collect()]
        assert len(got) == len(want) and set(got) == want
        made.append(sorted(map(tuple, canonical.composite_masks(df, held=0.5, union=0.5, apart=0.9, smaller=1.1).collect())))
    assert made[0] == made[1] and made[0]


def test_taxonomy_makes_no_rows_of_pairs(spark):
    lemmas = spark.createDataFrame([(f"n{i:04}", "s") for i in range(1_500)] + [("n0001", "t"), ("m", "t"), ("thing", "s"), ("alone", "u"), (None, "s"), ("n0002", None)], "lemma string, synset string")
    plan = taxonomy.alternatives(lemmas)
    found = {r[0]: r[1].split(",") for r in plan.collect()}
    names = sorted([f"n{i:04}" for i in range(1_500)] + ["thing"])
    assert found["n0007"] == [n for n in names if n != "n0007"] and found["n0001"] == ["m"] + [n for n in names if n != "n0001"] and found["m"] == ["n0001"] and "alone" not in found
    assert "lemma = other" not in plan._jdf.queryExecution().optimizedPlan().toString()
    edges = spark.createDataFrame([("s", "r"), ("u", "s")], "child string, parent string")
    pairs = spark.createDataFrame([("n0001", "m"), ("alone", "m"), ("alone", "n0003"), ("n0003", "alone"), ("alone", "thing"), ("no", "no"), ("no", "m"), ("alone", "n0003")], "expected string, mentioned string")
    matched = taxonomy.matches(pairs, lemmas, edges)
    assert sorted(map(tuple, matched.collect())) == [("alone", "n0003", "expected_is_direct_hyponym"), ("n0001", "m", "same_synset"), ("n0003", "alone", "expected_is_direct_hypernym"), ("no", "no", "exact_lemma")]
    assert matched._jdf.queryExecution().optimizedPlan().toString().count("Union") == 0  # each pair is one row throughout


def test_candidate_stops_at_the_first_noun():
    parser = lexicon.PlainParser(("dog", "cup"))
    calls, is_noun = [], parser._is_noun
    parser._is_noun = lambda w: calls.append(w) or is_noun(w)
    assert parser.candidate("She sees a big dog. " + "cup word " * 1_000) == "dog" and len(calls) < 50
    assert lexicon.terms(parser, "Dogs, pants; Shorts x_jeans topants the CUPS") == {"dog", "cup", "pants", "shorts", "jeans"}
    assert [m["text"] for m in parser.mentions("This dog and it, the other cup")] == ["This dog", "it", "the other cup"]
