"""The ten operators against brute force on the small tables, and with awkward rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from maskwright.llm import bpe_lexicon, exact_dedup, kd_shards, line_dedup, near_dedup, packing, pii, registry, token_counts, toxicity, vector_dedup

DATA = "/root/testdata/sf0.001"
LONG = "word " * 30_000 + "end"
AWKWARD = [
    (1, None, "x"), (2, "", "x"), (3, " \n ", "x"), (4, "one two", "x"), (5, "one two", "x"), (5, "one two", "x"), (None, "one two", "x"), (6, LONG, "x"), (7, LONG + " tail", "x"),
    (8, "naïve café 😀 漢字 <|endoftext|> it's a@b.co", "x"), (9, "a\nb\nc\nd", "x"), (10, "z\na\nb\nc", "x"),
]


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    return spark.createDataFrame(AWKWARD, "doc_id long, text string, kept string").withColumnsRenamed({}).selectExpr("*", "1 AS _id", "2 AS id", "3 AS n", "4 AS component_id")


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.limit(0)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(name, same):
    same(registry.QUERIES[name], registry.ORACLES[name])


# ---- 1
def _bpe_reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_equals_library(spark, documents):
    t = _bpe_reference()
    for r in bpe_lexicon.query(spark, DATA).collect():
        ids = t.encode(dict(documents)[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_awkward(awkward, empty):
    t = _bpe_reference()
    got = collections.Counter((r["doc_id"], bytes(r["ids"])) for r in bpe_lexicon.encode_decode(awkward).collect())
    assert got == collections.Counter((i, np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes()) for i, x, _ in AWKWARD)
    assert bpe_lexicon.encode_decode(empty).count() == 0


def test_tokens_without_repeated_words(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("hello world", add_special_tokens=False).ids
    got = bpe_lexicon.encode_decode(spark.createDataFrame([(1, "hello world")], "doc_id long, text string")).collect()
    assert [bytes(r["ids"]) for r in got] == [np.array(want, "<u4").tobytes()]


def _twins():
    """Two words of 2,048 letters that every polynomial hash modulo 2 ** 64 takes for one."""
    a = "a"
    while len(a) < 2048:
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


def _hard_texts():
    import random

    a, b = _twins()
    long = "".join(random.Random(1).choice("abcdefghij") for _ in range(200_000))
    return [f"{a} {b}", f"{b} x {a}", *[f"it's {long[:3000]} and {long[:3000]}"] * 3, long, f"ünï 漢字 {b}", a, b]


def test_bpe_hard_words(spark):
    t, texts = _bpe_reference(), _hard_texts()
    got = bpe_lexicon.encode_decode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: bytes(r["ids"]) for r in got} == {i: np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for i, x in enumerate(texts)}


def test_hard_words_elsewhere(spark):
    """The same words in packing, counts, near-dedup and toxicity."""
    import public_tokenizers
    from tokenizers import Tokenizer

    texts, (a, b) = _hard_texts(), _twins()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _check_pieces(packing.pack(docs).collect(), list(enumerate(texts)))
    model = token_counts._viterbi(public_tokenizers.path("piece_bpe_32k.model"))
    assert token_counts.Counter(model).counts(texts) == [model.count(token_counts.normalised(x)) for x in texts]
    tails = [f"{a} b c d e", f"{b} b c d e", f"{a} b c d e"]
    got = near_dedup.near_dedup(spark.createDataFrame(list(enumerate(tails)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {0: 0, 1: 1, 2: 0}
    m = toxicity.Model([f"idiot x{k}" for k in range(9)] + [f"calm x{k}" for k in range(9)], [1] * 9 + [0] * 9)
    both = toxicity.Scorer(m)
    assert both(texts).tolist() == [toxicity.Scorer(m)([x])[0] for x in texts]
    assert Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_long_words_stay_out_of_the_lexicon(tmp_path):
    path = tmp_path / "l"
    path.write_bytes(bpe_lexicon.build_lexicon(["ab", "x" * 3000], __import__("public_tokenizers").path("word_bpe_49k.json")))
    assert bpe_lexicon.Lexicon(str(path)).places([b"ab", b"x" * 3000]).tolist() == [0, -1]
    deep = bpe_lexicon.compile_lexicon([b"a" * 2999, b"a" * 3000])
    assert deep["final"].sum() == 2


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = sorted({w.encode() for w in ("tap", "taps", "top", "tops", "stop", "stops", "é", "a")})
    arrays = bpe_lexicon.compile_lexicon(words)
    assert len(arrays["final"]) == 8  # start; t; ta, to and sto; p; the end; s; st; the first byte of é
    path = tmp_path / "l"
    path.write_bytes(bpe_lexicon.build_lexicon([w.decode() for w in words], __import__("public_tokenizers").path("word_bpe_49k.json")))
    lex = bpe_lexicon.Lexicon(str(path))
    assert lex.places(words).tolist() == list(range(len(words)))
    assert (lex.places([b"to", b"topss", b"x", b"stap"]) == -1).all()


# ---- 2
def _near(rows):
    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_dedup_awkward(awkward, empty):
    want = _near([(i, t) for i, t, _ in AWKWARD if i is not None])
    for r in near_dedup.near_dedup(awkward).collect():
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == (*want[r["doc_id"]], want[r["doc_id"]][1] == r["doc_id"])
        else:
            assert r["component_id"] is None and r["kept"]
    assert near_dedup.near_dedup(empty).count() == 0


def test_near_dedup_long_texts(spark):
    """Texts of 30,000 different words: a copy, one at the threshold, one below it, and one in capitals."""
    words = [f"w{k}" for k in range(30_000)]
    cut = lambda n: words[:n]
    rows = [(1, " ".join(words)), (2, "\t".join(words).upper()), (3, " ".join(cut(22_501))), (4, " ".join(cut(22_400)) + " end"), (5, " ".join(words)), (6, "x " * 200_000)]
    want = _near(rows)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want and want[3][1] == 1


def test_near_dedup_family(spark):
    """A family of edited copies whose links form chains: no link is lost, also across blocks and components."""
    rng = np.random.default_rng(4)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.choice(60, rng.integers(0, 9), replace=False):
            words[k] = f"e{i}x{k}"
        rows.append((i, " ".join(words)))
    want = _near(rows)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in want.items()}


def test_near_dedup_recall(spark):
    """Against all sets of the table: every link of 300 documents lies within a component, and the measure sees what is missing."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = near_dedup.near_dedup(docs).persist()
    links, within = near_dedup.recall(docs, found, 300)
    assert links > 20 and within == links
    alone = found.withColumn("component_id", near_dedup.F.col("doc_id"))
    assert near_dedup.recall(docs, alone, 300) == (links, 0)


# ---- 3
def test_exact_dedup_awkward(awkward, empty):
    groups = collections.defaultdict(list)
    for i, t, _ in AWKWARD:
        groups[t or ""].append(i)
    for keep, pick in (("largest", max), ("smallest", min)):
        got = exact_dedup.exact_dedup(awkward, keep=keep).collect()
        assert len(got) == len(AWKWARD)
        want = {i: pick(x for x in g if x is not None) for g in groups.values() for i in g if i is not None}
        assert all(r["keep_id"] == want[r["doc_id"]] for r in got if r["doc_id"] is not None)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_hot_group(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same', concat('t', id)) AS text")
    got = exact_dedup.exact_dedup(df, keep="largest")
    assert got.filter("kept").count() == 2001 and got.filter("group_size = 1000 AND keep_id = 2997").count() == 1000
    null_ids = df.selectExpr("IF(doc_id < 9, NULL, doc_id) AS doc_id", "text").union(spark.sql("SELECT 12 AS doc_id, 'same' AS text"))
    small = exact_dedup.exact_dedup(null_ids, keep="smallest").filter("group_size = 1001")
    assert small.count() == 1001 and small.filter("keep_id = 9").count() == 1001 and small.filter("kept").count() == 1


def test_exact_dedup_compares_hot_texts(spark, monkeypatch):
    """Different texts of one digest, both frequent: the texts decide, not the digest."""
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: exact_dedup.F.lit("0" * 64))
    df = spark.range(1400).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'even', 'odd') AS text")
    got = exact_dedup.exact_dedup(df, keep="smallest").groupBy("keep_id", "group_size").count().collect()
    assert sorted(tuple(r) for r in got) == [(0, 700, 700), (1, 700, 700)]


# ---- 4
def _base(t):
    digits = lambda m: re.sub(r"[^0-9]", "", m)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]


def test_pii_equals_brute_force(spark, documents):
    for r in pii.query(spark, DATA).collect():
        want = _base(dict(documents)[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(x[0] == k for x in want) for k in pii.BASE]


def test_pii_random():
    import random

    rng = random.Random(3)
    for _ in range(20_000):
        t = "".join(rng.choice("a@.1 +-()0b9") for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(t) == _base(t)


def test_pii_added_and_redacted(awkward, empty):
    t = "My bank IBAN GB82 WEST 1234 5698 7654 32, call 555-123-4567, code 078-05-1120"
    assert {k for k, *_ in pii.find(t)} == {"iban", "local"}
    assert pii.find("id 555-123-4567") == [] and pii.find("ssn 078-05-1120")[0][0] == "national"
    assert pii.redacted("x a@b.co y") == "x [EMAIL] y"
    assert pii.base_spans("1" * 50_000 + " " + "." * 50_000) == []
    got = {r["doc_id"]: r["text"] for r in pii.redact(awkward).collect()}
    assert got[1] is None and got[8].endswith("[EMAIL]") and got[6] == LONG
    assert pii.find_pii(empty).count() == 0 == pii.redact(empty).count()


def test_pii_iban_before_other_tokens():
    code = "DE89370400440532013000"
    assert pii.redacted(f"IBAN {code} EUR 100") == "IBAN [IBAN] EUR 100"
    assert pii.redacted("IBAN GB82 WEST 1234 5698 7654 32 BIC X1") == "IBAN [IBAN] BIC X1"
    assert pii.find(f"IBAN {code[:-1]}1 EUR") == []
    assert pii.redacted("bank NO9386011117947 NO9386011117947 X") == "bank [IBAN] [IBAN] X"
    assert pii.redacted(f"bank AB12 CODE {code}") == "bank AB12 CODE [IBAN]"


# ---- 5
def test_packing(spark, documents):
    _check_pieces(packing.query(spark, DATA).collect(), documents)


def test_packing_awkward(awkward, empty):
    rows = packing.pack(awkward.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()
    _check_pieces(rows, [(i, t) for i, t in {i: t for i, t, _ in AWKWARD if i is not None}.items()])
    assert packing.pack(empty).count() == 0
    every = packing.pack(awkward).collect()  # with a null id and repeated rows, each a document of its own
    sizes = {r["doc_id"]: r["doc_tokens"] for r in every}
    tokens = collections.Counter()
    for r in every:
        tokens[r["doc_id"]] += r["length"]
    assert tokens == {i: n * sum(x == i for x, *_ in AWKWARD) for i, n in sizes.items()} and set(tokens) == {i for i, *_ in AWKWARD}


def _check_pieces(rows, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    assert set(by) == {i for i, _ in documents}
    for i, text in documents:
        ids, at = [*t.encode(text or "", add_special_tokens=False).ids, 1], 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : at], "<u4").tobytes())
        assert at == len(ids)
    for w in windows.values():
        w.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in w] == np.cumsum([0, *[r["length"] for r in w[:-1]]]).tolist() and w[-1]["offset"] + w[-1]["length"] <= 2048
    part = sum(w[-1]["offset"] + w[-1]["length"] < 2048 for w in windows.values())
    assert part <= len({k >> 40 for k in windows})
    assert len({r["sequence_id"] for r in rows if r["poured"]}) <= packing.OPEN * len({k >> 40 for k in windows})


def test_levels_follow_sum_of_squares():
    rng = np.random.default_rng(1)
    p = packing.LevelPacker(64, 10)
    levels = collections.Counter()
    for size in rng.integers(1, 64, 2000).tolist():
        left = size
        for _, h, k in p.place(size):
            assert h == 0 or levels[h] > 0
            options = {a: 2 * (levels[a + left] if a + left < 64 else -0.5) - 2 * levels[a] + 2 for a in levels if levels[a] and a + left <= 64}
            if levels.total() < 10:
                options[0] = 2 * levels[left] + 1
            if options:
                cost = 2 * levels[left] + 1 if not h else options[h]
                assert k == left and cost == min(options.values())
            else:
                assert h + k == 64 and levels[h] == max(levels.values())
            levels[h] -= bool(h)
            levels[h + k] += h + k < 64
            left -= k
        assert left == 0 and levels.total() <= 10 and +levels == collections.Counter({h: n for h, n in enumerate(p.count) if n})


def test_few_windows_are_poured(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8, "doc_id")
    r = packing.pack(docs).groupBy("poured").agg(packing.F.countDistinct("sequence_id").alias("n")).collect()
    n = {x["poured"]: x["n"] for x in r}
    assert n[True] < 0.05 * (n[True] + n[False])


# ---- 6
def test_toxicity_held_out(spark):
    rows = {r["doc_id"]: r for r in toxicity.query(spark, "/root/testdata/sf0.01").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(rows[i]["score"], rows[i]["predicted"], y) for i, y in labels.items() if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in rows)
    up, down = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in up for b in down]) > 0.85
    assert sum(p for _, p, y in held if not y) <= 0.03 * len(down)


def test_toxicity_kernel_tolerates_gaps():
    land = toxicity.Landmarks(["idiot"])
    k = land.kernel(["idiot", "idxiot", "idot", "meadow"])[:, 0] ** (1 / toxicity.POWER)
    assert abs(k[0] - 1) < 1e-12 and k[1] > 0.4 and k[2] > 0.4 and k[3] < 0.1
    assert toxicity.clean("1d.10t!") == "idiot" and toxicity.clean("123") == ""


def _plain_kernel(s, t):
    """Cosine of gap-weighted subsequences of three characters, by enumeration."""
    def counts(w):
        w, out = f"\x01{w}\x02", collections.Counter()
        for i in range(len(w)):
            for k in range(i + 2, min(i + toxicity.SPAN, len(w))):
                for j in range(i + 1, k):
                    out[w[i] + w[j] + w[k]] += toxicity.DECAY ** (k - i - 2)
        return out

    a, b = counts(s), counts(t)
    norm = lambda c: sum(v * v for v in c.values()) ** 0.5
    return sum(v * b[u] for u, v in a.items()) / (norm(a) * norm(b))


def test_toxicity_equals_plain_version():
    """Kernels, Nystroem features, machine and margins against plain loops; the kernel is symmetric and positive semidefinite."""
    rng = np.random.default_rng(9)
    words = sorted({"".join(rng.choice(list("abcdeé漢"), rng.integers(3, 9))) for _ in range(60)} | {"idiot", "idiots", "idxiot", "aaaaaaa"})
    plain = np.array([[_plain_kernel(a, b) for b in words] for a in words])
    assert np.allclose(toxicity.Landmarks(words).kernel(words), plain**toxicity.POWER, atol=1e-12)
    assert np.allclose(plain, plain.T) and np.linalg.eigvalsh(plain**toxicity.POWER).min() > -1e-9
    texts = [" ".join(rng.choice(words, rng.integers(1, 12))) for _ in range(80)]
    y = np.array(["idiot" in t for t in texts])
    sets = [toxicity._tokens(t) for t in texts]
    land = toxicity.Landmarks(words[:20])
    assert np.allclose(toxicity.text_kernel(land, sets), [[sum(_plain_kernel(t, z) ** toxicity.POWER for t in s) for z in words[:20]] for s in sets])
    kzz = plain[:20, :20] ** toxicity.POWER
    assert np.allclose(toxicity.root_inverse(kzz) @ kzz @ toxicity.root_inverse(kzz), np.eye(20), atol=1e-6)
    x, sign = toxicity.text_kernel(land, sets) @ toxicity.root_inverse(kzz), np.where(y, 1.0, -1.0)
    w = toxicity.solve(x, sign)
    weight = np.where(y, 1 / y.sum(), 1 / (~y).sum()) * len(y) / 2
    loss = lambda v: (weight * np.maximum(0, 1 - sign * (x @ v[:-1] + v[-1])) ** 2).sum() + toxicity.RIDGE * (v[:-1] ** 2).sum() + 1e-6 * v[-1] ** 2
    assert all(loss(w) <= loss(w + 1e-3 * rng.standard_normal(len(w))) for _ in range(200))
    m = toxicity.Model(texts, y.tolist())
    want = [1 / (1 + np.exp(-(m.scale * (sum(_plain_kernel(t, z) ** toxicity.POWER * a for t in s for z, a in zip(m.tokens, m.weights, strict=True)) + m.bias) + m.shift))) for s in sets]
    assert np.allclose(toxicity.Scorer(m)(texts), want, atol=1e-6)


def test_toxicity_ties_and_repeats(spark):
    rows = [(i, "you idiot clown" if i % 3 == 0 else f"a calm word{i % 5} here") for i in range(60)] * 2
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] * 2, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = collections.defaultdict(set)
    for r in toxicity.score(docs.repartition(5), model).collect():
        got[dict(rows)[r["doc_id"]]].add(r["score"])
    assert all(len(s) == 1 for s in got.values()) and min(got["you idiot clown"]) > max(max(s) for t, s in got.items() if "calm" in t)


def test_toxicity_long_text():
    """One insult among 30,000 different words counts like one among three; the rest adds what its tokens add, each once."""
    m = toxicity.Model([f"you idiot x{k}" for k in range(30)] + [f"you calm y{k}" for k in range(30)], [1] * 30 + [0] * 30)
    words = [f"zq{k:05d}vw" for k in range(30_000)]
    score = toxicity.Scorer(m)
    many = " ".join([*words, "idiot", *words])
    parts = toxicity.Scorer(m).parts(sorted({*words, "idiot"}))
    want = 1 / (1 + np.exp(-(m.scale * (parts.sum() / toxicity.UNIT + m.bias) + m.shift)))
    assert abs(score([many])[0] - want) < 1e-12 and score([many, ""]).tolist() == [score([many])[0], score([""])[0]]


def test_toxicity_awkward(spark, awkward, empty):
    labels = spark.createDataFrame([(4, 1), (6, 0), (8, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    for m in (toxicity.fit(awkward, labels), toxicity.fit(awkward, labels.limit(0))):
        got = toxicity.score(awkward, m).collect()
        assert len(got) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in got)
        assert toxicity.score(empty, m).count() == 0


# ---- 7
def _links(rows, threshold):
    unit = {}
    for i, v, label in rows:
        x = np.array([np.nan if c is None else c for c in v], float) if v else np.zeros(0)
        if i is not None and label is not None and len(x) and np.isfinite(x).all() and x.any():
            unit[i] = (label, x / np.linalg.norm(x))
    root, deg = {i: i for i, *_ in rows if i is not None}, collections.Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(unit)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= threshold:
                deg[a] += 1
                deg[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (deg[i], find(i)) for i in root}


def test_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).round(3).tolist(), int(i % 3)) for i in range(300)]
    hub = rng.standard_normal(8)
    rows += [(300 + i, (hub + 0.03 * rng.standard_normal(8)).tolist(), 1) for i in range(80)]
    rows += [(400, rows[0][1], 0), (401, [2 * x for x in rows[0][1]], 0), (402, None, 0), (403, [0.0] * 8, 0), (404, [1.0, None] * 4, 0), (405, [float("nan")] * 8, 0), (406, rows[0][1], None), (407, [], 0)]
    df = spark.createDataFrame([(*r, "e") for r in rows], "vec_id long, embedding array<double>, label int, key string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.vector_dedup(df).collect()}
    assert got == _links(rows, 0.93)
    assert vector_dedup.vector_dedup(df.limit(0)).count() == 0


def _blobs(sizes, seed):
    """Tight groups whose centres are at 0.95: every list fills inside its own group, links across stay below its places."""
    rng, rows = np.random.default_rng(seed), []
    for g, n in enumerate(sizes):
        centre = np.zeros(16)
        centre[0], centre[1 + g] = 0.95**0.5, 0.05**0.5
        rows += [(len(rows) + i, (centre + 0.002 * rng.standard_normal(16)).tolist(), 0) for i in range(n)]
    return rows


def test_vectors_saturated_lists(spark):
    rows = _blobs([30, 30, 5], 6)
    rows += [(100 + i, v, 1) for i, v, _ in _blobs([20, 20], 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.vector_dedup(df).collect()}
    assert got == _links(rows, 0.93) and got[0] == (64, 0) and got[100] == (39, 100)


def test_vectors_failing_audit_compares_all(spark, monkeypatch):
    rows = _blobs([9, 8], 8)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    begin = vector_dedup.start
    monkeypatch.setattr(vector_dedup, "start", lambda *a: begin(*a).limit(0))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.vector_dedup(df, most_tries=1).collect()}
    assert got == _links(rows, 0.93)


def test_vector_units():
    import pyarrow as pa

    rows = [[3.0, 4.0], None, [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [], [-0.0, -2.0], [1.0, 2.0, 2.0], [1e300, 1e300]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array([0] * len(rows)), pa.array(rows, pa.list_(pa.float64()))], names=["id", "label", "x"])
    got = next(iter(vector_dedup._units([batch])))
    vec = [None if v is None else np.frombuffer(v).round(6).tolist() for v in got.column(2).to_pylist()]
    assert vec == [[0.6, 0.8], None, None, None, None, None, [0.0, -1.0], [0.333333, 0.666667, 0.666667], [0.707107, 0.707107]]
    assert got.column(4).to_pylist() == [2, 0, 0, 0, 0, 0, 2, 3, 2]


def test_vectors_over_several_blocks(spark, monkeypatch):
    """Components of many blocks: each pair of blocks counts for both sides, copies with their number."""
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    rows = _blobs([70, 40], 9)
    rows += [(200 + i, rows[i][1], 0) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.vector_dedup(df).collect()}
    assert got == _links(rows, 0.93)


# ---- 8
def test_counts_equal_library(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer, models

    v = token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    t = Tokenizer(models.Unigram([("<unk>", 0.0), *[(f"<0x{b:02X}>", 0.0) for b in range(256)], *v], 0, True))
    for r in token_counts.query(spark, DATA).collect():
        assert r["n_tokens"] == len(t.encode(token_counts.normalised(dict(documents)[r["doc_id"]] or "")).ids)


def test_counts_ties_and_awkward(awkward, empty):
    from tokenizers import Tokenizer, models

    v = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("▁", -1.0), ("▁a", -2.0), ("a▁", -1.5)]
    for pieces in (v[:-1], v):
        m = token_counts.Viterbi(pieces)
        c = token_counts.Counter(m)
        t = Tokenizer(models.Unigram([("<unk>", 0.0), *[(f"<0x{b:02X}>", 0.0) for b in range(256)], *pieces], 0, True))
        texts = ["", "a", "ababa b a", "zz é ab", "  a  b", "abba" * 20]
        assert c.counts(texts) == [len(t.encode(token_counts.normalised(x)).ids) for x in texts]
    import public_tokenizers

    model = token_counts._viterbi(public_tokenizers.path("piece_bpe_32k.model"))
    want = collections.Counter((i, model.count(token_counts.normalised(x or ""))) for i, x, _ in AWKWARD)
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in token_counts.count_tokens(awkward).collect()) == want
    assert token_counts.count_tokens(empty).count() == 0


# ---- 9
def test_lines(spark, awkward, empty):
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.dedup_lines(awkward).collect()}
    assert got[9] == ("a\nb\nc\nd", 4, 0) and got[10] == ("z", 4, 3) and got[1][0] is None and got[7] == (LONG + " tail", 1, 0)
    assert line_dedup.dedup_lines(empty).count() == 0
    long = " ".join(f"p{k}" for k in range(60))
    rows = [(1, f"u\n{long}\n{long}1\n{long}2\nv", 7), (2, f"x\n{long}\n{long}1\n{long}2\ny", 8), (3, "r\nr\nr\nr\nr", 9), (4, f"a\n{long}\nb", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: rows[0][1], 2: "x\ny", 3: "r", 4: rows[3][1]}
    assert {r["n_lines"] for r in line_dedup.dedup_lines(df, counts=False).collect()} == {7, 8, 9, 1}


# ---- 10
@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shards(spark, documents, law):
    rows = kd_shards.kd_shards(spark.read.parquet(f"{DATA}/documents.parquet"), shards=24, law=law).collect()
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        text = (dict(documents)[r["doc_id"]] or "").encode()
        assert r["size"] == len(text) + 8 and r["text_crc32"] == zlib.crc32(text)
        size[r["shard"]] += r["size"] if law == "bytes" else 1
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == len(documents) and all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < 24
    if law == "rows":
        assert max(size.values()) - min(size.values()) <= 1
    else:
        assert max(size.values()) - min(size.values()) <= max(r["size"] for r in rows)


def _plain_tree(rows, shards, law):
    """A k-d tree by sorting: rows are (row, size, tie, grid); the place of each row's leaf."""
    wide = kd_shards.TIES
    weight = (lambda r: r[1]) if law == "bytes" else (lambda r: 1)
    leaves, out = [(rows, [(0, kd_shards.GRID)] * len(rows[0][3]), shards)], []
    while any(c > 1 for *_, c in leaves):
        then = []
        for node in leaves:
            some, box, c = node
            if c == 1:
                out.append((node, None))
                then.append(node)
                continue
            d = max(range(len(box)), key=lambda i: (box[i][1] - box[i][0], -i))
            order = sorted(some, key=lambda r: r[3][d] * wide + r[2])
            aim, before, cut = sum(map(weight, some)) * (c // 2) / c, 0.0, 0
            for r in order:
                w = weight(r)
                if before + w > aim and aim - before < w / 2:
                    break
                before, cut = before + w, cut + 1
                if before > aim:
                    break
            key = order[cut - 1][3][d] * wide + order[cut - 1][2] if cut else box[d][0] * wide - 1
            left, right = list(box), list(box)
            left[d], right[d] = (box[d][0], min(box[d][1], key // wide + 1)), (max(box[d][0], (key + 1) // wide), box[d][1])
            then += [(order[:cut], left, c // 2), (order[cut:], right, c - c // 2)]
        leaves = then
    return {r[0]: i for i, (some, *_) in enumerate(leaves) for r in some}


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_shards_equal_a_plain_tree(spark, law):
    """The same leaves as a tree that sorts all rows at each node: which rows lie together, and how leaves are filled."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    dims = ["doc_id", "lang", "source"]
    meta = [r.asDict() for r in kd_shards.metadata(docs, "doc_id", "text", dims).collect()]
    ends = [(min(r["_at"][i] for r in meta), max(r["_at"][i] for r in meta)) for i in range(4)]
    grid = lambda r: [min(int((x - lo) / max(hi - lo, 1e-300) * (kd_shards.GRID - 1)), kd_shards.GRID - 1) for x, (lo, hi) in zip(r["_at"], ends, strict=True)]
    for shards in (2, 5, 8):
        plain = _plain_tree([(r["_id"], r["_size"], r["_tie"], grid(r)) for r in meta], shards, law)
        got = {r["doc_id"]: r["shard"] for r in kd_shards.kd_shards(docs, shards=shards, law=law).collect()}
        groups = lambda of: {frozenset(i for i in of if of[i] == s) for s in set(of.values())}
        a, b = groups(plain), groups(got)
        moved = sum(min(len(x ^ y) for y in b) for x in a)
        assert moved == 0 if law == "rows" else moved <= 2 * shards  # by bytes a bin within the tolerance may stay whole


def test_copies_are_rows_like_others(spark):
    """A text that makes up a third of all rows is spread, so that sizes stay near equal."""
    docs = spark.range(900).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'copy of one text', concat('t', id)) AS text")
    by = collections.Counter()
    for r in kd_shards.kd_shards(docs, shards=6).collect():
        by[r["shard"]] += r["size"]
    assert max(by.values()) - min(by.values()) <= 2 * 24


def test_shards_awkward(spark, awkward, empty):
    got = kd_shards.kd_shards(awkward, shards=3).collect()
    want = collections.Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in AWKWARD)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert kd_shards.kd_shards(empty, shards=3).count() == 0
    one = spark.range(200).selectExpr("7 AS doc_id", "'t' AS text")
    by = collections.Counter(r["shard"] for r in kd_shards.kd_shards(one, shards=4).collect())
    assert sorted(by.values()) == [50] * 4
    assert kd_shards.kd_shards(one, target_bytes=900).select("shard").distinct().count() == 2
