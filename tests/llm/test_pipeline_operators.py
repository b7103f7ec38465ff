"""Quality, decontamination, near duplicates, secrets and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from emporium.llm.common import IdBitmap
from emporium.llm import bag_minhash, components, decontaminate, quality_fm, queries, secret_scan
from emporium.llm.common import WordHashes, multiset, multiset_jaccard, shingles, word_hashes

ODD = "doc_id long, text string, lang string, source string, n_chars long, id string, key string, word string"


def odd_rows():
    long = " ".join(f"w{i % 9000}" for i in range(60_000))
    return [(1, None, None, None, None, "a", "b", "c"), (2, "", "en", "s", 0, None, None, None), (None, "no id here", "en", "s", 10, "1", "2", "3"),
            (3, long, "en", "s", len(long), "x", "y", "z"), (4, long, "en", "s", len(long), "x", "y", "z"),
            (4, long, "en", "s", len(long), "x", "y", "z"), (5, "one", "en", "s", 3, "", "", "")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD)


# quality

def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op1_quality_fm(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [x for x in labels if got[x.doc_id].held_out]
    right = [got[x.doc_id].predicted == x.quality for x in held]
    assert len(held) > 50 and np.mean(right) > 0.95


def test_pair_identity_equals_all_pairs():
    rng = np.random.default_rng(1)
    m = quality_fm.train([quality_fm.features(t) for t in ["a b c. D", "x | y | z", "k l m n o p"]], np.array([1, 0, 1.]), epochs=1)
    m.factors = rng.normal(size=m.factors.shape)
    index, value, starts = m.rows([quality_fm.features("a b a q. zz 12")])
    want = m.bias + (m.linear[index] * value).sum() + sum(
        m.factors[i] @ m.factors[j] * x * y for a, (i, x) in enumerate(zip(index, value)) for j, y in list(zip(index, value))[:a])
    assert m.margin(index, value, starts)[0][0] == pytest.approx(want)


def test_quality_odd_rows(spark, odd):
    empty = quality_fm.fit(odd, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality_fm.score(odd, empty).collect()} == {0.5}
    model = quality_fm.fit(odd, spark.createDataFrame([(3, 1), (3, 1), (5, 0), (2, 0), (2, 1), (None, 1), (4, None)], "doc_id long, quality int"))
    assert quality_fm.score(odd, model).count() == 7
    assert quality_fm.score(odd.limit(0), model).count() == 0
    kept = quality_fm.keep(odd, model)
    assert kept.schema == odd.schema and kept.where("doc_id = 3").count() == 1


# near duplicates

def classes_by_brute_force(rows):
    cache, best = WordHashes(), {}
    bags = {i: multiset(shingles(word_hashes(t, cache))) for i, t in rows}
    best = {i: i for i in bags}

    def root(x):
        while best[x] != x:
            x = best[x]
        return x

    ids = sorted(i for i in bags if len(bags[i][0]))
    by = defaultdict(list)
    for i in ids:
        for h in set(bags[i][0].tolist()):
            by[h].append(i)
    for a, b in {(a, b) for v in by.values() for n, a in enumerate(v) for b in v[n + 1:]}:
        if multiset_jaccard(bags[a], bags[b]) >= 0.8:
            a, b = sorted((root(a), root(b)))
            best[b] = a
    return {i: root(i) for i in bags}


def test_near_duplicates_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(3000)]
    n = 10_000
    for g in range(12):  # families around and over the threshold
        base = rng.choices(vocabulary, k=rng.choice([12, 60, 200, 400]))
        for _ in range(rng.choice([2, 5, 25])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((n, " ".join(w)))
            n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in bag_minhash.near_duplicates(spark, df).collect()}
    want = classes_by_brute_force(rows)
    wrong = [i for i in want if want[i] != got[i]]
    assert len(wrong) <= 0.002 * len(want), wrong[:10]
    assert any(i != c for i, c in want.items())


def test_no_text_is_exchanged_for_ids_of_one_text(spark, monkeypatch):
    """Both scans of the texts pass a bitmap of the ids they are looked for by, whatever may be broadcast."""
    plans = {}
    real = bag_minhash.cut

    def cut(spark, df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(spark, df, name)
    monkeypatch.setattr(bag_minhash, "cut", cut)
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, "other words " * 9), (3, " ".join(words[1:]))]
    got = {tuple(r) for r in bag_minhash.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False)}
    assert plans["candidates"].count("getbit") >= 2


def test_signature_is_unbiased():
    rng = np.random.default_rng(0)
    for scale in (1, 40):
        u = np.sort(rng.integers(1, 1 << 62, 80).astype(np.uint64))
        a, b = rng.integers(1, 6, 80) * scale, rng.integers(1, 6, 80) * scale
        s = bag_minhash.signatures([(u, a), (u, b)], 4000)
        assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.035


def test_near_duplicates_odd_rows(spark, odd):
    got = bag_minhash.near_duplicates(spark, odd).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.kept) for r in got) == [
        (0, 0, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 3, False), (4, 3, False), (5, 5, True)]
    kept = bag_minhash.drop_copies(spark, odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 5]
    assert bag_minhash.drop_copies(spark, odd.limit(0)).count() == 0
    twice = odd.where("doc_id = 5").union(odd.where("doc_id = 5"))
    assert bag_minhash.drop_copies(spark, twice).count() == 1


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    rng.shuffle(links)
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r.node: r.component for r in components.components(spark, spark.createDataFrame([*links, (1, None)], "a long, b long").where("b is not null")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_components_of_small_classes_take_few_steps(spark, monkeypatch):
    """Classes around a node or two are done after a step or two; only long paths go through the stars."""
    written = []
    monkeypatch.setattr(components, "cut", lambda s, df, name, f=components.cut: written.append(name) or f(s, df, name))
    rng = random.Random(8)
    name = lambda x: (x * 0x9E3779B97F4A7C15 + 77) % (1 << 63)
    links = [(name(10 * c + rng.randrange(k)), name(10 * c + k)) for c in range(300) for k in range(1, rng.randrange(2, 5))]
    of = lambda rows: {r.node: r.component for r in components.components(spark, spark.createDataFrame(rows, "a long, b long")).collect()}
    got = of(links)
    classes = {}
    for node in got:
        classes.setdefault((node - 77) * pow(0x9E3779B97F4A7C15, -1, 1 << 63) % (1 << 63) // 10, set()).add(node)
    assert len(classes) == 300 and all({got[n] for n in c} == {min(c)} for c in classes.values())
    assert written.count("step") <= 3 and "large" not in written
    written.clear()
    assert of([(i, i + 1) for i in range(90)]) == {i: 0 for i in range(91)} and written.count("step") == 1 and "large" in written
    assert of([(1, 1)]) == {}


# decontamination

def test_decontamination_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.matches(spark, docs, items).collect()}
    d = [(r.doc_id, r.text) for r in docs.collect()]
    i = [(r.item_id, r.text) for r in items.collect()]
    assert {(a, b) for a, t in d for b, x in i if x in t} <= set(got)
    cache, ix, want = WordHashes(), decontaminate.ItemIndex(i), {}
    texts = [(a, word_hashes(t, cache)) for a, t in d]
    for at in ix.touched([w for _, w in texts]):
        a, w = texts[at]
        for k, item in enumerate(ix.ids):
            size = min(len(w), len(ix.grams[k]) + 4)
            for start in range(len(w) - size + 1):
                s = ix.similarity(shingles(w[start:start + size]), k)
                if s >= 0.8:
                    want[a, item] = max(s, want.get((a, item), 0))
    assert set(got) == set(want)
    assert all(got[k].similarity == pytest.approx(want[k]) for k in want)


def test_blocks_reach_every_fingerprint_in_the_radius():
    rng = random.Random(2)
    ix = decontaminate.ItemIndex([(7, " ".join(f"w{i}" for i in range(30)))])
    mark, (_, tables) = int(ix.prints[0]), ix.sizes[30]
    for _ in range(3000):
        other = mark
        for b in rng.sample(range(64), decontaminate.RADIUS):
            other ^= 1 << b
        assert any(0 in tables[k].get(other >> 8 * k & 255, ()) for k in range(8))


def test_decontamination_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, "one"), (2, None), (3, ""), (4, "no id here"), (None, "w1 w2 w3 w4 w5 w6 w7"), (1, "one")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(spark, odd, items).collect()}
    assert got == {(5, 1), (None, 4), (3, None), (4, None)}
    assert {r.doc_id for r in decontaminate.clean(spark, odd, items).collect()} == {1, 2}
    assert decontaminate.clean(spark, odd, items).columns == odd.columns
    assert decontaminate.matches(spark, odd.limit(0), items).count() == 0
    assert decontaminate.matches(spark, odd, items.limit(0)).count() == 0
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(spark, odd, items, block_bytes=16).collect()} == got


def test_decontamination_does_not_depend_on_blocks(spark):
    """Fifty items that share shingles: weights come from all of them in every block."""
    rng = random.Random(4)
    common = [f"c{n}" for n in range(60)]
    items = [(k, " ".join(common[k % 5 * 8:k % 5 * 8 + 20] + [f"i{k}x{n}" for n in range(14)])) for k in range(50)]
    docs = []
    for k, text in items:
        words = text.split()
        docs.append((k, " ".join(["before"] * 3 + words + ["after"] * 3)))
        for n in (1, 2):
            words[rng.randrange(len(words))] = f"new{n}"
            docs.append((100 * n + k, " ".join(words)))
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontaminate.matches(spark, d, i).collect())
    assert {(k, k) for k in range(50)} <= {(a, b) for a, b, _ in whole}
    assert sorted((r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontaminate.matches(spark, d, i, block_bytes=1500).collect()) == whole


def test_bitmap_never_loses_an_id(spark):
    wanted = spark.range(0, 60_000, 7)
    rows = spark.createDataFrame([(None, "x")], "id long, t string").union(spark.range(60_000).selectExpr("id", "cast(id as string)"))
    ids = IdBitmap(spark, wanted)
    among = ids.rows(rows, "id", among=True).collect()
    assert {r.id for r in among} >= set(range(0, 60_000, 7)) and len(among) < 1.1 * 60_000 / 7
    assert ids.rows(rows, "id", among=False).count() == 60_001 - len(among)
    assert IdBitmap(spark, wanted.limit(0)).rows(rows, "id", among=True).count() == 0


# secrets

def base_by_contract(text):
    out = []
    p = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    for k, (name, rx) in enumerate((("assign", p), ("access", re.compile("AKIA[A-Z0-9]+")), ("hex", re.compile("[0-9a-f]+")))):
        for m in rx.finditer(text):
            if (len(m[2]) >= 8 if k == 0 else len(m[0]) >= (16, 32)[k - 1]):
                out.append((m.start(), k, f"{name}:{m.start()}:{m.end()}"))
    return [x for _, _, x in sorted(out)]


def test_secrets_keep_the_base_and_add_random_strings(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op6_secret_scan(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_by_contract(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(","))
        n = Counter(x.split(":")[0] for x in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (n["assign"], n["access"], n["hex"])


def test_token_efficiency(spark):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        eff = secret_scan.Efficiency(f.read(), public_tokenizers.PATTERN)
    rng = random.Random(1)
    key = "".join(rng.choices("abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789", k=40))
    for text, want in ((f"use {key} now", [key]), ("d41d8cd98f00b204e9800998ecf8427e", []), ("D41D8CD98F00B204E9800998ECF8427E", []),
                       ("123e4567-e89b-12d3-a456-426614174000", []), ("customer_account_id_2024_final", []),
                       ("internationalization2024", []), ("a" * 50, []), ("1" * 50, []), (f"PASSWORD = '{key}'", [])):
        base, spans = secret_scan.find(text, eff)
        assert [text[s:e] for s, k, e in spans if k == 3] == want, text
    assert secret_scan.find("é password='short'  Token: \"abcdefgh\"", eff)[0] == [(20, 0, 36)]


def test_a_worker_holds_the_caches_of_one_operator():
    from emporium.llm import common
    caches = common._CACHES
    assert any(c is quality_fm._words for c in caches) and any(c is secret_scan._LOADED for c in caches)
    quality_fm.features("some words of a text")
    bag_minhash._cache["word"]
    common.keep_only(bag_minhash._cache)
    assert not quality_fm._words and bag_minhash._cache
    assert quality_fm.features("some words of a text")[2] == quality_fm.features("some words of a text")[2]
    common.keep_only()
    assert not bag_minhash._cache


def test_random_strings_of_letters_and_beside_base_spans():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        eff = secret_scan.Efficiency(f.read(), public_tokenizers.PATTERN)
    rng = random.Random(7)

    def tokens(text):
        base, spans = secret_scan.find(text, eff)
        assert [s for s in spans if s[1] < 3] == base
        return [text[s:e] for s, k, e in spans if k == 3]

    found = 0
    for letters in ("abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        for tail in ("", "7", "2024"):
            for _ in range(50):
                key = "".join(rng.choices(letters, k=40)) + tail
                found += tokens(f"use {key} now") == [key]
    assert found >= 0.97 * 300
    for name in ("Rechtsschutzversicherungsgesellschaften", "anticonstitutionnellement", "getUserAccountInformation", "INTERNATIONALIZATION",
                 "getUser_accountInformationOf", "MAX_CONNECTION_POOL_SIZE_PER_HOST", "-" * 40, "a_b_c_d_e_f_g_h_i_j_k_l"):
        assert tokens(f"see {name} here") == [], name
    left, right = ("".join(rng.choices("bcdfghjkmnpqrstvwxzBCDFGHJKMNPQRSTVWXZ23456789", k=24)) for _ in range(2))
    for inside in ("AKIA" + "Q7" * 8, "0123456789abcdef" * 2):
        text = f"{left}_{inside}_{right}"
        assert "".join(tokens(text)).replace("_", "") == left + right
        assert secret_scan.masked(text, secret_scan.find(text, eff)[1]).replace("[SECRET]", "").strip("_") == ""
    assert tokens("build-2024-" + "0123456789abcdef" * 2) == []


def test_secret_odd_rows(spark, odd):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = secret_scan.scan(odd, path, pattern).collect()
    assert len(rows) == 7 and {r.spans for r in rows} == {""} and {r.base_sha256 for r in rows} == {hashlib.sha256(b"").hexdigest()}
    assert secret_scan.scan(odd.limit(0), path, pattern).count() == 0
    df = odd.withColumn("text", F.when(F.col("doc_id") == 5, "password=abcdefgh12 x").otherwise(F.col("text")))
    out = {r.doc_id: r for r in secret_scan.redact(df, path, pattern).collect()}
    assert (out[5].text, out[5].n_chars) == ("[SECRET] x", 10) and out[1].text is None and out[3].text == odd_rows()[3][1]


# the pipeline

def test_pipeline_keeps_clean_documents_and_drops_the_rest(spark):
    sf = "/root/testdata/sf0.01"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "minhash_near_dedup", "benchmark_decontamination", "secret_scan", "bpe_encoding"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf)
        assert after.columns == docs.columns
        assert 0.5 * before.count() < after.count() <= before.count(), name
        before = after
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    left = {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()}
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(left & bad) <= 0.05 * len(bad)
    assert left == {r.doc_id for r in before.select("doc_id").collect()}


def test_pipeline_stages_on_odd_and_empty_input(spark, odd):
    for df in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, "/root/testdata/sf0.001")
            out.count()
            if name != "bpe_encoding":
                assert out.columns == df.columns


def test_each_text_of_a_repeated_id_is_compared(spark):
    """An id of two texts: a copy with one word changed of either one is in its class."""
    rng = random.Random(31)
    a, b, other = ([rng.choice("abcdefgh") + str(rng.randrange(9000)) for _ in range(150)] for _ in range(3))
    a[0], b[0] = "aaa", "zzz"  # the id's smallest text is a
    near_a, near_b = [*a[:-1], "changed"], [*b[:-1], "changed"]
    rows = [(5, " ".join(a)), (5, " ".join(b)), (7, " ".join(near_b)), (9, " ".join(near_a)), (3, " ".join(other)), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id, r.kept) for r in bag_minhash.near_duplicates(spark, df).collect())
    assert got == [(3, 3, True), (5, 5, True), (5, 5, True), (5, 5, True), (7, 5, False), (9, 5, False)]
    assert sorted(r.doc_id for r in bag_minhash.drop_copies(spark, df).collect()) == [3, 5]


def test_a_batch_holds_few_megabytes_of_text(spark):
    from emporium.llm import common as C

    was = spark.conf.get(C._BATCH_KEY, None)
    sizes = lambda it: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in it)
    texts = spark.range(0, 4000, 1, 1).selectExpr("repeat('abcd', 1000) as text")
    try:
        spark.conf.set(C._BATCH_KEY, C._BATCH_DEFAULT)
        C.importable(spark)
        got = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
        assert sum(got) > 16_000_000 and max(got) < 1.2 * C.BATCH_BYTES
        spark.conf.set(C._BATCH_KEY, "1000000")  # a session's own setting stays
        C.importable(spark)
        assert max(r.n for r in texts.mapInArrow(sizes, "n long").collect()) < 1_200_000
    finally:
        spark.conf.set(C._BATCH_KEY, was) if was else spark.conf.unset(C._BATCH_KEY)
