import random
import time
from collections import defaultdict

import numpy as np
import pyarrow as pa

from emporium.llm import paragraph_dedup as P
from emporium.llm.common import WordHashes, cut, text_hashes, word_hashes

WORDS = [f"u{i}" for i in range(9000)]


def flat(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")


def rows_with_passages(rng, n=240, edits=0):
    """Documents, of which every second holds one of 20 passages; where each lies."""
    passages = [flat(rng, rng.randint(51, 120)) for _ in range(20)]
    rows, where = [], defaultdict(list)
    for i in range(n):
        left, right = flat(rng, rng.randint(0, 150)), flat(rng, rng.randint(0, 150))
        p = []
        if i % 2 == 0:
            k = rng.randrange(20)
            p = list(passages[k])
            where[k].append((i, len(left), len(left) + len(p) - 1))
        elif i % 10 == 1:
            right += "the same short line of boilerplate that is in many documents".split()
        rows.append((i, [*left, *p, *right]))
    return rows, {k: v for k, v in where.items() if len(v) > 1}


def brute_force(rows, least):
    """(id, first, last) of the runs of ``least`` words and more that another document has."""
    owners = defaultdict(set)
    for i, t in rows:
        for k in range(len(t) - least + 1):
            owners[tuple(t[k:k + least])].add(i)
    out = set()
    for i, t in rows:
        covered = [False] * (len(t) + 1)
        for k in range(len(t) - least + 1):
            if len(owners[tuple(t[k:k + least])]) > 1:
                covered[k:k + least] = [True] * least
        start = None
        for k, c in enumerate(covered):
            if c and start is None:
                start = k
            if not c and start is not None:
                out.add((i, start, k - 1))
                start = None
    return out


def test_equal_passages_match_a_brute_force_search(spark):
    rows, where = rows_with_passages(random.Random(0))
    got = P.repeated(spark, frame(spark, rows)).collect()
    want = brute_force(rows, P.WORDS + P.REACH - 1)
    assert want == {x for v in where.values() for x in v}
    assert {(r.doc_id, r.first_word, r.last_word) for r in got} == want and all(r.n_words == r.last_word - r.first_word + 1 for r in got)
    by = {(r.doc_id, r.first_word): r for r in got}
    names = []
    for v in where.values():
        found = [by[i, a] for i, a, _ in v]
        assert len({r.cluster_id for r in found}) == 1 and [r.kept for r in found] == [i == min(v)[0] for i, _, _ in v]
        names.append(found[0].cluster_id)
    assert len(set(names)) == len(names)


def test_recall_by_edits(spark):
    """Copies of a passage with so many words changed, 60 pairs of documents each."""
    rng = random.Random(7)
    cases = [(55, 0, 1.0), (55, 1, 0.9), (100, 2, 0.9), (100, 4, 0.9), (55, 2, 0.75)]
    rows = []
    for c, (length, edits, _) in enumerate(cases):
        for k in range(60):
            p = flat(rng, length)
            q = list(p)
            for at in rng.sample(range(length), edits):
                q[at] = rng.choice(WORDS)
            for n, x in enumerate((p, q)):
                rows.append((1000 * c + 2 * k + n, [*flat(rng, rng.randint(5, 90)), *x, *flat(rng, rng.randint(5, 90))]))
    got = {r.doc_id for r in P.repeated(spark, frame(spark, rows)).collect()}
    found = [sum({1000 * c + 2 * k, 1000 * c + 2 * k + 1} <= got for k in range(60)) / 60 for c in range(len(cases))]
    assert all(f >= least for f, (_, _, least) in zip(found, cases)), found


def test_a_passage_and_part_of_it_are_one_cluster(spark):
    rng = random.Random(3)
    p = flat(rng, 130)
    rows = [(1, [*flat(rng, 40), *p, *flat(rng, 30)]), (2, [*p, *flat(rng, 60)]), (3, [*flat(rng, 80), *p[-70:], *flat(rng, 9)])]
    got = {r.doc_id: r for r in P.repeated(spark, frame(spark, rows)).collect()}
    assert len({r.cluster_id for r in got.values()}) == 1
    assert {i: (r.first_word, r.last_word, r.kept) for i, r in got.items()} == {1: (40, 169, True), 2: (0, 129, False), 3: (80, 149, False)}


def test_a_changed_word_between_two_equal_parts_is_covered(spark):
    rng = random.Random(5)
    p = flat(rng, 80)
    q = [*p[:40], "other", *p[41:]]
    rows = [(1, [*flat(rng, 30), *p, *flat(rng, 30)]), (2, [*flat(rng, 50), *q, *flat(rng, 30)])]
    got = {r.doc_id: (r.first_word, r.last_word) for r in P.repeated(spark, frame(spark, rows)).collect()}
    assert got == {1: (30, 109), 2: (50, 129)}


def test_odd_rows(spark):
    rng = random.Random(9)
    p, long = " ".join(flat(rng, 80)), " ".join(flat(rng, 20_000))
    rows = [(1, p), (2, p), (2, p), (None, p), (3, None), (4, ""), (5, "short"), (6, f"{long} {p}"), (7, "!! ?? " * 40), (8, "word " * 500), (9, "word " * 500)]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, start string, digest double")
    got = {r.doc_id: r for r in P.repeated(spark, df).collect()}
    assert set(got) == {1, 2, 6, 8, 9} and got[1].kept and not got[2].kept and not got[6].kept
    assert got[1].cluster_id == got[2].cluster_id == got[6].cluster_id and (got[6].first_word, got[6].last_word) == (20_000, 20_079)
    assert got[8].n_words == 500
    assert P.repeated(spark, df.limit(0)).count() == 0
    named = spark.createDataFrame([("a", p), ("b", p), ("5", p), ("6", p)], "doc_id string, text string")
    assert {r.doc_id for r in P.repeated(spark, named).collect()} == {5, 6}


def test_every_occurrence_in_a_document_is_reported(spark):
    """A passage that stands twice in a document has a stretch for both; one in a single document has none."""
    rng = random.Random(11)
    p, q = flat(rng, 90), flat(rng, 60)
    a, b = flat(rng, 80), flat(rng, 70)
    rows = [(1, [*flat(rng, 60), *p]), (2, [*a, *p, *b, *p]), (3, [*q, *flat(rng, 30), *q])]
    got = {(r.doc_id, r.first_word, r.last_word) for r in P.repeated(spark, frame(spark, rows)).collect()}
    assert got == {(1, 60, 149), (2, 80, 169), (2, 240, 329)}


def test_borders_are_winnowed_and_depend_on_the_words_beside_them():
    rng = np.random.default_rng(4)
    texts = [rng.integers(1, 1 << 60, n).astype(np.uint64) for n in (0, 24, 25, 30, 49, 50, 300, 3)]
    found = P.Paragraphs(texts)
    for d, t in enumerate(texts):
        grams, m = P.shingles(t), max(len(t) - P.WORDS + 1, 0)
        reach = min(P.REACH, m)
        want = sorted({j + int(np.argmin(grams[j:j + reach])) for j in range(m - reach + 1)}) if m else []
        assert found.start[found.doc == d].tolist() == want
    alone = P.Paragraphs([texts[6]])
    assert alone.digests().tolist() == found.digests()[found.doc == 6].tolist()
    assert [k.tolist() for k in alone.band_keys()] == [k[found.doc == 6].tolist() for k in found.band_keys()]


def test_edit_distances_match_the_plain_recurrence():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 6, (200, P.WORDS))
    b = a.copy()
    for i in range(200):
        for _ in range(i % 8):
            b[i, rng.integers(P.WORDS)] = rng.integers(6)
        if i % 3 == 0:
            b[i] = np.roll(b[i], 1)

    def plain(x, y):
        above = list(range(len(y) + 1))
        for i, u in enumerate(x, 1):
            row = [i]
            for j, v in enumerate(y, 1):
                row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (u != v)))
            above = row
        return above[-1]

    assert P.word_edits(a, b, 5).tolist() == [min(plain(x, y), 6) for x, y in zip(a.tolist(), b.tolist())]


def test_blocks_give_the_links_that_join_components():
    """Against all pairs: the same components, and no link that joins nothing anew."""
    rng = np.random.default_rng(2)
    base = rng.integers(1, 1 << 60, (6, P.WORDS)).astype(np.uint64)
    words = np.repeat(base, 8, 0)
    for row in words[1:]:
        row[rng.integers(P.WORDS, size=2)] = rng.integers(1, 1 << 60, 2)
    n = len(words)
    table = pa.table({"i": [0] * n, "j": [0] * n, "bucket": pa.array([5] * n, pa.int64()), "own": pa.array([0] * n, pa.int32()), "digest": pa.array(range(n), pa.int64()), "comp": pa.array(range(n), pa.int64()),
                      "body": P._binary(words)})
    got = P._joining_links(table, 5).to_pydict()
    assert len(got["a"]) == n - 6 and all(a // 8 == b // 8 for a, b in zip(got["a"], got["b"]))


def test_extension_ends_where_the_words_do():
    a = np.arange(1, 26, dtype=np.uint32)[None, :].repeat(5, 0)
    b = a.copy()
    b[0, 7:] = 99
    b[1, 4] = 99
    b[2] = 99
    b[3, 3:] = 99
    b[3, 9:10] = a[3, 9:10]  # a chance word beyond the end
    b[4, ::2] = 99
    assert P.extension(a == b).tolist() == [7, 25, 0, 3, 0]


def test_buckets_of_band_slices_are_those_of_all_bands(spark):
    rng = random.Random(3)
    rows = [(d, rng.randrange(12), *(100 * b + rng.randrange(40) for b in range(P.BANDS))) for d in range(60)]
    keys = [f"k{b}" for b in range(P.BANDS)]
    keyed = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in ["digest", "lo", *keys]))
    got = [tuple(r) for i in range(0, P.BANDS, P.SLICE) for r in P.in_buckets(spark, keyed, keys[i:i + P.SLICE]).collect()]
    members = defaultdict(list)
    for d, lo, *ks in rows:
        for k in ks:
            members[k].append((d, lo))
    want = [(k, d, lo, min(m)[0]) for k, m in members.items() if len({x for _, x in m}) > 1 for d, lo in m]
    assert sorted(got) == sorted(want)


def test_what_was_exchanged_for_a_table_goes_from_disk(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def exchanged():
        files = manager.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = exchanged(), spark.conf.get(key)
    out = cut(spark, spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "some")
    until = time.time() + 20
    while exchanged() - before and time.time() < until:
        time.sleep(0.2)
    assert not exchanged() - before
    assert sum(r["count"] for r in out.collect()) == 1000
    assert spark.conf.get(key) == was


def test_words_of_a_column_are_hashed_as_one_by_one():
    """The same hashes, and short words of common letters take no turn through the cache."""
    rng = random.Random(1)
    alpha = "ÀÞß×÷ÿĀΩΣДжאÈéaZbQİ .,-!'“”—\t\n\x0b\x1c\x1f\x00\x85\u00a0\u2003\u3000日😀9"
    texts = ["", None, " ", "!!!", " a ", "a\u00a0b", "A" * 31, "B" * 32, "C" * 33 + " d", "!" + "q" * 31 + "?", "Ω" * 15, "Ω" * 16, "ΑΣ ΑΣΑ", *("".join(rng.choices(alpha, k=rng.randrange(60))) for _ in range(3000)),
             *("".join(rng.choices("abcXYZ019,.", k=k)) for k in range(50))]
    column = pa.array(texts, pa.string())
    want = [word_hashes(t, WordHashes()).tolist() for t in texts]
    assert [h.tolist() for h in text_hashes(column, WordHashes())] == want
    assert [h.tolist() for h in text_hashes(column.slice(7, 100), WordHashes())] == want[7:107]
    assert text_hashes(column.slice(0, 0), WordHashes()) == [] and [len(h) for h in text_hashes(column.slice(0, 4), WordHashes())] == [0] * 4
    cache = WordHashes()
    text_hashes(pa.array(["Plain (words), déjà VU; Слова и ΛΟΓΟΙ. 12 3.5"] * 3), cache)
    assert not cache
    text_hashes(pa.array(["日本 \u201cso\u201d"]), cache)
    assert set(cache) == {"日本", "\u201cso\u201d"}


def test_a_linked_paragraph_belongs_to_the_cluster_of_its_copies(spark):
    """A paragraph of one document that differs by a word from one in two others, and one equal in two documents alone."""
    rng = random.Random(21)
    p, q = flat(rng, 60), flat(rng, 60)
    near = [*p[:30], "other", *p[31:]]
    rows = [(1, [*flat(rng, 40), *p]), (2, [*p, *flat(rng, 40)]), (3, [*flat(rng, 20), *near]), (4, q), (5, [*flat(rng, 9), *q])]
    got = {r.doc_id: r for r in P.repeated(spark, frame(spark, rows)).collect()}
    assert {i: (r.first_word, r.last_word, r.kept) for i, r in got.items()} == {1: (40, 99, True), 2: (0, 59, False), 3: (20, 79, False), 4: (0, 59, True), 5: (9, 68, False)}
    assert got[1].cluster_id == got[2].cluster_id == got[3].cluster_id != got[4].cluster_id == got[5].cluster_id
