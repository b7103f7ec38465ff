import itertools
import random
import re
from collections import Counter

from emporium.llm import license_scan, queries
from emporium.llm.common import WordHashes, word_hashes


def test_increasing_is_longest():
    rng = random.Random(1)
    for _ in range(60):
        v = rng.sample(range(20), 8)
        got = [v[i] for i in license_scan.increasing(v)]
        best = max((c for n in range(9) for c in itertools.combinations(v, n) if list(c) == sorted(c)), key=len)
        assert got == sorted(got) and len(got) == len(best)


def test_alignment_is_a_common_subsequence_and_whole_on_edits():
    rng = random.Random(2)
    for _ in range(100):
        b = [rng.randrange(60) for _ in range(rng.randint(1, 40))]
        a = list(b)
        for _ in range(rng.randint(0, 3)):
            a.insert(rng.randrange(len(a) + 1), 100 + rng.randrange(50))
        m = license_scan.align(a, b)
        assert all(a[i] == b[j] for i, j in m) and all(x[0] < y[0] and x[1] < y[1] for x, y in zip(m, m[1:]))
        assert len(m) >= 0.6 * len(b)
        if a == b:
            assert len(m) == len(b)


def naive(words, b, coverage, density, reach):
    """The best coverage over every window of the text."""
    best, need, of_b = 0, int(coverage * len(b) - 1e-9), Counter(b)
    for i in range(len(words)):
        if (Counter(words[i:i + reach]) & of_b).total() < need:  # too few equal words for any alignment
            continue
        hits = license_scan.align(words[i:i + reach], b)
        if hits and len(hits) >= density * (hits[-1][0] - hits[0][0] + 1):
            best = max(best, len(hits) / len(b))
    return best if best >= coverage - 1e-9 else 0


def test_regions_equal_all_windows():
    rng, cache = random.Random(3), WordHashes()
    s = license_scan.Scanner(license_scan.TEMPLATES)
    filler = "the of and to all rights license under version this software work copy notice lorem ipsum dolor".split()
    for _ in range(25):
        words = rng.choices(filler, k=rng.randint(0, 120))
        for name in rng.sample(list(license_scan.TEMPLATES), 2):
            t = license_scan.TEMPLATES[name].split()
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = rng.choice(filler)
            at = rng.randint(0, len(words))
            words[at:at] = t
        hashed = word_hashes(" ".join(words), cache)
        got = {f[0]: f[1] for f in s.find(hashed)}
        for name, b in s.templates.items():
            reach = max(len(b) + 2, int(license_scan.SPREAD * len(b)))
            want = naive(hashed.tolist(), b, s.coverage, s.density, reach)
            assert (name in got) == (want > 0) and got.get(name, 0) <= want + 1e-9, name


def test_query_finds_the_planted_lines(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r.doc_id, r.template) for r in queries.op4_license_scan(spark, sf).where("coverage = 1").collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        for name, t in license_scan.TEMPLATES.items():
            if t in r.text:
                assert (r.doc_id, name) in got
    everything = queries.op4_license_scan(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(re.search(r"licen[sc]e|rights reserved", texts[r.doc_id], re.I) for r in everything)


def test_repeats_edits_and_odd_rows(spark):
    mit, apache = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["Apache-2.0-notice"]
    edited = mit.replace("free of charge", "without any charge").replace("merge,", "join,")
    long = "the of and " * 100_000 + apache + " end " * 50_000
    df = spark.createDataFrame([(1, f"{mit}\n{mit}\n{mit}", "x"), (2, edited, "x"), (3, None, None), (4, "", ""), (None, apache, ""), (5, long, ""), (6, "rights", ""),
                                (7, apache, ""), (7, apache, "")], "doc_id long, text string, template string")
    got = {(r.doc_id, r.template): r for r in license_scan.scan(df).collect()}
    assert got[1, "MIT"].n_found == 3 and got[1, "MIT"].coverage == 1
    assert 0.9 < got[2, "MIT"].coverage < 1
    assert got[5, "Apache-2.0-notice"].first_word == 300_000 and got[5, "Apache-2.0-notice"].coverage == 1
    assert set(got) == {(1, "MIT"), (2, "MIT"), (None, "Apache-2.0-notice"), (5, "Apache-2.0-notice"), (7, "Apache-2.0-notice")}
    assert license_scan.scan(df).count() == 6
    assert license_scan.scan(df.limit(0)).count() == 0 and license_scan.scan(df, {"none": ""}).count() == 0


def test_neighbouring_licenses_are_told_apart(spark):
    t = license_scan.TEMPLATES
    cases = [("This work is licensed under the GNU Lesser General Public License, version 3", "LGPL-3.0-notice"),
             ("This work is licensed under the GNU Lesser General Public License, version 2.1", "LGPL-2.1-notice"),
             ("This work is licensed under the GNU General Public License, version 2", "GPL-2.0-notice"),
             ("This work is licensed under the GNU General Public License, version 3", "GPL-3.0-notice"),
             ("This work is licensed under the GNU Affero General Public License, version 3", "AGPL-3.0-notice"),
             ("Licensed under the Mozilla Public License, version 2.0.", "MPL-2.0-notice"),
             ("Released under the BSD License.", "BSD-notice"), ("Released under the Artistic License.", None),
             ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0-short"), ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0-short"),
             ("Licensed under CC BY 4.0.", "CC-BY-4.0-short"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0-notice"),
             ("# SPDX-License-Identifier: Apache-2.0", "SPDX-Apache-2.0"), ("// SPDX-License-Identifier: MIT", "SPDX-MIT"),
             (t["MIT-whole"], "MIT-whole"), (t["BSD-2-Clause-whole"], "BSD-2-Clause-whole"), (t["BSD-3-Clause-whole"], "BSD-3-Clause-whole"),
             (t["BSD-3-Clause"], "BSD-3-Clause"), (t["LGPL-2.1"], "LGPL-2.1"), (t["GPL-2.0"], "GPL-2.0"), (t["AGPL-3.0"], "AGPL-3.0"), (t["MPL-2.0"], "MPL-2.0")]
    df = spark.createDataFrame([(i, f"first words of it\n{text}\nand some words after it") for i, (text, _) in enumerate(cases)], "doc_id long, text string")
    got = {}
    for r in license_scan.scan(df).collect():
        got.setdefault(r.doc_id, []).append(r.template)
    assert got == {i: [name] for i, (_, name) in enumerate(cases) if name}


def test_every_template_names_itself_in_edited_texts():
    rng, cache = random.Random(5), WordHashes()
    s = license_scan.Scanner(license_scan.TEMPLATES, telling=license_scan.TELLING)
    telling = {cache[w] for w in license_scan.TELLING}
    for name, text in license_scan.TEMPLATES.items():
        words = text.split()
        assert [f[0] for f in s.best(word_hashes(text, cache))] == [name]
        if len(words) > 40:
            free = [i for i, w in enumerate(words) if cache[w] not in telling]
            for i in rng.sample(free, len(words) // 20):
                words[i] = f"other{i}"
            got = s.best(word_hashes(" ".join(words), cache))
            assert [f[0] for f in got] == [name] and got[0][1] >= 0.9
