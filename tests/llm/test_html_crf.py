import html
import itertools
import random
import re
import tracemalloc

import numpy as np
import pytest

from emporium.llm import html_crf, queries


@pytest.fixture(scope="module")
def model():
    return html_crf.default_model()


def test_held_out_pages(model):
    pages = html_crf.training_pages(300, seed=501)
    right = total = 0
    for blocks, labels in pages:
        got = model.viterbi(model.scores(blocks))
        right += sum(a == b for a, b in zip(got, labels))
        total += len(labels)
    assert right / total > 0.98


def test_viterbi_and_gradient_against_all_labelings(model):
    rng = random.Random(1)
    for _ in range(30):
        s = [rng.gauss(0, 2) for _ in range(7)]

        def value(y):
            v = sum(a for a, b in zip(s, y) if b) + model.start * y[0]
            return v + sum(model.move[2 * a + b] for a, b in zip(y, y[1:]))

        best = max(itertools.product((0, 1), repeat=7), key=value)
        assert model.viterbi(s) == list(best)


def test_likelihood_rises_with_training():
    pages = html_crf.training_pages(60, seed=9)

    def right(m):
        return np.mean([a == b for bl, y in pages for a, b in zip(m.viterbi(m.scores(bl)), y)])

    assert right(html_crf.train(pages, rounds=60)) > right(html_crf.train(pages, rounds=1))


def test_query_on_the_pages_table(spark):
    rows = {r.page_id: r for r in queries.op8_html_crf(spark, "/root/testdata/sf0.01").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        inner = re.search(r"<article>(.*)</article>", p.html, re.S)[1]
        cut = re.split(r"</?(?:h1|p|ul|li)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
        want = "\n\n".join(t for t in (" ".join(html.unescape(x).split()) for x in cut) if t)
        assert rows[p.page_id].text == want and rows[p.page_id].n_chars == len(want)


def test_blocks():
    def texts(page):
        return [b.text for b in html_crf.leaf_blocks(page)]

    assert texts("a<b>b</b>c<br>d &amp; e&nbsp;f") == ["abc d & e f"]
    assert texts("<p>one<p>two<ul><li>x<li>y</ul>z") == ["one", "two", "x", "y", "z"]
    assert texts("<head><title>t</title><body><script>if (a<b) '<p>'</script><p>x</p>") == ["x"]
    assert texts("x <!-- <p>no</p> --> y 3 < 4 <p title='a>b'>z") == ["x y 3 < 4", "z"]
    assert texts("</p></div>stray<div class=") == ["stray"]
    assert texts("") == [] and texts("<style>p{}") == []


def test_parts_are_left_out(model):
    page = """<html><head><title>T</title></head><body><header class="top"><a href="/">Site</a></header><nav><ul><li><a href=/a>A</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies on this site. Please accept them.</p></div>
    <main><article><h1>The Title</h1><p>First paragraph of the story, with   space &amp; marks.</p><div class="advert">Buy this now, it is cheap.</div>
    <p>Second paragraph, which is a little longer than the first one was.</p></article></main>
    <aside class="sidebar"><p>Related stories are listed in this place.</p></aside><form><label>Mail</label><input><button>Go</button></form>
    <section id="comments"><h3>Comments</h3><div class="comment"><p>I like this text very much, thank you.</p></div></section>
    <footer>&copy; 2024 Site</footer></body></html>"""
    assert model.extract(page) == ("The Title\n\nFirst paragraph of the story, with space & marks.\n\n"
                                   "Second paragraph, which is a little longer than the first one was.")


def test_formulas_and_embedded_text_stay_in_their_line(model):
    def texts(page):
        return [b.text for b in html_crf.leaf_blocks(page)]

    assert texts("<p>Energy <math><mi>E</mi><mo>=</mo><mn>5</mn><annotation>E=5</annotation></math> is</p>") == ["Energy E=5 is"]
    assert texts("<p>a <object data=x>b</object> <video src=y>c</video> <svg><title>t</title><text>d</text></svg> e</p>") == ["a b c d e"]
    assert texts("<head><title>İİİ</title><link><body><p>x</p>") == ["x"]


def test_deep_pages_take_memory_and_time_in_proportion(model):
    def peak(n):
        page = "".join(f"<div class='c{i % 50}'>word {i}." for i in range(n)) + "</i></b></section>" * n + "<p>x<b>" * n
        tracemalloc.start()
        model.extract(page)
        used = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return used

    peak(100)
    small, large = peak(2_000), peak(8_000)
    assert large < 6 * small and large < 40e6
    assert [b.tag for b in html_crf.leaf_blocks("<div>" * 60_000 + "x")] == ["div"]


def test_score_of_ancestors_is_the_sum_of_their_features(model):
    page = "<main class=content><ul id=nav><li>a</li><li><b>b</b></li></ul><p>c</p></main><footer>d</footer>"
    for b in html_crf.leaf_blocks(page):
        assert model.above(b.above) == pytest.approx(sum(model.weights.get(f, 0.0) for f in html_crf.ancestors(b)))
        assert html_crf.Model({"in:ul": 2.0}).above(b.above) == (2.0 if b.tag == "li" else 0.0)


def test_odd_rows(spark):
    long = "<article>" + "<p>word word word, word.</p>" * 30_000 + "</article>"
    df = spark.createDataFrame([(1, "u", None, "x", 1), (2, None, "", "x", 1), (None, "u", "<p", "x", 1), (3, "u", long, "x", 1), (3, "u", long, "x", 1)],
                               "page_id long, url string, html string, text string, id int")
    out = html_crf.extract(df).collect()
    assert len(out) == 5 and {r.text for r in out if r.page_id in (1, 2)} == {""}
    assert [len(r.text.split("\n\n")) for r in out if r.page_id == 3] == [30_000] * 2
    assert html_crf.extract(df.limit(0)).count() == 0
