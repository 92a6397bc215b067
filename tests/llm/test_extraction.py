from __future__ import annotations

import html
import itertools
import random
import re

import numpy as np
import pytest

from tidemark.llm import crf_extraction as crf
from tidemark.llm import page_layouts, queries
from tidemark.llm.page_blocks import blocks, name_words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reader():
    return crf.Extractor(crf.learn())


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks():
    assert blocks(None) == blocks("") == blocks(" \n ") == []
    assert texts("plain &amp; simple") == ["plain & simple"]
    assert texts("<p>a <b>b</b>\n c<br>d<p>e<div>f</div>g") == ["a b c d", "e", "f", "g"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><th>f</table>") == ["a", "b", "c", "d", "e", "f"]
    assert texts('<a title="x > y" href=z>one</a> two') == ["one two"]
    assert texts("<script>var a = '<p>no</p>'</script><style>p{}</style><textarea><p>typed</textarea>yes") == ["<p>typed", "yes"]
    assert texts("<head><title>t</title></head>a<!-- <p>no --> b<!--> c<!doctype html> d<?x y> e") == ["a b c d e"]
    assert texts("<title>unclosed") == [] and texts("a<script>never closed") == ["a"] and texts("a<!-- never closed <p>b") == ["a"]
    assert texts("a < b <3 &am &lt;p&gt; &copy; &#233;&nbsp;x</nothing></p>y <p") == ["a < b <3 &am <p> © é x", "y"]
    assert texts('<p class="odd>one</p><p>two</p>') == ["two"] or texts('<p class="odd>one</p><p>two</p>') == ["one", "two"]
    assert name_words(' class="postBody main-content x1" id=Side href="class"') == ("post", "body", "main", "content", "x", "side")
    found = blocks('<div class="a"><nav><a href="#">link text</a> rest</nav>')[0]
    assert [name for name, _ in found.around] == ["div", "nav"] and found.linked == 8


@pytest.mark.parametrize("part", ["<div>", "<p>x", "<!--", "</div>", "<a b='", "&amp;", "<", "<script>", "<li>"])
def test_long_pages_take_linear_time(part, reader):
    import time

    def seconds(n):
        page = part * n
        began = time.perf_counter()
        blocks(page)
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(60_000) < 40 * max(seconds(6000), 1e-3)


def chain(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 7))
    return rng.standard_normal(n), rng.integers(0, 2, n), rng.standard_normal((2, 2, 2)), rng.standard_normal(2)


def path_score(labels, scores, same, links, first):
    total = first[labels[0]] + sum(s for s, main in zip(scores, labels, strict=True) if main)
    return total + sum(links[same[i]][labels[i - 1]][labels[i]] for i in range(1, len(labels)))


def test_viterbi_equals_all_labellings():
    assert crf.viterbi([], [], [], []) == []
    for seed in range(200):
        scores, same, links, first = chain(seed)
        found = crf.viterbi(scores.tolist(), same.tolist(), links.tolist(), first.tolist())
        best = max(itertools.product([0, 1], repeat=len(scores)), key=lambda y: path_score(y, scores, same, links, first))
        assert [int(x) for x in found] == list(best)


def test_likelihood_equals_all_labellings():
    rng = np.random.default_rng(5)
    links, first = rng.standard_normal((2, 2, 2)), rng.standard_normal(2)
    lengths = [5, 3, 3, 1]
    inside = np.arange(5)[None, :] < np.array(lengths)[:, None]
    scores, same, labels = rng.standard_normal((4, 5)) * inside, rng.integers(0, 2, (4, 5)), rng.integers(0, 2, (4, 5)) * inside

    def plain(scores, links, first):
        value = 0.0
        for i, n in enumerate(lengths):
            every = [path_score(y, scores[i, :n], same[i], links, first) for y in itertools.product([0, 1], repeat=n)]
            value += path_score(labels[i, :n], scores[i, :n], same[i], links, first) - np.log(np.exp(every).sum())
        return value

    value, by_score, by_links, by_first = crf.likelihood(scores, same, inside, labels, links, first)
    assert np.isclose(value, plain(scores, links, first))
    for slope, change in ((by_score, "scores"), (by_links, "links"), (by_first, "first")):
        for at in np.ndindex(slope.shape):
            moved = {"scores": scores.copy(), "links": links.copy(), "first": first.copy()}
            if change == "scores" and not inside[at]:
                assert slope[at] == 0
                continue
            moved[change][at] += 1e-5
            assert np.isclose((plain(**moved) - value) / 1e-5, slope[at], atol=1e-3)


def test_held_out_layouts(reader):
    pages = page_layouts.labelled_pages(300, 4242)
    assert [p.html for p in page_layouts.labelled_pages(3, 7)] == [p.html for p in page_layouts.labelled_pages(3, 7)]
    wrong = sum(a != b for p in pages for a, b in zip(reader.labels(blocks(p.html)), p.labels, strict=True))
    assert wrong < 0.005 * sum(len(p.labels) for p in pages)


ARTICLE = "<h1>A title of some words</h1><p>First paragraph, with a few words in it.</p><p>Of.</p><p>Another one <a href='/x'>with a link</a> inside it, and more.</p>"
MAIN = ["A title of some words", "First paragraph, with a few words in it.", "Of.", "Another one with a link inside it, and more."]


@pytest.mark.parametrize(
    "noise",
    [
        '<nav><ul><li><a href="/">Home</a></li><li><a href="/a">Words</a></li></ul></nav>',
        "<header><div>The name of the site</div><p>Some words as a motto.</p></header>",
        '<aside class="sidebar"><h3>Related</h3><ul><li><a href="/q">Other words here</a></li></ul></aside>',
        '<div class="ad">Some words that sell. Buy them today!</div>',
        '<div class="cookie-notice"><p>We use cookies on this site.</p><button>OK</button></div>',
        '<form action="/s"><label>Your name</label><input><p>Subscribe to our newsletter</p></form>',
        '<section id="comments"><h3>Comments</h3><div class="comment"><p>A reader wrote this, which is as long as a paragraph of the text.</p></div></section>',
        "<footer><p>&copy; 2024 some.example. All rights reserved.</p></footer>",
    ],
)
@pytest.mark.parametrize("shell", ["<article>{}</article>", '<div class="post-content">{}</div>', '<main id="content">{}</main>'])
def test_each_kind_of_noise(reader, noise, shell):
    for page in (noise + shell.format(ARTICLE), shell.format(ARTICLE) + noise):
        assert reader.text(f"<html><body>{page}</body></html>").split("\n") == MAIN
    inside = ARTICLE.replace("<p>Of.", noise + "<p>Of.")
    if "<header>" not in noise and "<footer>" not in noise:
        assert reader.text(f"<html><body>{shell.format(inside)}</body></html>").split("\n") == MAIN


def test_whole_table_equals_a_plain_reading(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = queries.op11_html_extraction(spark, SF).collect()
    assert {r.page_id for r in found} == set(pages) and len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*?)(?:</article>|$)", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?(?:b|br)>", " ", part)).split()) for part in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_odd_rows(spark, reader):
    rng = random.Random(1)
    long = "".join(f"<p>{' '.join(f'word{rng.randrange(999)}' for _ in range(50))}.</p>" for _ in range(3000))
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (3, "u", f"<article>{long}</article>", "t"), (4, "u", "<nav>x</nav>", "t"), (4, "u", "<nav>x</nav>", "t")]
    rows += [(None, "u", f"<html><body><article>{ARTICLE}</article>", "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = crf.extracted(df, crf.learn())
    got = sorted((str(r.row.page_id), r.row.text, len(r.text.split("\n")) if r.text else 0, r.n_chars == len(r.text)) for r in found.collect())
    assert got == [("1", "t", 0, True), ("2", "t", 0, True), ("3", "t", 3000, True), ("4", "t", 0, True), ("4", "t", 0, True), ("None", "t", 4, True)]
    assert crf.extracted(df.limit(0), crf.learn()).count() == 0
