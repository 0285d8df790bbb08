"""Main text of pages: generated ones, those of the tables, and broken ones; the decoding against all sequences."""

from __future__ import annotations

import random
import re
import time
from html import unescape

import pytest

from shelfmark.llm import extraction


@pytest.fixture(scope="module")
def trained():
    return extraction.trained()


def test_extraction(spark, trained):
    field = trained
    good = total = 0
    for i in range(100):
        page, labels = extraction.labelled_page(9_000_000 + i)
        found = field.decode(extraction.blocks(page))
        total += len(labels)
        good += sum(a == b for a, (_, b) in zip(found, labels, strict=True))
    assert good / total > 0.98
    page = '<body><nav><a href=x>Menu</a></nav><article><h1>T&amp;C</h1><p>One\n <b>two</b>.<p>Three<script>"</p>"</script> four.</article><footer>&copy; x</footer>'
    pages = spark.createDataFrame([(1, "u", page, 5, "a"), (1, "u", page, 5, "a"), (2, None, None, 0, None), (3, "", "", 0, None)], "page_id long, url string, html string, n_chars int, b string")
    got = extraction.extract(pages, field)
    assert got.columns == ["page_id", "url", "b", "text", "n_chars"]
    rows = sorted((r["page_id"], r["text"], r["n_chars"]) for r in got.collect())
    assert rows == [(1, "T&C\nOne two.\nThree four.", 24)] * 2 + [(2, "", 0), (3, "", 0)]
    assert extraction.extract(pages.limit(0), field).isEmpty()


def test_viterbi_is_the_best_sequence():
    field = extraction.Field({"a": (0.3, 0.9), "b": (1.1, 0.2)}, ((0.5, -0.4), (-0.7, 0.6)), (0.1, -0.2))
    rng = random.Random(4)
    for _ in range(20):
        found = [extraction.Block("", [rng.choice("abc")]) for _ in range(6)]
        score = lambda ys: sum(field.weights.get(b.features[0], (0, 0))[y] for b, y in zip(found, ys)) + field.start[ys[0]] + sum(field.moves[x][y] for x, y in zip(ys, ys[1:]))  # noqa: B023,E731
        assert score(field.decode(found)) == pytest.approx(max(score([m >> k & 1 for k in range(6)]) for m in range(64)))



@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


def article(page):
    """What a reader of the tables' pages finds, by patterns alone."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:h1|p)>", re.sub(r"<br>", " ", inner))
    return "\n".join(t for t in (" ".join(unescape(re.sub(r"</?b>", "", x)).split()) for x in parts) if t)


def test_pages_of_the_tables(pages, trained):
    rows = pages.collect()
    for field in (trained, extraction.trained(pages)):  # one has seen no page of the tables
        assert all(extraction.main_text(r["html"], field) == article(r["html"]) for r in rows)


@pytest.mark.parametrize("tag", ["", "<div>", "<main>"])
def test_pages_without_article_tags(pages, tag):
    """The field does not stand on the article's tag alone."""
    field, good, total = extraction.trained(pages), 0, 0
    for r in pages.collect():
        labels = [extraction.main_by_tags(b.features) for b in extraction.blocks(r["html"])]
        page = r["html"].replace("<article>", tag).replace("</article>", tag.replace("<", "</"))
        good += sum(a == b for a, b in zip(field.decode(extraction.blocks(page)), labels, strict=True))
        total += len(labels)
    assert good / total > 0.98


def test_labels_by_rule(pages):
    sample = extraction.labelled_sample(pages, most=20)
    assert len(sample) == 20 and all(0 < sum(labels) < len(labels) for _, labels in sample)
    assert sum(any("in=article" in f for f in found) for found, _ in sample) == 10
    assert extraction.main_by_tags(["in=article", "in=body"]) == 1
    assert not any(map(extraction.main_by_tags, (["in=body"], ["in=article", "in=nav"], ["in=article", "named=comments"])))
    assert extraction.labelled_sample(pages.limit(0)) == []


BROKEN = ["<a " * 350_000, "<!--" * 250_000, "<div>x" * 100_000, "<" * 1_000_000, '<a b="' * 150_000, "<script>" * 100_000, "<svg>" * 100_000 + "</p>" * 100_000, "<x>" * 100_000 + "<h1>t</h1></y>" * 50_000, "<p><td>" + "<x>" * 100_000 + "<h1></h1>" * 50_000]


@pytest.mark.parametrize("page", BROKEN, ids=range(len(BROKEN)))
def test_broken_pages_take_time_by_length(page, trained):
    began = time.process_time()
    extraction.main_text(page, trained)
    assert time.process_time() - began < 6


def test_markup_by_html_rules():
    texts = lambda page: [b.text for b in extraction.blocks(page)]
    assert texts("<p title=it's>hello <b>there</b><p title='a>b'>c</p>x < y <3 </ >z") == ["hello there", "c", "x < y <3 z"]
    assert texts('<p class="a"id=b data-x="<p>">one</p><p\n>two<p/>three') == ["one", "two", "three"]
    assert texts("<SCRIPT>a</p></scripty></SCRIPT >b<style>c") == ["b"]
    assert texts("a<!--><p>b<!-- -- > --><!x><?y>c</3>d") == ["a", "bcd"]
    assert texts("a<p>b<p class='c>d<p>e") == ["a", "b"]  # the page ends inside a tag
    assert texts("a &am<b>p;</b> &amp;amp; &#x41;&nbsp;&lt;p&gt;") == ["a &amp; &amp; A <p>"]
    assert texts("a<svg><p>b</p></svg>c<template>d</template>e<svg>f") == ["acef"]
    assert extraction.blocks("<div class=x data-class=y>t")[0].features.count("named=x") == 1
    assert "named=y" not in extraction.blocks("<div class=x data-class=y>t")[0].features


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<body><nav><ul><li><a href=a>Home</a></ul></nav><article><p>The mark © 1990 stays.</p></article><footer>© 2020 Us</footer>", ["The mark © 1990 stays."]),
        ("<body><p>One paragraph that says a thing.</p><p>Another one that says some more of it.</p></body>", ["One paragraph that says a thing.", "Another one that says some more of it."]),
        ("<article><h1>A list</h1><ul><li><a href=1>First item</a></li><li><a href=2>Second item</a></li></ul></article>", ["A list", "First item", "Second item"]),
        ("<article><h1>Title</h1><p>Text that is long enough to be read.</p></article><ul><li>I liked this very much!</li><li>Me too, thank you for writing.</li></ul>", ["Title", "Text that is long enough to be read."]),
        ("<main><h1>Title</h1><p>Text that is long enough to be read.</p></main><aside><p>See also this</p></aside><footer><p>© 2021 All rights</p></footer>", ["Title", "Text that is long enough to be read."]),
    ],
    ids=["mark", "bare", "links", "readers", "main"],
)
def test_other_layouts(trained, page, want):
    assert extraction.main_text(page, trained).split("\n") == want


def test_sample_is_the_same_for_any_partitions(pages):
    one, many = (extraction.labelled_sample(pages.repartition(n), most=60) for n in (1, 23))
    assert one == many and len(one) == 60
