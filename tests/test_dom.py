"""Trees against hand-made ones of the HTML standard's rules, and times of broken pages."""

from __future__ import annotations

import random
import time

import pytest

from shelfmark.operators.cards import find_cards, raw_card
from shelfmark.operators.dom import DEPTH, Node, of_class, of_tag, parse


def shown(node):
    """The body's inside as markup with every end."""
    return "".join(c if isinstance(c, str) else f"<{c.tag}>{shown(c)}</{c.tag}>" for c in node.children)


def body(page):
    return shown(parse("<!doctype html>" + page).first(of_tag("body")))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<b>1<p>2</b>3</p>", "<b>1</b><p><b>2</b>3</p>"),
        ("<p>1<b>2<i>3</b>4</i>5</p>", "<p>1<b>2<i>3</i></b><i>4</i>5</p>"),
        ("<a>1<p>2</a>3</p>", "<a>1</a><p><a>2</a>3</p>"),
        ("<a>1<div>2<div>3</a>4</div>5</div>", "<a>1</a><div><a>2</a><div><a>3</a>4</div>5</div>"),
        ("<a href=1>a<a href=2>b", "<a>a</a><a>b</a>"),
        ("<p><b>x<p>y</b>z", "<p><b>x</b></p><p><b>y</b>z</p>"),
        ("<b><b><b><b>x<p>y", "<b><b><b><b>x<p>y</p></b></b></b></b>"),
        ("<p><b><b><b><b>x</p><p>y", "<p><b><b><b><b>x</b></b></b></b></p><p><b><b><b>y</b></b></b></p>"),
        ("<b>a<div>b</div>c</b>d", "<b>a<div>b</div>c</b>d"),
        ("<font><p>hello<b>cruel</font>world", "<font></font><p><font>hello<b>cruel</b></font><b>world</b></p>"),
        ("<table><b><tr><td>aaa</td></tr>bbb</table>ccc", "<b></b><b>bbb</b><table><tbody><tr><td>aaa</td></tr></tbody></table><b>ccc</b>"),
        ("A<table><tr> B</tr> </em>C</table>", "A BC<table><tbody><tr></tr> </tbody></table>"),
        ("<table>A<td>x<td>y<tr><th>z</table>w", "A<table><tbody><tr><td>x</td><td>y</td></tr><tr><th>z</th></tr></tbody></table>w"),
        ("<table><caption>c<col><tbody><tr><td>1</table>", "<table><caption>c</caption><colgroup><col></col></colgroup><tbody><tr><td>1</td></tr></tbody></table>"),
        ("<table><tr><td><table><tr><td>in</table>out</table>", "<table><tbody><tr><td><table><tbody><tr><td>in</td></tr></tbody></table>out</td></tr></tbody></table>"),
        ("<table><td><b>x</td><td>y</td></table>z", "<table><tbody><tr><td><b>x</b></td><td>y</td></tr></tbody></table>z"),
        ("<table><a>1<tr><td>x</td></tr></a>2</table>", "<a>1</a>2<table><tbody><tr><td>x</td></tr></tbody></table>"),
        ("<ul><li>1<ul><li>2</ul><li>3<div><li>4</div></ul>", "<ul><li>1<ul><li>2</li></ul></li><li>3<div></div></li><li>4</li></ul>"),
        ("<dl><dt>a<dd>b<dt>c</dl>", "<dl><dt>a</dt><dd>b</dd><dt>c</dt></dl>"),
        ("<p>1<div>2</p>3</div>", "<p>1</p><div>2<p></p>3</div>"),
        ("<h1>1<h2>2</h1>3", "<h1>1</h1><h2>2</h2>3"),
        ("<p>a<button>b<p>c</button>d", "<p>a<button>b<p>c</p></button>d</p>"),
        ("<p>a<table><tr><td>b</table>c", "<p>a</p><table><tbody><tr><td>b</td></tr></tbody></table>c"),
        ("<select><option>1<option>2<div>3</select>4", "<select><option>1</option><option>23</option></select>4"),
        ("<pre>\n\nx</pre><textarea>\n<b>&lt;</textarea>", "<pre>\nx</pre><textarea><b><</textarea>"),
        ("z<script>if (a</b) '<p>'</script><style>x<y</style>t", "z<script>if (a</b) '<p>'</script><style>x<y</style>t"),
        ("a<!-- <p> --->b<!>c<!-->d</ x>e<?x?>f", "abcdef"),
        ("</p></br>x</nothing>", "<p></p><br></br>x"),
        ("<td>x</td><tr>y", "xy"),
        ("x<svg><path/><circle/></svg>y", "x<svg><path></path><circle></circle></svg>y"),
        ("1 < 2 <3 <", "1 < 2 <3 <"),
        ("x<a href='", "x"),
        ("<div><b>1</div>2</b>3", "<div><b>1</b></div><b>2</b>3"),
        ("<object><b>1</object>2<p>3", "<object><b>1</b></object>2<p>3</p>"),
        ("<form>a<div><form>b</form>c</div>d", "<form>a<div>bc</div></form>d"),
    ],
)
def test_trees(page, want):
    assert body(page) == want


def test_a_paragraph_holds_a_table_in_old_pages():
    assert shown(parse("<p>a<table><tr><td>b</table>c").first(of_tag("p"))).startswith("a<table>")


def test_head_and_attributes():
    t = parse("<HTML a=1><title>x &amp; y</title><meta name=n><script>1</script> <p CLASS=' a\tb ' class=c x=&copy y='&copy=1&copyx&#65;' z/w = \"&lt&notit;\">t<html a=2 b=3><body c=4>")
    assert shown(t) == "<html><head><title>x & y</title><meta></meta><script>1</script></head><body><p>t</p></body></html>"
    p = t.first(of_tag("p"))
    assert p.attributes == {"class": " a\tb ", "x": "©", "y": "&copy=1&copyxA", "z": "", "w": "<&notit;"} and p.has_class("a") and p.has_class("b")
    assert t.first(of_tag("html")).attributes == {"a": "1", "b": "3"} and t.first(of_tag("body")).attributes == {"c": "4"}
    for empty in (None, "", " \n", "<!doctype html>", "<!--"):
        assert shown(parse(empty)) == "<html><head></head><body></body></html>"


def test_any_text_gives_a_tree():
    """Whatever comes: every node lies in its parent once, text isn't lost from plain markup, and depth is bounded."""
    rng = random.Random(5)
    parts = [f"<{e}{t}>" for t in "a b p i div table tr td tbody caption col li ul h1 h2 select option form button nobr object svg br hr input pre dd dt ruby rt html body head".split() for e in ("", "/")] + ["x", "y ", " ", "<!-- c -->", "<b class=q>", "&amp;"]
    for _ in range(3000):
        tree = parse("".join(rng.choices(parts, k=rng.randrange(40))))
        seen = set()
        for node in tree.walk():
            assert id(node) not in seen
            seen.add(id(node))
            assert all(c.parent is node for c in node.children if isinstance(c, Node))
    deep = parse("<div><b>" * 3000 + "end")
    depth, node = 0, next(n for n in deep.walk() if "end" in n.children)
    while node is not None:
        depth, node = depth + 1, node.parent
    assert depth <= DEPTH + 2 and "end" in deep.text()


BROKEN = {
    "stray ends": lambda n: "<i>" + "</b></x></td>" * n, "nested cards": lambda n: '<div class="col-md">' * n + '<p class="affil-name">', "open tags": lambda n: "<a " * n,
    "many numbers": lambda n: '<div class="col-md"><p class="affil-name"></p><div class="journal-list-stat">' + '<b class="pr-num">1</b>' * n, "formatting": lambda n: "".join(f"<b id={i}>" for i in range(n)) + "<p>x" * n,
    "fostered": lambda n: "<table>" + "<b>x" * n, "misnested": lambda n: "<b><div></b>" * n, "links": lambda n: "<a href=x><p>" * n, "comments": lambda n: "<!-- " * n, "quotes": lambda n: "<a b='" * n,
}


@pytest.mark.parametrize("kind", sorted(BROKEN))
def test_time_is_linear(kind):
    def seconds(n):
        page = BROKEN[kind](n)
        began = time.process_time()
        for card in find_cards(parse(page)):
            raw_card(card)
        return time.process_time() - began

    seconds(500)
    small, large = min(seconds(1000) for _ in range(2)), seconds(8000)
    assert large < 24 * small + 0.3, (small, large)
