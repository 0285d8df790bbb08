"""Trees as rows against searches of the tree, and table functions in SQL."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import tables
from shelfmark.operators import nodes
from shelfmark.operators.dom import Node, of_class, of_tag, parse
from tests.fakes import page


def pages_of(seed, n):
    rng = random.Random(seed)
    parts = [f"<{e}{t}>" for t in "div p b ul li".split() for e in ("", "", "/")] + ["<a href=h{}>", "</a>", "<i class='x y'>", "<i class=x>", "<u class=z>", "</i>", "t{} ", "<!-- c -->", "<br>"]
    return ["".join(rng.choice(parts).replace("{}", str(rng.randrange(9))) for _ in range(60)) for _ in range(n)] + ["", None]


@pytest.fixture(scope="module")
def both(spark):
    """Pages' trees with each element's pre, and their rows."""
    pages = pages_of(1, 12)
    trees = [parse(p) for p in pages]
    places = []
    for tree in trees:
        number, todo, at = {}, [tree], 0
        while todo:
            node = todo.pop()
            if isinstance(node, Node):
                number[id(node)] = at
                todo += reversed(node.children)
            at += 1
        places.append(number)
    rows = nodes.nodes(spark.createDataFrame([(i, p, "k") for i, p in enumerate(pages)], "page long, html string, tag string")).cache()
    return trees, places, rows


def test_searches(both):
    trees, places, rows = both
    want = lambda find: {(i, places[i][id(n)]) for i, t in enumerate(trees) for n in find(t)}
    got = lambda df, *c: {tuple(r[x] for x in ("page", *c)) for r in df.collect()}
    assert got(rows.filter("tag is not null"), "pre") == want(lambda t: t.walk())
    assert got(rows.filter(nodes.has_class("x")), "pre") == want(lambda t: t.all(of_class("x"))) != set()
    lists, marked = rows.filter("tag = 'div'"), rows.filter(nodes.has_class("x"))
    firsts = {(i, places[i][id(n)], places[i][id(m)]) for i, t in enumerate(trees) for n in t.all(of_tag("div")) if (m := n.first(of_class("x")))}
    assert got(nodes.first_below(lists, marked), "top", "pre") == firsts and len(firsts) > 5
    inside = {(i, places[i][id(n)], places[i][id(m)]) for i, t in enumerate(trees) for n in t.all(of_tag("div")) for m in n.all(of_class("x"))}
    assert got(nodes.below(lists, marked), "top", "pre") == inside
    assert got(nodes.below(lists, lists).filter("top = pre"), "pre") == want(lambda t: t.all(of_tag("div")))  # itself included


def test_ancestors_siblings_and_texts(both):
    trees, places, rows = both
    above = {(i, places[i][id(n)], places[i][id(a)], a.attributes.get("href", "")) for i, t in enumerate(trees) for n in t.all(of_class("x")) if (a := n.above("a"))}
    found = nodes.nearest_above(rows.filter(nodes.has_class("x")), rows.filter("tag = 'a'"))
    assert {(r["page"], r["of"], r["pre"], r["href"]) for r in found.withColumn("href", nodes.attribute("href")).collect()} == above != set()
    later = {(i, places[i][id(n)], places[i][id(m)] if (m := n.later("z")) else None) for i, t in enumerate(trees) for n in t.all(of_class("x"))}
    marked = nodes.with_later_sibling(rows, nodes.has_class("z")).filter(nodes.has_class("x"))
    assert {(r["page"], r["pre"], r["later"]) for r in marked.collect()} == later and any(x[2] for x in later)
    texts = {(i, places[i][id(n)], n.text()) for i, t in enumerate(trees) for n in t.all(of_tag("p"))}
    assert {(r["page"], r["top"], r["text"]) for r in nodes.texts(rows.filter("tag = 'p'"), rows).collect()} == texts != set()


def test_numbers(both):
    """Preorder and postorder are permutations, and descendants' intervals nest."""
    for (number,) in both[2].select("page").distinct().collect():
        own = both[2].filter(F.col("page") == number).orderBy("pre").collect()
        assert [r["pre"] for r in own] == sorted(r["post"] for r in own) == list(range(len(own)))
        for r in own[1:]:
            top = own[r["parent"]]
            assert top["pre"] < r["pre"] and r["post"] < top["post"] and top["depth"] == r["depth"] - 1


def test_no_tree_walk_for_each_query(both):
    """Searches are joins and windows over rows: no Python in their plans."""
    path = both[2]
    plan = nodes.nearest_above(path.filter(nodes.has_class("x")), path.filter("tag = 'a'"))._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" in plan and "MapInArrow" not in plan.split("InMemoryRelation")[0]


def test_table_functions(spark):
    tables.register(spark)
    spark.createDataFrame([(1, page(1)), (2, ""), (3, None), (4, page(4, ids=(7,)))], "page int, html string").createOrReplaceTempView("some_pages")
    rows = spark.sql("SELECT p.page, c.card_pos, trim(c.name) AS name, c.profile_url, c.metrics FROM some_pages p, LATERAL list_cards(p.html) c ORDER BY ALL").collect()
    assert [(r["page"], r["card_pos"], r["profile_url"]) for r in rows] == [(1, 0, "/profile/10"), (1, 1, "/profile/11"), (4, 0, "/profile/7")]
    assert [tuple(m) for m in rows[0]["metrics"]] == [("Impact", "1.234,5"), ("H5-index", "7,9"), ("Citations", "x")]
    found = spark.sql("SELECT text, href FROM list_nodes('<p>a<p>b<a href=u>c</a>', 'p') UNION ALL SELECT text, href FROM list_nodes('<a href=u>c</a>', 'a')").collect()
    assert [tuple(r) for r in found] == [("a", ""), ("bc", ""), ("c", "u")]
    assert spark.sql("SELECT tag FROM list_nodes('<p>x', null)").collect()[-1][0] == "p"
    assert [r["card_pos"] for r in spark.sql("SELECT * FROM list_cards(null)").collect()] == []
