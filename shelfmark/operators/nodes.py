"""Trees as rows: a row per element and per piece of text, with its places in preorder and postorder.

A page is parsed once; what its nodes are to each other is then told by expressions. A node lies below another if it begins
after and ends before it: its pre is larger and its post is smaller. Joins are by page, with such a range; siblings are
rows of one parent in the order of pre.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.dom import Node, parse

NODES = "page long, pre int, post int, parent int, depth int, tag string, classes array<string>, attributes map<string,string>, text string"
KINDS = [pa.int64(), *[pa.int32()] * 4, pa.string(), pa.list_(pa.string()), pa.map_(pa.string(), pa.string()), pa.string()]
#: Nodes of an Arrow batch.
MANY = 20_000


def numbered(root: Node) -> Iterator[tuple]:
    """Rows of NODES (page left out) of a tree in preorder. The root, which has no name, is number 0; text has no name either."""
    rows: list[list] = []
    todo: list[tuple] = [(root, None, 0, None)]
    post = 0
    while todo:
        node, parent, depth, own = todo.pop()
        if own is not None:  # all below has been numbered
            rows[own][1] = post
            post += 1
            continue
        pre = len(rows)
        if isinstance(node, str):
            rows.append([pre, post, parent, depth, None, [], {}, node])
            post += 1
            continue
        rows.append([pre, None, parent, depth, node.tag, sorted(node.classes), node.attributes, None])
        todo.append((node, parent, depth, pre))
        todo += [(c, pre, depth + 1, None) for c in reversed(node.children)]
    return map(tuple, rows)


def nodes(pages: DataFrame, page: str = "page") -> DataFrame:
    """NODES of all pages, which have `page` and html. A null page is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        names = [x.split()[0] for x in NODES.split(", ")]
        made = lambda: pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(KINDS)], names=names)
        for b in batches:
            for number, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows += ((number, *r) for r in numbered(parse(html)))
                if len(rows) >= MANY:
                    yield made()
                    rows.clear()
        if rows:
            yield made()

    return pages.select(F.col(page).cast("long").alias("page"), "html").mapInArrow(run, NODES)


def has_class(token: str) -> Column:
    return F.array_contains("classes", token)


def attribute(name: str) -> Column:
    """An attribute's value; empty where it is missing."""
    return F.coalesce(F.try_element_at("attributes", F.lit(name)), F.lit(""))


def below(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """inner's rows with `top`, the pre of each row of outer that they are or lie below."""
    o = outer.select(F.col("page").alias("_page"), F.col("pre").alias("top"), F.col("post").alias("_post"))
    return inner.join(o, (F.col("page") == F.col("_page")) & (F.col("top") <= F.col("pre")) & (F.col("post") <= F.col("_post"))).drop("_page", "_post")


def first_below(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """Of each row of outer (`top`) the first of inner that it is or that lies below it."""
    return _one(below(outer, inner), ["page", "top"], F.min_by)


def nearest_above(rows: DataFrame, outer: DataFrame) -> DataFrame:
    """outer's row that each of rows (`of`, its pre) lies below most closely; none for rows without one."""
    r = rows.select(F.col("page").alias("_page"), F.col("pre").alias("of"), F.col("post").alias("_post"))
    found = outer.join(r, (F.col("page") == F.col("_page")) & (F.col("pre") < F.col("of")) & (F.col("_post") < F.col("post"))).drop("_page", "_post")
    return _one(found, ["page", "of"], F.max_by)


def _one(rows: DataFrame, keys: list[str], choose) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(choose(F.struct(*rest), "pre").alias("_row")).select(*keys, "_row.*")


def with_later_sibling(rows: DataFrame, condition: Column, name: str = "later") -> DataFrame:
    """rows (all nodes of their pages) with the pre of the first later sibling that meets the condition; null without one."""
    after = Window.partitionBy("page", "parent").orderBy("pre").rowsBetween(1, Window.unboundedFollowing)
    return rows.withColumn(name, F.min(F.when(condition, F.col("pre"))).over(after))


def texts(outer: DataFrame, every: DataFrame) -> DataFrame:
    """page, top and text: all text below each row of outer, without separators; empty where there is none."""
    pieces = below(outer, every.filter("tag is null")).groupBy("page", "top").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pre", "text"))), lambda x: x["text"]), "").alias("text"))
    keys = outer.select("page", F.col("pre").alias("top"))
    return keys.join(pieces, ["page", "top"], "left").select("page", "top", F.coalesce("text", F.lit("")).alias("text"))
