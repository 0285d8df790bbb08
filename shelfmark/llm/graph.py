"""Connected components of a graph given as a table of edges; nothing but edges is moved, nothing comes to the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, spread_join

#: Edges that a task joins before it emits what they span; so few that one task joins them all.
FLUSH, FEW = 1 << 20, 1 << 14


class Forest(dict):
    """Disjoint sets: vertex -> parent; the root of a set is its least vertex."""

    def root(self, v: int) -> int:
        top = v
        while (up := self.setdefault(top, top)) != top:
            top = up
        while self[v] != top:
            self[v], v = top, self[v]
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self[max(a, b)] = min(a, b)
        return a != b


def _spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from each vertex to the root of its set, among the edges of a task."""
    forest, seen = Forest(), 0

    def stars() -> pa.RecordBatch:
        pairs = [(v, forest.root(v)) for v in list(forest)]
        pairs = [p for p in pairs if p[0] != p[1]]
        return pa.record_batch([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        seen += batch.num_rows
        if seen >= FLUSH:
            yield stars()
            forest, seen = Forest(), 0
    yield stars()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) of every vertex of the edges (a, b), longs without nulls. root is the same all over a component.

    Each round replaces every vertex by its least neighbour and drops edges inside a set, until no more than FEW are left,
    which one task joins. Vertices should be hashes: then a round leaves a fraction of them, whatever the graph's shape.
    """

    def spanned(edges: DataFrame) -> DataFrame:
        """Edges to the least root that any task has found for a vertex, and from its other roots to that: a large set's tasks have few
        roots, so that this leaves about one edge for each vertex, and not one for each of its tasks."""
        found = edges.mapInArrow(_spanned, "a long, b long").groupBy("a").agg(F.min("b").alias("to"), F.collect_set("b").alias("roots"))
        others = F.filter("roots", lambda r: r != F.col("to"))
        stars = found.select(F.explode(F.concat(F.array("a"), others)).alias("a"), F.col("to").alias("b"))
        return cut(stars.distinct())

    pairs = spanned(edges.select(F.col("a").cast("long"), F.col("b").cast("long")))
    label = pairs.select(F.explode(F.array("a", "b")).alias("vertex")).distinct().withColumn("root", F.col("vertex"))
    while (left := pairs.count()) > FEW:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("to")).select(F.col("a").alias("v"), "to"))
        # vertices of very many edges, and roots of very many vertices, are spread
        to = lambda name: least.select(F.col("v").alias(name), "to")
        label = cut(spread_join(label, "root", to("root"), F.col("vertex")).select("vertex", F.coalesce("to", "root").alias("root")))
        moved = cut(spread_join(pairs, "a", to("a"), F.col("b")).select(F.col("to").alias("a"), "b"))
        moved = spread_join(moved, "b", to("b"), F.col("a")).select("a", F.col("to").alias("b"))
        pairs = spanned(moved.filter("a <> b"))
    if left:
        last = pairs.coalesce(1).mapInArrow(_spanned, "a long, b long").select(F.col("a").alias("v"), F.col("b").alias("to"))
        label = label.join(F.broadcast(last), F.col("root") == F.col("v"), "left").select("vertex", F.coalesce("to", "root").alias("root"))
    return cut(label)
