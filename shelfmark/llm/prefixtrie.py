"""Trie of conversations' beginnings, encoded by preorder intervals.

A node stands for a distinct sequence of first turns. Nodes are ranked in the lexicographic order of their sequences (of
the turns' digests), which is preorder: a node's subtree is an interval of ranks, from its own to the largest last node
of its members. What is summed over a subtree is a difference of two prefix sums over the ranks.

Sequences of any length are ranked: a row has the digests of its block of BLOCK turns up to its own; where conversations
are longer, the ranks of the full blocks before it, and its own, are ranked again as a sequence, and so on.
Equal sequences need no common task: rows are sorted by ranges, and a range that goes on with the last node of the one
before takes over its rank. Texts are digested where they are read; none is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, lean, spread_join
from shelfmark.llm.ordered import dealt, joined_digests, placed, prefix_sums

#: Turns of a block, and blocks of a block of blocks.
BLOCK = 64
#: Members of a node that are joined to one text before texts of a node meet.
MEMBERS = 512
#: Most turns that a rebuilt conversation takes over, and conversations that take them from the same one.
HEADS, SHARED = 4, 20
WORD = r"[^\x20\x09-\x0D]+"


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv, place (from 1), key (digest of role and text, 128 bits in hex) and words of each turn, stored."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"), key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    # stored first: finding the ranges reads the rows once more
    return cut(placed(cut(rows), "conv", F.col("turn").asc_nulls_first(), F.col("key")).select("conv", "place", "key", "words"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv) of every conversation, and (conv, place, key, words) of the rebuilt ones: conversation c begins with the first h turns
    of c - c % SHARED and goes on with its own after the first h; h = crc32(c) % HEADS."""
    start = F.col("conv") - F.col("conv") % SHARED
    convs = turns.select("conv").distinct().withColumns({"h": F.crc32(F.col("conv").cast("string")) % HEADS, "source": start})
    heads = turns.filter((F.col("conv") % SHARED == 0) & (F.col("place") < HEADS)).groupBy(F.col("conv").alias("source"))
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("place", "key", "words"))).alias("heads"))
    taken = cut(convs.join(heads, "source", "left").select("conv", "h", F.slice(F.coalesce("heads", F.array().cast("array<struct<place:bigint,key:string,words:bigint>>")), F.lit(1), F.col("h").cast("int")).alias("heads")))
    own = spread_join(turns, "conv", taken.select("conv", "h", F.size("heads").alias("taken")), F.xxhash64("key", "place"))
    own = own.filter("place > h").select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("place"), "key", "words")
    first = taken.select("conv", F.explode("heads").alias("x")).select("conv", "x.place", "x.key", "x.words")
    return taken.select("conv"), cut(own.unionByName(first))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From conv, place, words, part and run, in order of run: conv, place, words, part, local (number of the run in its range), and
    a digest of the run."""
    last, local = None, -1
    for b in batches:
        numbers, digests = [], []
        for run in b.column(4).to_pylist():
            if run != last:
                last, local = run, local + 1
                digest = hashlib.blake2b(run, digest_size=16).digest()
            numbers.append(local)
            digests.append(digest)
        yield pa.record_batch([*b.columns[:4], pa.array(numbers, pa.int64()), pa.array(digests, pa.binary())], names=["conv", "place", "words", "part", "local", "digest"])


def ranked(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """(conv, place, words, rank), stored: rows have a binary `run`; rank is its place among the different ones, from 0. Their number,
    and the largest place."""
    order = dealt(rows.select("conv", "place", "words", "run"), F.col("run"), F.col("conv")).sortWithinPartitions("run", "conv")
    found = cut(order.select("conv", "place", "words", "part", "run").mapInArrow(lean(_numbered), "conv long, place long, words long, part int, local long, digest binary"))
    edges = found.groupBy("part").agg(F.min_by("digest", "local").alias("first"), F.max_by("digest", "local").alias("last"), F.max("local").alias("most"), F.max("place").alias("longest")).collect()  # a row a range
    offsets, total, last = [], 0, None
    for r in sorted(edges, key=lambda r: r["part"]):
        total -= r["first"] == last
        offsets.append((r["part"], total))
        total, last = total + r["most"] + 1, r["last"]
    before = rows.sparkSession.createDataFrame(offsets, "part int, before long")
    rows = cut(found.join(F.broadcast(before), "part").select("conv", "place", "words", (F.col("local") + F.col("before")).alias("rank")))
    return rows, total, max((r["longest"] for r in edges), default=0)


def preorder(paths: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int]:
    """(conv, place, words, rank) of (conv, place, key, words), stored: rank is that of the node of the first `place` turns. And how many
    nodes there are."""
    running = Window.partitionBy("conv", F.floor((F.col("place") - 1) / block)).orderBy("place")
    rows, total, longest = ranked(paths.withColumn("run", F.unhex(F.array_join(F.collect_list("key").over(running), ""))))
    size = block
    while longest > size:
        symbol = F.lpad(F.hex("rank"), 16, "0")
        earlier = Window.partitionBy("conv", F.floor((F.col("place") - 1) / (size * block))).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        ends = F.collect_list(F.when(F.col("place") % size == 0, symbol)).over(earlier)
        rows, total, _ = ranked(rows.withColumn("run", F.unhex(F.concat(F.array_join(ends, ""), symbol))))
        size *= block
    return rows, total


def _member_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From position, part and conv in order: position, part, at and text, up to MEMBERS numbers of a node joined by commas."""
    current, waiting, at = None, [], 0

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string()]
        return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["position", "part", "at", "text"])

    for b in batches:
        out = []
        for position, part, conv in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if waiting and ((position, part) != current or len(waiting) == MEMBERS):
                out.append((*current, at, ",".join(map(str, waiting))))
                waiting, at = [], at + 1
            current = position, part
            waiting.append(conv)
        if out:
            yield batch(out)
    if waiting:
        yield batch([(*current, at, ",".join(map(str, waiting)))])


def _ends(last: DataFrame) -> DataFrame:
    """position and digest of the conversations (position, conv) that end there, ascending."""
    in_order = dealt(last, F.col("position"), F.col("conv")).sortWithinPartitions("position", "conv").select("position", "part", "conv")
    texts = in_order.mapInArrow(lean(_member_texts), "position long, part int, at long, text string")
    return joined_digests(texts, "position", ["part", "at"], ",")


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, and the interval of its subtree: position and end, both included.

    conversations needs conv_id, turn, role and text; other columns are ignored. Null roles and texts are empty. Rows without
    a conv_id belong to no conversation and are left out. Rows of equal turn are in the order of a digest of role and text;
    repeated rows are turns each. Conversations without turns are members of the root. An empty table has no nodes.
    """
    convs, paths = rebuilt(turns_of(conversations))
    rows, count = preorder(paths, block)
    rows = rows.withColumn("position", F.col("rank") + 1).drop("rank")
    last = cut(rows.groupBy("conv").agg(F.max("position").alias("last")))
    ended = spread_join(rows, "conv", last, F.xxhash64("position"))
    nodes = ended.groupBy("position").agg(F.min("conv").alias("conv_id"), F.max("place").alias("depth"), F.max("words").alias("words"), F.count("*").alias("n_convs"), F.max("last").alias("end"))
    # a node's parent is where its smallest member was a turn before
    steps = rows.select(F.col("conv").alias("conv_id"), (F.col("place") + 1).alias("depth"), F.col("position").alias("up"))
    nodes = nodes.join(steps, ["conv_id", "depth"], "left").withColumn("up", F.coalesce("up", F.lit(0).cast("long")))
    root = convs.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(F.lit(0).cast("long").alias("position"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), "n_convs", F.lit(count).cast("long").alias("end"), F.lit(None).cast("long").alias("up"))
    sums = {"leaves": (F.col("end") == F.col("position")).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words")}
    summed = prefix_sums(nodes.select(root.columns).unionByName(root), "position", count + 1, sums)
    at_end = summed.select(F.col("position").alias("end"), F.col("leaves").alias("leaves_end"), F.col("saved").alias("saved_end"))
    with_end = spread_join(summed, "end", at_end, F.col("position"))
    parents = summed.select(F.col("position").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    with_parent = spread_join(cut(with_end), "up", parents, F.col("position"))
    children = summed.filter("up is not null").groupBy(F.col("up").alias("position")).agg(F.count("*").alias("n_children"))
    turnless = convs.join(last, "conv", "left_anti").select(F.lit(0).cast("long").alias("position"), "conv")
    ends = _ends(last.select(F.col("last").alias("position"), "conv").unionByName(turnless))
    out = with_parent.join(children, "position", "left").join(ends, "position", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        (F.col("leaves_end") - F.col("leaves") + sums["leaves"]).alias("n_leaves"), (F.col("saved_end") - F.col("saved") + sums["saved"]).alias("saved_tokens"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "position", "end",
    )
