"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments, at a few resolutions; of each segment the mean and the deviation are kept. The inner
product of two segments of w components is at most w * (product of means + product of deviations), by Cauchy and
Schwarz, so the statistics bound a pair's score from above (and its distance from below) without the vectors. Pairs
are taken coarse to fine: a pair whose bound falls under the query's k-th best score so far goes; survivors of the
finest resolution get their exact scores.

A first k-th best score of each query comes from a bounded sample of candidates. Queries are dealt to blocks of at
most QUERIES that lie near each other, and of each block the ranges of its statistics are broadcast. Each task holds
its candidates against them before anything is shipped: a candidate goes to the blocks that hold a query it may be
good for. There it meets the block's queries; a task keeps only the k best of each query and block of candidates, and
no pair becomes a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut

#: Vectors in a block of queries, and of candidates.
QUERIES, CANDIDATES = 4096, 2048
#: Tasks for each partition of a shuffle.
SHARES = 2
#: Candidates in the sample, and its bytes at most; queries whose bounds are computed together.
SAMPLE, SAMPLE_BYTES, CHUNK = 4096, 8 << 20, 128
#: Most blocks of queries whose ranges are broadcast (about 800 bytes each); with more, all candidates go to all blocks.
RANGES = 1 << 16
#: Segments at each resolution, coarse to fine; cut down for short vectors.
RESOLUTIONS = (1, 4, 16, 32)
#: Sums up to this are exact as doubles.
EXACT = 2.0**53


def quantised(column: pa.Array) -> list[np.ndarray | None]:
    """floor(256 * x) of each vector as doubles; None for vectors null, or with a component null or not finite."""
    offsets, missing = column.offsets.to_numpy(), column.is_null().to_numpy(zero_copy_only=False)
    low = int(offsets[0]) if len(offsets) else 0
    # nulls become NaN
    values = column.values.slice(low, int(offsets[-1]) - low if len(offsets) else 0).cast(pa.float64()).to_numpy(zero_copy_only=False)
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    whole = np.floor(256.0 * np.where(np.isfinite(values), values, 0.0))
    at = offsets - low
    return [None if gone or odd[e] > odd[s] else whole[s:e] for gone, s, e in zip(missing.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)]


def segment_statistics(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Per vector: for each segment the sums (means times root of width) and deviations (times root of width)."""
    edges = np.linspace(0, vectors.shape[1], segments + 1).astype(int)[:-1]
    widths = np.diff(np.append(edges, vectors.shape[1]))
    sums = np.add.reduceat(vectors, edges, axis=1)
    squares = np.add.reduceat(vectors**2, edges, axis=1)
    means = sums / np.sqrt(widths)
    return means, np.sqrt(np.maximum(squares - means**2, 0))


def best_of_each(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of the best score of each different id."""
    order = np.lexsort((-scores, ids))
    return order[np.diff(ids[order], prepend=~ids[order][:1]) != 0]


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, exact up to EXACT; beyond it rounded."""
    return queries @ vectors.T


def levels_of(vectors: np.ndarray) -> list[np.ndarray]:
    """Statistics at each resolution, coarse to fine."""
    return [np.hstack(segment_statistics(vectors, s)) for s in dict.fromkeys(min(s, vectors.shape[1]) for s in RESOLUTIONS)]


def first_floors(queries: np.ndarray, query_ids: np.ndarray, sample: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """A score that k different candidates of the sample reach, for each query; -inf if the sample has fewer."""
    out = np.full(len(queries), -np.inf)
    if len(np.unique(ids)) <= k or not queries.shape[1]:
        return out
    slack = 1e-9 * np.linalg.norm(queries, axis=1) * np.linalg.norm(sample, axis=1).max() + 1
    once = np.unique(ids, return_index=True)[1]  # any one row of an id will do
    for n in range(0, len(queries), CHUNK):
        found = np.where(query_ids[n : n + CHUNK, None] != ids[once], scores(queries[n : n + CHUNK], sample[once]), -np.inf)
        out[n : n + CHUNK] = np.partition(found, -k, axis=1)[:, -k] - slack[n : n + CHUNK]
    return out


def ranges_of(queries: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """What a block of queries is known by: least and largest mean of each segment, largest deviations, largest norm, least floor."""
    means, deviations = segment_statistics(queries, min(RESOLUTIONS[-1], queries.shape[1]))
    return np.concatenate([means.min(0), means.max(0), deviations.max(0), [np.linalg.norm(queries, axis=1).max(), floor.min()]])


def wanted(vectors: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """For each vector and each block of queries (a row of ranges_of()) whether it may reach the floor of any query there."""
    means, deviations = segment_statistics(vectors, min(RESOLUTIONS[-1], vectors.shape[1]))
    low, high, most = (ranges[:, i * means.shape[1] : (i + 1) * means.shape[1]] for i in range(3))
    bounds = np.maximum(means, 0) @ high.T + np.minimum(means, 0) @ low.T + deviations @ most.T
    slack = 1e-9 * np.linalg.norm(vectors, axis=1)[:, None] * ranges[:, -2] + 1
    return bounds + slack >= ranges[:, -1]


def search_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray, tally: dict[str, int] | None = None) -> list[tuple[int, int, int]]:
    """(query, id, score) of each query's k best here, leaving out itself and scores under floor, which it raises.
    A repeated id has one place, by its best score. tally: counts pairs, and those of which the exact score was taken."""
    if not queries.shape[1]:  # vectors without components
        return [(int(q), int(i), 0) for q in query_ids for i in np.unique(ids[ids != q])[:k]]
    repeated = len(np.unique(ids)) < len(ids)
    big = np.linalg.norm(queries, axis=1).max(initial=0) * np.linalg.norm(vectors, axis=1).max(initial=0)
    slack = 1e-9 * big + 1
    asked, offered = levels_of(queries), levels_of(vectors)
    out = []
    for at in range(0, len(queries), CHUNK):
        part = slice(at, at + CHUNK)
        here = np.arange(len(vectors))
        live = query_ids[part, None] != ids
        for n, (q, v) in enumerate(zip(asked, offered, strict=True)):
            bounds = q[part] @ v[here].T
            if not n:  # without a floor, the exact scores of those that look best give a first one
                for i in np.flatnonzero(np.isneginf(floor[part])):
                    probe = np.flatnonzero(live[i])
                    probe = probe[np.argsort(-bounds[i, probe], kind="stable")[: 4 * k]]
                    best = vectors[probe] @ queries[at + i]
                    best = best[best_of_each(best, ids[probe])] if repeated else best
                    if len(best) >= k:
                        floor[at + i] = np.partition(best, -k)[-k] - slack
            live &= bounds + slack >= floor[part, None]
            some = live.any(0)
            here, live = here[some], live[:, some]
        for i in np.flatnonzero(live.any(1)):
            n, own = at + int(i), here[live[i]]
            if tally is not None:
                tally["exact"] = tally.get("exact", 0) + len(own)
            exact = [int(x) for x in vectors[own] @ queries[n]] if big < EXACT else [sum(int(a) * int(b) for a, b in zip(queries[n], v, strict=True)) for v in vectors[own]]
            best = sorted(zip((-x for x in exact), ids[own].tolist(), strict=True))
            if repeated:  # the first of each id is its best
                best = [(s, i) for i, s in {i: s for s, i in reversed(best)}.items()]
                best.sort()
            best = best[:k]
            if len(best) == k:
                floor[n] = max(floor[n], -best[-1][0] - slack)
            out += [(int(query_ids[n]), i, -s) for s, i in best]
    if tally is not None:
        tally["pairs"] = tally.get("pairs", 0) + len(queries) * len(vectors)
    return out


def to_bytes(vectors: np.ndarray) -> bytes:
    """Vectors of whole numbers, in 16 bits a component where that holds them."""
    small = not vectors.size or np.abs(vectors).max() < 1 << 15
    return vectors.astype(np.int16 if small else np.float64).tobytes()


def from_bytes(data: bytes, count: int, dim: int) -> np.ndarray:
    kind = np.int16 if len(data) == 2 * count * dim else np.float64
    return np.frombuffer(data, kind).reshape(count, dim).astype(np.float64)


def exact_top_k(vectors: DataFrame, query: str, k: int = 5, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row for which the SQL condition `query` holds, its k rows of
    highest inner product of floor(256 * x), ties to the smaller id; all, if there are fewer.

    Rows of the query's own id are no candidates. A repeated id counts once: two ids have the best score of all their
    rows. Rows with a null id, and vectors null or with a component null or not finite, take no part. Vectors of
    different lengths do not meet. Scores are exact: beyond 2**53 they are summed as Python integers. Other columns are
    ignored. The sample and what is kept of blocks only steer the work: the result is the same without them.
    """
    spark = vectors.sparkSession
    plain = lambda rows: rows.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{column}`").alias("embedding")).filter("vec_id is not null")
    rows, asked = plain(vectors), plain(vectors.filter(F.expr(query)))
    sizes = rows.agg(F.count("*").alias("rows"), F.max(F.size("embedding")).alias("dim")).first()
    dim = max(1, sizes["dim"] or 1)
    n_queries = asked.count()
    cells = max(1, -(-n_queries // QUERIES))

    # the sample: floors, and the points that blocks of queries lie around
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
    share = min(1.0, 1.2 * most / max(1, sizes["rows"]))
    some = [(r["vec_id"], v) for r in rows.sample(share, seed=1).limit(most).collect() for v in quantised(pa.array([r["embedding"]], pa.list_(pa.float64()))) if v is not None]
    sample = {d: (np.array([i for i, v in some if len(v) == d], np.int64), np.array([v for _, v in some if len(v) == d]).reshape(-1, d)) for d in {len(v) for _, v in some}}
    shared = spark.sparkContext.broadcast(sample)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with their floors and the cell that they lie in."""
        for b in batches:
            found: dict[int, list] = {}
            for i, v in zip(b.column(0).to_pylist(), quantised(b.column(1)), strict=True):
                if v is not None:
                    found.setdefault(len(v), []).append((i, v))
            for d, items in found.items():
                ids, own = np.array([i for i, _ in items], np.int64), np.array([v for _, v in items]).reshape(-1, d)
                sample_ids, points = shared.value.get(d, (np.empty(0, np.int64), np.empty((0, d))))
                floor = first_floors(own, ids, points, sample_ids, k)
                cell = np.zeros(len(ids), np.int64)
                if cells > 1 and len(points) and d:
                    centres = points[:cells]
                    cell = np.concatenate([(scores(own[n : n + CHUNK], centres) - (centres**2).sum(1) / 2).argmax(1) for n in range(0, len(own), CHUNK)])
                columns = [pa.array(cell, pa.int32()), pa.array(np.full(len(ids), d, np.int32)), pa.array(ids), pa.array([x.tobytes() for x in own], pa.binary()), pa.array(floor)]
                yield pa.record_batch(columns, names=["cell", "dim", "vec_id", "data", "floor"])

    near = cut(asked.mapInArrow(placed, "cell int, dim int, vec_id long, data binary, floor double").distinct())
    counts = [(r["cell"], r["dim"], r["count"]) for r in near.groupBy("cell", "dim").count().orderBy("dim", "cell").collect()]  # cells, of which there is one in QUERIES queries
    # full cells are several blocks
    split = [(cell, d, -(-n // QUERIES)) for cell, d, n in counts]
    before = np.cumsum([0, *(n for *_, n in split)]).tolist()
    n_blocks = before[-1]
    if not n_blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    table = spark.createDataFrame([(cell, d, first, n) for (cell, d, n), first in zip(split, before, strict=False)], "cell int, dim int, first int, blocks int")
    block = (F.col("first") + F.pmod(F.xxhash64("vec_id", "data"), "blocks")).cast("int").alias("block")
    # a block of queries is one row; QUERIES bounds its size
    questions = near.join(F.broadcast(table), ["cell", "dim"]).select(block, "dim", "vec_id", "data", "floor").groupBy("block", "dim").agg(F.array_sort(F.collect_list(F.struct("vec_id", "data", "floor"))).alias("queries"))
    questions = cut(questions)

    def opened(d: int, queries: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = np.frombuffer(b"".join(q["data"] for q in queries), np.float64).reshape(-1, d) if d else np.zeros((len(queries), 0))
        return own, np.array([q["vec_id"] for q in queries], np.int64), np.array([q["floor"] for q in queries])

    def summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n, d, queries in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                own, _, floor = opened(d, queries)
                yield pa.record_batch([pa.array([n], pa.int32()), pa.array([d], pa.int32()), pa.array([ranges_of(own, floor).tobytes() if d else b""], pa.binary())], names=["block", "dim", "ranges"])

    known: dict[int, tuple[np.ndarray, np.ndarray | None]] = {}
    dims: dict[int, list[int]] = {}
    for (_, d, n), first in zip(split, before, strict=False):
        dims.setdefault(d, []).extend(range(first, first + n))
    told = {r["block"]: np.frombuffer(r["ranges"]) for r in questions.mapInArrow(summed_up, "block int, dim int, ranges binary").collect()} if n_blocks <= RANGES else {}
    for d, blocks in dims.items():
        there = [n for n in blocks if n in told] if told else blocks
        known[d] = np.array(there, np.int32), np.array([told[n] for n in there]) if told and d else None
    blocks_of = spark.sparkContext.broadcast(known)

    def shipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of candidates for each block of queries that they may be good for."""
        waiting: dict[int, list] = {}

        def sent(d: int) -> Iterator[pa.RecordBatch]:
            items = waiting.pop(d)
            ids, own = np.array([i for i, _ in items], np.int64), np.array([v for _, v in items]).reshape(-1, d)
            blocks, ranges = blocks_of.value.get(d, (np.empty(0, np.int32), None))
            good = wanted(own, ranges) if ranges is not None else np.ones((len(ids), len(blocks)), bool)
            for n in np.flatnonzero(good.any(0)):
                some = good[:, n]
                columns = [pa.array([blocks[n]], pa.int32()), pa.array([d], pa.int32()), pa.array([ids[some].tobytes()], pa.binary()), pa.array([to_bytes(own[some])], pa.binary())]
                yield pa.record_batch(columns, names=["block", "dim", "ids", "data"])

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), quantised(b.column(1)), strict=True):
                if v is not None:
                    waiting.setdefault(len(v), []).append((i, v))
                    if len(waiting[len(v)]) == CANDIDATES:
                        yield from sent(len(v))
        for d in list(waiting):
            yield from sent(d)

    # few blocks of queries are copied to several tasks, which share the candidates out among them
    parts = max(1, -(-SHARES * int(spark.conf.get("spark.sql.shuffle.partitions")) // n_blocks))
    candidates = rows.mapInArrow(shipped, "block int, dim int, ids binary, data binary").withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int"))
    copies = questions.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # a block's queries come once, ahead of its candidates
    kind = lambda n, *more: ("block", "dim", "part", F.lit(n).alias("kind"), *more)
    nothing = F.lit(None).cast("binary")
    asked_first = copies.select(*kind(0, nothing.alias("ids"), nothing.alias("data"), "queries"))
    then = candidates.select(*kind(1, "ids", "data", F.lit(None).cast(questions.schema["queries"].dataType).alias("queries")))
    key = ["block", "dim", "part"]
    meeting = asked_first.unionByName(then).repartition(*key).sortWithinPartitions(*key, "kind").select(*key, "ids", "data", "queries")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for b in batches:
            for row in range(b.num_rows):
                d, ids, data = (b.column(i)[row].as_py() for i in (1, 3, 4))
                if ids is None:
                    own = opened(d, b.column(5)[row].as_py())
                    continue
                queries, query_ids, floor = own
                there = np.frombuffer(ids, np.int64)
                found = search_block(queries, query_ids, from_bytes(data, len(there), d), there, k, floor)
                yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else ((), (), ()))], names=["query_id", "vec_id", "score"])

    best = meeting.mapInArrow(searched, "query_id long, vec_id long, score long")
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")))
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    top = best.groupBy("query_id").agg(F.slice(ordered, 1, k).alias("top"))
    return top.select("query_id", F.posexplode("top").alias("rank", "t")).select("query_id", (F.col("rank") + 1).alias("rank"), F.col("t.vec_id").alias("vec_id"), (-F.col("t.s")).alias("score"))
