"""Packing documents into sequences of bounded length by Karmarkar-Karp multiway differencing.

Documents as long as a window or longer fill whole windows first. What remains of each document, shorter than a
window, is cut into equal pieces of at most a quarter window; small pieces balance well. They gather in blocks of
BLOCK pieces of one partition. A block of pieces becomes windows of nearly equal
sums: every piece starts as a partial partition of its own, and the two partial partitions of largest imbalance
merge, heaviest subset against lightest, until one is left. If its heaviest window is over capacity, the count
of windows rises and the block is dealt again. Nothing is shuffled: a partition's documents are packed where
they are read, and at most its last window per block is poorly filled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import lean

#: Pieces that are balanced together.
BLOCK = 1024
#: Bytes of text that a task packs, on average at least.
LEAST = 1 << 20
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def difference(sizes: list[int], count: int) -> list[list[int]]:
    """count subsets of the indexes of sizes with nearly equal sums (some empty if there are fewer sizes).

    A partial partition is a list of (sum, members) by falling sum; subsets that are empty, and so have the
    lowest sum, are left out until all are used. Members are nested pairs, flattened at the end.
    """
    if not sizes:
        return [[] for _ in range(count)]
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        over = len(one) + len(two) - count
        if over <= 0:
            merged = one + two
        else:  # heaviest against lightest: the heaviest of each meet the other's empty subsets
            meet = [(a[0] + b[0], (a[1], b[1])) for a, b in zip(one[len(one) - over :], reversed(two[len(two) - over :]), strict=True)]
            merged = one[: len(one) - over] + meet + two[: len(two) - over]
        merged.sort(key=itemgetter(0), reverse=True)
        least = merged[-1][0] if len(merged) == count else 0
        heapq.heappush(heap, (least - merged[0][0], serial, merged))
        serial += 1
    out: list[list[int]] = []
    for _, members in heap[0][2]:
        flat, todo = [], [members]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo += x
            else:
                flat.append(x)
        out.append(flat)
    return out + [[] for _ in range(count - len(out))]


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Subsets of the indexes of sizes, each of at most capacity in sum; sizes are at most capacity."""
    total = sum(sizes)
    count = max(1, -(-total // capacity))
    while True:
        out = [x for x in difference(sizes, count) if x]
        if all(sum(sizes[i] for i in x) <= capacity for x in out):
            return out
        count += 1


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int | None = 1, block: int = BLOCK, cache: int | None = None) -> DataFrame:
    """One row per piece: doc_id, start (the document's ids before it), length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset in the sequence. Every id of every document lies in exactly one piece.

    cache: words whose ids a worker keeps; fewer take less memory and more time.
    docs needs doc_id and text; other columns are ignored. Null and empty texts consist of end_id alone (with no
    end_id they have no piece). Repeated rows are packed each. Very long texts span many sequences.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from shelfmark.llm.tokens import encoder

        encode, end = encoder(tokenizer, *filter(None, (cache,))), b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        part = max(1, capacity // 4)
        sequence = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        def balanced() -> list[tuple]:
            nonlocal sequence
            rows = []
            for members in windows([len(x[2]) // 4 for x in waiting], capacity):
                offset = 0
                for i in members:
                    doc, start, ids, total = waiting[i]
                    rows.append((doc, start, len(ids) // 4, ids, total, sequence, offset))
                    offset += len(ids) // 4
                sequence += 1
            waiting.clear()
            return rows

        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = encode.encode(text) + end
                total, start = len(ids) // 4, 0
                while total - start >= capacity:
                    rows.append((doc, start, capacity, ids[4 * start : 4 * (start + capacity)], total, sequence, 0))
                    sequence, start = sequence + 1, start + capacity
                rest = total - start
                count = -(-rest // part)
                for i in range(count):
                    length = rest // count + (i < rest % count)
                    waiting.append((doc, start, ids[4 * start : 4 * (start + length)], total))
                    start += length
                if len(waiting) >= block:
                    rows += balanced()
            if rows:
                yield batch(rows)
        if waiting:
            yield batch(balanced())

    texts = docs.select("doc_id", "text")
    tasks = -(-(texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // LEAST)
    return texts.coalesce(max(1, min(tasks, (1 << 31) - 1))).mapInArrow(lean(packed, "tokens"), SCHEMA)
