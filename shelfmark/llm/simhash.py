"""SimHash near-duplicates: fingerprints of word shingles, and a binary-trie self-join within a few differing bits.

Different fingerprints are joined, each once. The join walks pairs of nodes of a binary trie together: from a pair it
goes to the pairs of their children, adds the bits in which these differ, and leaves a pair that exceeds the budget of
errors. As one half of two fingerprints at up to 3 bits differs in at most 1, two tries are walked, one with
the halves exchanged: the budget is 1 in the first half and 3 in all.

Tasks share the work by leaves: nodes that hold at most LEAF fingerprints, found from counts of ever longer prefixes. A task
gets the fingerprints of two leaves (or of one), and walks pairs of nodes below. A fingerprint is sent to the leaves
that its prefix reaches by one bit, at most 32. Within a task, pairs of nodes whose fingerprints hang together already
are left too, and only what the links span is emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, lean, slices, spread_join, text_bytes, word_spans
from shelfmark.llm.graph import components

#: Bits in which linked fingerprints may differ: in the first half of a trie's bits, and in all.
HALF, ALL = 1, 3
#: Different fingerprints of a leaf, at most.
LEAF = 1 << 13
#: Shingles whose bits are counted at a time; pairs of nodes that are walked at a time; pairs of fingerprints below which a pair
#: of nodes isn't walked on but compared.
COUNTED, WALKED, COMPARED = 1 << 16, 1 << 16, 64
SEED = 42


def fingerprints(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """SimHash of each text in data: a bit is 1 if more than half of its shingles' XXH64 have it."""
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    starts, ends, first = word_spans(data, offsets)
    lengths = ends - starts
    # words one after the other, a space behind each
    at = np.cumsum(lengths + 1) - lengths - 1
    joined = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    word = np.repeat(np.arange(len(starts)), lengths)
    inside = np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    joined[at[word] + inside] = data[starts[word] + inside]
    buffer, stop = joined.tobytes(), at + lengths
    n_words = np.diff(first)
    many = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    owner = np.repeat(np.arange(len(many)), many)
    begin = first[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    end = np.minimum(begin + size, first[1:][owner]) - 1
    counts = np.zeros((len(many), 64), np.int64)
    hashed = xxhash.xxh64_intdigest
    for i in range(0, len(owner), COUNTED):
        j = min(len(owner), i + COUNTED)
        h = np.fromiter((hashed(buffer[a:b], SEED) for a, b in zip(at[begin[i:j]].tolist(), stop[end[i:j]].tolist(), strict=True)), np.uint64, j - i)
        bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        own = owner[i:j]
        edge = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
        counts[own[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int64)
    return np.packbits(2 * counts > many[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def _fingerprinted(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in slices(b, most=8 << 20):
                found = fingerprints(*text_bytes(part.column(1)), size)
                yield pa.record_batch([part.column(0), pa.array(found.view(np.int64))], names=["doc_id", "value"])

    return run


class Leaves:
    """A trie's leaves as intervals of 64-bit numbers: starts, depths, and how many blocks the fingerprints of each are dealt to (one,
    but for leaves of 32 bits that hold more than LEAF)."""

    def __init__(self, found: list[tuple[int, int, int]], most: int):
        found = sorted((prefix << (64 - depth), depth, count) for depth, prefix, count in found)
        self.starts = np.array([x[0] for x in found], np.uint64)
        self.depths = np.array([x[1] for x in found], np.int64)
        self.blocks = np.array([-(-x[2] // most) for x in found], np.int64)
        self.first = np.cumsum(self.blocks) - self.blocks

    def of(self, values: np.ndarray) -> np.ndarray:
        """The leaf of each value; -1 where there is none."""
        at = np.searchsorted(self.starts, values, "right") - 1
        inside = (at >= 0) & ((values - self.starts[at]) >> (np.uint64(64) - self.depths[at].astype(np.uint64)) == 0)
        return np.where(inside, at, -1)

    def cells(self, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(which value, own block, other block) for all pairs of blocks that a value takes part in."""
        own = self.of(values)
        block = self.first[own] + (values % np.maximum(self.blocks[own], 1).astype(np.uint64)).astype(np.int64)
        which = np.arange(len(values))
        for bit in range(-1, 32):
            other = own if bit < 0 else self.of(values ^ np.uint64(1 << (63 - bit)))
            ok = (other >= 0) & ((other != own) | (bit < 0))
            for k in range(int(self.blocks[other[ok]].max(initial=0))):
                has = ok & (k < self.blocks[other])
                yield which[has], block[has], self.first[other[has]] + k


def turned(values: np.ndarray, trie: int) -> np.ndarray:
    """Numbers with their halves exchanged for the second trie."""
    return (values << np.uint64(32)) | (values >> np.uint64(32)) if trie else values


def _celled(tries: list[Leaves]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for trie, leaves in enumerate(tries):
                values = turned(b.column(0).to_numpy().view(np.uint64), trie)
                for which, own, other in leaves.cells(values):
                    columns = [np.full(len(which), trie, np.int32), np.minimum(own, other), np.maximum(own, other), (own > other).astype(np.int32), values[which].view(np.int64)]
                    yield pa.record_batch([pa.array(x) for x in columns], names=["trie", "a", "b", "side", "value"])

    return run


def _split(values: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> np.ndarray:
    """Where, in each run of values that agree in their first bits, those with the next bit set begin."""
    shift = np.uint64(63 - depth)
    return np.clip(np.searchsorted(values, ((values[low] >> shift) | np.uint64(1)) << shift), low, high)


class Together:
    """Which of some numbered things hang together: label is the least number of their set."""

    def __init__(self, count: int):
        self.label = np.arange(count)

    def join(self, i: np.ndarray, j: np.ndarray) -> bool:
        any_new = False
        while len(i):
            a, b = self.label[i], self.label[j]
            new = a != b
            if not new.any():
                break
            i, j, a, b, any_new = i[new], j[new], a[new], b[new], True
            up = np.arange(len(self.label))
            np.minimum.at(up, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up, up[up]):
                up = up[up]
            self.label = up[self.label]
        return any_new

    def runs(self, low: int, high: int) -> np.ndarray:
        """For each place of a range of things, how often the label changes before it."""
        part = self.label[low:high]
        return np.concatenate([[0], np.cumsum(part[1:] != part[:-1])]) if len(part) else part


def walk(x: np.ndarray, y: np.ndarray | None, sets: Together, base: int = 0) -> None:
    """Joins in `sets` all pairs of x and y (ascending, each value once; y None: of x with itself) that are linked. x's numbers there
    begin at 0, y's at base."""
    same, y = y is None, x if y is None else y
    if not len(x) or not len(y):
        return
    allowed = [HALF] * 33 + [ALL] * 32
    todo = [(0, np.array([[0], [len(x)], [0], [len(y)], [0]]))]
    changes = sets.runs(0, len(x)), sets.runs(base, base + len(y))
    while todo:
        depth, f = todo.pop()
        la, lb = sets.label[f[0]], sets.label[base + f[2]]
        done = (la == lb) & (changes[0][f[0]] == changes[0][f[1] - 1]) & (changes[1][f[2]] == changes[1][f[3] - 1])
        f = f[:, ~done]
        small = ((f[1] - f[0]) * (f[3] - f[2]) <= COMPARED) | (depth == 64)
        if small.any():
            g = f[:, small]
            wide = g[3] - g[2]
            many = (g[1] - g[0]) * wide
            owner = np.repeat(np.arange(len(many)), many)
            k = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
            i, j = g[0][owner] + k // wide[owner], g[2][owner] + k % wide[owner]
            near = (np.bitwise_count(x[i] ^ y[j]) <= ALL) & ((i < j) | (not same))
            if sets.join(i[near], base + j[near]):
                changes = sets.runs(0, len(x)), sets.runs(base, base + len(y))
            f = f[:, ~small]
        if not f.shape[1]:
            continue
        am, bm = _split(x, f[0], f[1], depth), _split(y, f[2], f[3], depth)
        crossed = np.stack([am, f[1], f[2], bm, f[4] + 1])
        if same:  # a node with itself has one pair of different children
            crossed = crossed[:, f[0] != f[2]]
        below = np.concatenate([np.stack([f[0], am, f[2], bm, f[4]]), np.stack([am, f[1], bm, f[3], f[4]]), np.stack([f[0], am, bm, f[3], f[4] + 1]), crossed], axis=1)
        below = below[:, (below[0] < below[1]) & (below[2] < below[3]) & (below[4] <= allowed[depth + 1])]
        # pairs with fewest errors last, so that they are walked first
        below = below[:, np.argsort(-below[4], kind="stable")]
        todo += [(depth + 1, below[:, i : i + WALKED]) for i in range(0, below.shape[1], WALKED)]


def _joined(table: pa.Table) -> pa.Table:
    """Edges that span the links among the fingerprints of a pair of blocks."""
    trie, a, b = (table.column(i)[0].as_py() for i in range(3))
    side, values = table.column("side").to_numpy(), table.column("value").to_numpy().view(np.uint64)
    x, y = np.unique(values[side == 0]), np.unique(values[side == 1])
    sets = Together(len(x) + len(y))
    if a == b:
        walk(x, None, sets)
    else:
        walk(x, y, sets, len(x))
    both = turned(np.concatenate([x, y]), trie).view(np.int64)
    joined = np.flatnonzero(sets.label != np.arange(len(both)))
    return pa.table({"a": both[joined], "b": both[sets.label[joined]]})


def _leaves(values: DataFrame, most: int) -> Leaves:
    """From counts of prefixes, four bits longer each time for those that hold too many: a row for 1/16 of a leaf's worth comes to the
    driver, at most."""
    prefix = lambda depth: F.shiftrightunsigned("value", 64 - depth)
    found, depth, heavy = [], 8, None
    while depth == 8 or heavy:
        rows = values
        if heavy:
            dense = values.sparkSession.createDataFrame([(p,) for p in heavy], "prefix long")
            rows = values.join(F.broadcast(dense), prefix(depth - 4) == F.col("prefix"), "left_semi")
        counts = [(r["p"], r["count"]) for r in rows.groupBy(prefix(depth).alias("p")).count().collect()]
        found += [(depth, p, n) for p, n in counts if n <= most or depth == 32]
        heavy = [p for p, n in counts if n > most] if depth < 32 else None
        depth += 4
    return Leaves(found, most)


def links(values: DataFrame, most: int = LEAF) -> DataFrame:
    """(a, b): edges that span the links of the different fingerprints `value`, longs without nulls. values is read several times."""
    tries = [_leaves(values.select(column.alias("value")), most) for column in (F.col("value"), F.shiftleft("value", 32).bitwiseOR(F.shiftrightunsigned("value", 32)))]
    cells = values.select("value").mapInArrow(lean(_celled(tries)), "trie int, a long, b long, side int, value long")
    return cells.groupBy("trie", "a", "b").applyInArrow(_joined, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 3, most: int = LEAF) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (least doc_id that links reach, its own included) of every row.

    docs needs doc_id and text; other columns are ignored. A-Z are lower-cased; words are [^\\x20\\x09-\\x0D]+; a text of fewer
    words than size has one shingle, all its words. Null texts and texts without words have the fingerprint zero, which is
    linked like any other. Rows of a null doc_id take part, and their component_id is the least id reached, null if there
    is none. Repeated rows are returned each. An empty table gives an empty one.
    """
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(_fingerprinted(size)), "doc_id long, value long"))
    values = cut(rows.groupBy("value").agg(F.min("doc_id").alias("least")))
    linked = components(cut(links(values.select("value"), most)))
    lowest = values.join(linked, F.col("value") == F.col("vertex")).groupBy("root").agg(F.min("least").alias("lowest"))
    reached = spread_join(linked, "root", lowest, F.col("vertex")).select(F.col("vertex").alias("value"), "lowest")
    named = cut(values.join(reached, "value", "left").select("value", F.coalesce("lowest", "least").alias("component_id")))
    out = spread_join(rows, "value", named, F.xxhash64("doc_id"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"), "component_id")
