"""N-gram Jaccard join by prefix trees: which documents are linked, directly or over others, by equal word n-grams.

Two documents link when 100 * intersection >= percent * union of their sets of word n-grams. The join is exact:

1. Documents of equal sets form a class; from here on classes take the place of documents.
2. N-grams have one global order: those that are known to be very frequent last, by hash otherwise. Linked sets
   share an n-gram among the first n - ceil(percent * n / 100) + 1 of each, their prefixes. Rare n-grams of the
   prefixes yield candidate pairs, of which those go that share too few prefix n-grams for their sizes. Classes
   that meet in a frequent n-gram of their prefixes (large groups of near copies) are candidates as a whole, but
   for those whose prefixes have fewer frequent n-grams than any of the sizes met there would have to share.
3. Connected candidates form families. There a trie holds the ordered sets of a block, equal beginnings once. Other
   sets walk the trie with the overlap so far, and leave a subtree when what remains on either side cannot reach the
   needed overlap, or when all below is linked with it already. A task emits what its links span, not the pairs.
   A family of several blocks is joined in two steps, as most of a group of near copies hangs together by few of its
   links: first each block with itself and with a few sets that all blocks get; then what is not in the family's
   largest component yet meets all blocks. Sets that are both in that component need no test.
   In a family of many blocks step 2 comes once more before that, with n-grams counted in its whole sets: the counts of
   the first pass know beginnings only, so that sets with a passage in common stay candidates as a whole there.
4. The components of these edges are the result.

Which n-grams are called frequent changes the work, never the result: at most HOT_MOST are, and lists of others
that turn out long are treated like them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import NO_ID, cut, lean, mixed, packed, shared_dir, slices, spread_join, text_bytes, unpacked, window_hashes, word_hashes, word_spans
from shelfmark.llm.graph import Forest, components

#: A list of more sets than this is frequent. Most n-grams that are broadcast as frequent (8 bytes each).
HOT, HOT_MOST = 64, 1 << 18
#: Sets in a block of a family, and n-grams, at most about; of those left over in a block of the second step.
BLOCK, BLOCK_GRAMS, LEFT = 32, 1 << 21, 512
#: Sets of a large family that all of its blocks get.
PIVOTS = 4
#: Candidates are sought anew in families of more blocks than this. Ranges of sizes on either side of a set's own.
WIDE, RANGES = 8, 31
#: Bits of the sieve that keeps most texts without a family from being shipped; a power of two.
SIEVE = 1 << 22
ROWS = "doc_id long, key long, row long, cls long, n long, rare int, tokens binary, check long"


def shingle_sets(batch: pa.RecordBatch, size: int, column: int = 1) -> Iterator[np.ndarray]:
    """For each row its set of hashed n-grams, ascending. A-Z are lower-cased; words are [^\\x20\\x09-\\x0D]+; a text of
    fewer words than size has one n-gram, all its words; null and texts without words have none."""
    for part in slices(batch, batch.schema.names[column]):
        data, offsets = text_bytes(part.column(column))
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        starts, ends, first = word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        windows = window_hashes(words, size)
        for i in range(part.num_rows):
            low, high = first[i], first[i + 1]
            if high - low >= size:
                found = np.sort(windows[low : high - size + 1])
                yield found[np.append(True, found[1:] != found[:-1])]
            else:
                yield window_hashes(words[low:high], int(high - low)) if high > low else words[:0]


def needed(n: int, percent: int) -> int:
    """Least intersection that a set of n shares with any set it is linked with."""
    return -(-percent * n // 100)


def overlap(n: np.ndarray | int, m: np.ndarray | int, percent: int):
    """Least intersection with which sets of n and m are linked: 100 i >= percent * (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def shared_in_prefixes(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least number of n-grams that linked sets of n and m share in their prefixes."""
    return np.maximum(1, overlap(n, m, percent) - np.maximum(needed(n, percent), needed(m, percent)) + 1)


def _prefix(found: np.ndarray, hot: tuple[np.ndarray, np.ndarray], percent: int) -> tuple[int, np.ndarray]:
    """A set's prefix: how many rare n-grams it has, and those, then frequent ones by their ranks. hot: frequent n-grams, and ranks."""
    frequent, ranks = hot
    count = len(found) - needed(len(found), percent) + 1
    if not len(frequent):
        return len(found[:count]), found[:count]
    place = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
    is_hot = frequent[place] == found
    rare = found[~is_hot][:count]
    order = np.argsort(ranks[place[is_hot]])[: count - len(rare)]
    return len(rare), np.concatenate([rare, found[is_hot][order]])


def _digest(found: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two longs: its class, and what tells classes of equal number apart."""
    whole = xxhash.xxh3_128_intdigest(found.tobytes())
    return (whole >> 64) - (1 << 63), (whole & ((1 << 64) - 1)) - (1 << 63)


def _prefix_tokens(size: int, percent: int):
    """The n-grams of half as much again as the prefix, for counting; those of equal sets of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: set[tuple[int, int]] = set()
            parts = []
            for found in shingle_sets(b, size, 0):
                if len(found) and (d := _digest(found)) not in seen:
                    seen.add(d)
                    parts.append(found[: (len(found) - needed(len(found), percent) + 1) * 3 // 2 + 1])
            yield pa.record_batch([pa.array(np.concatenate(parts).view(np.int64) if parts else [], pa.int64())], names=["token"])

    return run


def _rows(size: int, percent: int, hot):
    """ROWS: the hash and size of each row's set, and its prefix: rare n-grams, then frequent ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made: list[tuple] = []
            for found in shingle_sets(b, size, 3):
                rare, tokens = _prefix(found, hot.value, percent)
                cls, check = _digest(found) if len(found) else (None, None)
                made.append((cls, len(found), rare, tokens.tobytes(), check))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]
            yield pa.record_batch([*b.columns[:3], *(pa.array([x[i] for x in made], k) for i, k in enumerate(kinds))], names=[x.split()[0] for x in ROWS.split(", ")])

    return run


def _prefixes(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """From cls, n, rare and tokens, equal sets once: these three, the n-grams of all prefixes, and of each its set and place there."""
    _, once = np.unique(b.column(0).to_numpy(), return_index=True)
    cls, n, rare = (b.column(i).to_numpy()[once] for i in range(3))
    blobs = b.column(3).take(pa.array(once)).to_pylist()
    sizes = np.array([len(x) // 8 for x in blobs], np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return cls, n, rare, np.frombuffer(b"".join(blobs), np.int64), owner, place


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From cls, n, rare and tokens: (token, cls, n, hot) for each rare n-gram of each prefix; equal sets of a batch once. hot: how
    many frequent n-grams the prefix has."""
    for b in batches:
        cls, n, rare, tokens, owner, place = _prefixes(b)
        hot = np.bincount(owner, minlength=len(cls)) - rare
        own = owner[keep := place < rare[owner]]
        yield pa.record_batch([pa.array(x) for x in (tokens[keep], cls[own], n[own].astype(np.int32), hot[own].astype(np.int32))], names=["token", "cls", "n", "hot"])


def _candidates(percent: int):
    """From postings in order of token: (a, b, share, whole) candidate pairs, and with whole, (n-gram, class) members of long
    lists. share: rare n-grams that a and b must share in their prefixes, if they share all frequent ones there."""
    kinds = [np.int64, np.int64, np.int64, np.bool_]

    def batch(*columns: np.ndarray) -> pa.RecordBatch:
        a, b, share, whole = (x.astype(k) for x, k in zip(columns, kinds, strict=True))
        return pa.record_batch([pa.array(a), pa.array(b), pa.array(share.astype(np.int32)), pa.array(whole)], names=["a", "b", "share", "whole"])

    def members(token: np.ndarray, cls: np.ndarray) -> pa.RecordBatch:
        return batch(token, cls, np.ones(len(token)), np.ones(len(token)))

    def once(columns: list[np.ndarray]) -> list[np.ndarray]:
        """Rows in order of n-gram and class, equal ones once."""
        token, cls = columns[:2]
        order = np.lexsort((cls, token))
        token, cls = token[order], cls[order]
        return [x[order[np.append(True, (token[1:] != token[:-1]) | (cls[1:] != cls[:-1]))[: len(order)]]] for x in columns]

    def lists(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """What whole lists yield."""
        token, cls, n, hot = once(columns)
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])[: len(token)])
        sizes = np.diff(np.append(starts, len(token)))
        ends, many = np.repeat(starts + sizes, sizes), np.repeat(sizes > HOT, sizes)
        if many.any():
            yield members(token[many], cls[many])
        left, step, found = np.flatnonzero(~many), 1, []
        while len(left := left[left + step < ends[left]]):  # pairs of places that are so far apart
            right = left + step
            fit = 100 * np.minimum(n[left], n[right]) >= percent * np.maximum(n[left], n[right])
            i, j = left[fit], right[fit]
            found.append((cls[i], cls[j], np.maximum(1, shared_in_prefixes(n[i], n[j], percent) - np.minimum(hot[i], hot[j]))))
            step += 1
        if found:
            pairs = [np.concatenate(x) for x in zip(*found, strict=True)]
            yield batch(*pairs, np.zeros(len(pairs[0])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, long = [np.empty(0, np.int64)] * 4, None  # rows of the last n-gram, whose list may go on; one whose list is long
        for b in batches:
            columns = [np.concatenate([x, b.column(i).to_numpy().astype(np.int64)]) for i, x in enumerate(held)]
            token = columns[0]
            if not len(token):
                continue
            first = int(np.searchsorted(token != long, True)) if long is not None else 0
            if first:
                yield members(token[:first], columns[1][:first])
            same = np.append(False, token[1:] == token[:-1])
            last = int(np.flatnonzero(~same)[-1]) if first < len(token) else first
            several = same | np.append(same[1:], False)
            several[:first], several[last:] = False, False
            if several.any():
                yield from lists([x[several] for x in columns])
            held, long = once([x[last:] for x in columns]), None if first < len(token) else long
            if len(held[0]) > HOT:
                yield members(*held[:2])
                held, long = [np.empty(0, np.int64)] * 4, int(token[-1])
        yield from lists(held)

    return run


def _spots(percent: int):
    """From cls, n, rare and tokens: (token, cls, bucket, mask) for frequent n-grams of each prefix. bucket: the range of n, of which
    RANGES hold all sizes that a set can link with on one side. mask: in which buckets, by their distance from the own one (RANGES is
    added), sets may have so few n-grams to share with this one that they share one of its frequent ones up to here, and no rare one:
    where s must be shared and it has h, among the first h - s + 1."""
    width = max(np.log(100 / percent), 1e-6) / (RANGES - 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, n, rare, tokens, owner, place = _prefixes(b)
            hot = np.bincount(owner, minlength=len(cls)) - rare
            keep = place >= rare[owner]
            tokens, owner, place = tokens[keep], owner[keep], (place - rare[owner])[keep]
            bucket, mask = np.floor(np.log(n) / width).astype(np.int64), np.zeros(len(tokens), np.int64)
            for bit in range(2 * RANGES + 1):
                at = bucket + bit - RANGES
                low = np.maximum(np.floor(np.exp(at * width)).astype(np.int64) - 1, needed(n, percent))
                high = np.minimum(np.ceil(np.exp((at + 1) * width)).astype(np.int64) + 1, 100 * n // percent)
                # least at one of the ends, but for rounding
                share = np.maximum(1, np.minimum(shared_in_prefixes(n, low, percent), shared_in_prefixes(n, high, percent)) - 1)
                mask |= (place < np.where(low <= high, hot - share + 1, 0)[owner]).astype(np.int64) << bit
            own = owner[some := mask != 0]
            yield pa.record_batch([pa.array(x) for x in (tokens[some], cls[own], bucket[own].astype(np.int32), mask[some])], names=["token", "cls", "bucket", "mask"])

    return run


def _partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (token, bucket, mask) in order of token: (token, bucket, partners), the bits of mask whose buckets have the bit of this one."""
    for rows in _groups(batches, 1):
        bucket, mask = (np.array([r[i] for r in rows], np.int64) for i in (1, 2))
        step = bucket[None] - bucket[:, None] + RANGES
        bit = np.clip(step, 0, 2 * RANGES)
        both = (step == bit) & ((mask[:, None] >> bit) & (mask[None] >> (2 * RANGES - bit)) & 1).astype(bool)
        partners = np.bitwise_or.reduce(np.where(both, np.int64(1) << bit, 0), axis=1)
        yield pa.record_batch([pa.array(x) for x in (np.full(len(rows), rows[0][0]), bucket.astype(np.int32), partners)], names=["token", "bucket", "partners"])


def _candidate_edges(rows: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect all classes that may be linked. rows: cls, n, rare, tokens, read twice. Vertices are classes, and
    n-grams that many of them meet in."""
    rows = rows.filter("cls is not null").select("cls", "n", "rare", "tokens")
    postings = rows.filter("rare > 0").mapInArrow(lean(_postings), "token long, cls long, n int, hot int")
    found = postings.repartition("token").sortWithinPartitions("token").mapInArrow(lean(_candidates(percent)), "a long, b long, share int, whole boolean")
    shared = found.groupBy("a", "b", "whole").agg(F.count("*").alias("met"), F.max("share").alias("share"))
    edges = shared.filter(F.col("whole") | (F.col("met") >= F.col("share"))).select("a", "b")
    spots = cut(rows.filter("length(tokens) > 8 * rare").mapInArrow(lean(_spots(percent)), "token long, cls long, bucket int, mask long"))
    if spots.isEmpty():
        return edges
    seen = spots.groupBy("token", "bucket").agg(F.bit_or("mask").alias("mask")).repartition("token").sortWithinPartitions("token")
    key = F.xxhash64("token", "bucket").alias("key")
    partners = cut(seen.mapInArrow(lean(_partners), "token long, bucket int, partners long").filter("partners <> 0").select(key, "partners"))
    met = spread_join(spots.select("token", "cls", "mask", key), "key", partners, F.col("cls")).filter(F.col("mask").bitwiseAND(F.col("partners")) != 0)
    return edges.unionByName(met.select(F.col("token").alias("a"), F.col("cls").alias("b")))


class Trie:
    """Ordered sets of integers below `top`, equal beginnings once: nodes stand for runs of numbers that all sets below
    them go on with. Nodes are in order of depth, so that a walk goes on level by level with whole arrays."""

    def __init__(self, sets: list[np.ndarray], top: int):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].tolist())
        ordered = [sets[i] for i in self.order]
        self.sizes = np.array([len(x) for x in ordered])
        common = [self._common(a, b) for a, b in zip(ordered, ordered[1:], strict=False)]
        runs, nodes, levels = [], [], [[(0, len(ordered), 0)]] if ordered else []
        # a level's entries: sets low to high that agree on their first `depth` numbers
        level = levels[0] if levels else []
        self.levels: list[tuple[np.ndarray, ...]] = []
        at = 0
        while level:
            below, rows = [], []
            for parent, (low, high, depth) in enumerate(level):
                i = low
                while i < high:
                    j, least = i + 1, len(ordered[i])
                    while j < high and common[j - 1] > depth:
                        least = min(least, common[j - 1])
                        j += 1
                    least = max(least, depth) if j > i + 1 else len(ordered[i])
                    run = ordered[i][depth:least]
                    runs.append(run)
                    rows.append((parent, i, j, at, at + len(run), least, int(run[-1]) if len(run) else -1, int(self.sizes[i:j].min()), int(self.sizes[i:j].max())))
                    at += len(run)
                    below.append((i, j, least) if j > i + 1 else (i, i, least))
                    i = j
            self.levels.append(tuple(np.array(x) for x in zip(*rows, strict=True)))
            # sets that end here are the first of their node; the others go deeper
            level = [(low + sum(len(ordered[k]) == depth for k in range(low, high)), high, depth) if high > low else (low, low, depth) for low, high, depth in below]
            if all(high <= low for low, high, _ in level):
                break
        self.numbers = np.concatenate(runs) if runs else np.empty(0, np.int64)
        self.mask = np.zeros(top, bool)

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    def linked(self, probe: np.ndarray, percent: int, same: np.ndarray) -> list[int]:
        """Sets (by their first places) linked with probe. same: for each set, in order, whether it needs no test."""
        self.mask[:] = False
        self.mask[probe] = True
        hits = np.concatenate([[0], np.cumsum(self.mask[self.numbers])])
        done = np.concatenate([[0], np.cumsum(same)])
        n, out = len(probe), []
        counts = None
        for parent, low, high, start, end, depth, last, least, most in self.levels:
            got = hits[end] - hits[start]
            live = np.ones(len(got), bool)
            if counts is not None:
                live = counts[1][parent]
                got = got + counts[0][parent]
            live &= done[high] - done[low] < high - low
            rest = np.minimum(n - np.searchsorted(probe, last, "right"), most - depth)
            live &= (got + rest >= overlap(n, np.maximum(least, needed(n, percent)), percent)) & (100 * most >= percent * n)
            for k in np.flatnonzero(live):
                for i in range(low[k], high[k]):  # sets that end in this node come first
                    if self.sizes[i] != depth[k]:
                        break
                    if not same[i] and 100 * got[k] >= percent * (n + self.sizes[i] - got[k]):
                        out.append(self.order[i])
            counts = got, live
        return out


def join_blocks(left: list[tuple[int, np.ndarray]], right: list[tuple[int, np.ndarray]] | None, percent: int, roots: dict[int, int] | None = None) -> list[tuple[int, int]]:
    """Edges (class, class) that span the links between two blocks, or within one where right is None. roots: the known component
    of classes; links inside one are left out."""
    everything = left + (right or [])
    if len(everything) < 2:
        return []
    _, numbers = np.unique(np.concatenate([x for _, x in everything]), return_inverse=True)
    cuts = np.cumsum([0, *(len(x) for _, x in everything)])
    ordered = [numbers[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    top, forest, edges = int(numbers.max()) + 1, Forest(), []
    for cls, root in (roots or {}).items():
        forest.join(cls, root)
    trie = Trie(ordered[: len(left)], top)
    names = [everything[i][0] for i in trie.order]
    probes = range(len(left)) if right is None else range(len(left), len(everything))
    for i in probes:
        own = everything[i][0]
        root = forest.root(own)
        same = np.fromiter((forest.root(x) == root for x in names), bool, len(names))
        for j in trie.linked(ordered[i], percent, same):
            if forest.join(own, everything[j][0]):
                edges.append((own, everything[j][0]))
    return edges


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows of batches that are in order of their first columns, gathered by these; one group is held at a time."""
    waiting: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if waiting and row[:keys] != waiting[0][:keys]:
                yield waiting
                waiting = []
            waiting.append(row)
    if waiting:
        yield waiting


def _set(grams: bytes) -> np.ndarray:
    return np.frombuffer(grams, np.uint64)


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([e[i] for e in found], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _within(percent: int):
    """Edges inside each block of rows (family, block, cls, grams)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, 2):
            yield _edges(join_blocks([(cls, _set(g)) for cls, g in {r[2]: r[3] for r in rows}.items()], None, percent))

    return run


def _across(percent: int):
    """Edges between the two sides of each group of rows (family, left, block, side, cls, root, grams)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, 3):
            sides = [[(r[4], _set(r[6])) for r in rows if r[3] == side] for side in (0, 1)]
            if all(sides):
                yield _edges(join_blocks(*sides, percent, {r[4]: r[5] for r in rows}))

    return run


def _sieved(size: int, words: np.ndarray):
    """key, row and grams of the rows whose bit the sieve has; equal rows of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = b.column(1).to_numpy() & (SIEVE - 1)
            hit = np.flatnonzero((words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1))
            own = b.take(pa.array(hit[np.unique(b.column(1).to_numpy()[hit], return_index=True)[1]]))
            grams = pa.array([x.tobytes() for x in shingle_sets(own, size, 2)], pa.binary())
            yield pa.record_batch([own.column(0), own.column(1), grams], names=["key", "row", "grams"])

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with key and row: a row is known by its id and a hash, as ids may be null or repeated."""
    return docs.withColumns({"key": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "row": F.xxhash64("doc_id", "text")})


def _frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of counts (token, count) those of more than HOT, the most frequent ones, if they are more than HOT_MOST: ascending, and
    their ranks by count."""
    least, broad = HOT, 0
    for row in counts.groupBy(F.floor(F.log2("count")).cast("int").alias("power")).count().orderBy(F.desc("power")).collect():
        broad += row["count"]
        if broad > HOT_MOST:  # only the most frequent are broadcast
            least = 2 ** (row["power"] + 1) - 1
            break
    found = counts.filter(F.col("count") > least).select("token", "count").collect()
    frequent, times = np.array([r["token"] for r in found], np.int64).view(np.uint64), np.array([r["count"] for r in found], np.int64)
    order = np.argsort(frequent)
    frequent, times = frequent[order], times[order]
    ranks = np.empty(len(found), np.int32)
    ranks[np.lexsort((frequent, times))] = np.arange(len(found))
    return frequent, ranks


def _stored_rows(keyed: DataFrame, size: int, percent: int) -> DataFrame:
    """ROWS of all rows, written once."""
    spark = keyed.sparkSession
    counts = cut(keyed.select("text").mapInArrow(lean(_prefix_tokens(size, percent)), "token long").groupBy("token").count().filter(F.col("count") > HOT))
    hot = spark.sparkContext.broadcast(_frequent(counts))
    path = shared_dir(spark, "ngram-rows")
    keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "key", "row", "text").mapInArrow(lean(_rows(size, percent, hot)), ROWS).write.parquet(path)
    return told_apart(spark.read.schema(ROWS).parquet(path))


def told_apart(rows: DataFrame) -> DataFrame:
    """rows with different classes for different sets: of those that have one number of 64 bits by chance (half the square of the
    rows over 2**64, so about three of ten billion), all but one get another."""
    sets = rows.filter("cls is not null").groupBy("cls").agg(F.min("check").alias("_own"), F.max("check").alias("_most"))
    clashes = cut(sets.filter("_own <> _most").select("cls", "_own"))
    if clashes.isEmpty():
        return rows
    other = F.when(F.col("check") > F.col("_own"), F.xxhash64("cls", "check")).otherwise(F.col("cls"))
    return rows.join(F.broadcast(clashes), "cls", "left").withColumn("cls", other).select(*rows.columns)


def _dealt(members: DataFrame) -> DataFrame:
    """members (family, n and others; stored) of families of two at least, with n_blocks."""
    sizes = members.groupBy("family").agg(F.count("*").alias("members"), F.sum("n").alias("grams")).filter("members > 1")
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int").alias("n_blocks")
    return cut(spread_join(members, "family", sizes.select("family", blocks), F.col("cls")).filter("n_blocks is not null"))


def _family_sets(keyed: DataFrame, rows: DataFrame, candidates: DataFrame, size: int) -> DataFrame:
    """family, n_blocks, cls and grams of each class that has candidates."""
    families = components(candidates).withColumnsRenamed({"vertex": "cls", "root": "family"})
    # a class stands for its documents, and any row of it has its text
    heads = rows.filter("cls is not null").groupBy("cls").agg(F.min(F.struct("key", "row")).alias("h"), F.max("n").alias("n")).select("cls", "h.key", "h.row", "n")
    members = cut(heads.join(families, "cls"))
    wanted = _dealt(members)
    place = F.col("row").bitwiseAND(SIEVE - 1)
    bits = wanted.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("bits"))
    words = np.zeros(SIEVE >> 6, np.uint64)
    for r in bits.collect():  # as many rows as the sieve has words, whatever the input
        words[r["word"]] = r["bits"] & 0xFFFFFFFFFFFFFFFF
    found = keyed.select("key", "row", "text").mapInArrow(lean(_sieved(size, words)), "key long, row long, grams binary")
    return cut(found.join(wanted, ["key", "row"]).dropDuplicates(["key", "row"]).select("family", "n_blocks", "cls", "grams"))


def _own_tokens(family: int, grams: bytes) -> np.ndarray:
    """A set's n-grams as numbers that are the family's own, ascending."""
    return np.sort(mixed(_set(grams) ^ np.uint64(family & ((1 << 64) - 1))))


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (family, grams): (token, count) of about so many n-grams at a time as a block has."""
    for b in batches:
        waiting, held = [], 0
        for i, (family, grams) in enumerate(zip(b.column(0), b.column(1), strict=True)):
            waiting.append(_own_tokens(family.as_py(), grams.as_py()))
            held += len(waiting[-1])
            if held >= BLOCK_GRAMS or i + 1 == b.num_rows:
                tokens, counts = np.unique(np.concatenate(waiting), return_counts=True)
                yield pa.record_batch([pa.array(tokens.view(np.int64)), pa.array(counts, pa.int64())], names=["token", "count"])
                waiting, held = [], 0


def _family_rows(percent: int, hot):
    """From (family, cls, grams): cls, n, rare and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for family, cls, grams in zip(*b.columns, strict=True):
                found = _own_tokens(family.as_py(), grams.as_py())
                rare, tokens = _prefix(found, hot.value, percent)
                made.append((cls.as_py(), len(found), rare, tokens.tobytes()))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.record_batch([pa.array([x[i] for x in made], k) for i, k in enumerate(kinds)], names=["cls", "n", "rare", "tokens"])

    return run


def _narrowed(sets: DataFrame, percent: int) -> DataFrame:
    """sets, with those of families of more than WIDE blocks in smaller families or left out: candidates are sought again in
    each by n-grams that are counted in its whole sets."""
    wide = sets.filter(F.col("n_blocks") > WIDE)
    if wide.isEmpty():
        return sets
    counts = cut(wide.select("family", "grams").mapInArrow(lean(_tally), "token long, count long").groupBy("token").agg(F.sum("count").alias("count")).filter(F.col("count") > HOT))
    hot = sets.sparkSession.sparkContext.broadcast(_frequent(counts))
    rows = cut(wide.select("family", "cls", "grams").mapInArrow(lean(_family_rows(percent, hot)), "cls long, n long, rare int, tokens binary"))
    families = components(_candidate_edges(rows, percent)).withColumnsRenamed({"vertex": "cls", "root": "family"})
    own = _dealt(cut(rows.select("cls", "n").join(families, "cls"))).join(wide.select("cls", "grams"), "cls")
    return cut(sets.filter(F.col("n_blocks") <= WIDE).unionByName(own.select("family", "n_blocks", "cls", "grams")))


def _family_links(sets: DataFrame, percent: int) -> DataFrame:
    """(vertex, root) of every class that is linked."""
    block = F.pmod(F.xxhash64("cls"), "n_blocks").cast("int").alias("block")
    large = sets.filter("n_blocks > 1")
    chosen = large.groupBy("family").agg(F.array_distinct(F.array(*(F.min(F.struct(F.xxhash64("cls", F.lit(j)), "cls"))["cls"] for j in range(PIVOTS)))).alias("pivots"))
    pivots = large.join(chosen.select(F.explode("pivots").alias("cls")), "cls").select("family", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"), "cls", "grams")
    first = sets.select("family", block, "cls", "grams").unionByName(pivots)
    # written first: in one stage with what follows, each task would hold two Python workers
    links = cut(first.repartition("family", "block").sortWithinPartitions("family", "block").mapInArrow(lean(_within(percent)), "a long, b long"))
    linked = components(links)
    if large.isEmpty():
        return linked
    named = cut(large.select("family", "n_blocks", "cls").join(linked, F.col("cls") == F.col("vertex"), "left").select("family", "n_blocks", "cls", F.coalesce("root", "cls").alias("root")))
    largest = named.groupBy("family", "root").count().groupBy("family").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
    marked = cut(spread_join(named, "family", largest, F.col("cls")))
    outside = marked.filter("root <> main")
    if outside.isEmpty():
        return linked
    lefts = outside.groupBy("family").agg(F.ceil(F.count("*") / LEFT).cast("int").alias("lefts"))
    every = spread_join(marked, "family", lefts, F.col("cls")).filter("lefts is not null").join(large.select("cls", "grams"), "cls")
    own = every.filter("root <> main").select("family", F.pmod(F.xxhash64("cls", F.lit(1)), "lefts").cast("int").alias("left"), F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"), F.lit(1).alias("side"), "cls", "root", "grams")
    others = every.select("family", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)).alias("left"), block, F.lit(0).alias("side"), "cls", "root", "grams")
    both = own.unionByName(others).repartition("family", "left", "block").sortWithinPartitions("family", "left", "block")
    return components(links.unionByName(cut(both.mapInArrow(lean(_across(percent)), "a long, b long"))))


def _linked(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """ROWS of all rows, and (vertex, root) of the classes that are linked: root is the same all over a component."""
    keyed = _keyed(docs.select("doc_id", "text"))
    rows = _stored_rows(keyed, size, percent)
    sets = _narrowed(_family_sets(keyed, rows, _candidate_edges(rows, percent), size), percent)
    return rows, _family_links(sets, percent)


def join_documents(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles (of the document's set) and component_id (least doc_id that links reach, its own included).

    docs needs doc_id and text; other columns are ignored. Null and empty texts have no set and no links. Rows of a
    null doc_id take part, and their component_id is the least id reached, null if there is none. Repeated rows are
    returned each. An empty table gives an empty one.
    """
    rows, linked = _linked(docs, size, percent)
    rows = rows.select("doc_id", "row", "cls", "n")
    least = cut(rows.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least")))
    together = linked.join(least, F.col("vertex") == F.col("cls")).groupBy("root").agg(F.min("least").alias("lowest"))
    reached = spread_join(linked, "root", together, F.col("vertex")).select(F.col("vertex").alias("cls"), "lowest")
    named = cut(least.join(reached, "cls", "left").select("cls", F.coalesce("lowest", "least").alias("least")))
    out = spread_join(rows, "cls", named, F.col("row"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each component: that of the least doc_id (null counts as least), of equal ids that of the least
    hash, of equal rows one. Rows without words are in no component and stay. Columns and their order are kept, whatever
    their names."""
    rows, linked = _linked(docs, size, percent)
    heads = cut(rows.filter("cls is not null").groupBy("cls").agg(F.min(F.struct("key", "row")).alias("h")))
    alone = heads.join(linked, F.col("cls") == F.col("vertex"), "left_anti").select("h")
    together = heads.join(linked, F.col("cls") == F.col("vertex")).groupBy("root").agg(F.min("h").alias("h")).select("h")
    kept = alone.unionByName(together).select("h.key", "h.row")
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    whole = packed(docs.columns).alias("whole")
    # rows without words are not shuffled: they would all have few keys
    own = _keyed(docs.filter(has_words).select("doc_id", "text", whole)).select("key", "row", "whole").join(kept, ["key", "row"])
    first = Window.partitionBy("key", "row").orderBy(F.xxhash64("whole"))
    once = own.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select("whole")
    stay = docs.filter(~has_words).select(whole)
    return once.unionByName(stay).select(*unpacked(docs.columns, "whole").values())
