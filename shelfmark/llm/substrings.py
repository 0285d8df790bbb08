"""Substring dedup by relative Lempel-Ziv parsing against an index that is dealt out in reference blocks.

A factor of a document is a run of words that also stands earlier: in a document of smaller id, or further ahead in
the same one. Factors of `size` words or more are found exactly, whatever their number of copies:

1. Every window of `size` words has an anchor, the n-gram of least rank inside it, so that equal windows have equal
   anchors. Rank is a hash, and n-grams that are frequent in the texts come after all others: a window over the edge
   of a common passage then has an anchor outside it. Anchors are dealt by hash; those that stand in one place alone
   belong to no repeated window. Frequent ones are repeated by their counts and aren't sent.
   Whole documents ride along by 128 bits of hashes of all their words: later copies are one factor each.
2. The windows of a repeated anchor's place are one segment of text. Segments are dealt by their anchors, and gathered
   anchor by anchor into reference blocks. A block's index holds every word sequence of `size` words or more of its
   segments and where it stands first. Each segment is parsed greedily against it: from the first window that stands
   earlier, the longest sequence that stands earlier is the next factor, found by going on word by word. At the
   factor's boundary the parse goes on with the window after its last one, which still overlaps it; so no window of
   a document is left out. Factors are compared with their references as text, word for word.
3. Factors come back to their documents. Those that go on with each other, here and in their reference, are joined to maximal
   ones, over the edges of segments; these are the spans, and the words they cover go.

Each slice of a task first settles equal segments among its own rows and sends one on: a passage that stands in a third
of all documents costs a block one segment per slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import NO_ID, lean, mixed, packed, ranged_hashes, slices, text_bytes, unpacked, window_hashes, word_hashes, word_spans

#: Words of an anchor, as long as windows have twice as many.
ANCHOR = 8
#: N-grams with more than HOT places for each SHARE bytes of text are frequent: at most a HOT-th of a share's words. They are counted
#: PART bytes at a time. This steers what is sent where; which windows are repeated doesn't hang on it.
SHARE, HOT, PART = 32 << 20, 8, 16 << 20
#: Groups of anchors for each partition of a shuffle, at least, and bytes of text for one, at most about.
BLOCKS, BLOCK_BYTES = 4, 12 << 20
#: Bytes of segments in a reference block; the segments of one anchor stay together.
REFERENCE = 2 << 20
ANCHORS = "block int, known boolean, hash binary, more binary, doc binary, row binary, pos binary"
SEGMENTS = "deal long, doc long, row long, pos int, windows int, ref_doc long, ref_pos int, text binary"
FACTOR = "doc long, row long, start int, windows int, ref_doc long, ref_start int"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


class Windows:
    """Words and windows of a batch of texts. In `first`, the first word of each text and the count of all."""

    def __init__(self, texts: pa.Array, size: int, frequent: np.ndarray):
        self.data, offsets = text_bytes(texts)
        self.starts, self.ends, self.first = word_spans(self.data, offsets)
        self.words = word_hashes(self.data, self.starts, self.ends)
        #: Where in the words each whole window begins, its text, its anchor's place, and whether that is frequent.
        counts = np.diff(self.first)
        whole = np.maximum(counts - size + 1, 0)
        self.text = np.repeat(np.arange(len(counts)), whole)
        self.at = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole) + np.repeat(self.first[:-1], whole)
        n = anchor_words(size)
        self.grams = window_hashes(self.words, n)
        common = among(self.grams, frequent)
        rank = (self.grams >> np.uint64(1)) | (common.astype(np.uint64) << np.uint64(63))
        view = np.lib.stride_tricks.sliding_window_view(rank, size - n + 1) if len(self.at) else np.empty((0, 1))
        self.anchor = self.at + np.concatenate([view[self.at[i : i + 65536]].argmin(1) for i in range(0, len(self.at), 65536)] or [self.at])
        self.common = common


def anchor_words(size: int) -> int:
    return min(ANCHOR, -(-size // 2))


def among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Whether each value is one of `some`, which are in order."""
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values if len(some) else np.zeros(len(values), bool)


def _frequent(texts: DataFrame, size: int, most: float) -> np.ndarray:
    """The n-grams that have more than `most` places in all texts, in order. Every text is read and every n-gram counted, PART bytes of
    a task at a time; a part tells of those that have two places in it and their share of a frequent one's, so that counts may
    be short by what is rare in a part."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, held, kept = anchor_words(size), 0, []

        def told() -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(kept), return_counts=True)
            some = counts >= max(2, HOT * held / SHARE)
            return pa.record_batch([pa.array(hashes[some].view(np.int64)), pa.array(counts[some], pa.int64())], names=["hash", "places"])

        for batch in batches:
            for b in slices(batch):
                data, offsets = text_bytes(b.column(0))
                starts, ends, first = word_spans(data, offsets)
                inside = np.maximum(np.diff(first) - n + 1, 0)
                at = np.arange(inside.sum()) - np.repeat(np.cumsum(inside) - inside, inside) + np.repeat(first[:-1], inside)
                kept.append(window_hashes(word_hashes(data, starts, ends), n)[at])
                held += len(data)
                if held >= PART:
                    yield told()
                    kept.clear()
                    held = 0
        if kept:
            yield told()

    found = texts.mapInArrow(lean(counted), "hash long, places long").groupBy("hash").agg(F.sum("places").alias("places")).filter(F.col("places") > most)
    return np.sort(np.array([r["hash"] for r in found.select("hash").collect()], np.int64).view(np.uint64))


# --- repeated anchors -------------------------------------------------------------------------------------------


def _dealt(blocks: np.ndarray, known: bool, arrays: list[np.ndarray]) -> list[tuple]:
    """A row for each block that occurs."""
    order = np.argsort(blocks, kind="stable")
    cuts = np.flatnonzero(np.diff(blocks[order], prepend=-1, append=-2))
    return [(int(blocks[order[s]]), known, *((x[order[s:e]] if len(x) else x).tobytes() for x in arrays)) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]


def _anchors(size: int, blocks: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]
        for batch in batches:
            for b in slices(batch):
                w = Windows(b.column(2), size, shared.value)
                docs, rows = (b.column(i).to_numpy() for i in (0, 1))
                out = []
                # whole texts stand at position -1; of equal ones of a slice the least id is sent on
                long = np.flatnonzero(np.diff(w.first) >= size)
                whole = np.array([window_hashes(w.words[w.first[i] : w.first[i + 1]], int(w.first[i + 1] - w.first[i]), salt=7)[0] for i in long], np.uint64)
                more = np.array([xxhash.xxh3_64_intdigest(w.words[w.first[i] : w.first[i + 1]].tobytes()) for i in long], np.uint64)
                order = np.lexsort((docs[long], more, whole))
                long, whole, more = long[order], whole[order], more[order]
                fresh = (np.diff(whole, prepend=~whole[:1]) != 0) | (np.diff(more, prepend=~more[:1]) != 0)
                least = docs[long][np.maximum.accumulate(np.where(fresh, np.arange(len(long)), 0))] if len(long) else docs[long]
                later = docs[long] > least
                for known in (False, True):
                    own = np.flatnonzero(later == known)
                    block = whole[own] if not known else mixed(rows[long[own]].view(np.uint64))
                    what = [whole[own], more[own]] if not known else [whole[:0], more[:0]]
                    out += _dealt((block % np.uint64(blocks)).astype(np.int32), known, [*what, docs[long[own]], rows[long[own]], np.full(len(own), -1, np.int32)])
                # places of anchors: one of each is sent, the others of it are known to be repeated; so are all frequent ones
                places = w.anchor[np.diff(w.anchor, prepend=-1) != 0]
                text = np.searchsorted(w.first, places, "right") - 1
                hashes, pos = w.grams[places], (places - w.first[text]).astype(np.int32)
                _, head, inverse, counts = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                sent = np.zeros(len(hashes), bool)
                sent[head] = True
                sent &= ~w.common[places]
                again = (counts[inverse] > 1) | w.common[places]
                for known in (False, True):
                    own = np.flatnonzero(sent & (again == known))
                    out += _dealt((hashes[own] % np.uint64(blocks)).astype(np.int32), known, [hashes[own], more[:0], docs[text[own]], rows[text[own]], pos[own]])
                rest = np.flatnonzero(again & ~sent)
                # of no use to other tasks: an empty hash, and any block
                out += _dealt((mixed(rows[text[rest]].view(np.uint64)) % np.uint64(blocks)).astype(np.int32), True, [hashes[:0], more[:0], docs[text[rest]], rows[text[rest]], pos[rest]])
                yield pa.record_batch([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=_names(ANCHORS))

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """(doc, row, pos) of the anchors of a block that stand in several places; pos is -1 for copies of a whole text."""

    def joined(own: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(b"".join(own.column(n).to_pylist()), k) for n, k in (("hash", np.uint64), ("more", np.uint64), ("doc", np.int64), ("row", np.int64), ("pos", np.int32))]

    has = lambda name: pc.greater(pc.binary_length(table.column(name)), 0)
    passed = joined(table.filter(pc.invert(has("hash"))))[2:]
    hashes, more, doc, row, pos = joined(table.filter(has("more")))
    order = np.lexsort((doc, more, hashes))
    hashes, more, doc, row, pos = (x[order] for x in (hashes, more, doc, row, pos))
    fresh = (np.diff(hashes, prepend=~hashes[:1]) != 0) | (np.diff(more, prepend=~more[:1]) != 0)
    copy = doc > doc[np.maximum.accumulate(np.where(fresh, np.arange(len(doc)), 0))] if len(doc) else np.zeros(0, bool)
    copies = [x[copy] for x in (doc, row, pos)]
    own = table.filter(pc.and_(has("hash"), pc.invert(has("more"))))
    hashes, _, doc, row, pos = joined(own)
    known = np.repeat(own.column("known").to_numpy(), [len(x) // 8 for x in own.column("hash").to_pylist()])
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    again = known | (counts[inverse] > 1)
    columns = [np.concatenate([x, y, z[again]]) for x, y, z in zip(passed, copies, (doc, row, pos), strict=True)]
    return pa.table([pa.array(x) for x in columns], names=["doc", "row", "pos"])


# --- the parse --------------------------------------------------------------------------------------------------


def _segments(size: int, shared):
    """From texts and the places of their repeated anchors: segments, and factors that a slice has settled itself (no text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                w = Windows(b.column(2), size, shared.value)
                docs, rows = (b.column(i).to_numpy() for i in (0, 1))
                marks = b.column(3)
                values = marks.values.to_numpy(zero_copy_only=False)[marks.offsets[0].as_py() : marks.offsets[-1].as_py()]
                owner = np.repeat(np.arange(b.num_rows), np.diff(marks.offsets.to_numpy()))
                flag = np.zeros(len(w.words) + 1, bool)
                flag[w.first[owner] + values] = True
                mine = np.flatnonzero(flag[w.anchor])
                begin = np.flatnonzero(np.diff(w.anchor[mine], prepend=-1) != 0)
                count = np.diff(np.append(begin, len(mine)))
                at, text, anchor = w.at[mine[begin]], w.text[mine[begin]], w.anchor[mine[begin]]
                end = at + count + size - 1
                pos = (at - w.first[text]).astype(np.int32)
                doc, row = docs[text], rows[text]
                raw = w.data.tobytes()
                said = [raw[s:e] for s, e in zip(w.starts[at].tolist(), w.ends[end - 1].tolist(), strict=True)]
                first = firsts(mixed(ranged_hashes(w.words, at, end) + (end - at).astype(np.uint64)), doc, pos)
                again = (doc > doc[first]) | ((doc == doc[first]) & (pos > pos[first]))
                for i in np.flatnonzero(again).tolist():
                    if said[i] != said[first[i]] and said[i].split() != said[first[i]].split():
                        again[i] = False
                deal = np.where(again, mixed(row.view(np.uint64)), mixed(w.grams[anchor])).view(np.int64)
                texts = pa.array([None if a else x for a, x in zip(again.tolist(), said, strict=True)], pa.binary())
                columns = [deal, doc, row, pos, count.astype(np.int32), doc[first], pos[first]]
                yield pa.record_batch([*(pa.array(x) for x in columns), texts], names=_names(SEGMENTS))

    return run


def firsts(hashes: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """For each place the index of the first place, by (doc, pos), of equal hash."""
    if not len(hashes):
        return np.empty(0, np.int64)
    order = np.lexsort((pos, doc, hashes))
    fresh = np.diff(hashes[order], prepend=~hashes[order][:1]) != 0
    out = np.empty(len(hashes), np.int64)
    out[order] = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
    return out


class Sequences:
    """Numbers of sequences of words that are equal for equal sequences alone: those of twice the length are numbered by pairs."""

    def __init__(self, words: np.ndarray):
        self.levels = [np.unique(words, return_inverse=True)[1].astype(np.uint64)]

    def of(self, at: np.ndarray, length: int) -> np.ndarray:
        top, many = length.bit_length() - 1, np.uint64(len(self.levels[0]) + 1)
        while len(self.levels) <= top:
            half, own = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.unique(own[:-half] * many + own[half:], return_inverse=True)[1].astype(np.uint64))
        return self.levels[top][at] * many + self.levels[top][at + length - (1 << top)]


def longest_earlier(words: np.ndarray, first: np.ndarray, doc: np.ndarray, pos: np.ndarray, size: int, exact: Sequences | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The index of a reference block, asked for each of its own windows. words: of all segments; first: the first word of each
    segment, and the count; doc, pos: where segments stand.

    For each window: the word it begins at, its segment, the number of words over `size` of the longest sequence from there
    that stands earlier (-1: none does), and the word where that stands first. exact: in place of hashes.
    """
    counts = np.maximum(np.diff(first) - size + 1, 0)
    segment = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first[:-1], counts)
    place = pos[segment] + at - first[segment]
    longest, reference = np.full(len(at), -1), np.full(len(at), -1)
    live = np.arange(len(at))
    more = 0
    while len(live):  # sequences of size, then of one word more, as long as any stands earlier
        length = size + more
        hashes = exact.of(at[live], length) if exact else mixed(ranged_hashes(words, at[live], at[live] + length) + np.uint64(length))
        head = live[firsts(hashes, doc[segment[live]], place[live])]
        earlier = (doc[segment[head]] < doc[segment[live]]) | ((doc[segment[head]] == doc[segment[live]]) & (place[head] < place[live]))
        longest[live[earlier]], reference[live[earlier]] = more, at[head[earlier]]
        # a longer sequence can only stand twice if this one does
        twice = np.zeros(len(at), bool)
        twice[live[earlier]] = True
        twice[head[earlier]] = True
        more += 1
        live = live[twice[live] & (at[live] + size + more <= first[segment[live] + 1])]
    return at, segment, longest, reference


def greedy(segment: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """The windows at which factors begin: from each segment's first, the next one that stands earlier; then the one after the
    factor's last window, which overlaps it still."""
    n = len(segment)
    if not n:
        return np.empty(0, np.int64)
    begin = np.flatnonzero(np.diff(segment, prepend=-1) != 0)
    end = np.append(begin[1:], n)
    # the next window from each on that stands earlier
    ahead = np.minimum.accumulate(np.where(longest >= 0, np.arange(n), n)[::-1])[::-1]
    ahead = np.append(ahead, n)
    out, at = [], begin
    while len(at):
        at = ahead[at]
        inside = at < end
        at, end = at[inside], end[inside]
        out.append(at)
        at = at + longest[at] + 1
        on = at < end
        at, end = at[on], end[on]
    return np.sort(np.concatenate(out))


def parse_block(texts: list[bytes], doc: np.ndarray, row: np.ndarray, pos: np.ndarray, size: int) -> list[np.ndarray]:
    """Factors (see FACTOR) of the segments of a reference block."""
    data, offsets = text_bytes(pa.array(texts, pa.binary()))
    starts, ends, first = word_spans(data, offsets)
    words, raw = word_hashes(data, starts, ends), data.tobytes()
    for exact in (None, Sequences):
        numbers: dict[bytes, int] = {}
        if exact:  # two different words or sequences had one hash
            exact = Sequences(np.array([numbers.setdefault(raw[s:e], len(numbers)) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]))
        at, segment, longest, reference = longest_earlier(words, first, doc, pos, size, exact)
        begin = greedy(segment, longest)
        low, ref, count = at[begin], reference[begin], size + longest[begin]
        spans = zip(starts[low].tolist(), ends[low + count - 1].tolist(), starts[ref].tolist(), ends[ref + count - 1].tolist(), strict=True)
        if all(raw[a:b] == raw[c:d] or raw[a:b].split() == raw[c:d].split() for a, b, c, d in spans):
            break
    own = segment[begin]
    found = np.searchsorted(first, ref, "right") - 1
    start, ref_start = pos[own] + low - first[own], pos[found] + ref - first[found]
    return [doc[own], row[own], start.astype(np.int32), (longest[begin] + 1).astype(np.int32), doc[found], ref_start.astype(np.int32)]


def _parsed(size: int):
    """From segments in order of deal: factors. Segments gather in reference blocks, those of one anchor in the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _names(FACTOR)

        def block(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(parts).combine_chunks()
            doc, row, pos = (table.column(n).to_numpy() for n in ("doc", "row", "pos"))
            return pa.record_batch([pa.array(x) for x in parse_block(table.column("text").to_pylist(), doc, row, pos, size)], names=names)

        waiting: list[pa.RecordBatch] = []
        held = 0
        for b in batches:
            settled = pc.is_null(b.column(7))
            done = b.filter(settled)
            if done.num_rows:
                yield pa.record_batch([done.column(i) for i in range(1, 7)], names=names)
            own = b.filter(pc.invert(settled))
            if not own.num_rows:
                continue
            if held > REFERENCE:  # up to the last anchor that is complete
                last = waiting[-1].column(0)[-1].as_py()
                old = int(np.searchsorted(own.column(0).to_numpy() != last, True)) if last == own.column(0)[0].as_py() else 0
                if old < own.num_rows:
                    yield block([*waiting, own.slice(0, old)])
                    waiting, held, own = [], 0, own.slice(old)
            waiting.append(own)
            held += own.column(7).nbytes + 100 * own.num_rows
        if waiting:
            yield block(waiting)

    return run


def maximal(factors: list[dict]) -> list[dict]:
    """Factors of a document with those joined that go on with each other here and in their reference: what began in one segment
    and went on in the next is one span. Other factors stay as they are."""
    open_: dict[tuple, dict] = {}
    out = []
    for f in sorted(factors, key=lambda f: (f["start"], -f["windows"])):
        way = f["ref_doc"], None if f["ref_start"] is None else f["ref_start"] - f["start"]
        last = open_.get(way)
        if last is not None and f["start"] >= 0 and f["start"] <= last["start"] + last["windows"]:
            last["windows"] = max(last["windows"], f["start"] + f["windows"] - last["start"])
        else:
            open_[way] = f = dict(f)
            out.append(f)
    return out


def repeated_factors(docs: DataFrame, size: int = 20) -> DataFrame:
    """Factors of at least `size` words of docs (doc, row, text, rest; see find_repeats): document, first word, count of
    windows, and where the same words stand earlier. start is -1 for a document whose words are all an earlier one's."""
    sizes = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(BLOCKS * partitions, (sizes["bytes"] or 0) // BLOCK_BYTES)
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs.select("text"), size, HOT * max(1, (sizes["bytes"] or 0) / SHARE)))
    marks = docs.select("doc", "row", "text").mapInArrow(lean(_anchors(size, blocks, shared)), ANCHORS).groupBy("block").applyInArrow(_repeated, "doc long, row long, pos int")
    own = marks.groupBy("doc", "row").agg(F.min("pos").alias("least"), F.collect_list("pos").alias("marks"))
    copies = own.filter("least < 0").select("doc", "row", F.lit(-1).alias("start"), F.lit(0).alias("windows"), F.lit(None).cast("long").alias("ref_doc"), F.lit(None).cast("int").alias("ref_start"))
    # rest is of no use here; with it, this shuffle of the texts is the same as that of find_repeats(), and done once
    texts = docs.join(own.filter("least >= 0"), ["doc", "row"]).select("doc", "row", "text", "marks", "rest")
    segments = texts.mapInArrow(lean(_segments(size, shared)), SEGMENTS)
    dealt = segments.repartition(max(partitions, (sizes["bytes"] or 0) // (8 * BLOCK_BYTES)), "deal").sortWithinPartitions("deal")
    return dealt.mapInArrow(lean(_parsed(size)), FACTOR).unionByName(copies)


def _parts(docs: DataFrame, size: int, columns: list[str], whole_text: bool) -> DataFrame:
    """text (if whole_text), rest (`columns`, packed), factors, n_words, n_removed and kept of every row."""
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("doc_id", "text").alias("row")]
    whole = docs.select(*key, "text", packed(columns).alias("rest"))
    found = repeated_factors(whole, size)
    lists = found.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "windows", "ref_doc", "ref_start")).alias("factors"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch):
                data, offsets = text_bytes(b.column(0))
                starts, ends, first = word_spans(data, offsets)
                view, counts, removed, kept, spans = memoryview(data), [], [], [], []
                for i, found_here in enumerate(b.column(2).to_pylist()):
                    marks = maximal(found_here or ())
                    spans.append(marks if found_here else None)
                    s, e = starts[first[i] : first[i + 1]], ends[first[i] : first[i + 1]]
                    gone = np.zeros(len(s) + 1, np.int64)
                    for m in marks:
                        low, high = (0, len(s)) if m["start"] < 0 else (m["start"], m["start"] + m["windows"] + size - 1)
                        gone[low] += 1
                        gone[high] -= 1
                    stay = np.cumsum(gone[:-1]) == 0
                    counts.append(len(s))
                    removed.append(int(len(s) - stay.sum()))
                    kept.append(b" ".join(view[x:y] for x, y in zip(s[stay].tolist(), e[stay].tolist(), strict=True)).decode())
                made = [b.column(1), pa.array(spans, b.schema.field(2).type), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
                text = {"text": b.column(0)} if whole_text else {}
                yield pa.record_batch([*text.values(), *made], names=[*text, "rest", "factors", "n_words", "n_removed", "kept"])

    made = "factors array<struct<start:int,windows:int,ref_doc:bigint,ref_start:int>>, n_words long, n_removed long, kept string"
    schema = T.StructType([*([T.StructField("text", T.StringType())] if whole_text else []), T.StructField("rest", whole.schema["rest"].dataType), *T.StructType.fromDDL(made).fields])
    return whole.join(lists, ["doc", "row"], "left").select("text", "rest", "factors").mapInArrow(lean(cut_out), schema)


MADE = ("factors", "n_words", "n_removed", "kept")


def find_repeats(docs: DataFrame, size: int = 20, columns: list[str] | None = None) -> DataFrame:
    """docs with n_words, n_removed, kept (the words that are left, joined by one space) and factors (start, windows,
    ref_doc, ref_start; null for text without repeats), for the removal of every word of a window of `size` words that also starts earlier.

    Words are [^\\x20\\x09-\\x0D]+. Earlier is: in a document of smaller doc_id, or at an earlier word of the same
    document. Rows of equal doc_id count as one document, and equal rows have equal results; a null doc_id is the
    smallest. Null and empty texts have no words; texts of fewer words than `size` stay whole. Other columns are
    kept (or those named in `columns`), but own columns of the four new names give way to them; remove_repeats() keeps
    all. An empty table gives an empty one.
    """
    columns = [c for c in (docs.columns if columns is None else columns) if c.lower() not in MADE]
    others = [c for c in columns if c != "text"]
    out, own = _parts(docs, size, others, "text" in columns), unpacked(others, "rest")
    return out.select(*(own.get(c, F.col("text")) for c in columns), *MADE)


def remove_repeats(docs: DataFrame, size: int = 20) -> DataFrame:
    """docs with the repeated words cut out of text, and n_chars (where it is a column) counted anew; see find_repeats. Texts
    that lose nothing stay as they are, white space included. All other columns stay, whatever their names."""
    others = [c for c in docs.columns if c != "text"]
    own, cut = unpacked(others, "rest"), F.col("n_removed") > 0
    own["text"] = F.when(cut, F.col("kept")).otherwise(F.col("text")).alias("text")
    if "n_chars" in others:
        own["n_chars"] = F.when(cut, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(own["n_chars"]).alias("n_chars")
    return _parts(docs, size, others, True).select(*(own[c] for c in docs.columns))
