"""SimHash fingerprints and their trie join against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from shelfmark.llm import queries, simhash
from tests.llm.tables import WORD, frame, words


def plain_fingerprint(text, size=3):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(text or "")]
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain(rows):
    """Counter of (doc_id, fingerprint, component_id)."""
    prints = [plain_fingerprint(t) for _, t in rows]
    different = np.array(sorted(set(prints)), np.uint64)
    up = list(range(len(different)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(different)):
        for j in np.flatnonzero(np.bitwise_count(different[i + 1 :] ^ different[i]) <= 3):
            up[top(i + 1 + int(j))] = top(i)
    place = {int(f): i for i, f in enumerate(different)}
    least: dict = {}
    for (doc, _), f in zip(rows, prints, strict=True):
        if doc is not None:
            least[top(place[f])] = min(least.get(top(place[f]), doc), doc)
    return Counter((doc, f"{f:016x}", least.get(top(place[f]))) for (doc, _), f in zip(rows, prints, strict=True))


@pytest.fixture(scope="module")
def corpus():
    base = [words(i, 400, 5000) for i in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    rng = random.Random(1)
    for i in range(80):  # near copies, at the border of 3 bits too
        w = base[i % 6].split()
        for _ in range(rng.randrange(12)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(99)}"
        rows.append((100 + i, " \t".join(w)))
    rows += [(200 + i, base[1].upper()) for i in range(30)] + [(300 + i, words(i, 9)) for i in range(60)]
    rows += [(50, None), (51, ""), (52, " \n"), (53, "one"), (54, "one two"), (55, "One  Two"), (56, words(5, 70_000)), (None, base[3]), (None, "null id"), (60, "same row"), (60, "same row"), (61, "é ß 漢字 \U0001f600 x É")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("most", [simhash.LEAF, 3])
def test_near_duplicates(spark, corpus, most):
    got = simhash.near_duplicates(frame(spark, corpus), most=most)
    assert Counter(map(tuple, got.collect())) == plain(corpus)


def test_of_the_table(spark):
    data = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, queries.op13_simhash(spark, data).collect())) == plain(rows)


def test_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).isEmpty()
    assert [tuple(r) for r in simhash.near_duplicates(frame(spark, [(3, None), (2, "")])).orderBy("doc_id").collect()] == [(2, "0" * 16, 2), (3, "0" * 16, 2)]


def near(seed, n, flips):
    """Numbers around few centres, that differ in few bits."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(5)]
    out = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(n):
        x = rng.choice(centres)
        for _ in range(rng.randrange(flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return np.array(sorted(out), np.uint64)


def linked_sets(values):
    sets = simhash.Together(len(values))
    far = np.bitwise_count(values[:, None] ^ values[None, :])
    i, j = np.nonzero(np.triu(far <= 3, 1))
    sets.join(i, j)
    return sets.label


@pytest.mark.parametrize("flips", [4, 12])
def test_walk(flips, monkeypatch):
    monkeypatch.setattr(simhash, "WALKED", 100)
    values = near(flips, 500, flips)
    # all links whose first half differs in one bit at most, and all with the halves exchanged, are all links
    both = simhash.Together(len(values))
    simhash.walk(values, None, both)
    other = np.argsort(simhash.turned(values, 1))
    sets = simhash.Together(len(values))
    simhash.walk(simhash.turned(values, 1)[other], None, sets)
    both.join(other, other[sets.label])
    assert np.array_equal(both.label, linked_sets(values))


@pytest.mark.parametrize("most", [2, 50, 10_000])
def test_links(spark, most):
    """Dense leaves of 32 equal bits too, which are dealt to blocks."""
    values = np.unique(np.concatenate([near(9, 150, 9), np.arange(0, 4000, 37, dtype=np.uint64) + np.uint64(7 << 40), np.array([0, (1 << 64) - 1], np.uint64)]))
    table = spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "value long").cache()
    edges = simhash.links(table, most).collect()
    place = {int(x): i for i, x in enumerate(values.view(np.int64))}
    sets = simhash.Together(len(values))
    sets.join(np.array([place[r["a"]] for r in edges]), np.array([place[r["b"]] for r in edges]))
    assert np.array_equal(sets.label, linked_sets(values))
