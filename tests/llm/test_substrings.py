"""Removal of repeated passages against brute force, and the parse against its definition."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm import substrings
from tests.llm.tables import WORD, frame, words
from tests.llm.test_operators import corpus  # noqa: F401


def removed(rows, size):
    """(n_words, n_removed, kept) of each row."""
    first = {}
    key = lambda i: -(1 << 63) if i is None else i
    texts = [WORD.findall(t or "") for _, t in rows]
    for (i, _), w in zip(rows, texts, strict=True):
        for p in range(len(w) - size + 1):
            k = tuple(w[p : p + size])
            first[k] = min(first.get(k, (key(i), p)), (key(i), p))
    out = []
    for (i, _), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for p in range(len(w) - size + 1):
            if first[tuple(w[p : p + size])] < (key(i), p):
                gone[p : p + size] = [True] * size
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize(("size", "hot"), [(20, substrings.HOT), (5, substrings.HOT), (5, 1)])
def test_substrings(spark, corpus, size, hot, monkeypatch):  # noqa: F811
    monkeypatch.setattr(substrings, "HOT", hot)
    got = substrings.find_repeats(frame(spark, corpus), size).select("doc_id", "n_words", "n_removed", "kept")
    assert Counter(map(tuple, got.collect())) == Counter((i, *r) for (i, _), r in zip(corpus, removed(corpus, size), strict=True))


@pytest.mark.parametrize(("hot", "reference"), [(1, substrings.REFERENCE), (substrings.HOT, 1 << 10), (1 << 30, 1 << 10)])
def test_substrings_of_frequent_anchors(spark, monkeypatch, hot, reference):
    """One passage in all of 700 documents, which come in batches of two."""
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "REFERENCE", reference)
    passage = words(7, 30, 1000)
    rows = [(i, f"{words(1000 + i, 12, 1000)} {passage} {words(2000 + i, 12, 1000)}") for i in range(700)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = substrings.find_repeats(frame(spark, rows)).select("doc_id", "n_words", "n_removed", "kept").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert Counter(map(tuple, got)) == Counter((i, *r) for (i, _), r in zip(rows, removed(rows, 20), strict=True))


def test_substrings_stage(spark, corpus):  # noqa: F811
    docs = frame(spark, corpus)
    got = substrings.remove_repeats(docs)
    assert got.columns == docs.columns
    want = Counter((i, t if not n else kept) for (i, t), (_, n, kept) in zip(corpus, removed(corpus, 20), strict=True))
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == want
    assert substrings.remove_repeats(docs.limit(0)).isEmpty()


def test_factors_stand_earlier(spark, corpus):  # noqa: F811
    rows = [(i, t) for i, t in corpus if i is not None and i not in (60, 61)]
    texts = {i: WORD.findall(t or "") for i, t in rows}
    found = substrings.find_repeats(frame(spark, rows)).filter("factors is not null").collect()
    assert found
    for r in found:
        for f in r["factors"]:
            if f["start"] >= 0:
                n = f["windows"] + 19
                assert (f["ref_doc"], f["ref_start"]) < (r["doc_id"], f["start"])
                assert texts[r["doc_id"]][f["start"] : f["start"] + n] == texts[f["ref_doc"]][f["ref_start"] : f["ref_start"] + n]



def block(seed, n=60, many=4):
    """Segments of few different words, in any order."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("abcd"[:many]) * rng.randint(1, 2) for _ in range(rng.randint(3, 14))) for _ in range(n)]
    doc = np.array([rng.randrange(12) for _ in range(n)])
    pos = np.array([rng.randrange(40) for _ in range(n)], np.int32)
    return [t.encode() for t in texts], doc, np.arange(n), pos


def by_definition(texts, doc, row, pos, size):
    """(doc, row, start, windows) of each factor: the longest sequence that stands earlier, then on behind its last window."""
    split = [t.split() for t in texts]
    first = {}
    for d, p, w in zip(doc, pos, split, strict=True):
        for i in range(len(w)):
            for n in range(size, len(w) - i + 1):
                key = tuple(w[i : i + n])
                first[key] = min(first.get(key, (d, p + i)), (d, p + i))
    out = []
    for d, r, p, w in zip(doc, row, pos, split, strict=True):
        i = 0
        while i + size <= len(w):
            fits = [n for n in range(size, len(w) - i + 1) if first[tuple(w[i : i + n])] < (d, p + i)]
            if fits:
                out.append((d, r, p + i, fits[-1] - size + 1))
                i += fits[-1] - size
            i += 1
    return Counter(out)


@pytest.mark.parametrize("seed", range(6))
def test_parse_is_greedy_and_longest(seed):
    own = block(seed)
    got = substrings.parse_block(*own, size=4)
    assert Counter(zip(*(x.tolist() for x in got[:4]), strict=True)) == by_definition(*own, size=4)
    split = [(d, p, t.split()) for t, d, p in zip(own[0], own[1].tolist(), own[3].tolist(), strict=True)]
    # several segments of a document may hold one place here, with different words
    stands = lambda d, at, n: [w[at - p : at - p + n] for e, p, w in split if e == d and p <= at and at - p + n <= len(w)]
    for d, _, start, n, ref_doc, ref_start in zip(*(x.tolist() for x in got), strict=True):
        assert (ref_doc, ref_start) < (d, start)
        assert any(x in stands(ref_doc, ref_start, n + 3) for x in stands(d, start, n + 3))


def test_words_of_equal_hashes_are_told_apart(monkeypatch):
    plain = substrings.word_hashes
    own = block(3)
    want = by_definition(*own, size=4)
    monkeypatch.setattr(substrings, "word_hashes", lambda *a: plain(*a) % np.uint64(2))
    got = substrings.parse_block(*own, size=4)
    assert Counter(zip(*(x.tolist() for x in got[:4]), strict=True)) == want


def test_a_long_passage_is_one_factor(spark):
    """Its windows lie in many segments, of different anchors."""
    passage = words(3, 500, 4000)
    rows = [(1, words(4, 30, 4000) + " " + passage + " x"), (2, passage), (3, words(5, 8, 4000) + "\n" + passage + " " + words(6, 40, 4000)), (4, passage.rsplit(" ", 100)[0] + " y")]
    found = {r["doc_id"]: r["factors"] for r in substrings.find_repeats(frame(spark, rows)).collect()}
    assert found[1] is None
    for doc, start in ((2, 0), (3, 8)):
        assert [tuple(f) for f in found[doc]] == [(start, 481, 1, 30)]
    # a segment that its slice has settled refers to the first one there, so that a passage may have two references
    ends = [(f["start"], f["start"] + f["windows"]) for f in found[4]]
    assert len(ends) <= 2 and ends[0][0] == 0 and ends[-1][1] == 381 and all(a[1] == b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_maximal_factors():
    factor = lambda *x: dict(zip(("start", "windows", "ref_doc", "ref_start"), x, strict=True))
    got = substrings.maximal([factor(10, 5, 1, 110), factor(0, 10, 1, 100), factor(14, 3, 2, 14), factor(20, 2, 1, 120), factor(12, 2, 1, 112), factor(17, 4, 2, 17)])
    assert [tuple(f.values()) for f in got] == [(0, 15, 1, 100), (14, 7, 2, 14), (20, 2, 1, 120)]
    assert substrings.maximal([factor(-1, 0, None, None)]) == [factor(-1, 0, None, None)] and substrings.maximal([]) == []


def test_sequences_in_a_certain_order():
    """Polynomials modulo 2**64 over two words in this order and its complement are equal; the parse ends and tells them apart."""
    order = [bin(i).count("1") % 2 for i in range(4096)]
    texts = [" ".join(("yes", "no")[x] for x in order).encode(), " ".join(("no", "yes")[x] for x in order).encode()]
    doc, row, pos = np.array([1, 2]), np.array([1, 2]), np.array([0, 0], np.int32)
    found = substrings.parse_block(texts, doc, row, pos, 3000)
    split = [t.split() for t in texts]
    for d, _, start, windows, ref_doc, ref_start in zip(*found, strict=True):
        assert split[d - 1][start : start + windows + 2999] == split[ref_doc - 1][ref_start : ref_start + windows + 2999] and (ref_doc, ref_start) < (d, start)
    first = {}
    covered = {(d, start + i) for d, _, start, windows, _, _ in zip(*found, strict=True) for i in range(windows)}
    for d, w in enumerate(split, 1):
        for i in range(len(w) - 2999):
            if first.setdefault(hash(tuple(w[i : i + 3000])), (d, i)) != (d, i):
                assert (d, i) in covered
    assert len(covered) < 3000


def test_exact_sequences():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 3, 300)
    exact = substrings.Sequences(values)
    for length in (1, 2, 3, 7, 8, 20):
        at = np.arange(300 - length + 1)
        ids = exact.of(at, length).tolist()
        own = [tuple(values[i : i + length].tolist()) for i in at]
        assert len(set(ids)) == len(set(own)) == len(set(zip(ids, own, strict=True)))
