"""Fingerprints against a plain version of the method, and their likeness against generalised Jaccard."""

from __future__ import annotations

import hashlib
import math
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash

from shelfmark.llm import common, fingerprints
from tests.llm.tables import WORD, frame, words
from tests.llm.test_operators import corpus  # noqa: F401


def h64(kind, x, seed=42):
    """Spark's xxhash64() of one long (q) or int (i)."""
    return xxhash.xxh64_intdigest(struct.pack(f"<{kind}", x - (1 << 64) if kind == "q" and x >> 63 else x), seed=seed)


def plain(text, samples=48):
    """The fingerprint of a text, one draw after the other."""
    bag = Counter(xxhash.xxh64_intdigest(w.encode(), seed=42) & ~1 for w in WORD.findall(text))
    out = []
    for s in range(samples if bag else 0):
        part, j = divmod(s, fingerprints.GROUP)
        best = None
        for h, n in bag.items():
            base = h64("i", part, h64("q", h))
            x, y, z = (h64("i", kind * fingerprints.GROUP + j, h64("q", base)) for kind in range(3))
            gamma = lambda v: -math.log((((v & 0xFFFFFFFF) + 0.5) / 2**32) * (((v >> 32) + 0.5) / 2**32))
            r, b = gamma(x), (z >> 32) / 2**32
            t = math.floor(math.log(n) / r + b)
            time = int((math.log(gamma(y)) - r * (t + 1 - b)) * (1 << 24))
            key = (time, (z + t * 0x9E3779B1) & 0xFFFFFFFF)
            best = key if best is None or key < best else best
        out.append(f"{h64('q', best[1]) & 0xFFFF:04x}")
    return "".join(out)


def jaccard(one, two):
    a, b = Counter(one.split()), Counter(two.split())
    return sum((a & b).values()) / sum((a | b).values())


def test_fingerprints_are_the_plain_ones(spark, corpus):  # noqa: F811
    rows = [(i, t or "") for i, t in corpus if not t or len(t) < 2000]
    tie = lambda t: xxhash.xxh64_intdigest(t.encode(), seed=42) >> 1
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])), reverse=True)
    want = Counter()
    for k, (i, t) in enumerate(order):
        after, third = order[(k + 1) % len(order)][1], len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), plain(t), plain(edited)] += 1
    got = fingerprints.fingerprint_documents(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) for r in got) == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert fingerprints.fingerprint_documents(frame(spark, rows).limit(0)).isEmpty()
    one = fingerprints.fingerprint_documents(frame(spark, [(1, None)])).first()
    assert (one["n_chars"], one["near_edited"], one["near_next"], one["fingerprint"]) == (0, 1.0, 1.0, "")


def test_an_id_of_many_rows_has_several_ranges(spark):
    rows = [(None, f"a{i} b{i % 7} c") for i in range(3000)] + [(i, f"d{i} c") for i in range(100)]
    known, by_id = common.ranges(frame(spark, rows).selectExpr("coalesce(doc_id, -9223372036854775808) AS doc", "text"), 16)
    assert not by_id and sum(low[0] == common.NO_ID for low, _ in known) > 8
    tie = lambda t: xxhash.xxh64_intdigest(t.encode(), seed=42) >> 1
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie(r[1])), reverse=True)
    want = Counter()
    for k, (i, t) in enumerate(order):
        third = len(t) // 3
        want[i, hashlib.sha256((t[: len(t) - third] + order[(k + 1) % len(order)][1][:third]).encode()).hexdigest()] += 1
    got = fingerprints.fingerprint_documents(frame(spark, rows), samples=16)
    assert Counter((r["doc_id"], r["edited_sha256"]) for r in got.collect()) == want


def mixture(n, heavy):
    """Two texts of about n different words: a share in common, a share of one text alone, and some words of large weight."""
    rng = np.random.default_rng(n)
    common_words = [w for i in range(n * 7 // 10) for w in [f"z{i}"] * (int(rng.integers(20, 60)) if i < heavy else 1)]
    more = [w for i in range(heavy) for w in [f"z{i}"] * int(rng.integers(0, 30))]
    return [" ".join([*common_words, *(more if side == "a" else []), *(f"{side}{i}" for i in range(n * 3 // 10))]) for side in "ab"]


@pytest.mark.parametrize(("n", "heavy"), [(100, 0), (100, 20), (5000, 250), (20_000, 1000)])
def test_likeness_is_generalised_jaccard(spark, n, heavy):
    """480 samples: a standard deviation of 0.023 at most."""
    one, two = mixture(n, heavy)
    got = fingerprints.fingerprint_documents(frame(spark, [(2, one), (1, two)]), samples=480).filter("doc_id = 2").first()
    assert abs(got["near_next"] - jaccard(one, two)) < 0.07


@pytest.mark.parametrize("n", [100, 20_000])
def test_different_texts_share_no_samples(spark, n):
    texts = [" ".join(f"{side}{i}" for i in range(n)) for side in "ab"]
    got = fingerprints.fingerprint_documents(frame(spark, list(enumerate(texts))), samples=480).collect()
    assert all(r["near_next"] < 0.005 for r in got)


def test_mean_error_over_many_texts(spark):
    rows = sorted(((i, words(i % 7, 80, 60) + " " + words(i, 40, 60)) for i in range(120)), reverse=True)
    near = {r["doc_id"]: r["near_next"] for r in fingerprints.fingerprint_documents(frame(spark, rows), samples=480).collect()}
    error = [near[i] - jaccard(t, rows[(k + 1) % len(rows)][1]) for k, (i, t) in enumerate(rows)]
    assert abs(np.mean(error)) < 0.03 and np.std(error) < 0.05
