"""What round 4 found in the operators."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfmark.llm import ngramjoin
from tests.llm.tables import frame
from tests.llm.test_operators import components, grams


def edited(rng, words, n):
    """words with n of them replaced by new ones."""
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"e{rng.randrange(1 << 40)}"
    return out


def fresh(rng, n):
    return [f"n{rng.randrange(1 << 40)}" for _ in range(n)]


def test_sets_that_are_not_linked_do_not_meet_all_blocks(spark, monkeypatch):
    """op2: 300 texts with a passage in common that is half of each, and 300 that are each under 0.85 like one text, were families whose
    sets met all blocks; the time grew with the square of their number. None of them is linked."""

    def refused(percent):
        raise AssertionError("sets that no set is linked with meet all blocks")

    monkeypatch.setattr(ngramjoin, "_across", refused)
    rng = random.Random(4)
    passage, whole = fresh(rng, 200), fresh(rng, 300)
    texts = [passage + fresh(rng, 200) for _ in range(300)] + [edited(rng, whole, 8) for _ in range(300)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = ngramjoin.join_documents(frame(spark, rows), 4, 85).collect()
    assert len(got) == 600 and all(r["component_id"] == r["doc_id"] for r in got)


@pytest.mark.parametrize(("size", "percent", "most"), [(4, 85, 1 << 18), (2, 60, 1 << 18), (4, 85, 20)])
def test_candidates_of_wide_families(spark, monkeypatch, size, percent, most):
    """op2: families of several blocks are sought anew; passages in common, near copies about the border, of other sizes too, and frequent
    n-grams of which few are known."""
    for name, value in (("HOT", 3), ("BLOCK", 4), ("WIDE", 1), ("HOT_MOST", most)):
        monkeypatch.setattr(ngramjoin, name, value)
    rng = random.Random(size)
    passage, whole = fresh(rng, 40), fresh(rng, 120)
    texts = [passage + fresh(rng, rng.choice([5, 8, 12, 40])) for _ in range(25)]
    texts += [edited(rng, whole, rng.randrange(8)) for _ in range(30)]
    texts += [edited(rng, whole, rng.randrange(4))[: rng.randrange(95, 121)] for _ in range(30)]
    texts += [edited(rng, whole + passage, rng.randrange(6)) for _ in range(15)] + [whole, whole, passage]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = [grams(t, size) for _, t in rows]
    roots = components(sets, percent)
    least = {}
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = min(least.get(r, i), i)
    assert 1 < len(least) < len(rows) - 20
    got = ngramjoin.join_documents(frame(spark, rows), size, percent).collect()
    assert Counter(map(tuple, got)) == Counter((i, len(s), least[r]) for (i, _), s, r in zip(rows, sets, roots, strict=True))


def test_sets_that_share_enough_frequent_ngrams_meet():
    """op2: whatever the sizes, prefixes that share as many frequent n-grams as linked sets must share meet in one of them."""
    pairs = 0
    for percent in (85, 50, 99, 100, 10):
        rng = random.Random(percent)
        for _ in range(100):
            sets = []
            for cls in range(6):
                n = rng.choice([1, 2, 5, 20, 60, 100, rng.randrange(1, 400)])
                most = n - ngramjoin.needed(n, percent) + 1
                rare = rng.randrange(most + 1)
                hot = sorted(rng.sample(range(most + 3), most - rare))
                sets.append((cls, n, rare, hot))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            columns = [(c, n, rare, np.array([1000 * (c + 1) + i for i in range(rare)] + hot, np.int64).tobytes()) for c, n, rare, hot in sets]
            batch = pa.record_batch([pa.array([x[i] for x in columns], k) for i, k in enumerate(kinds)], names=["cls", "n", "rare", "tokens"])
            spots = [r for b in ngramjoin._spots(percent)(iter([batch])) for r in b.to_pylist()]
            seen = Counter()
            for r in spots:
                seen[r["token"], r["bucket"]] |= r["mask"]
            keys = sorted(seen)
            lists = pa.table({"token": pa.array([k[0] for k in keys], pa.int64()), "bucket": pa.array([k[1] for k in keys], pa.int32()), "mask": pa.array([seen[k] for k in keys], pa.int64())})
            partners = {(r["token"], r["bucket"]): r["partners"] for b in ngramjoin._partners(iter(lists.to_batches())) for r in b.to_pylist()}
            met = {(r["token"], r["cls"]) for r in spots if r["mask"] & partners.get((r["token"], r["bucket"]), 0)}
            for a, n, _, one in sets:
                for b, m, _, other in sets[a + 1 :]:
                    both = set(one) & set(other)
                    if 100 * min(n, m) >= percent * max(n, m) and len(both) >= ngramjoin.shared_in_prefixes(n, m, percent):
                        pairs += 1
                        assert any({(t, a), (t, b)} <= met for t in both)
    assert pairs > 300
