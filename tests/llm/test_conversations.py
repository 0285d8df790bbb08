"""The prefix trie and the repair of conversations against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import ordered, prefixtrie, queries, repair
from tests.llm.tables import WORD

SCHEMA = "conv_id long, turn long, role string, text string, place int, position int, name string, part int, seg int, `a.b` int"
TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
REPAIR = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, "n", 3, 4, 5) for r in rows], SCHEMA).repartition(parts)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def table(spark, name):
    return [tuple(r) for r in spark.read.parquet(f"/root/testdata/{name}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]


@pytest.fixture(scope="module")
def some():
    """Nulls everywhere, repeated rows, negative ids, a conversation of many turns, and many with equal turns."""
    rng = random.Random(7)
    rows = []
    for c in [*range(-25, 70), 100, 101, 119, 1 << 40]:
        roles = rng.choice((["user", "assistant"], ["system", "user", "assistant"], ["user", "user"], ["tool", "assistant", ""], ["assistant"]))
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, roles[t % len(roles)], rng.choice(("Yes.", "no way", "What? Why!", "", " \n", "it is so ", "漢字 é.", f"own {c}."))))
    rows += [(7, t, rng.choice(("user", "assistant")), f"t{t % 30} a b" + "." * (t % 3)) for t in range(300)]
    rows += [(55, None, "user", "null turn."), (55, None, "assistant", "null turn too."), (56, 3, None, None), (57, 2, "user", None), (57, 2, "user", None), (58, 1, "user", "tie b"), (58, 1, "user", "tie a")]
    rows += [(c, t, *x) for c in range(200, 260) for t, x in enumerate([("user", "same first."), ("assistant", "same second."), ("user", f"third {c % 3}.")])]
    rows += [(None, 1, "user", "no conversation."), (None, None, "assistant", "none")]
    rng.shuffle(rows)
    return rows


def ordered_turns(rows, key):
    by_conv = defaultdict(list)
    for c, t, role, text in rows:
        by_conv[c].append((t is not None, t or 0, key(role, text), role, text))
    return {c: [x[3:] for x in sorted(v)] for c, v in by_conv.items()}


def plain_trie(rows):
    clean = [(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]
    own = ordered_turns(clean, lambda r, x: sha(f"{len(r)}:{r}{x}"))
    members, ends = defaultdict(set), defaultdict(list)
    for c in own:
        h, sign = zlib.crc32(str(c).encode()) % 4, -1 if c < 0 else 1
        path = own.get(c - sign * (abs(c) % 20), [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
        ends[tuple(path)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(",".join(map(str, sorted(ends[p]))))) for p, m in members.items())


@pytest.mark.parametrize("block", [64, 5, 2])
def test_trie(spark, some, block, monkeypatch):
    if block < 64:
        monkeypatch.setattr(prefixtrie, "MEMBERS", 2)
    got = prefixtrie.prefix_trie(frame(spark, some), block)
    rows = got.collect()
    assert Counter(tuple(r[c] for c in TRIE) for r in rows) == plain_trie(some)
    place = {r["position"]: r for r in rows}
    assert sorted(place) == list(range(len(rows)))
    for r in rows:  # an interval holds its node's descendants
        inside = [place[i] for i in range(r["position"] + 1, r["end"] + 1)]
        assert sum(x["depth"] == r["depth"] + 1 for x in inside) == r["n_children"] and all(x["depth"] > r["depth"] for x in inside)


def test_trie_of_the_table(spark):
    got = queries.op11_prefix_trie(spark, "/root/testdata/sf0.001").select(TRIE).collect()
    assert Counter(map(tuple, got)) == plain_trie(table(spark, "sf0.001"))


def test_trie_of_few(spark):
    assert prefixtrie.prefix_trie(frame(spark, [])).isEmpty()
    assert prefixtrie.prefix_trie(frame(spark, [(None, 1, "user", "x")])).isEmpty()
    c = next(c for c in range(21, 99) if zlib.crc32(str(c).encode()) % 4)
    (one,) = prefixtrie.prefix_trie(frame(spark, [(c, 0, "user", "x")])).select(TRIE).collect()  # its source is absent
    assert tuple(one) == (c, 0, None, 1, 0, 1, 0, sha(str(c)))


def test_one_conversation_in_several_ranges(spark):
    """A third of all rows in one conversation, and many in one node: places go on over ranges."""
    rows = [(1, t, "user", f"{t}") for t in range(300)] + [(c, 0, "user", "hello there") for c in range(1000, 1300)] + [(c, t, "user", f"{c}") for c in range(5000, 5100) for t in range(2)]
    assert Counter(map(tuple, prefixtrie.prefix_trie(frame(spark, rows, 5)).select(TRIE).collect())) == plain_trie(rows)
    got = ordered.placed(frame(spark, rows, 5).select("conv_id", "turn"), "conv_id", F.col("turn")).collect()
    assert all(r["place"] == r["turn"] + 1 for r in got) and len(got) == len(rows)


def legal(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def cheapest(codes, longest):
    """The cheapest edits' initials by trying all, and their cost."""
    best = None
    for n in range(len(codes), longest + 1):
        for edits in product(("D", "Iu", "Ia", "K", "Ru", "Ra"), repeat=n):
            if sum(x[0] != "I" for x in edits) != len(codes):
                continue
            cost, left, i = 0, "", 0
            for x in edits:
                if x[0] == "I":
                    cost, left = cost + 2, left + x[1]
                    continue
                code, i = codes[i], i + 1
                if x == "D":
                    cost += 3
                    continue
                if code == repair.MUST:
                    cost = None
                    break
                left += (repair.INITIALS[code & 3] or "x") if x == "K" else x[1]
                cost += (code >> 2) + (0 if x == "K" else 2)
            if cost is not None and legal(left):
                best = min(best or (cost, "~"), (cost, "".join(x[0] for x in edits)))
    return best


CODES = [0, 1, 2, 3, 4, 5, 6, 7, repair.MUST]


def test_edits_against_all(some):
    repairs = repair.Repairs()
    rng = random.Random(3)
    for codes in [(), *product(CODES, repeat=1), *product(CODES, repeat=2), *(tuple(rng.choices(CODES, k=3)) for _ in range(12))]:
        cost, edits = repairs.edits(bytes(codes))
        assert (cost, "".join(edits)) == cheapest(codes, len(codes) + 3), codes
    assert len(repairs.steps) < 300
    repairs.edits(bytes(rng.choices(CODES, k=20_000)))
    assert len(repairs.steps) < 500  # costs to go are few but for a number


def plain_repair(rows, key):
    damaged = []
    for c, t, role, text in rows:
        name = " " if c is None else str(c)
        kind = zlib.crc32(f"{name}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        damaged += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    turns = ordered_turns(damaged, key)
    numbers = defaultdict(list)
    for c, t, _, _ in damaged:
        if t is not None:
            numbers[c].append(t)
    out = Counter()
    for c in {r[0] for r in rows}:
        own = turns.get(c, [])
        faults, seen = [], set()
        for role, text in own:
            words = WORD.findall(text)
            faults.append("b" if not words else "d" if (role, text) in seen else "t" if words[-1][-1] not in ".!?" else "")
            seen.add((role, text))
        least: dict = {}

        def best(i, state):  # state: initials so far, as far as the grammar needs them
            if (i, state) in least:
                return least[i, state]
            ways = []
            if i == len(own):
                ways.append((0, "", ()) if state in ("", "a") else (9999, "", ()))
            else:
                cost, audit, kept = best(i + 1, state)
                ways.append((cost + 3, "D" + audit, kept))
                if faults[i] not in ("b", "d"):
                    late = 1 if faults[i] == "t" else 0
                    for to, first, more in [(own[i][0], "K", 0), ("user", "R", 2), ("assistant", "R", 2)]:
                        after = to[:1] if (state, to[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")} else None
                        if after:
                            cost, audit, kept = best(i + 1, after)
                            ways.append((cost + more + late, first + audit, (f"{to}:{own[i][1]}", *kept)))
            least[i, state] = min(ways)
            return least[i, state]

        def relaxed(i, state):
            for s in ("", "s", "u", "a"):
                best(i, s)
            for _ in range(3):
                for s, after, to in (("", "u", "user"), ("s", "u", "user"), ("u", "a", "assistant"), ("a", "u", "user")):
                    cost, audit, kept = least[i, after]
                    least[i, s] = min(least[i, s], (cost + 2, "I" + audit, (f"{to}:", *kept)))

        for i in range(len(own), -1, -1):
            relaxed(i, "")
        cost, audit, kept = least[0, ""]
        t = numbers[c]
        bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        out[c, max(t) - min(t) + 1 - len(set(t)) if t else 0, faults.count("b"), faults.count("d"), faults.count("t"), bad, cost, audit, sha("\n".join(kept))] += 1
    return out


def order_of(spark, rows):
    """The hash by which Spark orders turns of equal number; plain versions take it as given."""
    texts = [(r, x) for r in {r[2] if r[2] is not None else " " for r in rows} | {"user"} for x in {y for t in rows for z in [t[3] if t[3] is not None else " "] for y in (z, "", re.sub("[.!?]", "", z))}]
    found = spark.createDataFrame(texts, "role string, text string").selectExpr("role", "text", "xxhash64(role, text) AS h").collect()
    by = {(r["role"], r["text"]): r["h"] for r in found}
    return lambda role, text: by[role, text]


@pytest.mark.parametrize("most", [4096, 3])
def test_repair(spark, some, most, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT_TURNS", most)
    if most == 3:
        monkeypatch.setattr(repair, "SEGMENT_BYTES", 60)
    got = repair.repair_conversations(frame(spark, some))
    assert got.columns == REPAIR
    want = plain_repair(some, order_of(spark, some))
    assert Counter(map(tuple, got.collect())) == want and len(want) > 150


def test_repair_of_the_table(spark):
    rows = table(spark, "sf0.001")
    got = Counter(map(tuple, queries.op12_repair(spark, "/root/testdata/sf0.001").collect()))
    assert got == plain_repair(rows, lambda r, x: x)


def test_repair_of_few(spark):
    assert repair.repair_conversations(frame(spark, [])).isEmpty()
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert tuple(repair.repair_conversations(frame(spark, [(dropped, 0, "user", "x.")])).first()) == (dropped, 0, 0, 0, 0, 0, 0, "", sha(""))
