"""Repair of conversations whose turns were damaged, by the cheapest edits that make roles alternate.

Roles must read `(s?(ua)+)?` by their initials. Costs to go are found backward over turns and the states of that grammar;
a walk forward then takes, of the steps that keep to the least cost, the one whose initial is least in ASCII. Costs
to go differ by little between states, so that there are few different ones but for an additive number: what a turn does
to them, and which edits it gets from each state, is worked out once and looked up then.

A conversation is dealt to segments of SEGMENT_TURNS turns or SEGMENT_BYTES of text. One of a single segment is repaired where
it was gathered. Of a longer one only a byte a turn meets in one task, which is less than the audit that the result
holds of it; repeated turns are found by a shuffle of their digests, and texts are joined segment by segment.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, lean, shared_dir
from shelfmark.llm.ordered import dealt, joined_digests

SEGMENT_TURNS, SEGMENT_BYTES = 4096, 4 << 20
SPACES, ENDS = " \t\n\x0b\x0c\r", ".!?"
#: States: nothing yet, after s, after u, after a. The state that a user or assistant turn leads to from each.
NEXT = (2, 2, 3, 2)
ROLES = {2: "user", 3: "assistant"}
#: States by the initial that is kept: from each state, None where the grammar forbids it.
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "": (None,) * 4}
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
LEGAL = {"su", "ua", "au"}
#: A turn's code: its initial's place here, plus 4 if it is truncated; or MUST, if it has to be deleted.
INITIALS, MUST = ("s", "u", "a", ""), 8
FAR = 1 << 20


class Repairs:
    """The dynamic programme, with all it has worked out. Costs to go are known by the differences to the least one."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        #: Differences of costs before a turn, what is added to the least, and for each state the edits and the next state.
        self.steps: list[tuple] = []
        self.end = self._settled([0, FAR, FAR, 0])

    @staticmethod
    def _settled(base: list[int]) -> list[int]:
        """Least costs where turns may be inserted first."""
        user, assistant = min(base[2], INSERT + base[3]), min(base[3], INSERT + base[2])
        return [min(base[0], INSERT + user), min(base[1], INSERT + user), user, assistant]

    def step(self, code: int, after: tuple) -> int:
        """Number of the step for a turn of this code before these costs."""
        key = code, after
        if key not in self.known:
            self.known[key] = len(self.steps)
            self.steps.append(self._worked_out(code, after))
        return self.known[key]

    def _worked_out(self, code: int, after: tuple) -> tuple:
        ways = []
        for state in range(4):
            own = {"D": (DELETE + after[state], state)}
            if code != MUST:
                more, kept = (code >> 2) * TRUNCATED, KEPT[INITIALS[code & 3]][state]
                own["R"] = REROLE + more + after[NEXT[state]], NEXT[state]
                if kept is not None:
                    own["K"] = more + after[kept], kept
            ways.append(own)
        costs = self._settled([min(c for c, _ in own.values()) for own in ways])
        walks = []
        for state in range(4):
            letters = ""
            while True:
                tight = sorted([x for x, (cost, _) in ways[state].items() if cost == costs[state]] + ["I"] * (INSERT + costs[NEXT[state]] == costs[state]))
                letters += tight[0]
                if tight[0] != "I":
                    walks.append((letters, ways[state][tight[0]][1]))
                    break
                state = NEXT[state]
        least = min(costs)
        return tuple(c - least for c in costs), least, tuple(walks)

    def edits(self, codes: bytes) -> tuple[int, list[str]]:
        """The least cost, and the initials of each turn's edits (insertions before its own), with those after the last turn."""
        after, total, taken = tuple(self.end), 0, array("I")
        for code in reversed(codes):
            i = self.step(code, after)
            after, least, _ = self.steps[i]
            taken.append(i)
            total += least
        total += after[0]
        out, state = [], 0
        for i in reversed(taken):
            letters, state = self.steps[i][2][state]
            out.append(letters)
        out.append("I" * (self.end[state] // INSERT))  # costs of the end are those of its insertions
        return total, out


def turns_kept(edits: list[str], state: int, roles: list[str], texts: list[str]) -> tuple[list[str], int]:
    """`role:text` of the turns that these edits leave, and the state after them."""
    out = []
    for letters, role, text in zip(edits, roles, texts, strict=True):
        for x in letters:
            if x == "I":
                state = NEXT[state]
                out.append(f"{ROLES[state]}:")
            elif x == "R":
                state = NEXT[state]
                out.append(f"{ROLES[state]}:{text}")
            elif x == "K":
                state = KEPT[initial(role)][state]
                out.append(f"{role}:{text}")
    return out, state


def initial(role: str) -> str:
    return role[0] if role and role[0] in "sua" else ""


def coded(roles: list[str], texts: list[str], firsts: set[int] | None = None) -> tuple[bytes, list[int]]:
    """Codes of turns, and how many are blank, duplicates and truncated. firsts: places of the turns that are neither blank nor
    seen earlier; where None, what was seen earlier is found among these turns."""
    codes, faults, seen = bytearray(), [0, 0, 0], set()
    for i, (role, text) in enumerate(zip(roles, texts, strict=True)):
        plain = text.rstrip(SPACES)
        if not plain:
            codes.append(MUST)
            faults[0] += 1
            seen.add((role, text))
        elif (role, text) in seen if firsts is None else i not in firsts:
            codes.append(MUST)
            faults[1] += 1
        else:
            seen.add((role, text))
            truncated = plain[-1] not in ENDS
            faults[2] += truncated
            codes.append(INITIALS.index(initial(role)) + 4 * truncated)
    return bytes(codes), faults


def illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of conversations as the contract damages them, by the hash of conversation and turn: name, conv (null is kept), turn,
    role and text. Nulls in role and text, and in what is hashed, are one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.filter("kind <> 0").withColumns({"role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")), "text": text})
    return rows.select(F.coalesce(F.col("conv").cast("string"), F.lit(" ")).alias("name"), "conv", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("_")).drop("_")


def _segments(rows: DataFrame) -> DataFrame:
    """name, part, seg, alone, turns, roles and texts: a conversation's turns in order, dealt to segments; written once. alone:
    whether the conversation has one segment in its range."""
    order = [F.col("turn").asc_nulls_first(), F.xxhash64("role", "text")]
    inside = Window.partitionBy("name", "part").orderBy(*order)
    size = F.octet_length("text") + F.octet_length("role")
    place = F.row_number().over(inside)
    before = F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - size
    numbered = dealt(rows.drop("conv"), F.col("name"), *order).withColumns({"place": place, "seg": F.floor((place - 1) / SEGMENT_TURNS) + F.floor(before / SEGMENT_BYTES)})
    lines = F.sort_array(F.collect_list(F.struct("place", "turn", "role", "text")))
    gathered = numbered.groupBy("name", "part", "seg").agg(lines.alias("lines"))
    alone = F.count("*").over(Window.partitionBy("name", "part")) == 1
    parts = [F.col(f"lines.{c}").alias(f"{c}s") for c in ("turn", "role", "text")]
    path = shared_dir(rows.sparkSession, "segments")
    gathered.withColumn("alone", alone).select("name", "part", (F.col("part").cast("long") * (1 << 32) + F.col("seg")).alias("seg"), "alone", *parts).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long"
RESULT = f"name string, {COUNTS}, cost long, audit string, repaired_sha256 string"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
    fields = [x.split(" ") for x in schema.split(", ")]
    return pa.record_batch([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """RESULT of conversations of one segment: name, turns, roles and texts."""
    repairs = Repairs()
    for b in batches:
        out = []
        for name, turns, roles, texts in zip(*(c.to_pylist() for c in b.columns), strict=True):
            codes, faults = coded(roles, texts)
            cost, edits = repairs.edits(codes)
            kept, state = turns_kept(edits[:-1], 0, roles, texts)
            kept += turns_kept(edits[-1:], state, [""], [""])[0]
            there = {t for t in turns if t is not None}
            gaps = max(there) - min(there) + 1 - len(there) if there else 0
            out.append((name, gaps, *faults, illegal(roles), cost, "".join(edits), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
        yield _batch(out, RESULT)


CODED = "name string, seg long, codes binary, blank long, duplicate long, truncated long, illegal long, first string, last string, least long, most long, distinct long"


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """CODED from name, seg, turns, roles, texts and the places of turns that are neither blank nor seen earlier."""
    for b in batches:
        out = []
        for name, seg, turns, roles, texts, firsts in zip(*(c.to_pylist() for c in b.columns), strict=True):
            codes, faults = coded(roles, texts, set(firsts or ()))
            there = {t for t in turns if t is not None}
            out.append((name, seg, codes, *faults, illegal(roles), roles[0][:1], roles[-1][:1], min(there, default=None), max(there, default=None), len(there)))
        yield _batch(out, CODED)


EDITED = "name string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, segs array<bigint>, states array<bigint>, edits array<array<string>>"


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """EDITED from name and segments, in order, of a conversation of several: for each segment the state before it and its edits."""
    repairs = Repairs()
    for b in batches:
        rows = []
        for name, segments in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            cost, edits = repairs.edits(b"".join(s["codes"] for s in segments))
            at, state, states, dealt_edits = 0, 0, [], []
            sums = {k: sum(s[k] for s in segments) for k in ("blank", "duplicate", "truncated", "illegal", "distinct")}
            for i, s in enumerate(segments):
                own = edits[at : at + len(s["codes"])] + (edits[-1:] if i == len(segments) - 1 else [])
                states.append(state)
                dealt_edits.append(own)
                for letters, code in zip(own, [*s["codes"], MUST], strict=False):
                    for x in letters:
                        state = NEXT[state] if x in "IR" else KEPT[INITIALS[code & 3]][state] if x == "K" else state
                at += len(s["codes"])
                if i:
                    sums["illegal"] += segments[i - 1]["last"] + s["first"] not in LEGAL
                    sums["distinct"] -= s["least"] is not None and segments[i - 1]["most"] == s["least"]
            turns = [s["least"] for s in segments if s["least"] is not None], [s["most"] for s in segments if s["most"] is not None]
            gaps = turns[1][-1] - turns[0][0] + 1 - sums["distinct"] if turns[0] else 0
            rows.append((name, gaps, *(sums[k] for k in ("blank", "duplicate", "truncated", "illegal")), cost, [s["seg"] for s in segments], states, dealt_edits))
        fields = [x.split(" ", 1) for x in EDITED.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<array<string>>": pa.list_(pa.list_(pa.string()))}
        yield pa.record_batch([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


KEPT_TEXT = "name string, seg long, text string"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """KEPT_TEXT from name, seg, roles, texts, state and edits; none where nothing is left."""
    for b in batches:
        out = []
        for name, seg, roles, texts, state, edits in zip(*(c.to_pylist() for c in b.columns), strict=True):
            more = len(edits) - len(roles)  # of the last segment
            kept, _ = turns_kept(edits, state, roles + [""] * more, texts + [""] * more)
            if kept:
                out.append((name, seg, "\n".join(kept)))
        yield _batch(out, KEPT_TEXT)


def _long(several: DataFrame) -> DataFrame:
    """RESULT of conversations of several segments."""
    filled = F.col("x.text").rlike(r"[^\x20\x09-\x0D]")
    zipped = F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text"))
    turns = several.select("name", "seg", F.posexplode(zipped).alias("at", "x")).filter(filled)
    digest = F.sha2(F.concat(F.char_length("x.role").cast("string"), F.lit(":"), "x.role", "x.text"), 256)
    firsts = turns.groupBy("name", digest.alias("digest")).agg(F.min(F.struct("seg", "at")).alias("x"))
    firsts = firsts.groupBy("name", F.col("x.seg").alias("seg")).agg(F.collect_list("x.at").alias("firsts"))
    inputs = several.join(firsts, ["name", "seg"], "left").select("name", "seg", "turns", "roles", "texts", "firsts")
    codes = inputs.mapInArrow(lean(_coded), CODED)
    gathered = codes.groupBy("name").agg(F.sort_array(F.collect_list(F.struct(*(x.split(" ")[0] for x in CODED.split(", ")[1:])))).alias("segments"))
    edited = cut(gathered.mapInArrow(lean(_edited), EDITED))
    each = edited.select("name", F.explode(F.arrays_zip("segs", "states", "edits")).alias("x")).select("name", F.col("x.segs").alias("seg"), F.col("x.states").alias("state"), F.col("x.edits").alias("edits"))
    texts = several.join(each, ["name", "seg"]).select("name", "seg", "roles", "texts", "state", "edits").mapInArrow(lean(_kept), KEPT_TEXT)
    digests = joined_digests(texts, "name", ["seg"], "\n")
    audit = F.array_join(F.flatten("edits"), "").alias("audit")
    counts = [x.split(" ")[0] for x in COUNTS.split(", ")]
    return edited.join(digests, "name", "left").select("name", *counts, "cost", audit, F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def repair_conversations(conversations: DataFrame, damage=damaged) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    conversations needs conv_id, turn, role and text; other columns are ignored. damage: makes name, turn, role and text (with
    no nulls but in turn) of the turns that are repaired; a conversation that has none left gets zeros, an empty audit and the
    empty string's hash. Rows of a null conv_id are one conversation. Turns of equal number are in the order of a hash of
    role and text, so that repeated rows follow each other; null numbers come first and don't count for gaps. A role
    with an initial other than s, u and a, and an empty one, fits nowhere: its turn is re-roled or deleted. An empty
    table gives an empty one.
    """
    segments = _segments(damage(conversations))
    # a conversation in several ranges lies at the edges of them: no more of these than ranges
    spread = segments.groupBy("name").agg((F.min("part") < F.max("part")).alias("spread")).filter("spread")
    marked = segments.join(F.broadcast(cut(spread)), "name", "left").withColumn("one", F.col("alone") & F.col("spread").isNull())
    whole = marked.filter("one").select("name", "turns", "roles", "texts").mapInArrow(lean(_whole), RESULT)
    several = marked.filter("not one").select("name", "seg", "turns", "roles", "texts")
    found = whole if several.isEmpty() else whole.unionByName(_long(several))
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().withColumn("name", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    zero = F.lit(0).cast("long")
    counts: list[Column] = [F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, "name", "left").select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
