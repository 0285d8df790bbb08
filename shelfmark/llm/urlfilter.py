"""URL filters by a cascade of Bloom filters: exact membership over the corpus, with no join of URLs to rules.

A rule is a host and a path prefix. Only a few (labels, path length) shapes occur among the rules, so each URL
has one key per shape: its last labels and the first characters of its path. Level 0 of a cascade encodes the
listed keys. Level 1 encodes those of the corpus's other keys that level 0 lets through, level 2 the listed keys
that level 1 lets through, and so on until a level lets nothing through. The first level that refuses a key then
says exactly whether it is listed, for every key of the corpus the cascade was built on.

The first level's rate of false positives is set from the counts of listed and other keys, so that level 1 and
all later ones hold about as many keys as the list: filters grow with the list and the logarithm of the corpus.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, packed, unpacked

#: (verdict, host, path prefix)
Rule = tuple[str, str, str]
#: Most words of 64 bits in a filter, which is part of the plan: some 3 million listed keys among a billion others.
MOST_WORDS = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased. Path: from there up to ? # or the end.

    Both are empty for null and where :// is missing.
    """
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substring(url, place + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def url_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The URL's key of each shape, longest first; null where the URL is too short for it."""
    key = lambda labels, chars: F.when(
        (F.size(F.split(host, r"\.")) >= labels) & (F.length(path) >= chars),
        F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, chars)),
    )
    return F.array(*(key(*shape) for shape in shapes))


def _positions(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(hashes)]


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: tuple[int, ...]

    def passes(self, key: Column, level: int) -> Column:
        # one text literal, folded to an array when planned, whatever the filter's size
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        found = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")) == 1 for p in _positions(key, level, self.hashes, self.bits)]
        out = found[0]
        for x in found[1:]:
            out = out & x
        return out


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Exact for listed keys and for the keys of the corpus it was built on. Null is not contained."""
        found = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            found = F.when(self.levels[i].passes(key, i), found).otherwise(F.lit(i % 2 == 1))
        return F.coalesce(key.isNotNull() & found, F.lit(False)) if self.levels else F.lit(False)


def _level(keys: DataFrame, count: int, rate: float, level: int) -> Level:
    hashes = max(1, round(-math.log2(rate)))
    bits = max(64, math.ceil(count * hashes / math.log(2) / 64) * 64)
    if bits // 64 > MOST_WORDS:
        raise ValueError(f"a filter of {bits // 8 >> 20} MB for {count} keys is more than fits in a plan")
    words = (
        keys.select(F.explode(F.array(*_positions(F.col("key"), level, hashes, bits))).alias("p"))
        .groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("bits"))
        .collect()
    )
    out = [0] * (bits // 64)
    for row in words:  # as many as the filter has, which MOST_WORDS bounds
        out[row["word"]] = row["bits"]
    return Level(bits, hashes, tuple(out))


def build_cascade(listed: DataFrame, others: DataFrame, n_listed: int, n_others: int) -> Cascade:
    """listed and others: a column key each; others may repeat keys and hold listed ones, which are left out."""
    if not n_listed:
        return Cascade(())
    rate = min(0.5, max(2.0**-40, n_listed * math.sqrt(0.5) / max(1, n_others)))
    levels = [_level(listed, n_listed, rate, 0)]
    inside = cut(others.filter(levels[0].passes(F.col("key"), 0)).distinct().join(listed, "key", "left_anti"))
    outside = listed
    while n := inside.count():
        k = len(levels)
        levels.append(_level(inside, n, 0.5, k))
        inside, outside = outside.filter(levels[-1].passes(F.col("key"), k)), inside
    return Cascade(tuple(levels))


def filter_urls(pages: DataFrame, rules: list[Rule], url: str = "url", otherwise: str = "allow") -> DataFrame:
    """pages with host, path, rule (host and path of the longest rule that fits, else null) and verdict.

    A rule fits its host and all subdomains if the path starts with the rule's. These four columns replace columns of
    pages that have the same names; all others stay, whatever their names. Null URLs fit no rule; repeated rows each get their verdict; an
    empty table gives an empty one; no rules give the verdict `otherwise` everywhere.
    """
    pages = pages.drop(*({"host", "path", "rule", "verdict"} - {url}))
    host, path = host_and_path(F.col(f"`{url}`"))
    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules}, key=lambda s: (-s[0], -s[1]))
    keys = url_keys(F.col("host"), F.col("path"), shapes) if shapes else F.array()
    parts = pages.select(host.alias("host"), path.alias("path"))
    found = {}
    if rules:
        universe = parts.select(F.explode(keys).alias("key")).filter("key is not null")
        total = universe.agg(F.approx_count_distinct("key").alias("n")).first()["n"]
        for kind in sorted({kind for kind, _, _ in rules}):
            own = sorted({h + p for k, h, p in rules if k == kind})
            listed = pages.sparkSession.createDataFrame([(k,) for k in own], "key string")
            found[kind] = build_cascade(listed, universe, len(own), total)
    # one literal for each level of a verdict's cascade, whatever the number of shapes
    hit = lambda kind: F.transform(keys, lambda k: F.when(found[kind].contains(k), F.struct(F.length(k).alias("length"), k.alias("rule"), F.lit(kind).alias("verdict"))))
    best = F.array_max(F.concat(*map(hit, found))) if found else F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    out = pages.select(packed(pages.columns).alias("rest"), host.alias("host"), path.alias("path")).select("rest", "host", "path", best.alias("fit"))
    made = [F.col("host"), F.col("path"), F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.lit(otherwise)).alias("verdict")]
    return out.select(*unpacked(pages.columns, "rest").values(), *made)
