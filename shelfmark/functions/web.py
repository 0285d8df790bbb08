"""URLs, waits and estimates of a harvest, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Seconds before the second to the fifth attempt.
WAITS = (5, 15, 30, 60)


def retry_wait(attempt: Column) -> Column:
    """Seconds to wait before a repeated attempt (from 1); later ones wait as the last."""
    return F.element_at(F.array(*map(F.lit, WAITS)), F.least(attempt, F.lit(len(WAITS))).cast("int"))


def estimate_seconds(pages: Column, least: float, most: float) -> Column:
    """Seconds for so many pages at the mean delay."""
    return pages * ((least + most) / 2)


def delay_seconds(least: float, most: float, seed: int) -> Column:
    """A delay between the two, or the least if the most is not above it."""
    return F.lit(least) + F.rand(seed) * max(0.0, most - least)


def _pairs(query: Column) -> Column:
    """array<struct<k, v>> of a query string, decoded; parts with a semicolon or a broken escape are left out."""
    parts = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.contains(";"))
    pair = lambda p: F.struct(F.try_url_decode(F.substring_index(p, "=", 1)).alias("k"), F.try_url_decode(F.when(p.contains("="), F.substring(p, F.instr(p, "=") + 1, F.length(p))).otherwise("")).alias("v"))
    return F.filter(F.transform(parts, pair), lambda x: x["k"].isNotNull() & x["v"].isNotNull())


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def build_url(base: Column, extra: Column, page: Column) -> Column:
    """base with page set in its query, and then every key of the query string `extra` (of a repeated key the last value).

    Keys of base that neither names keep all their values. Keys are in order, and values are percent-encoded.
    """
    plain = F.substring_index(base, "#", 1)
    fragment = F.when(base.contains("#"), F.concat(F.lit("#"), F.substring(base, F.instr(base, "#") + 1, F.length(base)))).otherwise("")
    query = F.when(plain.contains("?"), F.substring(plain, F.instr(plain, "?") + 1, F.length(plain))).otherwise("")
    own = _pairs(F.coalesce(extra, F.lit("")))
    set_page = F.struct(F.lit("page").alias("k"), page.cast("string").alias("v"))
    extras = F.concat(F.array(set_page), own)
    last = F.filter(extras, lambda x, i: ~F.exists(F.slice(extras, i + 2, F.greatest(F.size(extras) - i - 1, F.lit(0))), lambda y: y["k"] == x["k"]))
    kept = F.filter(_pairs(query), lambda x: ~F.exists(extras, lambda y: y["k"] == x["k"]))
    numbered = F.transform(F.concat(kept, last), lambda x, i: F.struct(x["k"].alias("k"), i.alias("i"), x["v"].alias("v")))
    text = F.array_join(F.transform(F.array_sort(numbered), lambda x: F.concat(_escaped(x["k"]), F.lit("="), _escaped(x["v"]))), "&")
    return F.concat(F.substring_index(plain, "?", 1), F.lit("?"), text, fragment)
