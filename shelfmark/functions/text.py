"""Text and number functions of the listing's locale, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Plain decimal numbers; try_cast alone would also take '1.0d' and text with spaces around.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
PAGINATION = r"Page\s+([\d.]+)\s+of\s+([\d.]+)\s*\|\s*Total Records\s+([\d.]+)"


def collapse_space(text: Column) -> Column:
    """Runs of Unicode white space become one space, and none stays at either end."""
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"^ | $", "")


def trim_space(text: Column) -> Column:
    """Without Unicode white space at either end; that inside stays."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def locale_number(text: Column) -> Column:
    """'14.902' is 14902 and '104,00' is 104; empty text is 0, and what is no number is null."""
    t = trim_space(text)
    plain = F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(t == "", 0.0).when(plain.rlike(NUMBER), plain.try_cast("double"))


def whole(number: Column) -> Column:
    """A double without its fraction; null if it is beyond 64 bits."""
    return number.try_cast("bigint")


def profile_id(url: Column) -> Column:
    """The number after /profile/; null without one, for 0, and for more than 64 bits."""
    return F.nullif(F.regexp_extract(url, r"/profile/(\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def link_kind(text: Column) -> Column:
    """google_scholar, editor or website by the words of a link; null for other links. The first that fits counts."""
    low = F.lower(text)
    return F.when(low.contains("google scholar"), "google_scholar").when(low.contains("editor url"), "editor").when(low.contains("website"), "website")


def issn(text: Column, kind: str) -> Column:
    """Digits and X after 'P-ISSN :' or 'E-ISSN :', up to a hyphen; empty if there are none."""
    return F.regexp_extract(text, rf"{kind}-ISSN\s*:\s*([0-9Xx]*)", 1)


def subject_area(text: Column) -> Column:
    return trim_space(F.regexp_extract(text, r"Subject Area\s*:\s*(.+)$", 1))


def pagination_total(text: Column, group: int) -> Column:
    """Total pages (group 2) or records (group 3) of 'Page 1 of 1.678 | Total Records 16.772'; 0 if that is not there."""
    return F.coalesce(F.replace(F.regexp_extract(text, PAGINATION, group), F.lit("."), F.lit("")).try_cast("int"), F.lit(0))


def float_text(number: Column) -> Column:
    """Shortest digits, with an exponent of two digits or more below 1e-4 and from 1e6 on: 104, 12.5, 1e+06, 1e-05."""
    s = F.abs(number).cast("string")
    mantissa = F.substring_index(s, "E", 1)
    power = F.when(F.contains(s, F.lit("E")), F.substring_index(s, "E", -1).try_cast("int")).otherwise(0)
    head, tail = F.substring_index(mantissa, ".", 1), F.substring_index(mantissa, ".", -1)
    every = F.concat(head, tail)
    bare = F.regexp_replace(every, "^0+", "")
    digits = F.regexp_replace(bare, "0+$", "")
    point = F.length(head) + power - (F.length(every) - F.length(bare))
    e = point - 1
    fraction = lambda d: F.when(d != "", F.concat(F.lit("."), d)).otherwise("")
    rest = F.substring(digits, F.lit(2), F.length(digits))
    science = F.concat(F.substring(digits, 1, 1), fraction(rest), F.when(e < 0, "e-").otherwise("e+"), F.when(F.abs(e) < 10, "0").otherwise(""), F.abs(e).cast("string"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)
    large = F.concat(F.rpad(F.substring(digits, F.lit(1), point), point, F.lit("0")), fraction(F.substring(digits, point + 1, F.length(digits))))
    text = F.when(digits == "", "0").when((e < -4) | (e >= 6), science).when(point <= 0, small).otherwise(large)
    return F.concat(F.when(number < 0, "-").otherwise(""), text)


def rfc3339(time: Column) -> Column:
    """UTC text of one-second precision; the session's time zone must be UTC."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")


#: Fields of the content hash in their order, which fixes its value.
HASHED = "name website_url affiliation issn_print issn_electronic subject_area rank_raw garuda_url is_scopus is_garuda impact h5_index citations_5yr citations_total".split()


def _hash_parts() -> list[Column]:
    text = lambda c: float_text(F.col(c)) if c == "impact" else F.col(c).cast("string")
    return [F.coalesce(text(c), F.lit("")) for c in HASHED]


def content_hash() -> Column:
    """SHA-256 of a record's fields joined by bars. Bars inside fields are not escaped, see content_hash_v2()."""
    return F.sha2(F.concat_ws("|", *_hash_parts()), 256)


def content_hash_v2() -> Column:
    """The same fields, each with its length before it, so that different records have different input."""
    return F.sha2(F.concat_ws("|", *(F.concat_ws(":", F.length(p).cast("string"), p) for p in _hash_parts())), 256)
