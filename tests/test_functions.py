from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import sql, web
from shelfmark.functions import text as X
from shelfmark.sources.listing import page_url


def values(spark, rows, expression):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string" if not rows or isinstance(rows[0], (str, type(None))) else "i int, x double")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_locale_numbers(spark):
    got = values(spark, ["14.902", "104,00", "", "104.00", "1,234,567", "abc", "1.0d", ",5", " 5 ", "nan", "-1,5", None], X.locale_number)
    assert got == [14902.0, 104.0, 0.0, 10400.0, None, None, None, 0.5, 5.0, None, -1.5, None]


def test_spaces(spark):
    assert values(spark, ["\t a \n\n b\xa0\x85c ", "", " "], X.collapse_space) == ["a b c", "", ""]
    assert values(spark, ["\n a  b\xa0", "\x85"], X.trim_space) == ["a  b", ""]


def test_float_text(spark):
    rows = [0.0, 104.0, 12.5, 1e6, 0.0001, 0.00001, 1234567.0, 123456.0, 999999.5, 1e21, -0.25, 1.5e-7, 100000.0]
    want = ["0", "104", "12.5", "1e+06", "0.0001", "1e-05", "1.234567e+06", "123456", "999999.5", "1e+21", "-0.25", "1.5e-07", "100000"]
    assert values(spark, rows, X.float_text) == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e15, max_value=1e15), min_size=20, max_size=40))
def test_float_text_reads_back(spark, rows):
    assert [float(x) for x in values(spark, rows, X.float_text)] == [x + 0.0 for x in rows]


def test_ids_and_cards_text(spark):
    assert values(spark, ["/profile/12", "/a/profile/0", "/profile/99999999999999999999", "x", "/profile/7/profile/8"], X.profile_id) == [12, None, None, None, 7]
    t = "P-ISSN : 1234-5678 | E-ISSN :2345678x Subject Area :  Art, Law "
    assert values(spark, [t, "none"], lambda c: X.issn(c, "P")) == ["1234", ""]
    assert values(spark, [t], lambda c: X.issn(c, "E")) == ["2345678x"]
    assert values(spark, [t, ""], X.subject_area) == ["Art, Law", ""]
    assert values(spark, ["GOOGLE Scholar website", "Editor URL website", "My Website", "Else"], X.link_kind) == ["google_scholar", "editor", "website", None]


def test_pagination(spark):
    rows = ["Page 1.000 of 1.678 | Total Records 16.772", "Page 1 of 2|Total Records 3", "", "Page x of 2 | Total Records 3", "Page 1 of 99999999999 | Total Records 3"]
    assert values(spark, rows, lambda c: X.pagination_total(c, 2)) == [1678, 2, 0, 0, 0]
    assert values(spark, rows, lambda c: X.pagination_total(c, 3)) == [16772, 3, 0, 0, 3]


def test_retry_and_estimate(spark):
    df = spark.range(1, 7)
    assert [r[0] for r in df.select(web.retry_wait(F.col("id"))).collect()] == [5, 15, 30, 60, 60, 60]
    assert df.select(web.estimate_seconds(F.lit(1678), 3.0, 8.0)).first()[0] == 9229.0
    assert all(3 <= r[0] < 8 for r in df.select(web.delay_seconds(3, 8, 1)).collect())
    assert df.select(web.delay_seconds(3, 2, 1)).first()[0] == 3


URLS = [
    ("https://h/p?b=2&a=1&b=3#f", "", 4), ("https://h/p", "x=1&x=2&page=9", 1), ("https://h/p?page=3&f[0]=a b", "f%5B0%5D=c*~", 2),
    ("https://h/p?x=1", "y=é&z", 7), ("h", "", 1), ("https://h/p?a;b=1&c=%41", "", 1),
]


@pytest.mark.parametrize(("base", "extra", "page"), URLS[:5])
def test_build_url_is_the_scalar_one(spark, base, extra, page):
    got = spark.range(1).select(web.build_url(F.lit(base), F.lit(extra), F.lit(page))).first()[0]
    assert got == page_url(base, extra, page)


def test_build_url(spark):
    got = [spark.range(1).select(web.build_url(F.lit(b), F.lit(e), F.lit(p))).first()[0] for b, e, p in URLS]
    assert got[0] == "https://h/p?a=1&b=2&b=3&page=4#f"
    assert got[1] == "https://h/p?page=9&x=2"
    assert got[2] == "https://h/p?f%5B0%5D=c%2A~&page=2"
    assert got[5] == "https://h/p?c=A&page=1"


def test_sql_functions_are_the_expressions(spark):
    sql.register(spark)
    texts = ["", " ", "\xa0 a   b\x85", "14.902", " 104,00 ", "1,234,567", "1.0d", "abc", "-3,5e2", "/x/profile/12?y", "/profile/0", "/profile/99999999999999999999", "Google  Scholar", "my GOOGLE SCHOLAR website", "Editor URL Website", "P-ISSN : 1234567x | E-ISSN:12-34 Subject Area :  A, B ", "Page 1.000 of 1.678 | Total Records 16.772", "Page x", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    calls = {
        "collapse_space(t)": X.collapse_space(F.col("t")), "trim_space(t)": X.trim_space(F.col("t")), "locale_number(t)": X.locale_number(F.col("t")), "profile_id(t)": X.profile_id(F.col("t")), "link_kind(t)": X.link_kind(F.col("t")),
        "issn(t, 'P')": X.issn(F.col("t"), "P"), "issn(t, 'E')": X.issn(F.col("t"), "E"), "subject_area(t)": X.subject_area(F.col("t")), "pagination_total(t, 2)": X.pagination_total(F.col("t"), 2), "pagination_total(t, 3)": X.pagination_total(F.col("t"), 3), "retry_wait(i + 1)": web.retry_wait(F.col("i") + 1),
    }
    got = rows.select(*(F.expr(c).alias(f"a{n}") for n, c in enumerate(calls)), *(c.alias(f"b{n}") for n, c in enumerate(calls.values())))
    for r in got.collect():
        assert [r[f"a{n}"] for n in range(len(calls))] == [r[f"b{n}"] for n in range(len(calls))]
    plan = rows.selectExpr("locale_number(t)")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "regexp_replace" in plan
