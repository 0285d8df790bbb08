"""Columns of tables whose names the operators use themselves, or that hold dots, come through unchanged."""

from __future__ import annotations

from collections import Counter

import pytest

from shelfmark.llm import extraction, ngramjoin, queries, substrings, toxicity, urlfilter
from tests.llm.tables import words

NAMES = ["kept", "factors", "n_words", "n_removed", "_fit", "fit", "rest", "whole", "row", "key", "cls", "doc", "tie", "_n", "family", "a.b", "with space", "-"]


@pytest.fixture(scope="module")
def table(spark):
    passage = words(3, 30, 900)
    texts = [words(i, 40, 900) + (f" {passage} " if i % 3 == 0 else " ") + words(50 + i, 20, 900) for i in range(12)] + [words(1, 40, 900) + " " + words(51, 20, 900), None, ""]
    rows = [(i, t, *(f"{n}{i}" for n in NAMES)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in NAMES))


def own(rows):
    return {r["doc_id"]: tuple(r[n] for n in NAMES) for r in rows}


@pytest.mark.parametrize("stage", [substrings.remove_repeats, ngramjoin.one_of_each, lambda d: toxicity.reject(d, toxicity.fit([], None_labels()))], ids=["remove_repeats", "one_of_each", "reject"])
def test_stages(table, stage):
    got = stage(table)
    assert got.columns == table.columns and got.schema.simpleString() == table.schema.simpleString()
    before, rows = own(table.collect()), got.collect()
    assert len(rows) in (14, 15) and all(before[i] == x for i, x in own(rows).items())


def None_labels():
    import numpy as np

    return np.empty(0)


def test_stages_change_texts_alone(table):
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    got = {r["doc_id"]: r["text"] for r in substrings.remove_repeats(table).collect()}
    assert {i for i in texts if texts[i] != got[i]} == {3, 6, 9, 12}


def test_find_repeats(table):
    got = substrings.find_repeats(table)
    replaced = {"kept", "factors", "n_words", "n_removed"}
    assert Counter(got.columns) == Counter(table.columns)
    rows = got.collect()
    assert all(r["a.b"] == f"a.b{r['doc_id']}" and r["rest"] == f"rest{r['doc_id']}" for r in rows)
    assert all(r[n] != f"{n}{r['doc_id']}" for r in rows for n in replaced)


def test_url_filter(table):
    pages = table.withColumnRenamed("text", "url")
    got = urlfilter.filter_urls(pages, queries.URL_RULES)
    assert got.columns == [*pages.columns, "host", "path", "rule", "verdict"]
    assert own(got.collect()) == own(table.collect())


def test_extraction(table):
    field = extraction.Field({}, ((0.0, 0.0), (0.0, 0.0)), (0.0, 1.0))
    got = extraction.extract(table.withColumnRenamed("text", "html"), field)
    assert own(got.collect()) == own(table.collect())


@pytest.mark.parametrize("operator", [ngramjoin.join_documents, lambda d: toxicity.score(d, toxicity.fit([], None_labels()))], ids=["join", "score"])
def test_operators_ignore_them(table, operator):
    assert Counter(r["doc_id"] for r in operator(table).collect()) == Counter(range(15))
