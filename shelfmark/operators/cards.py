"""From listing pages to typed records: one Arrow function takes the raw parts from the tree, expressions do the rest."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import text as X
from shelfmark.operators.dom import Node, of_class, of_tag, parse
from shelfmark.schemas import RECORD, names

#: Characters of html after which the parts that were taken are sent on.
MANY = 1 << 20
LINK = pa.struct([("text", pa.string()), ("href", pa.string())])
METRIC = pa.struct([("label", pa.string()), ("number", pa.string())])
CARD = pa.struct([
    ("profile", LINK), ("links", pa.list_(LINK)), ("location", LINK), ("ids", pa.string()), ("rank", pa.string()),
    ("is_scopus", pa.bool_()), ("is_garuda", pa.bool_()), ("garuda_url", pa.string()), ("metrics", pa.list_(METRIC)),
])
_link = "struct<text:string,href:string>"
RAW = f"pagination string, cards array<struct<profile:{_link},links:array<{_link}>,location:{_link},ids:string,rank:string,is_scopus:boolean,is_garuda:boolean,garuda_url:string,metrics:array<struct<label:string,number:string>>>>"


def find_cards(page: Node) -> list[Node]:
    """Outermost div elements of class col-md that hold an element of class affil-name."""
    holders: set[int] = set()
    for node in page.all(of_class("affil-name")):
        while node is not None and id(node) not in holders:
            holders.add(id(node))
            node = node.parent
    out: list[Node] = []
    todo = [page]
    while todo:
        node = todo.pop()
        if node.tag == "div" and node.has_class("col-md"):
            if id(node) in holders:
                out.append(node)
                continue
        todo += [c for c in reversed(node.children) if isinstance(c, Node) and id(c) in holders]
    return out


#: Where a card holds its parts.
PARTS = frozenset("affil-name affil-abbrev affil-loc profile-id stat-prev journal-list-stat".split())


def _link_in(place: Node | None) -> dict | None:
    link = place and place.first(of_tag("a"))
    return link and {"text": link.text(), "href": link.attributes.get("href", "")}


def raw_card(card: Node) -> dict:
    parts = card.firsts(PARTS)
    names_, badges, stats, ids = (parts.get(c) for c in ("affil-abbrev", "stat-prev", "journal-list-stat", "profile-id"))
    marks = badges.firsts(frozenset(("accredited", "garuda-indexed", "scopus-indexed"))) if badges else {}
    rank, garuda = marks.get("accredited"), marks.get("garuda-indexed")
    around = garuda and garuda.above("a")
    metrics = []
    for number in stats.all(of_class("pr-num")) if stats else ():
        label = number.later("pr-txt")
        metrics.append({"label": label.text() if label else "", "number": number.text()})
    return {
        "profile": _link_in(parts.get("affil-name")),
        "links": [{"text": a.text(), "href": a.attributes.get("href", "")} for a in (names_.all(of_tag("a")) if names_ else ())],
        "location": _link_in(parts.get("affil-loc")),
        "ids": ids.text() if ids else "",
        "rank": rank.text() if rank else "",
        "is_scopus": "scopus-indexed" in marks,
        "is_garuda": bool(garuda),
        "garuda_url": around.attributes.get("href", "") if around else "",
        "metrics": metrics,
    }


def raw_pages(pages: DataFrame) -> DataFrame:
    """page, pagination (raw text, empty if there is none) and cards (raw parts) of pages with page and html."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        kinds = {"page": pa.int32(), "pagination": pa.string(), "cards": pa.list_(CARD)}
        made = lambda: pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds.values())], names=list(kinds))
        held = 0
        for b in batches:
            for number, html in zip(b.column(0), b.column(1), strict=True):  # a tree at a time, however many pages a batch has
                page = html.as_py()
                tree = parse(page)
                note = tree.first(of_class("pagination-text"))
                rows.append((number.as_py(), note.text() if note else "", [raw_card(c) for c in find_cards(tree)]))
                held += len(page or "")
                if held >= MANY:
                    yield made()
                    rows.clear()
                    held = 0
        if rows:
            yield made()

    return pages.select(F.col("page").cast("int").alias("page"), "html").mapInArrow(read, f"page int, {RAW}")


def _last(items: Column, test) -> Column:
    found = F.filter(items, test)
    return F.get(found, F.size(found) - 1)


def _record(card: Column, page: Column) -> list[Column]:
    empty = lambda c: F.coalesce(c, F.lit(""))
    url = empty(card["profile"]["href"])
    link = lambda kind: empty(_last(card["links"], lambda x: X.link_kind(x["text"]) == kind)["href"])
    ids = X.collapse_space(card["ids"])
    label = lambda m: F.lower(X.collapse_space(m["label"]))
    number = lambda m: X.locale_number(X.collapse_space(m["number"]))
    metric = lambda name: F.coalesce(number(_last(card["metrics"], lambda m: (label(m) == name) & number(m).isNotNull())), F.lit(0.0))
    count = lambda name: F.coalesce(X.whole(metric(name)), F.lit(0).cast("bigint"))
    values = [
        X.profile_id(url), X.trim_space(empty(card["profile"]["text"])), url, link("google_scholar"), link("website"), link("editor"),
        X.trim_space(empty(card["location"]["text"])), empty(card["location"]["href"]), X.issn(ids, "P"), X.issn(ids, "E"), X.subject_area(ids),
        X.collapse_space(card["rank"]), card["is_scopus"], card["is_garuda"], card["garuda_url"],
        metric("impact"), count("h5-index"), count("citations 5yr"), count("citations"), page,
    ]
    return [v.alias(n) for v, n in zip(values, names(RECORD), strict=True)]


def records(raw: DataFrame) -> DataFrame:
    """One record per card of raw_pages(), with card_pos (its place on the page); cards without an id are left out."""
    cards = raw.select("page", F.posexplode("cards").alias("card_pos", "card"))
    return cards.select(*_record(F.col("card"), F.col("page")), "card_pos").filter("id is not null")


def page_results(raw: DataFrame) -> DataFrame:
    """Per page: total_pages, total_records, n_cards (records), rejected_cards (cards without an id) and warning (pages without cards)."""
    note = X.collapse_space(F.col("pagination"))
    good = F.size(F.filter("cards", lambda c: X.profile_id(F.coalesce(c["profile"]["href"], F.lit(""))).isNotNull()))
    return raw.select("page", X.pagination_total(note, 2).alias("total_pages"), X.pagination_total(note, 3).alias("total_records"), good.alias("n_cards"), (F.size("cards") - good).alias("rejected_cards"), F.when(good == 0, "no cards").alias("warning"))
