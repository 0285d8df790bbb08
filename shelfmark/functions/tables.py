"""Table functions for SQL.

    register(spark)
    spark.sql("SELECT p.page, c.* FROM pages p, LATERAL list_cards(p.html) c")
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from shelfmark.operators.cards import find_cards, raw_card
from shelfmark.operators.dom import Node, parse

CARDS = (
    "card_pos int, name string, profile_url string, links array<struct<text:string,href:string>>, affiliation string, affiliation_url string, ids string, rank string, "
    "is_scopus boolean, is_garuda boolean, garuda_url string, metrics array<struct<label:string,number:string>>"
)
NODE_ROWS = "pos int, tag string, text string, href string"


class ListCards:
    """The cards of a listing page in order, with their raw parts. A null page has none."""

    def eval(self, html: str) -> Iterator[tuple]:
        for i, card in enumerate(find_cards(parse(html))):
            c = raw_card(card)
            profile, place = c["profile"] or {}, c["location"] or {}
            yield (
                i, profile.get("text"), profile.get("href"), [(x["text"], x["href"]) for x in c["links"]], place.get("text"), place.get("href"), c["ids"], c["rank"],
                c["is_scopus"], c["is_garuda"], c["garuda_url"], [(x["label"], x["number"]) for x in c["metrics"]],
            )


class ListNodes:
    """The elements of a page, of one name or (where it is null) all, in order, with all text below."""

    def eval(self, html: str, tag: str) -> Iterator[tuple]:
        wanted = lambda n: n.tag == tag if tag is not None else n.tag != ""
        found: list[Node] = parse(html).all(wanted)
        for i, n in enumerate(found):
            yield i, n.tag, n.text(), n.attributes.get("href", "")


def register(spark: SparkSession) -> None:
    """list_cards(html) and list_nodes(html, tag)."""
    spark.udtf.register("list_cards", udtf(ListCards, returnType=CARDS))
    spark.udtf.register("list_nodes", udtf(ListNodes, returnType=NODE_ROWS))
