from __future__ import annotations

from shelfmark.operators import cards
from shelfmark.operators.dom import of_class, of_tag, parse

CARD = """<div class="x col-md"><DIV CLASS="affil-name"><a href="/profile/{id}">\xa0 A &amp; <i></i>B\n </a></div>
<div class="affil-abbrev"><a href="1">Google  Scholar</a><a href="2">google scholar</a><a href="3">My Website<a href="4">Editor URL</a></div>
<div class="affil-loc"><p>one<p><a href="/aff">Uni</a></div><div class="profile-id">P-ISSN : 12345678<br>E-ISSN : Subject Area : A, B</div>
<div class="stat-prev"><span class="accredited">S1\n Accredited</span><a href="g"><b><span class="garuda-indexed"></span></b></a></div>
<div class="journal-list-stat"><div><p class="pr-num">1.234,5</p><p class="other"></p><p class="pr-txt">Impact</p></div>
<div class="pr-num">7,9</div><div class="pr-txt">H5-index</div><div class="pr-num">x</div><div class="pr-txt">Citations</div></div></div>"""


def read(spark, *pages):
    return cards.raw_pages(spark.createDataFrame([(i + 1, p) for i, p in enumerate(pages)], "page int, html string"))


def test_record(spark):
    row = cards.records(read(spark, CARD.format(id=5))).first().asDict()
    assert row == {
        "id": 5, "name": "A & B", "profile_url": "/profile/5", "google_scholar_url": "2", "website_url": "3", "editor_url": "4", "affiliation": "Uni", "affiliation_url": "/aff",
        "issn_print": "12345678", "issn_electronic": "", "subject_area": "A, B", "rank_raw": "S1 Accredited", "is_scopus": False, "is_garuda": True, "garuda_url": "g",
        "impact": 1234.5, "h5_index": 7, "citations_5yr": 0, "citations_total": 0, "source_page": 1, "card_pos": 0,
    }


def test_pages(spark):
    note = '<div class="pagination-text">Page 1 of 1.678 |\n Total Records 16.772</div>'
    decoy = '<div class="col-md-4"><div class="affil-name"><a href="/profile/9">no</a></div></div>'
    wrapper = f'<div class="col-md">{CARD.format(id=1)}{CARD.format(id=2)}</div>'
    raw = read(spark, CARD.format(id=1) + CARD.format(id=0) + decoy + note, wrapper, "", None)
    got = {r["page"]: r.asDict() for r in cards.page_results(raw).collect()}
    assert got[1] == {"page": 1, "total_pages": 1678, "total_records": 16772, "n_cards": 1, "rejected_cards": 1, "warning": None}
    assert (got[2]["n_cards"], got[2]["total_pages"]) == (1, 0)
    assert got[3]["warning"] == got[4]["warning"] == "no cards"
    assert [(r["source_page"], r["id"]) for r in cards.records(raw).orderBy("source_page").collect()] == [(1, 1), (2, 1)]


def test_tree():
    t = parse('<ul><li class="a b">x<li>y</ul><p>1<p>2<div>3</div><a href=u>l<a href=v>m</a></b>')
    assert [n.text() for n in t.all(of_tag("li"))] == ["x", "y"]
    assert [n.text() for n in t.all(of_tag("p"))] == ["1", "2"]
    assert [a.attributes["href"] for a in t.all(of_tag("a"))] == ["u", "v"]
    assert t.first(of_class("b")).tag == "li" and t.first(of_class("ab")) is None
    assert t.first(of_class("a")).above("ul").tag == "ul" and t.first(of_class("a")).later("a") is None
