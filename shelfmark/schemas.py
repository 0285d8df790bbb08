"""Schemas of the tables that a harvest reads and writes."""

from __future__ import annotations

#: What a listing card holds, in the order of the table; text is empty where a card lacks it, never null.
RECORD = (
    "id long, name string, profile_url string, google_scholar_url string, website_url string, editor_url string, affiliation string, "
    "affiliation_url string, issn_print string, issn_electronic string, subject_area string, rank_raw string, is_scopus boolean, "
    "is_garuda boolean, garuda_url string, impact double, h5_index long, citations_5yr long, citations_total long, source_page int"
)
JOURNALS = RECORD + ", content_hash string, first_seen_at timestamp, last_scraped_at timestamp"
PROGRESS = "run_key string, page int, completed_at timestamp"
#: A micro-batch of a stream, which its checkpoint folder names.
BATCHES = "stream string, batch long, started_at timestamp, stored boolean"
#: A fetched page; error is null where html is there.
PAGES = "page int, url string, html string, error string, attempts int"


def names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]
