"""python -m shelfmark.cli --base-url URL --user-agent "name (contact)" --db FOLDER"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from shelfmark.plans.harvest import harvest
from shelfmark.sources.listing import Session
from shelfmark.sources.tables import Catalog


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shelfmark", description=__doc__)
    p.add_argument("--base-url", required=True)
    p.add_argument("--user-agent", required=True, help="who fetches, with a contact")
    p.add_argument("--query", default="", help="query string that is added to every page's URL")
    p.add_argument("--filter", default="", help="form data that is posted first")
    p.add_argument("--run-key", default="default", help="name of the run, for going on with it later")
    p.add_argument("--max-pages", type=int, default=0, help="0 or less: as many as the listing has")
    p.add_argument("--workers", type=int, default=1, help="at least 1; pages are fetched by one task whatever it is, which keeps the pace")
    p.add_argument("--db", default="data/catalog", help="folder of the tables")
    p.add_argument("--min-delay", type=float, default=3.0, help="seconds")
    p.add_argument("--max-delay", type=float, default=8.0, help="seconds")
    p.add_argument("--refetch-empty", action="store_true", help="don't mark pages without cards as completed")
    p.add_argument("--verbose", action="store_true", help="log every stored page")
    return p


def main(args: list[str] | None = None, transport=None) -> int:
    p = parser()
    a = p.parse_args(args)
    if a.workers <= 0:
        p.error("--workers must be over 0")
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("shelfmark").setLevel(logging.DEBUG if a.verbose else logging.INFO)
    spark = SparkSession.builder.appName("shelfmark").getOrCreate()
    more = {"transport": transport} if transport else {}
    with Catalog(spark, a.db) as catalog:
        session = lambda: Session(a.base_url, a.user_agent, a.query, a.filter, a.min_delay, a.max_delay, **more)
        summary = harvest(spark, catalog, session, a.run_key, a.max_pages, refetch_empty=a.refetch_empty).first()
    return 1 if summary["failed_pages"] else 0


if __name__ == "__main__":
    raise SystemExit(main())
