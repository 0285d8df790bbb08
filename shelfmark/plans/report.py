"""Summary of a run from the outcomes of its pages."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

log = logging.getLogger("shelfmark")
#: Of an outcome: error is null for a page that was fetched and stored.
OUTCOMES = "page int, arrival_seq long, n_cards int, total_records int, error string"


def run_summary(outcomes: DataFrame, target: int, limited: bool = False, first_cards: int = 0, done_before: int = 0, expected: int = 0) -> DataFrame:
    """One row: ok_pages, failed_pages, cards (not different ids), expected_records (the first that a page says, or `expected`),
    handled, overall_pages (with those of earlier runs), percent, and verdict.

    first_cards: cards of page 1 where it was stored to learn the number of pages. limited: whether the pages were
    limited by hand. verdict: OK or FAILED where every page was handled and the records are known, PARTIAL for a
    complete run of limited pages, else null.
    """
    ok = F.col("error").isNull()
    said = ok & (F.col("total_records") > 0)
    sums = outcomes.agg(
        F.count_if(ok).alias("ok_pages"),
        F.count_if(~ok).alias("failed_pages"),
        (F.coalesce(F.sum(F.when(ok, F.col("n_cards"))), F.lit(0)) + first_cards).cast("long").alias("cards"),
        F.coalesce(F.min_by(F.when(said, F.col("total_records")), F.when(said, F.col("arrival_seq"))), F.lit(expected)).cast("int").alias("expected_records"),
    )
    handled = F.col("ok_pages") + (1 if first_cards > 0 else 0)
    complete = F.col("handled") == target
    return (
        sums.withColumn("handled", handled)
        .withColumn("overall_pages", F.col("handled") + done_before)
        .withColumn("percent", F.round(F.col("overall_pages") * 100.0 / F.lit(target if target else None), 1))
        .withColumn("verdict", verdict_of(complete, limited))
    )


def verdict_of(complete: Column, limited: bool = False) -> Column:
    """Of a run with cards and expected_records."""
    counted = F.when(F.col("cards") == F.col("expected_records"), "OK").otherwise("FAILED")
    return F.when(complete & F.lit(limited), "PARTIAL").when(complete & (F.col("expected_records") > 0), counted)


def progress(outcomes: DataFrame, target: int, elapsed: float) -> DataFrame:
    """One row: done, percent, seconds_per_page and seconds_left (null before the first page)."""
    done = outcomes.agg(F.count_if(F.col("error").isNull()).alias("done"))
    each = F.lit(float(elapsed)) / F.nullif(F.col("done"), F.lit(0).cast("long"))
    return done.select("done", (F.col("done") * 100.0 / target).alias("percent"), each.alias("seconds_per_page"), (each * (F.lit(target) - F.col("done"))).alias("seconds_left"))


class ProgressLog:
    """Log lines of a run: of each page that failed or has no cards, and where the run stands, after every tenth page, after 30
    seconds without such a line, and at the end."""

    EVERY, SECONDS = 10, 30.0

    def __init__(self, target: int, clock: Callable[[], float] = time.monotonic):
        self.target, self.clock, self.pages, self.cards = target, clock, 0, 0
        self.began = self.said = clock()

    def add(self, rows: list[Row]) -> None:
        """rows: outcomes of pages, in their order."""
        before = self.pages
        for r in rows:
            if r["error"] is not None:
                log.warning("page %d failed: %s", r["page"], r["error"])
                continue
            if not r["n_cards"]:
                log.warning("page %d has no cards", r["page"])
            log.debug("page %d: %d cards stored", r["page"], r["n_cards"])
            self.pages, self.cards = self.pages + 1, self.cards + r["n_cards"]
        now = self.clock()
        if self.pages > before and (self.pages // self.EVERY > before // self.EVERY or now - self.said > self.SECONDS or self.pages == self.target):
            each = (now - self.began) / self.pages
            if not self.target:  # a stream's pages are not known
                log.info("%d pages, %d cards, %.1f s a page", self.pages, self.cards, each)
                self.said = now
                return
            log.info("%d of %d pages (%.1f %%), %d cards, %.1f s a page, %.1f min left", self.pages, self.target, 100 * self.pages / max(1, self.target), self.cards, each, each * (self.target - self.pages) / 60)
            self.said = now

    def end(self, summary: Row) -> None:
        log.info("done in %.0f s: %d pages, %d failed, %d cards; %.1f %% of the listing", self.clock() - self.began, summary["ok_pages"], summary["failed_pages"], summary["cards"], summary["percent"] or 0)
        if summary["verdict"]:
            log.log(logging.WARNING if summary["verdict"] == "FAILED" else logging.INFO, "verdict %s: %d cards, the listing says %d", summary["verdict"], summary["cards"], summary["expected_records"])
        if summary["failed_pages"]:
            log.warning("run again to fetch the pages that failed")
