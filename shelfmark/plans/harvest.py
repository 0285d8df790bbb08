"""A whole run: learn the pages, fetch those that are missing, store them batch by batch, and report."""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.cards import page_results, raw_pages, records
from shelfmark.plans.report import OUTCOMES, ProgressLog, run_summary
from shelfmark.plans.resume import target_pages
from shelfmark.schemas import PAGES, names
from shelfmark.sources.folders import shared_root
from shelfmark.sources.listing import Session, page_stream
from shelfmark.sources.tables import Catalog

log = logging.getLogger("shelfmark")


def now() -> datetime:
    return datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None)


#: OUTCOMES of stored pages, with what is worth knowing besides.
STORED = f"{OUTCOMES}, rejected_cards int, warning string"


def store_pages(catalog: Catalog, run_key: str, pages: DataFrame, time: datetime, refetch_empty: bool = False) -> list[Row]:
    """Merges the records of fetched pages, marks the pages as completed, and returns their outcomes (STORED), a row per page of
    the batch, whose number the caller sets. One job for either table; the second one's write counts the outcomes.

    Records are stored before pages are marked: after a crash between the two, the same pages are stored again,
    which changes nothing but times. Pages without cards are marked too, unless refetch_empty.
    """
    good = pages.filter("error is null") if "error" in pages.columns else pages
    raw = raw_pages(good).persist()
    try:
        catalog.store(records(raw), time)
        results = page_results(raw)
        rows = results.select("page", F.col("page").cast("long").alias("arrival_seq"), "n_cards", "total_records", F.lit(None).cast("string").alias("error"), "rejected_cards", "warning")
        if "error" in pages.columns:
            failed = pages.filter("error is not null").select("page", F.col("page").cast("long").alias("arrival_seq"), F.lit(0).alias("n_cards"), F.lit(0).alias("total_records"), "error")
            rows = rows.unionByName(failed, allowMissingColumns=True)
        seen = Observation()
        observed = rows.observe(seen, F.collect_list(F.struct(*names(STORED))).alias("outcomes"))
        catalog.complete(run_key, observed.filter("error is null" + (" and warning is null" if refetch_empty else "")), time)
        found = {r["page"]: r for r in seen.get["outcomes"] or ()}  # a task that ran twice has told twice
        return [found[n] for n in sorted(found)]
    finally:
        raw.unpersist()


class _Run:
    """What a run's batches leave on the driver: a few numbers for each page that one polite task fetched."""

    def __init__(self, spark: SparkSession, catalog: Catalog, run_key: str, last: int, done: list[int], delay: tuple[float, float], refetch_empty: bool, scratch: str):
        self.spark, self.catalog, self.run_key, self.target, self.done = spark, catalog, run_key, last, frozenset(done)
        self.delay, self.refetch_empty, self.scratch = delay, refetch_empty, scratch
        self.learns, self.expected, self.first_cards, self.outcomes, self.seen = last <= 0, 0, 0, [], set()
        self.progress, self.finished, self.error = None, threading.Event(), None
        if not self.learns:
            self.begin()

    def begin(self) -> None:
        """The number of pages is known."""
        self.due = {n for n in range(1, self.target + 1) if n not in self.done and not (self.learns and n == 1)}
        least, most = self.delay
        log.info("%d pages to fetch of %d, %.1f to %.1f s between requests, about %.1f min", len(self.due), self.target, least, most, len(self.due) * (least + most) / 120)
        self.progress = ProgressLog(len(self.due))
        self.check()

    def check(self) -> None:
        if self.due <= self.seen:
            self.finished.set()

    def store(self, batch: DataFrame, number: int) -> None:
        """A batch of the stream: pages are stored as they came before anything is made of them."""
        try:
            path = f"{self.scratch}/fetched-{number}"
            batch.write.mode("overwrite").parquet(path)
            pages = self.spark.read.schema(PAGES).parquet(path).repartition("page")
            if self.progress is None:
                self.target, self.expected = target_pages(page_results(raw_pages(pages.filter("page = 1 and error is null"))))
                self.begin()
                if 1 in self.done:
                    pages = pages.filter("page <> 1")
            rows = store_pages(self.catalog, self.run_key, pages, now(), self.refetch_empty)
            if self.learns:
                self.first_cards += sum(r["n_cards"] for r in rows if r["page"] == 1)
                rows = [r for r in rows if r["page"] != 1]
            self.progress.add(rows)
            self.outcomes += [tuple(r[c] for c in names(OUTCOMES)) for r in rows]
            self.seen |= {r["page"] for r in rows}
            self.check()
        except Exception as e:
            self.error = e
            raise


def harvest(spark: SparkSession, catalog: Catalog, session: Callable[[], Session], run_key: str = "default", max_pages: int = 0, batch: int = 10, refetch_empty: bool = False) -> DataFrame:
    """Runs to the end of the listing (or max_pages, if over 0), and returns run_summary().

    Pages that the run has completed are not fetched again; failed ones are left for the next run. Pages come as a stream from
    one session, which keeps its cookie and its pace for the whole run; `batch` pages are stored at a time. A page that
    was fetched to learn the number of pages is stored like any other.
    """
    done = sorted(r["page"] for r in catalog.completed(run_key).collect())
    own, scratch = session(), f"{shared_root(spark)}/harvest-{uuid.uuid4().hex}"
    run = _Run(spark, catalog, run_key, max(0, max_pages), done, (own.least, max(own.least, own.most)), refetch_empty, scratch)
    if not run.finished.is_set():
        pages = page_stream(spark, session, max(0, max_pages), done, batch)
        query = pages.writeStream.foreachBatch(run.store).option("checkpointLocation", f"{scratch}/checkpoint").start()
        try:
            while not run.finished.wait(0.1):
                if not query.isActive:
                    query.awaitTermination()  # raises what ended it
                    break
            query.processAllAvailable()
        except Exception as e:
            raise run.error or e from None
        finally:
            query.stop()
            path = spark._jvm.org.apache.hadoop.fs.Path(scratch)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if not run.outcomes:
        log.info("all %d pages were completed before", run.target)
    summary = run_summary(spark.createDataFrame(run.outcomes, OUTCOMES), run.target, max_pages > 0, run.first_cards, len(done), run.expected)
    run.progress.end(summary.first())
    return summary
