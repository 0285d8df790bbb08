"""Streams: progress lines, runs' counts as state, and jobs of a stored batch."""

from __future__ import annotations

import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfmark.plans import report
from shelfmark.plans.harvest import store_pages
from shelfmark.sources.tables import Catalog
from shelfmark.streaming import landing, summary
from shelfmark.streaming.log import StreamLog
from tests import fakes


def test_progress_lines_of_a_stream(spark, tmp_path, caplog):
    """Three batches of four pages: lines after every tenth page and at the end, warnings of pages without cards."""
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(1, 13):
        (folder / f"page-{n}.html").write_text(fakes.page(n, 12) if n != 7 else "<p>none</p>")
    said = StreamLog(target=12)
    with Catalog(spark, f"file://{tmp_path}/db") as c, caplog.at_level("INFO", "shelfmark"):
        query = landing.start(spark, f"file://{folder}", c, "s", f"file://{tmp_path}/cp", files_per_batch=4, listener=said)
        query.awaitTermination()
        assert said.ended.wait(30)
        lines = [r.getMessage() for r in caplog.records]
        assert c.journals.read().count() == 22 and c.completed("s").count() == 12
    assert "page 7 has no cards" in lines and sum(x.startswith("12 of 12 pages (100.0 %), 22 cards") for x in lines) == 1
    assert lines[-1].startswith("stream ended after") and lines[-1].endswith(": 12 pages, 0 failed, 22 cards")


def test_a_stream_that_fails_says_so(spark, tmp_path, caplog, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.html").write_text(fakes.page(1))
    monkeypatch.setattr(landing, "store_pages", lambda *_: 1 / 0)
    said = StreamLog()
    with Catalog(spark, f"file://{tmp_path}/db") as c, caplog.at_level("INFO", "shelfmark"):
        query = landing.start(spark, f"file://{tmp_path}/in", c, "s", f"file://{tmp_path}/cp", listener=said)
        with pytest.raises(Exception, match="division"):
            query.awaitTermination()
        assert said.ended.wait(30)
    assert any(r.getMessage().startswith("stream failed") for r in caplog.records)


def test_unknown_number_of_pages(caplog):
    progress = report.ProgressLog(0, lambda: 5.0)
    with caplog.at_level("INFO", "shelfmark"):
        progress.add([{"page": n, "n_cards": 2, "error": None} for n in range(10)])
    assert [r.getMessage() for r in caplog.records] == ["10 pages, 20 cards, 0.0 s a page"]


@pytest.fixture
def state_store(spark):
    before = {k: spark.conf.get(k, None) for k in summary.STORE}
    for k, v in summary.STORE.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_running_counts_equal_the_summary(spark, tmp_path, state_store):
    """After every batch, of which two are in one query and the third after a restart."""
    source, got = f"file://{tmp_path}/in", {}
    batches = [
        [("a", 2, 5, 10, 30, None), ("a", 3, 6, 10, 31, None), ("b", 1, 1, 0, 0, "status 500")],
        [("a", 1, 2, 10, 29, None), ("a", 4, 7, 0, 0, "status 404"), ("b", 1, 9, 4, 0, None)],
        [("a", 4, 8, 9, 99, None), ("c", 1, 1, 1, 1, None)],
    ]
    schema = f"run_key string, {report.OUTCOMES}"
    targets = spark.createDataFrame([("a", 4), ("b", 2), ("c", 1)], "run_key string, target int")

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        store = lambda df, n: got.update({n: [r.asDict() for r in summary.summaries(df, targets).collect()]})
        summary.running_counts(stream).writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()

    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        if n:
            run()
    now: dict = {}
    for n, rows in enumerate(batches):
        for r in got[n]:
            now[r["run_key"]] = r
        for key, target in (("a", 4), ("b", 2), ("c", 1)):
            so_far = spark.createDataFrame([x for b in batches[: n + 1] for x in b if x[0] == key], schema)
            if not so_far.isEmpty():
                want = report.run_summary(so_far, target).first().asDict()
                assert {k: now[key][k] for k in now[key] if k != "run_key"} == {k: want[k] for k in now[key] if k != "run_key"}, (n, key)
    assert now["a"]["verdict"] == "FAILED" and now["c"]["verdict"] == "OK" and len(got) == 3


def test_a_batch_takes_one_job_for_each_table(spark, tmp_path):
    """The outcomes are counted on the way to the second table."""
    c = Catalog(spark, f"file://{tmp_path}/db")
    rows = [(n, "u", fakes.page(n, 9) if n != 3 else "<p>", None, 1) for n in range(1, 6)] + [(6, "u", None, "status 500", 5)]
    pages = spark.createDataFrame(rows, "page int, url string, html string, error string, attempts int")
    ids = lambda: set(spark.sparkContext.statusTracker().getJobIdsForGroup("stored"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans have a job for each of their stages
    try:
        spark.sparkContext.setJobGroup("stored", "a batch")
        got = store_pages(c, "r", pages, datetime(2024, 1, 1))
        jobs = ids()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 2, jobs
    assert [(r["page"], r["n_cards"], r["error"], r["warning"]) for r in got] == [(1, 2, None, None), (2, 2, None, None), (3, 0, None, "no cards"), (4, 2, None, None), (5, 2, None, None), (6, 0, "status 500", None)]
    assert sorted(r["page"] for r in c.completed("r").collect()) == [1, 2, 3, 4, 5] and c.journals.read().count() == 8
    assert [r["page"] for r in store_pages(c, "empty", pages.limit(0), datetime(2024, 1, 1))] == []
    store_pages(c, "again", pages, datetime(2024, 1, 1), refetch_empty=True)
    assert sorted(r["page"] for r in c.completed("again").collect()) == [1, 2, 4, 5]
    assert threading.active_count() < 100 and c.progress.read().filter(F.col("run_key") == "r").count() == 5
