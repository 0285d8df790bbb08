"""What large tables would cost: files, batches and tasks by the bytes of the input, memory that doesn't go with it."""

from __future__ import annotations

import duckdb
import pyarrow as pa
import pytest

from shelfmark.operators import cards
from shelfmark.plans import catalogue
from shelfmark.sources.listing import packed_pages, write_pages
from shelfmark.sources.tables import Catalog, Table
from shelfmark.streaming import landing
from tests import fakes

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def scratch(tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "_scratch", lambda spark: f"file://{tmp_path}/s")
    return tmp_path / "s"


def test_landed_pages_share_files(spark, scratch):
    """16 pages of the smallest table land in a file for each task."""
    assert catalogue.stream_upsert(spark, DATA).count() == 149
    assert 0 < len(list((scratch / "landing").rglob("*.parquet"))) <= 4 and not list((scratch / "landing").glob("page=*"))


def test_packed_files_run_in_batches_of_bytes(spark, tmp_path):
    """1,200 pages in files of at most 500 take one batch, or one for each file where bytes say so, with equal tables."""
    pages = spark.createDataFrame([(n, fakes.page(n, 1200)) for n in range(1, 1201)], "page int, html string").coalesce(1)
    write_pages(pages, f"file://{tmp_path}/in")
    assert packed_pages(spark, f"file://{tmp_path}/in").exceptAll(packed_pages(spark, f"file://{tmp_path}/in").limit(0)).count() == 1200
    files = len(list((tmp_path / "in").glob("*.parquet")))
    assert files == 3
    for name, most in (("one", landing.BYTES_PER_BATCH), ("each", 1)):
        c = Catalog(spark, f"file://{tmp_path}/{name}")
        stream = landing.packed_stream(spark, f"file://{tmp_path}/in", most)
        seen: list[int] = []
        stream.writeStream.foreachBatch(lambda df, n, seen=seen: seen.append(df.count())).option("checkpointLocation", f"file://{tmp_path}/cp-{name}").trigger(availableNow=True).start().awaitTermination()
        assert sum(seen) == 1200 and len(seen) == (1 if name == "one" else 3)
        landing.start(spark, f"file://{tmp_path}/in", c, "r", f"file://{tmp_path}/cp2-{name}", packed=True).awaitTermination()
        assert c.journals.read().count() == 2400 and c.completed("r").count() == 1200


def test_rewriting_is_in_proportion(spark, tmp_path):
    """a table is written anew when it has doubled, not after every so many batches."""
    t = Table(spark, f"file://{tmp_path}/t", "k long, note string", ["k"], compact=2)
    for n in range(12):
        t.write(spark.range(2000 * n, 2000 * (n + 1), numPartitions=1).selectExpr("id AS k", "sha2(string(id), 256) AS note"))
    assert t.version() - 12 <= 3 and t.read().count() == 24_000


def test_headings_equal_sql_where_references_are_cut(spark, tmp_path):
    """references without their semicolon, quotes and named letters stay as they are written."""
    heads = ["a&amp;&amp", "token = &quot;x&quot;", " b &lt;i&gt; &amp;lt; ", "&eacute;&#65;", "plain", ""]
    rows = [(n, "u", f"<p>x</p><h1>{h}</h1><h1>second</h1>") for n, h in enumerate(heads)] + [(90, "u", "<p>none</p>"), (91, "u", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"file://{tmp_path}/pages.parquet")
    want = duckdb.sql(catalogue.ORACLE_SQL["page_heading"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")).fetchall()
    assert sorted(map(tuple, catalogue.page_heading(spark, f"file://{tmp_path}").collect())) == sorted(want) and len(want) == 6


def test_stored_pages_share_files(spark, scratch):
    """a file for each task, not for each page."""
    assert catalogue.stored_listing(spark, DATA).count() == 149
    assert 0 < len(list((scratch / "pages").rglob("*.parquet"))) <= 4 and not list((scratch / "pages").glob("page=*"))


def test_small_pages_are_parsed_once_by_many_tasks(spark, scratch, monkeypatch):
    """the table of customers is one small file; its pages are dealt, and results are read from where they were stored."""
    dealt = []

    def raw_pages(pages, own=cards.raw_pages):
        dealt.append(pages.rdd.getNumPartitions())
        return own(pages)

    monkeypatch.setattr(cards, "raw_pages", raw_pages)
    found = catalogue.empty_pages(spark, DATA)
    assert dealt == [int(spark.conf.get("spark.sql.shuffle.partitions"))] and found.count() == 150
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()


def test_parts_are_sent_on_page_by_page(spark, monkeypatch):
    """of a batch of 400 pages, a few trees are built before the first parts leave; all pages come out in order."""

    class Frame:
        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):  # noqa: N802
            return run

    built = []
    monkeypatch.setattr(cards, "parse", lambda page, own=cards.parse: built.append(1) or own(page))
    monkeypatch.setattr(cards, "MANY", 20_000)
    html = [None, "", *(fakes.page(n, 400) for n in range(398))]
    out = cards.raw_pages(Frame())(iter([pa.record_batch([pa.array(range(400), pa.int32()), pa.array(html)], names=["page", "html"])]))
    first = next(out)
    assert len(built) == first.num_rows < 50
    rows = [r for b in (first, *out) for r in b.to_pylist()]
    assert [r["page"] for r in rows] == list(range(400)) and [len(r["cards"]) for r in rows] == [0, 0] + [2] * 398
