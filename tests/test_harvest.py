from __future__ import annotations

import http.client
import socket
import threading
import time
from datetime import datetime

import pytest

from shelfmark import cli
from shelfmark.plans.harvest import harvest
from shelfmark.sources.folders import shared_root
from shelfmark.sources.listing import Failed, ListingSource, Session, fetch_pages, over_http, pages_of, pages_text, stored_pages, total_pages
from shelfmark.sources.tables import Catalog
from shelfmark.streaming import landing
from tests import fakes


class Clock:
    def __init__(self):
        self.now, self.waits = 0.0, []

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.waits.append(s)
        self.now += s


def session(transport, **more):
    clock = Clock()
    return Session("https://h/list", "tests", least=3, most=3, transport=transport, clock=clock, sleep=clock.sleep, **more), clock


def test_pace_and_retries():
    answers = iter([(500, [], b""), (429, [], b""), (200, [], b"ok")])
    times = []
    s, clock = session(lambda *_: (times.append(clock.now), next(answers))[1])
    assert s.fetch(1)[2:] == ("ok", None, 3)
    assert clock.waits == [5, 15]
    s.transport = lambda *_: (200, [], b"ok")
    assert s.fetch(2)[2:] == ("ok", None, 1) and clock.waits == [5, 15, 3]


def test_gives_up():
    s, clock = session(lambda *_: (503, [], b""))
    assert s.fetch(1)[2:] == (None, "status 503", 5) and clock.waits == [5, 15, 30, 60]
    s, clock = session(lambda *_: (404, [], b""))
    assert s.fetch(403)[2:] == (None, "status 404", 1) and clock.waits == []

    def fails(*_):
        raise OSError("reset")

    assert session(fails)[0].fetch(1)[3:] == ("connection: reset", 5)


def test_broken_answers_are_tried_again(caplog):
    answers = [http.client.IncompleteRead(b"x"), http.client.BadStatusLine("y"), ValueError("z"), None]

    def transport(*_):
        error = answers.pop(0)
        if error:
            raise error
        return 200, [], b"ok"

    s, clock = session(transport)
    with caplog.at_level("INFO", "shelfmark"):
        assert s.fetch(1)[2:] == ("ok", None, 4) and clock.waits == [5, 15, 30]
    assert [r.getMessage().endswith(f"s before attempt {n} of 5") for n, r in enumerate(caplog.records, 2)] == [True] * 3

    def always(*_):
        raise http.client.IncompleteRead(b"")

    assert session(always)[0].fetch(1)[3].startswith("connection: ")
    assert session(always, filter="f")[0].fetch(1)[3].startswith("filter: connection: ")


def test_truncated_body_over_http():
    """A server that promises more than it sends."""
    server = socket.create_server(("127.0.0.1", 0))

    def serve():
        for _ in range(2):
            peer, _ = server.accept()
            peer.recv(4096)
            peer.sendall(b"HTTP/1.1 200 OK\r\nContent-Length: 1000\r\n\r\nshort")
            peer.close()

    thread = threading.Thread(target=serve, daemon=True)
    thread.start()
    url = f"http://127.0.0.1:{server.getsockname()[1]}/"
    with pytest.raises(http.client.IncompleteRead):
        over_http("GET", url, None, {}, 5)
    s, _ = session(over_http)
    with pytest.raises(Failed, match="connection"):
        s.get(url)
    server.close()


def test_session_is_activated_and_renewed():
    seen = []

    def transport(method, url, body, headers, timeout):
        seen.append((method, headers.get("Cookie"), body))
        if method == "POST":
            return 200, [("Set-Cookie", f"ci_session=s{len(seen)}")], b""
        return (403, [], b"") if len(seen) == 4 else (200, [], b"ok")

    s, clock = session(transport, filter="f=1")
    assert s.fetch(1)[2] == "ok"
    clock.now += 71 * 60
    assert s.fetch(2)[2] == "ok"
    assert [(m, c) for m, c, _ in seen] == [("POST", None), ("GET", "ci_session=s1"), ("POST", None), ("GET", "ci_session=s3"), ("POST", None), ("GET", "ci_session=s5")]
    assert seen[0][2] == b"f=1"
    assert session(lambda *_: (500, [], b""), filter="f")[0].fetch(1)[3] == "filter: status 500"
    assert session(lambda *_: (200, [], b""), filter="f")[0].fetch(1)[3] == "filter: no session cookie"


def quick(transport):
    return lambda: Session("https://h/list", "tests", least=0, most=0, transport=transport)


def test_harvest_resumes(spark, tmp_path):
    with Catalog(spark, f"file://{tmp_path}/db") as c:
        first = harvest(spark, c, quick(fakes.broken), "r", batch=2).first()
        assert (first["ok_pages"], first["failed_pages"], first["handled"], first["verdict"]) == (1, 1, 2, None)
        assert sorted(r["page"] for r in c.completed("r").collect()) == [1, 3]
        second = harvest(spark, c, quick(fakes.listing), "r").first()
        assert (second["ok_pages"], second["failed_pages"], second["overall_pages"], second["percent"]) == (1, 0, 3, 100.0)
        assert c.journals.read().count() == 6
        assert harvest(spark, c, quick(fakes.listing), "r").first()["overall_pages"] == 3
        assert harvest(spark, c, quick(fakes.listing), "other", max_pages=2).first()["verdict"] == "PARTIAL"
        assert harvest(spark, c, quick(fakes.listing), "whole").first()["verdict"] == "OK"


def test_data_source(spark):
    spark.dataSource.register(ListingSource)
    reader = spark.read.format("listing").option("base_url", "https://h/list").option("user_agent", "tests").option("least", "0").option("most", "0")
    rows = reader.option("transport", "tests.fakes:listing").option("pages", "1,3,4").load()
    assert rows.rdd.getNumPartitions() == 1
    assert [(r["page"], r["html"] is None, r["error"]) for r in rows.collect()] == [(1, False, None), (3, False, None), (4, True, "status 404")]
    plan = spark.createDataFrame([(2,)], "page int")
    assert fetch_pages(plan, quick(fakes.listing)).first()["url"] == "https://h/list?page=2"


def test_stream_is_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in (1, 2):
        (folder / f"page-{n}.html").write_text(fakes.page(n))
    c = Catalog(spark, f"file://{tmp_path}/db")
    run = lambda t: landing.start(spark, f"file://{folder}", c, "s", f"file://{tmp_path}/cp", t).awaitTermination()
    run(datetime(2024, 1, 1))
    (folder / "page-3.html").write_text(fakes.page(3, ids=(10, 31)))
    (folder / "no-number.html").write_text(fakes.page(9))
    run(datetime(2024, 1, 2))
    got = {r["id"]: (r["source_page"], r["first_seen_at"].day, r["last_scraped_at"].day) for r in c.journals.read().collect()}
    assert got == {10: (3, 1, 2), 11: (1, 1, 1), 20: (2, 1, 1), 21: (2, 1, 1), 31: (3, 2, 2)}
    assert sorted(r["page"] for r in stored_pages(spark, f"file://{folder}").collect()) == [1, 2, 3]


def test_stored_batches_are_left_out(spark, tmp_path):
    c = Catalog(spark, f"file://{tmp_path}/db")
    one, two = datetime(2024, 1, 1), datetime(2024, 1, 2)
    assert c.begin("s", 0, one) == one
    assert c.begin("s", 0, two) == one  # it broke off: the time of the first attempt
    c.end("s", 0, one)
    assert c.begin("s", 0, two) is None and c.begin("other", 0, two) == two and c.begin("s", 1, two) == two


def test_shared_folder(spark, tmp_path):
    class Fake:
        def __init__(self, conf, folder, master):
            self.conf, self.sparkContext = self, self
            self.values, self.folder, self.master = conf, folder, master

        def get(self, name, default):
            return self.values.get(name, default)

        def getCheckpointDir(self):  # noqa: N802
            return self.folder

    assert shared_root(Fake({"spark.checkpoint.dir": "hdfs:/a/"}, "hdfs:/b", "yarn")) == "hdfs:/a"
    assert shared_root(Fake({}, "hdfs:/b", "yarn")) == "hdfs:/b"
    assert shared_root(Fake({}, None, "local[2]")).startswith("file:///")
    with pytest.raises(ValueError, match="checkpoint"):
        shared_root(Fake({}, None, "spark://host:7077"))


def test_command_line(spark, tmp_path):
    args = ["--base-url", "https://h/list", "--user-agent", "tests", "--db", f"file://{tmp_path}/db", "--min-delay", "0", "--max-delay", "0", "--filter", "f=1"]
    assert cli.main(args, transport=fakes.listing) == 0
    assert Catalog(spark, f"file://{tmp_path}/db").journals.read().count() == 6


def logged(path, pages):
    """A transport that notes when each request came, in a file: the stream's reader is another process."""

    def transport(method, url, body, headers, timeout):
        with open(path, "a") as f:
            f.write(f"{method} {url.rpartition('page=')[2] if method == 'GET' else '-'} {time.monotonic()} {headers.get('Cookie', '-')}\n")
        if method == "POST":
            return 303, [("Set-Cookie", "ci_session=s1; path=/")], b""
        n = int(url.rpartition("page=")[2])
        return (200, [], fakes.page(n, pages).encode()) if n <= pages else (404, [], b"")

    return transport


def test_one_session_over_a_run(spark, tmp_path, caplog):
    """25 pages with a filter: one POST, and the pace holds between batches and around what Spark does."""
    path, gap = str(tmp_path / "log"), 0.06

    def session():
        return Session("https://h/list", "tests", filter="f=1", least=gap, most=gap, transport=logged(path, 25))

    with Catalog(spark, f"file://{tmp_path}/db") as c, caplog.at_level("INFO", "shelfmark"):
        summary = harvest(spark, c, session, "r", batch=4).first()
    assert (summary["ok_pages"], summary["failed_pages"], summary["verdict"], summary["overall_pages"]) == (24, 0, "OK", 25)
    lines = [x.split() for x in open(path)]
    assert [x[0] for x in lines].count("POST") == 1 and [x[1] for x in lines[1:]] == [str(n) for n in range(1, 26)]
    times = [float(x[2]) for x in lines]
    assert all(b - a >= gap - 0.02 for a, b in zip(times, times[1:], strict=False)) and {x[3] for x in lines[1:]} == {"ci_session=s1"}
    said = [r.getMessage() for r in caplog.records]
    assert "24 pages to fetch of 25, 0.1 to 0.1 s between requests, about 0.0 min" in said and any(x.startswith("24 of 24 pages") for x in said)
    with caplog.at_level("INFO", "shelfmark"):
        again = harvest(spark, c, session, "r", max_pages=25).first()
    assert again["overall_pages"] == 25 and len(list(open(path))) == 26 and "all 25 pages were completed before" in caplog.text


def test_first_page_that_fails(spark, tmp_path):
    with Catalog(spark, f"file://{tmp_path}/db") as c, pytest.raises(ValueError, match="page 1"):
        harvest(spark, c, quick(lambda *_: (404, [], b"")), "r")


def test_numbers_of_pages():
    for pages, text in (([], ""), ([3], "3"), ([1, 2, 3, 7, 9, 10], "1-3,7,9-10")):
        assert pages_text(pages) == text and pages_of(text) == pages
    assert pages_of(" 5, 1-2,2 ") == [1, 2, 5]
    assert total_pages(fakes.page(1, 1234).replace("1234 |", "1.234 |")) == 1234 and total_pages("<p>") == total_pages(None) == 0


def test_stream_of_given_pages(spark, tmp_path):
    """Pages of an option, two at a time, and those that are done left out; a restart goes on behind what was stored."""
    spark.dataSource.register(ListingSource)
    options = {"base_url": "https://h/list", "user_agent": "tests", "least": "0", "most": "0", "transport": "tests.fakes:listing", "pages": "1-3", "done": "2", "batch": "1"}
    seen = []

    def run():
        query = spark.readStream.format("listing").options(**options).load().writeStream.foreachBatch(lambda df, n: seen.append((n, [r["page"] for r in df.collect()]))).option("checkpointLocation", f"file://{tmp_path}/cp").start()
        query.processAllAvailable()
        query.stop()

    run()
    assert [x for x in seen if x[1]] == [(0, [1]), (1, [3])]
    run()
    assert sum(bool(x[1]) for x in seen) == 2


def test_conditions_on_pages_reach_the_reader(spark, tmp_path):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        path = str(tmp_path / "log")
        rows = page_source(spark, logged(path, 30)).option("pages", "1-30").option("push", "true").load()
        assert [r["page"] for r in rows.filter("page in (4, 7, 40) and url like '%list%'").collect()] == [4, 7]
        assert [r["page"] for r in rows.filter("page >= 28 and page < 30 and error is null").collect()] == [28, 29]
        assert [x.split()[1] for x in open(path)] == ["4", "7", "28", "29"]
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    with open(path, "w"):
        pass
    assert [r["page"] for r in page_source(spark, logged(path, 3)).option("pages", "1-3").load().filter("page = 2").collect()] == [2]
    assert len(list(open(path))) == 3


def page_source(spark, transport):
    class Logged(ListingSource):
        @classmethod
        def name(cls):
            return "logged_listing"

        def session(self):
            return lambda: Session("https://h/list", "tests", least=0, most=0, transport=transport)

    spark.dataSource.register(Logged)
    return spark.read.format("logged_listing")
