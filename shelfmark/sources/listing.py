"""Listing pages over HTTP, politely: one task fetches, so that the pace between requests holds for the whole job.

    spark.dataSource.register(ListingSource)
    spark.read.format("listing").option("base_url", ...).option("user_agent", ...).option("pages", "1-3,5").load()
    spark.readStream.format("listing").option("base_url", ...).option("user_agent", ...).option("batch", 10).load()

With option push, and spark.sql.python.filterPushdown.enabled, conditions on `page` decide what is fetched. As a stream, page numbers are
offsets, and one reader beside the driver has one session for the whole query, over all its batches.

Every request keeps the pace, repeated ones and those for the session too. Only errors that may pass are tried again:
429, 500 and above, 403 (after a new session, where there is a filter), and failures of the connection.
"""

from __future__ import annotations

import http.client
import importlib
import logging
import random
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, SimpleDataSourceStreamReader

from shelfmark.functions.text import PAGINATION
from shelfmark.functions.web import WAITS
from shelfmark.operators.dom import of_class, parse
from shelfmark.schemas import PAGES

log = logging.getLogger("shelfmark")
#: What a connection that breaks off, also within a body, or that makes no sense raises.
BROKEN = (OSError, http.client.HTTPException, ValueError)
#: (method, url, body, headers, timeout) to (status, headers, body); raises one of BROKEN if the connection fails.
Transport = Callable[[str, str, bytes | None, dict[str, str], float], tuple[int, list[tuple[str, str]], bytes]]
COOKIE = "ci_session"


class _Stay(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, req, *_):
        return None if req.get_method() == "POST" else super().redirect_request(req, *_)


def over_http(method: str, url: str, body: bytes | None, headers: dict[str, str], timeout: float) -> tuple[int, list[tuple[str, str]], bytes]:
    request = urllib.request.Request(url, data=body, headers=headers, method=method)
    try:
        with urllib.request.build_opener(_Stay).open(request, timeout=timeout) as r:
            return r.status, r.headers.items(), r.read()
    except urllib.error.HTTPError as e:
        return e.code, list(e.headers.items()), e.read()


class Failed(Exception):
    def __init__(self, message: str, status: int = 0, final: bool = False):
        super().__init__(message)
        self.status, self.final = status, final


def page_url(base: str, extra: str, page: int) -> str:
    """functions.web.build_url() for one URL."""
    parts = urllib.parse.urlsplit(base)
    values: dict[str, list[str]] = {}
    for k, v in urllib.parse.parse_qsl(parts.query, keep_blank_values=True):
        values.setdefault(k, []).append(v)
    values["page"] = [str(page)]
    values |= {k: [v] for k, v in urllib.parse.parse_qsl(extra, keep_blank_values=True)}
    return urllib.parse.urlunsplit(parts._replace(query=urllib.parse.urlencode(sorted(values.items()), doseq=True)))


@dataclass
class Session:
    base_url: str
    user_agent: str
    extra: str = ""
    filter: str = ""
    least: float = 3.0
    most: float = 8.0
    timeout: float = 30.0
    #: A session is renewed after so many seconds.
    age: float = 70 * 60
    transport: Transport = over_http
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    random: random.Random = field(default_factory=random.Random)
    cookie: str = ""
    since: float = 0.0
    _free: float = float("-inf")

    def _ask(self, method: str, url: str, body: bytes | None = None) -> tuple[int, list[tuple[str, str]], bytes]:
        wait = self._free - self.clock()
        if wait > 0:
            self.sleep(wait)
        self._free = self.clock() + self.random.uniform(self.least, max(self.least, self.most))
        headers = {"User-Agent": self.user_agent, "Accept": "text/html"}
        if body is not None:
            headers["Content-Type"] = "application/x-www-form-urlencoded"
        elif self.cookie:
            headers["Cookie"] = self.cookie
        return self.transport(method, url, body, headers, self.timeout)

    def activate(self) -> None:
        """Posts the filter and keeps the session's cookie."""
        try:
            status, headers, _ = self._ask("POST", self.base_url, self.filter.encode())
        except BROKEN as e:
            raise Failed(f"filter: connection: {e}") from e
        if status not in (200, 303):
            raise Failed(f"filter: status {status}", status)
        for name, value in headers:
            own = value.split(";")[0].strip()
            if name.lower() == "set-cookie" and own.startswith(f"{COOKIE}="):
                self.cookie, self.since = own, self.clock()
                return
        raise Failed("filter: no session cookie")

    def get(self, url: str) -> str:
        try:
            status, _, body = self._ask("GET", url)
        except BROKEN as e:
            raise Failed(f"connection: {e}") from e
        if status == 200:
            return body.decode("utf-8", "replace")
        raise Failed(f"status {status}", status, final=not (status in (403, 429) or status >= 500))

    def fetch(self, page: int) -> tuple[int, str, str | None, str | None, int]:
        """A row of PAGES."""
        url, attempts = page_url(self.base_url, self.extra, page), 0
        try:
            if self.filter and (not self.cookie or self.clock() - self.since >= self.age):
                self.activate()
            while True:
                attempts += 1
                try:
                    return page, url, self.get(url), None, attempts
                except Failed as e:
                    if e.final or attempts > len(WAITS):
                        raise
                    if e.status == 403 and self.filter:
                        try:
                            self.activate()
                        except Failed as new:  # the page is tried again as it is
                            log.warning("page %d: no new session: %s", page, new)
                    log.info("page %d: %s; %d s before attempt %d of %d", page, e, WAITS[attempts - 1], attempts + 1, len(WAITS) + 1)
                    self.sleep(WAITS[attempts - 1])
        except Failed as e:
            return page, url, None, str(e), attempts


def pages_of(text: str) -> list[int]:
    """Numbers of a text like 1-3,7, ascending."""
    found = set()
    for part in filter(None, (x.strip() for x in text.split(","))):
        low, _, high = part.partition("-")
        found |= set(range(int(low), int(high or low) + 1))
    return sorted(found)


def pages_text(pages: list[int]) -> str:
    """The shortest text that pages_of() reads so."""
    out: list[list[int]] = []
    for n in sorted(set(pages)):
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return ",".join(f"{a}" if a == b else f"{a}-{b}" for a, b in out)


class _All(InputPartition):
    pass


#: Conditions on a page number that decide what is fetched.
TESTS: dict[type, Callable[[int, object], bool]] = {
    EqualTo: lambda n, v: n == v, In: lambda n, v: n in v, GreaterThan: lambda n, v: n > v, GreaterThanOrEqual: lambda n, v: n >= v, LessThan: lambda n, v: n < v, LessThanOrEqual: lambda n, v: n <= v,
}


class _Reader(DataSourceReader):
    def __init__(self, session: Callable[[], Session], pages: list[int]):
        self.session, self.pages = session, pages

    def partitions(self) -> list[InputPartition]:
        return [_All(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        own = self.session()
        for page in self.pages:
            yield own.fetch(page)


class _Choosing(_Reader):
    """A reader that conditions reach. Spark refuses one where its setting is off."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            value = getattr(f, "value", None)
            plain = isinstance(value, int) or (isinstance(value, (tuple, list)) and all(isinstance(v, int) for v in value))
            if type(f) in TESTS and f.attribute == ("page",) and plain:
                self.pages = [n for n in self.pages if TESTS[type(f)](n, value)]
            else:
                yield f


class _Stream(SimpleDataSourceStreamReader):
    """Offsets: the next page, and the last one (0 while it is not known). Pages of `done` are passed over, but for page 1 where it
    must say how many pages there are."""

    def __init__(self, session: Callable[[], Session], pages: list[int] | None, done: list[int], batch: int):
        self.session, self.pages, self.batch, self.own = session, pages, batch, None
        self.wanted, self.done = pages and frozenset(pages), frozenset(done)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"next": 1, "last": self.pages[-1] if self.pages else 0}

    def _fetched(self, page: int) -> tuple:
        if self.own is None:
            self.own = self.session()
        return self.own.fetch(page)

    def _is_due(self, page: int, last: int) -> bool:
        return page not in self.done and (self.wanted is None or page in self.wanted) or (page == 1 and not last)

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        page, last, rows = start["next"], start["last"], []
        while len(rows) < self.batch and (page <= last or not last):
            if self._is_due(page, last):
                rows.append(self._fetched(page))
                if not last:
                    last = max(1, total_pages(rows[-1][2]))
            page += 1
        return iter(rows), {"next": page, "last": last}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        """Pages of a batch that broke off are fetched again."""
        return iter([self._fetched(n) for n in range(start["next"], end["next"]) if self._is_due(n, start["last"])])


def total_pages(html: str | None) -> int:
    """How many pages a page says there are; 0 if it doesn't."""
    note = parse(html).first(of_class("pagination-text")) if html else None
    found = note and re.search(PAGINATION, " ".join(note.text().split()))
    digits = found[2].replace(".", "") if found else ""
    return int(digits) if digits.isdigit() else 0


class ListingSource(DataSource):
    """Options: base_url and user_agent (with a contact) must be given; extra (query string), filter (form data), pages (like 1-3,7;
    1, or for streams all that the listing has), push (true: conditions on page decide), least and most (seconds between requests), timeout, age, transport
    (module:name, in place of HTTP); for streams, done (pages to pass over) and batch (pages at a time, 10)."""

    @classmethod
    def name(cls) -> str:
        return "listing"

    def schema(self) -> str:
        return PAGES

    def session(self) -> Callable[[], Session]:
        """What makes the session that pages are fetched in."""
        o = {k.lower(): v for k, v in self.options.items()}
        for needed in ("base_url", "user_agent"):
            if not o.get(needed):
                raise ValueError(f"option {needed} is needed")

        def made() -> Session:
            transport = over_http
            if "transport" in o:
                module, _, name = o["transport"].partition(":")
                transport = getattr(importlib.import_module(module), name)
            numbers = {k: float(o[k]) for k in ("least", "most", "timeout", "age") if k in o}
            return Session(o["base_url"], o["user_agent"], o.get("extra", ""), o.get("filter", ""), transport=transport, **numbers)

        return made

    def reader(self, schema) -> DataSourceReader:
        kind = _Choosing if str(self.options.get("push", "")).lower() == "true" else _Reader
        return kind(self.session(), pages_of(self.options.get("pages", "1")))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802
        pages = pages_of(self.options["pages"]) if self.options.get("pages") else None
        return _Stream(self.session(), pages, pages_of(self.options.get("done", "")), int(self.options.get("batch", 10)))


def page_stream(spark: SparkSession, session: Callable[[], Session], last: int = 0, done: list[int] | None = None, batch: int = 10) -> DataFrame:
    """PAGES as a stream, `batch` pages at a time, fetched by one session. last: 0 to learn it from page 1."""

    class Run(ListingSource):
        @classmethod
        def name(cls) -> str:
            return "listing_run"

        def session(self) -> Callable[[], Session]:
            return session

    spark.dataSource.register(Run)
    options = {"batch": str(batch), "done": pages_text(done or []), "pages": f"1-{last}" if last > 0 else ""}
    return spark.readStream.format("listing_run").options(**options).load()


def fetch_pages(plan: DataFrame, session: Callable[[], Session]) -> DataFrame:
    """PAGES rows of a plan (page), fetched in its order by one task; for plans too long for an option."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        own = session()
        for b in batches:
            for page in b["page"]:
                yield pd.DataFrame([own.fetch(int(page))], columns=[x.split()[0] for x in PAGES.split(", ")])

    return plan.coalesce(1).mapInPandas(run, PAGES)


def stored_pages(spark, path: str, pattern: str = r"(\d+)[^/]*$") -> DataFrame:
    """page, url and html of a folder of files, a page each, whose number stands in the file's path where `pattern` says."""
    from pyspark.sql import functions as F

    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
    return files.select(F.regexp_extract("url", pattern, 1).try_cast("int").alias("page"), "url", "html").filter("page is not null")


#: Pages in a file of many, at most: some 15 KB of html each, which pack well.
PAGES_PER_FILE = 500
PACKED = "page int, html string"


def write_pages(pages, path: str) -> None:
    """Stores pages (page, html) as Parquet files of many pages each, for packed_pages() and streams of landed pages: with a file for
    each page, the count of files is what a large listing's time goes to."""
    pages.selectExpr("CAST(page AS INT) AS page", "html").write.option("maxRecordsPerFile", PAGES_PER_FILE).parquet(path)


def packed_pages(spark, path: str) -> DataFrame:
    """page, url (of the file) and html of what write_pages() has stored."""
    from pyspark.sql import functions as F

    return spark.read.schema(PACKED).parquet(path).select("page", F.col("_metadata.file_path").alias("url"), "html").filter("page is not null")
