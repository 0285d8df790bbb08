"""Tables of keyed rows that batches are merged into.

A batch is one new folder of Parquet files, however large the table is; reading takes the last row of each key. After COMPACT
batches or more that hold as many bytes as the table did, it is written anew as one folder, so that all rewriting together is in
proportion to what came; folders before the one before it are removed. A folder
counts once Spark has put its success mark there, so that a write that breaks off leaves the table as it was, and
nothing overwrites files that are being read. The next write takes a number above what is left of it, and removes that once
it is done itself. Folders may lie in any store that Spark reads. One writer at a time: of two, one fails, as its folder
already exists. A table may be dealt to partitions by columns of its key, of which a filter then reads those it names.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.merge import last_of_each, stamped
from shelfmark.schemas import BATCHES, JOURNALS, PROGRESS, names

#: Batches after which a table is written anew, at the earliest.
COMPACT = 16
#: A table's folders: their number and kind.
FOLDER = re.compile(r"/folder=(\d+)-(base|batch)(?:/_SUCCESS)?$")


class Table:
    """keys: columns of a row's key. kept: columns whose first value stays when a key comes again. by: text columns of the key that
    the files are dealt by."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], kept: tuple[str, ...] = (), compact: int = COMPACT, by: tuple[str, ...] = ()):
        self.spark, self.path, self.schema, self.keys, self.kept, self.compact, self.by = spark, path.rstrip("/"), schema, keys, kept, compact, by

    def _store(self, path: str):
        """A path, and the store that it is in."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, pattern: str) -> list[tuple[int, str]]:
        path, store = self._store(pattern)
        found = (FOLDER.search(x.getPath().toString()) for x in store.globStatus(path) or ())
        return sorted((int(m[1]), m[2]) for m in found if m)

    def _folders(self) -> list[tuple[int, str]]:
        """(number, kind: base or batch) of every finished folder, in order."""
        return self._listed(f"{self.path}/*/_SUCCESS")

    def _name(self, number: int, kind: str) -> str:
        return f"{self.path}/folder={number:08d}-{kind}"

    def _bytes(self, folder: tuple[int, str]) -> int:
        path, store = self._store(self._name(*folder))
        return store.getContentSummary(path).getLength()

    def version(self) -> int:
        """Number of the latest finished folder; 0 if there is none."""
        return max((n for n, _ in self._folders()), default=0)

    def next_number(self) -> int:
        """A number above those of all folders, also of such as a write left behind that broke off."""
        return max((n for n, _ in self._listed(f"{self.path}/*")), default=0) + 1

    def sweep(self) -> None:
        """Removes folders that were not finished, below the last one that was."""
        finished = self._folders()
        for old in self._listed(f"{self.path}/*"):
            if finished and old[0] < finished[-1][0] and old not in finished:
                path, store = self._store(self._name(*old))
                store.delete(path, True)

    def read(self) -> DataFrame:
        folders = self._folders()
        base = max((n for n, kind in folders if kind == "base"), default=0)
        live = [(n, kind) for n, kind in folders if n >= base]
        if not live:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(f"{self.schema}, folder string").option("basePath", self.path).parquet(*(self._name(*x) for x in live))
        rows = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in self.by})  # empty text makes no folder's name
        columns = names(self.schema)
        if len(live) == 1:
            return rows.select(*columns)
        others = [c for c in columns if c not in self.keys]
        first = [F.min_by(c, "folder").alias(c) for c in self.kept]
        last = F.max_by(F.struct(*(c for c in others if c not in self.kept)), "folder").alias("_last")
        merged = rows.select(*columns, "folder").groupBy(*self.keys).agg(last, *first)
        return merged.select(*(F.col(c) if c in self.keys or c in self.kept else F.col(f"_last.{c}") for c in columns))

    def _append(self, rows: DataFrame, kind: str) -> None:
        writer = rows.select(*names(self.schema)).write
        (writer.partitionBy(*self.by) if self.by else writer).parquet(self._name(self.next_number(), kind))

    def write(self, rows: DataFrame) -> None:
        """Merges a batch, of one row for each key: keys that are there get its values, but for `kept`."""
        self._append(rows, "batch")
        self.tidy()

    def tidy(self) -> None:
        """Writes the table anew once COMPACT batches and as many bytes as it held have come, and removes what no reader needs."""
        folders = self._folders()
        bases = [n for n, kind in folders if kind == "base"]
        fresh = folders[folders.index((bases[-1], "base")) + 1 :] if bases else folders
        if len(fresh) >= self.compact and (not bases or sum(map(self._bytes, fresh)) >= self._bytes((bases[-1], "base"))):
            self._append(self.read(), "base")
            for old in [x for x in folders if bases and x[0] < bases[-1]]:  # readers of the base before this one may go on
                path, store = self._store(self._name(*old))
                store.delete(path, True)
        self.sweep()


class Catalog:
    """The journal table, the progress table, and the table of stream batches below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        path = path.rstrip("/")
        self.journals = Table(spark, f"{path}/journals", JOURNALS, ["id"], ("first_seen_at",))
        self.progress = Table(spark, f"{path}/progress", PROGRESS, ["run_key", "page"], by=("run_key",))
        self.batches = Table(spark, f"{path}/batches", BATCHES, ["stream", "batch"], ("started_at",))

    def __enter__(self) -> Catalog:
        return self

    def __exit__(self, *_) -> None:
        pass

    def completed(self, run_key: str) -> DataFrame:
        """Different pages that a run has completed."""
        return self.progress.read().filter(F.col("run_key") == run_key).select("page").distinct()

    def store(self, records: DataFrame, time) -> None:
        """Merges records (one batch) into the journal table; all of them or none. Of records of one id the last card of the
        last page counts. The table itself isn't read."""
        batch = stamped(records.filter("id is not null and id <> 0"), time)
        order = [c for c in ("arrival_seq", "source_page", "card_pos") if c in batch.columns]
        self.journals.write(last_of_each(batch, ["id"], order))

    def complete(self, run_key: str, pages: DataFrame, time) -> None:
        """Marks pages as completed, or their time anew."""
        rows = pages.select(F.lit(run_key).alias("run_key"), F.col("page").cast("int").alias("page"), F.lit(time).cast("timestamp").alias("completed_at"))
        self.progress.write(last_of_each(rows, ["run_key", "page"], ["completed_at"]))

    def begin(self, stream: str, batch: int, time):
        """The time of a stream's batch: of its first attempt. None if the batch was stored already."""
        row = self.batches.read().filter((F.col("stream") == stream) & (F.col("batch") == batch)).first()
        if row is None:
            self._mark(stream, batch, time, False)
            return time
        return None if row["stored"] else row["started_at"]

    def end(self, stream: str, batch: int, time) -> None:
        self._mark(stream, batch, time, True)

    def _mark(self, stream: str, batch: int, time, stored: bool) -> None:
        spark = self.batches.spark
        self.batches.write(spark.range(1).select(F.lit(stream).alias("stream"), F.lit(batch).cast("long").alias("batch"), F.lit(time).cast("timestamp").alias("started_at"), F.lit(stored).alias("stored")))
