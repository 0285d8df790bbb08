"""Pages that land as files, as a stream: each micro-batch is merged and marked like a batch of fetched pages."""

from __future__ import annotations

import threading
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shelfmark.plans.harvest import now, store_pages
from shelfmark.sources.listing import PACKED
from shelfmark.sources.tables import Catalog
from shelfmark.streaming.log import StreamLog

#: The first digits of a file's name.
NUMBERED = r"(\d+)[^/]*$"
#: Bytes of files of many pages in a batch, about: some thousand pages of such a file's size, packed.
BYTES_PER_BATCH = 32 << 20


def landed_pages(spark: SparkSession, folder: str, files_per_batch: int = 100, pattern: str = NUMBERED) -> DataFrame:
    """Stream of page, url and html: a page per file, its number in the file's path where `pattern` says."""
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", files_per_batch).load(folder)
    found = files.select(F.regexp_extract("_metadata.file_path", pattern, 1).try_cast("int").alias("page"), F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
    return found.filter("page is not null")


def packed_stream(spark: SparkSession, folder: str, bytes_per_batch: int = BYTES_PER_BATCH) -> DataFrame:
    """Stream of page, url and html from files of many pages (write_pages()): batches are bounded in bytes, so that their count, and
    what a batch costs besides its pages, doesn't go with the count of pages."""
    files = spark.readStream.schema(PACKED).option("maxBytesPerTrigger", bytes_per_batch).parquet(folder)
    return files.select("page", F.col("_metadata.file_path").alias("url"), "html").filter("page is not null")


def start(spark: SparkSession, folder: str, catalog: Catalog, run_key: str, checkpoint: str, time: datetime | None = None, pattern: str = NUMBERED, files_per_batch: int = 100, listener: StreamLog | None = None, packed: bool = False) -> StreamingQuery:
    """Merges all files that are there and ends. Progress is logged batch by batch. A batch that is run again, after a crash, has the time of its first attempt and
    so the same result; one that was stored already is left out.

    time: in place of the present, for every batch. packed: files hold many pages each (packed_stream()).
    """

    def store(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        began = catalog.begin(checkpoint, number, time or now())
        if began is not None:
            said.add(number, store_pages(catalog, run_key, batch, began))
            catalog.end(checkpoint, number, began)

    said = listener or StreamLog()
    spark.streams.addListener(said)
    pages = packed_stream(spark, folder) if packed else landed_pages(spark, folder, files_per_batch, pattern)
    query = pages.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    said.query = str(query.id)
    threading.Thread(target=_done, args=(spark, query, said), daemon=True).start()
    return query


def _done(spark: SparkSession, query: StreamingQuery, said: StreamLog) -> None:
    """Takes a query's listener away once it has said the last."""
    try:
        query.awaitTermination()
    except Exception:  # the caller gets it from the query
        pass
    said.ended.wait(30)
    spark.streams.removeListener(said)
