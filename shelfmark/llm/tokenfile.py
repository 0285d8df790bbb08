"""Token ids in ORC files: integer run-length encoding, row indexes, and a Bloom filter on the document id.

Files are in ascending order of doc_id, one per partition of a range shuffle, and each row holds its position in
its file. A reader of a few documents skips files and stripes by the id's statistics and row groups by the Bloom
filter; a reader of all takes stripes in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import NO_ID, lean, range_of, ranges, tie

SCHEMA = "doc_id long, position long, n_tokens long, ids array<int>"
OPTIONS = {
    "compression": "lz4",  # packed ids hardly get smaller by more work
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "2000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 1) -> str:
    """Writes doc_id, position (in its file), n_tokens and ids (array of int) of every document to path, and returns path.

    docs needs doc_id and text; other columns are ignored. Null and empty texts have end_id alone. Rows of equal
    doc_id are all written, one after the other; null ids come first. An empty table gives files without rows.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from shelfmark.llm.tokens import encoder

        encode, end = encoder(tokenizer), b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        position = 0
        for b in batches:
            ids = [encode.encode(x) + end for x in b.column(1).to_pylist()]
            offsets = np.cumsum([0, *(len(x) // 4 for x in ids)])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))
            places = pa.array(np.arange(position, position + len(ids)), pa.int64())
            position += len(ids)
            yield pa.record_batch([b.column(0), places, pa.array(np.diff(offsets), pa.int64()), lists], names=["doc_id", "position", "n_tokens", "ids"])

    # ranges are found from the ids alone; a range shuffle of the documents would read all texts twice
    keyed = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"))
    known, by_id = ranges(keyed, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lows = [low for low, _ in known] or [(NO_ID, 0)]
    dealt = keyed.repartitionById(len(lows), range_of(F.col("doc"), F.lit(0).cast("long") if by_id else tie(F.col("text")), lows))
    rows = dealt.sortWithinPartitions("doc").select("doc_id", "text").mapInArrow(lean(encoded, "tokens"), SCHEMA)
    rows.write.options(**OPTIONS).orc(path)
    return path


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, position, n_tokens, ids and file of every row."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows.select("doc_id", "position", "n_tokens", "ids", F.col("_metadata.file_name").alias("file"))


def token_summary(rows: DataFrame) -> DataFrame:
    """Per document of read_token_ids(): doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    start adds up tokens inside each file in parallel, and the totals of the files, of which there are few.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for b in batches:
            lists = b.column(3)
            offsets = np.frombuffer(lists.buffers()[1], np.int32, len(lists) + 1, lists.offset * 4)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [zlib.crc32(values[s:e]) for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.record_batch([b.column(0), b.column(1), b.column(4), pa.array(np.diff(offsets), pa.int64()), pa.array(sums, pa.int64())], names=["doc_id", "position", "file", "n_tokens", "ids_crc32"])

    each = rows.mapInArrow(lean(summed, "tokens"), "doc_id long, position long, file string, n_tokens long, ids_crc32 long")
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("_total"))
    # files are in order of the number in their names, which may have more digits than names are padded to
    in_order = Window.orderBy(F.regexp_extract("file", r"part-(\d+)", 1).try_cast("long"), "file")
    before = totals.select("file", (F.sum("_total").over(in_order) - F.col("_total")).alias("_before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("position")) - F.col("n_tokens")
    out = each.withColumn("_inside", inside).join(before, "file")
    return out.select("doc_id", (F.col("_before") + F.col("_inside")).alias("start"), "n_tokens", "ids_crc32")
