"""The tables of tables.py as a sink of batches and streams: a Python data source whose driver commits or aborts.

    spark.dataSource.register(TableSink)
    df.write.format("shelfmark_table").mode("append").option("path", table.path).save()
    stream.writeStream.format("shelfmark_table").option("path", table.path).option("checkpointLocation", ...).start()

Each task writes one Parquet file (one for each partition of a table that is dealt) under a name that no other attempt
has, and tells it to the driver. The driver puts the success mark once all tasks are done, and removes what other attempts
left. Where the job fails it removes all. A stream's batch has a folder by its number and stream, and is left out
if it was stored before. The path may lie in any store that pyarrow opens.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from shelfmark.sources.tables import FOLDER

#: Names the stream and batch of a folder.
ORIGIN = "_origin"


@dataclass
class Wrote(WriterCommitMessage):
    files: list[str]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Writer:
    """by: columns that files are dealt by, as Spark's own partitionBy() deals them."""

    def __init__(self, path: str, by: list[str]):
        self.path, self.by = path.rstrip("/"), by

    def _numbers(self) -> list[tuple[int, str, bool]]:
        """(number, kind, finished) of the table's folders."""
        store, path = _opened(self.path)
        found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        named = [(m, x.path) for x in found if (m := FOLDER.search(f"/{x.base_name}"))]
        return sorted((int(m[1]), m[2], store.get_file_info(f"{p}/_SUCCESS").type != fs.FileType.NotFound) for m, p in named)

    def _new_folder(self) -> str:
        return f"{self.path}/folder={max((n for n, _, _ in self._numbers()), default=0) + 1:08d}-batch"

    def write_to(self, folder: str, batches: Iterator[pa.RecordBatch]) -> Wrote:
        store, at = _opened(folder)
        files: dict[str, tuple[str, pq.ParquetWriter]] = {}
        try:
            for b in batches:
                for place, rows in self._dealt(b):
                    if place not in files:
                        store.create_dir(f"{at}{place}", recursive=True)
                        name = f"{at}{place}/part-{uuid.uuid4().hex}.parquet"
                        files[place] = name, pq.ParquetWriter(name, rows.schema, filesystem=store, compression="zstd")
                    files[place][1].write_batch(rows)
            for _, writer in files.values():
                writer.close()
        except BaseException:
            for name, writer in files.values():
                writer.close()
                store.delete_file(name)
            raise
        return Wrote([name[len(at) :] for name, _ in files.values()])

    def _dealt(self, batch: pa.RecordBatch) -> list[tuple[str, pa.RecordBatch]]:
        """Parts of a batch and the folders that they go to, below the table's folder."""
        if not self.by or not batch.num_rows:
            return [("", batch)] if batch.num_rows else []
        keys = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in self.by), strict=True))
        kept = [i for i, c in enumerate(batch.schema.names) if c not in self.by]
        places: dict[tuple, list[int]] = {}
        for i, key in enumerate(keys):
            places.setdefault(key, []).append(i)
        named = lambda v: quote(v, safe=" !$()+,-.;@_~&") if v else "__HIVE_DEFAULT_PARTITION__"
        return [("".join(f"/{c}={named(v)}" for c, v in zip(self.by, key, strict=True)), batch.take(pa.array(rows)).select(kept)) for key, rows in places.items()]

    def finish(self, folder: str, messages: list, origin: dict | None = None) -> None:
        """Puts the mark, after files of other attempts are gone."""
        store, at = _opened(folder)
        store.create_dir(at, recursive=True)
        told = {f for m in messages if m is not None for f in m.files}
        for x in store.get_file_info(fs.FileSelector(at, recursive=True)):
            if x.type == fs.FileType.File and x.path[len(at) :] not in told:
                store.delete_file(x.path)
        for name, content in ((ORIGIN, json.dumps(origin)), ("_SUCCESS", "")) if origin else (("_SUCCESS", ""),):
            with store.open_output_stream(f"{at}/{name}") as out:
                out.write(content.encode())

    @staticmethod
    def remove(folder: str) -> None:
        store, at = _opened(folder)
        if store.get_file_info(at).type == fs.FileType.Directory:
            store.delete_dir(at)


class TableWriter(DataSourceArrowWriter, _Writer):
    def __init__(self, path: str, by: list[str]):
        _Writer.__init__(self, path, by)
        self.folder = self._new_folder()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        return self.write_to(self.folder, iterator)

    def commit(self, messages: list) -> None:
        self.finish(self.folder, messages)

    def abort(self, messages: list) -> None:
        self.remove(self.folder)


class TableStreamWriter(DataSourceStreamArrowWriter, _Writer):
    """Tasks write to a folder of their stream that no reader looks at; committing moves a batch's files to the table."""

    def __init__(self, path: str, by: list[str], stream: str):
        _Writer.__init__(self, path, by)
        self.stream, self.waiting = stream, f"{self.path}/_waiting-{uuid.uuid5(uuid.NAMESPACE_URL, stream).hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        return self.write_to(self.waiting, iterator)

    def _stored(self, batch: int) -> bool:
        store, at = _opened(self.path)
        for number, kind, finished in self._numbers():
            name = f"{at}/folder={number:08d}-{kind}/{ORIGIN}"
            if finished and store.get_file_info(name).type == fs.FileType.File:
                with store.open_input_stream(name) as f:
                    if json.loads(f.read()) == {"stream": self.stream, "batch": batch}:
                        return True
        return False

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803
        store, at = _opened(self.waiting)
        told = [f for m in messages if m is not None for f in m.files]
        if not self._stored(batchId):
            folder = self._new_folder()
            _, to = _opened(folder)
            for f in told:
                store.create_dir(f"{to}{f}".rpartition("/")[0], recursive=True)
                store.move(f"{at}{f}", f"{to}{f}")
            self.finish(folder, messages, {"stream": self.stream, "batch": batchId})
        self.remove(self.waiting)

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.remove(self.waiting)


class TableSink(DataSource):
    """Options: path (of the table); by (names of the columns that its files are dealt by, with commas); stream (name of a stream,
    else its checkpoint's)."""

    @classmethod
    def name(cls) -> str:
        return "shelfmark_table"

    def _by(self) -> list[str]:
        return [x for x in self.options.get("by", "").split(",") if x]

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("batches are merged: use append")
        return TableWriter(self.options["path"], self._by())

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamArrowWriter:  # noqa: N802
        return TableStreamWriter(self.options["path"], self._by(), self.options.get("stream") or self.options.get("checkpointLocation") or unquote(self.options["path"]))
