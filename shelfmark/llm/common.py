"""What the operators share: the folder all executors see, and word hashes of Arrow text columns.

Word hashes mix a word's UTF-8 bytes, eight at a time, into 64 bits; those of long words are XXH3. Hashes of windows are
polynomials modulo 2**64 over word hashes, from prefix sums. Both are computed for a whole Arrow column at once, so that
no Python object is made per word.
"""

from __future__ import annotations

import ctypes
import gc
import math
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.sources.folders import shared_root

#: Stands for a null doc_id, and is less than any other.
NO_ID = -(1 << 63)
#: Bytes that separate words: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Text is hashed in pieces of about so many bytes, which bounds the memory of a very long text.
SEGMENT = 1 << 18
#: Most keys that spread_join() takes for hot.
HEAVY = 1000
#: Longest word, in bytes, that is hashed with others.
SHORT = 64
#: The lowest bytes of 64 bits, by their count.
_LOW = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}


def let_go(*keep: str) -> None:
    """Frees what tokenizers (but those named) keep in this Python worker, and gives unused memory back."""
    for name in ("tokens", "pieces"):
        if name not in keep and (module := sys.modules.get(f"shelfmark.llm.{name}")):
            module._encoders.clear()
    trim()


def trim() -> None:
    """Gives this process's unused memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # a system without it


def lean(run: Callable, *keep: str) -> Callable:
    """An Arrow function that lets go before and after its work: Python workers live on from one operator to the next, idle ones
    too, and what they keep would add to the memory of others."""

    def wrapped(batches: Iterator) -> Iterator:
        let_go(*keep)
        yield from run(batches)
        let_go(*keep)

    return wrapped


def shared_dir(spark, name: str) -> str:
    """A new folder under the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark, path: str) -> None:
    """Removes a folder of intermediate data that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cut(df):
    """df with its lineage cut: written to the checkpoint folder, which all executors share."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def packed(columns: list[str]) -> Column:
    """A struct of these columns, by their places: so none of their names can clash with an operator's own."""
    return F.struct(F.lit(0).alias("none"), *(F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(columns)))


def unpacked(columns: list[str], struct: str) -> dict[str, Column]:
    """The columns of packed(), by name."""
    return {c: F.col(struct)[f"f{i}"].alias(c) for i, c in enumerate(columns)}


def spread_join(rows: DataFrame, key: str, table: DataFrame, salt: Column) -> DataFrame:
    """rows, left join table on key (a long, unique there). The HEAVY most frequent keys are joined by broadcast; their rows and
    those without a key are dealt by `salt`, so that no task gets a hot key. rows and table are read twice: they should
    be stored or small plans."""
    heavy = rows.filter(F.col(key).isNotNull()).groupBy(key).count().orderBy(F.desc("count")).limit(HEAVY).select(F.col(key).alias("_heavy"))
    values = F.struct(*(c for c in table.columns if c != key))
    few = table.join(F.broadcast(heavy), F.col(key) == F.col("_heavy")).select("_heavy", values.alias("_few"))
    marked = rows.join(F.broadcast(few), F.col(key) == F.col("_heavy"), "left").drop("_heavy")
    dealt = marked.withColumn("_plain", F.col("_few").isNull() & F.col(key).isNotNull()).withColumn("_deal", F.when(F.col("_plain"), F.col(key)).otherwise(salt))
    many = table.select(F.col(key).alias("_deal"), F.lit(True).alias("_plain"), values.alias("_many"))
    out = dealt.join(many.hint("shuffle_merge"), ["_deal", "_plain"], "left").withColumn("_found", F.coalesce("_few", "_many"))
    return out.select(*rows.columns, *(F.col("_found")[c].alias(c) for c in table.columns if c != key))


def tie(text: Column) -> Column:
    """What orders rows of equal ids: 63 bits of a hash of their texts; null is as empty."""
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 1)


def ranges(docs: DataFrame, count: int) -> tuple[list[tuple], bool]:
    """Least and largest (doc, tie) of each of about `count` ranges that hold about as many ids, in order, and whether ids alone
    tell ranges apart (ties are 0 then). They do unless one id has more rows than a range should. docs: doc and text."""
    bounds = lambda parts, *by: parts.repartitionByRange(count, *by).groupBy(F.spark_partition_id())
    counts = docs.groupBy("doc").count()
    found = bounds(counts, "doc").agg(F.min("doc").alias("low"), F.max("doc").alias("top"), F.sum("count").alias("rows"), F.max("count").alias("most")).collect()
    if max((r["most"] for r in found), default=0) <= max(1000, 2 * sum(r["rows"] for r in found) // count):
        return sorted(((r["low"], 0), (r["top"], 0)) for r in found), True
    pairs = docs.select("doc", tie(F.col("text")).alias("tie")).distinct()
    place = F.struct("doc", "tie")
    found = bounds(pairs, "doc", "tie").agg(F.min(place).alias("low"), F.max(place).alias("top")).collect()
    return sorted((tuple(r["low"]), tuple(r["top"])) for r in found), False


def longs(values: list[int]) -> Column:
    """An array literal: one text, folded when planned."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def range_of(doc: Column, tie: Column, lows: list[tuple[int, int]]) -> Column:
    """Place of the range that (doc, tie) lies in: among every step-th range first, then among those that follow it."""
    step = math.isqrt(len(lows)) + 1
    pairs = lambda x: F.arrays_zip(longs([d for d, _ in x]).alias("d"), longs([t for _, t in x]).alias("t"))
    under = lambda x: (x["d"] < doc) | ((x["d"] == doc) & (x["t"] <= tie))
    coarse = F.size(F.filter(pairs(lows[::step]), under)) - 1
    fine = F.size(F.filter(F.slice(pairs(lows), coarse * step + 1, F.lit(step)), under))
    return coarse * step + fine - 1


def _powers(kind: str, least: int) -> np.ndarray:
    if kind not in _tables or len(_tables[kind]) < least:
        size = max(SEGMENT + 1, least)
        base = np.full(size, _BASE if kind == "up" else _INVERSE, np.uint64)
        base[0] = 1
        _tables[kind] = np.cumprod(base, dtype=np.uint64)
    return _tables[kind]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits; a bijection."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def ranged_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[s:e] for each pair, wherever in values it lies. Starts ascend."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(starts, low + SEGMENT)))
        high = int(ends[i:j].max())
        up, down = _powers("up", high - low), _powers("down", int(starts[j - 1]) - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((values[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        out[i:j] = (sums[ends[i:j] - low] - sums[starts[i:j] - low]) * down[starts[i:j] - low]
        i = j
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and where each text begins in them (with the end). Null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in data, and the first word of each text (with the count of all)."""
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of data[s:e] for each pair. A step is no linear function of the bytes, so that words of few letters in a certain order,
    which polynomials modulo a power of two take for each other, differ."""
    lengths = ends - starts
    out = mixed(lengths.astype(np.uint64) * np.uint64(_BASE))
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))  # those from each place on
    left, at = np.flatnonzero(lengths <= SHORT), 0
    while len(left):
        rest = lengths[left] - at
        out[left] = mixed((out[left] ^ (eight[starts[left] + at] & _LOW[np.minimum(rest, 8)])) * np.uint64(_BASE))
        left, at = left[rest > 8], at + 8
    for i in np.flatnonzero(lengths > SHORT):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return out


def window_hashes(words: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """A hash of words[i:i+size] for each i; across texts too, which the caller leaves out."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    starts = np.arange(n)
    source = mixed(words ^ np.uint64(salt)) if salt else words
    return mixed(ranged_hashes(source, starts, starts + size) ^ np.uint64(size))


def slices(batch: pa.RecordBatch, text: str = "text", most: int = 2 << 20):
    """Parts of a batch with about so many bytes of text each, one row at least."""
    sizes = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(sizes.buffers()[1], np.int64, len(sizes) + 1, sizes.offset * 8)
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j
