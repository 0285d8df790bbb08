"""Order where one key may hold a large part of all rows: places in groups, prefix sums, and digests of ordered parts.

Rows are dealt by ranges of their order, so that a group of very many rows lies in several ranges. What a range must know
of those before it is a few numbers for each, of which there are as many as shuffle partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import cut, lean


def dealt(rows: DataFrame, *order: Column) -> DataFrame:
    """rows with `part`, the range that they lie in. Ranges are found anew by each plan that runs: store what comes of it."""
    return rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id())


def placed(rows: DataFrame, group: str, *order: Column) -> DataFrame:
    """rows, stored, with `place`, from 1 inside their group. Rows that agree in group and order lie in one range."""
    inside = Window.partitionBy(group, "part").orderBy(*order)
    numbered = cut(dealt(rows, F.col(group), *order).withColumn("place", F.row_number().over(inside).cast("long")))
    counts = numbered.groupBy(group, "part").agg(F.count("*").alias("n"))
    # only groups at the edges of ranges lie in several: no more rows than ranges twice over
    several = counts.withColumn("parts", F.count("*").over(Window.partitionBy(group))).filter("parts > 1")
    before = F.sum("n").over(Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = several.select(F.col(group).alias("_group"), F.col("part").alias("_part"), F.coalesce(before, F.lit(0)).alias("_before"))
    found = numbered.join(F.broadcast(offsets), F.col(group).eqNullSafe(F.col("_group")) & (F.col("part") == F.col("_part")), "left")
    return found.withColumn("place", F.col("place") + F.coalesce("_before", F.lit(0))).select(*rows.columns, "place")


def prefix_sums(rows: DataFrame, position: str, count: int, values: dict[str, Column]) -> DataFrame:
    """rows, stored, with the sum of each value over all positions up to their own. position: 0 to count - 1, each once."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = max(1, -(-count // parts))
    inside = Window.partitionBy("_part").orderBy(position)
    summed = rows.withColumn("_part", F.floor(F.col(position) / each).cast("int"))
    summed = cut(summed.withColumns({name: F.sum(value).over(inside) for name, value in values.items()}))
    totals = summed.groupBy("_part").agg(*(F.max_by(name, position).alias(name) for name in values)).collect()  # a row a part
    before, at = [], dict.fromkeys(values, 0)
    for row in sorted(totals, key=lambda r: r["_part"]):
        before.append((row["_part"], *at.values()))
        at = {name: at[name] + row[name] for name in values}
    if not before:
        return summed.drop("_part")
    offsets = rows.sparkSession.createDataFrame(before, "_part int, " + ", ".join(f"_{name} long" for name in values))
    out = summed.join(F.broadcast(offsets), "_part")
    return out.select(*rows.columns, *((F.col(name) + F.col(f"_{name}")).alias(name) for name in values))


def joined_digests(rows: DataFrame, key: str, order: list[str], separator: str) -> DataFrame:
    """key and digest, the SHA-256 (lowercase hex) of the key's texts in order with separators between them. rows: key, order and
    text. A key's texts go through one task as a stream and are not held."""
    kind = rows.schema[key].dataType.simpleString()
    sep = separator.encode()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for b in batches:
            keys, sums = [], []
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if state is None or k != current:
                    if state is not None:
                        keys.append(current)
                        sums.append(state.hexdigest())
                    current, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(sep)
                    state.update(text.encode())
            yield pa.record_batch([pa.array(keys, b.schema.field(0).type), pa.array(sums, pa.string())], names=[key, "digest"])
        if state is not None:
            yield pa.record_batch([pa.array([current], b.schema.field(0).type), pa.array([state.hexdigest()], pa.string())], names=[key, "digest"])

    in_order = rows.repartition(key).sortWithinPartitions(key, *order).select(key, "text")
    return in_order.mapInArrow(lean(digests), f"{key} {kind}, digest string")
