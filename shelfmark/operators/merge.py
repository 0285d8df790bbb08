"""Upserts of batches into snapshots, and what changed between two snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.text import content_hash, rfc3339
from shelfmark.schemas import JOURNALS, RECORD, names


def last_of_each(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes last in `order`."""
    newest = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    return rows.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], kept: list[str], order: list[str] | None = None) -> DataFrame:
    """target with the rows of batch: new keys are added; of keys that exist, every column but `kept` is overwritten, by empty
    values too. Of batch rows of one key, the last in `order` counts. Rows of target that the batch lacks stay."""
    source = last_of_each(batch, keys, order) if order else batch
    columns = [c for c in target.columns if c not in keys]
    joined = target.alias("t").join(source.withColumn("_new", F.lit(True)).alias("s"), keys, "full_outer")
    new = F.col("_new").isNotNull()
    pick = lambda c: F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")) if c in kept else F.when(new, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
    return joined.select(*keys, *(pick(c).alias(c) for c in columns)).select(*target.columns)


def stamped(records: DataFrame, time) -> DataFrame:
    """Records with their hash and with `time` (one for a batch) as first and last time."""
    when = F.lit(time).cast("timestamp")
    extra = [c for c in records.columns if c not in names(RECORD)]
    return records.select(*names(RECORD), content_hash().alias("content_hash"), when.alias("first_seen_at"), when.alias("last_scraped_at"), *extra)


def merge_records(target: DataFrame, records: DataFrame, time) -> DataFrame:
    """The journal table after a batch. Of records of one id the last card of the last page counts."""
    batch = stamped(records, time)
    order = [c for c in ("arrival_seq", "source_page", "card_pos") if c in batch.columns]
    return upsert(target.select(*names(JOURNALS)), batch, ["id"], ["first_seen_at"], order)


def changes(before: DataFrame, after: DataFrame, key: str = "id", value: str = "content_hash") -> DataFrame:
    """key and change (added, removed, changed) of every row that differs in `value` between two snapshots."""
    both = before.select(key, F.col(value).alias("_old"), F.lit(1).alias("_b")).join(after.select(key, F.col(value).alias("_new"), F.lit(1).alias("_a")), key, "full_outer")
    change = F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    return both.select(key, change.alias("change")).filter("change is not null")


def exported(rows: DataFrame) -> DataFrame:
    """Rows as plain text and numbers hold them: booleans as 0 or 1, times as text of their UTC second."""
    kind = lambda f: F.col(f.name).cast("int") if f.dataType.simpleString() == "boolean" else rfc3339(F.col(f.name)) if f.dataType.simpleString() == "timestamp" else F.col(f.name)
    return rows.select(*(kind(f).alias(f.name) for f in rows.schema.fields))
