"""Which pages a named run still has to fetch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def pages_to_fetch(spark: SparkSession, pages: int, completed: DataFrame) -> DataFrame:
    """page: 1 to `pages` without the completed ones, in order. None for 0 or less."""
    every = spark.range(1, max(0, pages) + 1).select(F.col("id").cast("int").alias("page"))
    return every.join(completed.select("page").distinct(), "page", "left_anti").orderBy("page")


def target_pages(first_page: DataFrame, most: int = 0) -> tuple[int, int]:
    """(pages to cover, records that the listing has) of page_results() of page 1. `most` over 0 limits the pages."""
    row = first_page.select("total_pages", "total_records").first()
    if row is None or (most <= 0 and row["total_pages"] <= 0):
        raise ValueError("page 1 does not say how many pages there are")
    return (most if most > 0 else row["total_pages"]), row["total_records"]
