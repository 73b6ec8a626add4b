"""Tables stored by patient: the same patients in the same bucket of every table, so that joins and groupings by patient need no exchange.

All tables of a study have one number of buckets. A patient's rows can't be spread over buckets, so a table in which one patient has more
rows than a task should hold is not stored this way: it is read as any other table, with the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimtrail.sources.manifest import entry_of

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 1 << 16  # a power of two
TRACKED = 10_000  # keys of the sketch that looks for the most frequent one


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """The power of two that brings the rows of a bucket to ``rows_per_bucket`` at most, if patients have alike many."""
    return min(MAX_BUCKETS, 1 << max(0, -(-rows // rows_per_bucket) - 1).bit_length())


def hottest(key: str) -> Column:
    """Aggregate: about how many rows the most frequent value of ``key`` has, NULL without rows. Never too low by more than one row in 10,000.

    A mergeable sketch, so no key is shuffled.
    """
    return F.get(F.expr(f"approx_top_k(xxhash64(`{key}`), 1, {TRACKED})"), F.lit(0))["count"]


def buckets_of(spark: SparkSession, table: str) -> tuple[str, int] | None:
    """Column and number of a table's buckets."""
    column, _, count = entry_of(spark, table).get("buckets", "").rpartition(":")
    return (column, int(count)) if column else None


def together(spark: SparkSession, *tables: str) -> bool:
    """Are the tables stored by the same column in as many buckets?"""
    layouts = {buckets_of(spark, t) for t in tables}
    return len(layouts) == 1 and None not in layouts


def into_buckets(df: DataFrame, key: str, count: int) -> DataFrame:
    """Rows in the tasks that write their buckets, so that each bucket is one file."""
    return df.repartition(count, F.col(key))
