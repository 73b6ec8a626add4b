"""Ordered computation: forward fill, numbering, first and last row of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

FILL_BLOCK = 100_000


def forward_fill(df: DataFrame, column: str, order_col: str, block: int = FILL_BLOCK) -> DataFrame:
    """Replace NULL with the last value above it in line-number order.

    Lines are cut into blocks of ``block`` consecutive line numbers, so no task orders more than one block. A block's
    opening NULLs take the last value of the blocks before it, found over one row per block.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order_col) / block))
    ends = blocked.groupBy("_block").agg(
        F.max_by(column, F.when(F.col(column).isNotNull(), F.col(order_col))).alias("_end")
    )
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_block", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    within = Window.partitionBy("_block").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.join(carried, "_block", "left")
        .withColumn(column, F.coalesce(F.last(column, ignorenulls=True).over(within), F.col("_carried")))
        .select(*df.columns)
    )


def row_number_global(df: DataFrame, order: Sequence[Column], name: str = "row_num") -> DataFrame:
    """Number the rows of a table that is small by nature (one row per code, per day): it orders in one task."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def first_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """First and last row of each group as ``first_<v>`` / ``last_<v>``, by aggregates that combine before the shuffle."""
    place = F.struct(
        *[F.col(c).alias(f"by_{i}") for i, c in enumerate(order)], *[F.col(v).alias(f"v_{v}") for v in values]
    )
    ends = df.groupBy(*keys).agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    return ends.select(
        *keys,
        *[F.col(f"_first.v_{v}").alias(f"first_{v}") for v in values],
        *[F.col(f"_last.v_{v}").alias(f"last_{v}") for v in values],
    )


def top_n_with_ties(df: DataFrame, n: int, order_col: str) -> DataFrame:
    """The ``n`` rows with the largest ``order_col`` and every row tied with the last of them."""
    ranked = df.withColumn("_rank", F.rank().over(Window.orderBy(F.desc(order_col))))
    return ranked.where(F.col("_rank") <= n).drop("_rank")
