"""Cleaning of days of supply on drug claims."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from claimtrail.operators.joins import lookup_join


def dedupe_keep_max_supply(
    df: DataFrame, keys: Sequence[str], supply_col: str = "daysupp", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the largest supply, missing last. Ties are settled by the kept columns.

    The first-row filter on the row number is applied by each map task before the shuffle as well, so copies of one
    claim do not travel. Without kept columns it is a plain maximum.
    """
    if not keep:
        return df.groupBy(*keys).agg(F.max(supply_col).alias(supply_col))
    order = [F.col(supply_col).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in keep]]
    numbered = df.select(*keys, supply_col, *keep).withColumn(
        "_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return numbered.where(F.col("_n") == 1).drop("_n")


def supply_mode(df: DataFrame, ndc_col: str = "ndcnum", supply_col: str = "daysupp") -> DataFrame:
    """Most frequent positive supply of each drug code; the smallest one on a tie."""
    counted = df.where(F.col(supply_col) > 0).groupBy(ndc_col, supply_col).agg(F.count(F.lit(1)).alias("_freq"))
    rank = F.struct(F.col("_freq"), -F.col(supply_col))
    return counted.groupBy(ndc_col).agg(F.max_by(supply_col, rank).alias("mode_supply"))


def clean_supply_days(
    df: DataFrame,
    id_col: str = "enrolid",
    date_col: str = "svcdate",
    ndc_col: str = "ndcnum",
    supply_col: str = "daysupp",
    keep: Sequence[str] = (),
) -> DataFrame:
    """One fill per (patient, day, drug code) with a positive supply.

    A missing or non-positive supply becomes the code's usual one. Fills of a code that never has a positive supply
    are dropped.
    """
    fills = dedupe_keep_max_supply(df, [id_col, date_col, ndc_col], supply_col, keep)
    usual = supply_mode(fills, ndc_col, supply_col)
    supply = F.when(F.col(supply_col) > 0, F.col(supply_col)).otherwise(F.col("mode_supply"))
    return lookup_join(fills, usual, [ndc_col]).select(id_col, date_col, ndc_col, supply.alias(supply_col), *keep)
