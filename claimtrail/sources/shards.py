"""Claims shards: tables of one source, scope and year, kept as one table partitioned by those three."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimtrail.functions.codes import as_list
from claimtrail.sources.schemas import conform, reconcile

SHARD_COLUMNS = ("source", "scope", "year")
#: Two-digit years from this one on are of the last century.
PIVOT = 70


def shard_parts(name: Column) -> dict[str, Column]:
    """Split a shard name such as ``ccaeo081``: source (4), scope (1), two-digit year (2), version (rest)."""
    bare = F.substring_index(name, ".", -1)
    two = F.substring(bare, 6, 2).try_cast("int")
    return {
        "source": F.substring(bare, 1, 4),
        "scope": F.substring(bare, 5, 1),
        "year": two + F.when(two >= PIVOT, 1900).otherwise(2000),
        "version": F.substring(bare, 8, 8),
    }


def shard_columns(df: DataFrame, name: str) -> DataFrame:
    """A shard's table with the columns ``source``, ``scope`` and ``year`` of its name."""
    parts = shard_parts(F.lit(name))
    return df.withColumns({c: parts[c] for c in SHARD_COLUMNS})


def union_columns(shards: Mapping[str, DataFrame], code_widths: Mapping[str, int] | None = None) -> DataFrame:
    """All shards as one table: lower-case names, column union with NULL fill, the shard's name in ``tb_name``.

    A column of several types takes the least type that holds them all (``schemas.wider``): text wins over numbers. Columns in ``code_widths``
    are text; numbers among them get back the leading zeros of a code of that width. ``schemas.reconcile`` tells which columns clash, and where.
    """
    if not shards:
        raise ValueError("no shards to union")
    schema, _ = reconcile(shards, code_widths)
    named = [conform(df, schema, code_widths, name).withColumn("tb_name", F.lit(name)) for name, df in shards.items()]
    first = len(next(iter(shards.values())).columns)  # the name stands behind the columns of the first shard
    return reduce(DataFrame.union, named).select(*[F.col(f"`{c}`") for c in (*schema.names[:first], "tb_name", *schema.names[first:])])


def select_shards(
    claims: DataFrame,
    sources: str | Sequence[str] | None = None,
    scopes: str | Sequence[str] | None = None,
    years: Sequence[int] | None = None,
    year_col: str = "year",
) -> DataFrame:
    """Keep the named sources, scopes and years, and rows without a year. On a partitioned table this prunes partitions."""
    for column, wanted in zip(SHARD_COLUMNS[:2], (sources, scopes)):
        if wanted is not None:
            claims = claims.where(F.col(column).isin(as_list(wanted)))
    if years is not None:
        claims = claims.where(F.col(year_col).isin(list(years)) | F.col(year_col).isNull())
    return claims
