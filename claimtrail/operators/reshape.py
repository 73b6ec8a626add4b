"""Reshaping: values to flag columns, wide to long, appended tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

def flag_dictionary(codes: DataFrame, value_col: str, name_col: str) -> dict[str, str]:
    """Value -> flag name from the table of the values that become columns."""
    return {r[0]: r[1] for r in codes.select(value_col, name_col).collect()}


def vec2mat(
    df: DataFrame, id_col: str, value_col: str, dictionary: Mapping[str, str], numeric: bool = True
) -> DataFrame:
    """One row per id with a 0/1 flag per dictionary value; ids without a hit keep all zeros.

    With ``numeric=False`` the flags are the characters ``'0'`` and ``'1'``. Each flag is labelled with its value.
    """
    if not dictionary:
        return df.select(id_col).distinct()
    kind = "int" if numeric else "string"
    hits = [
        F.max(F.when(F.col(value_col) == value, 1).otherwise(0)).cast(kind).alias(name, metadata={"label": f"{name} ({value})"})
        for value, name in dictionary.items()
    ]
    return df.groupBy(id_col).agg(*hits)


def distinct_values(df: DataFrame, id_col: str, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct (id, value) over several columns, in one pass."""
    return df.select(id_col, F.explode(F.array(*columns)).alias(name)).distinct()


def to_long(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], name_col: str = "varname", value_col: str = "value"
) -> DataFrame:
    """Wide to long: one row per (row, column)."""
    return df.unpivot(list(ids), list(columns), name_col, value_col)


def outer_union(first: DataFrame, second: DataFrame) -> DataFrame:
    """Append by column name; columns only one side has are NULL on the other."""
    return first.unionByName(second, allowMissingColumns=True)


def with_pseudo_group(df: DataFrame, group_col: str, label: str) -> DataFrame:
    """Every row twice: in its own group and in one group that holds them all. The table is read once."""
    own = F.col(group_col) if group_col in df.columns else F.lit(None).cast("string")
    return df.withColumn(group_col, F.explode(F.array(own, F.lit(label))))
