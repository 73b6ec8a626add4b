"""Keep a table's further columns out of an operator's way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def pack(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, and all columns but the text in one struct, so that no name of theirs can clash."""
    return docs.select("doc_id", "text", F.struct(*[named(c) for c in docs.columns if c != "text"]).alias("_row"))


def unpack(packed: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """The columns that ``pack`` was given, in their order, with the text as it is now; then ``more`` columns."""
    return packed.select(*[F.col("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in columns], *more)
