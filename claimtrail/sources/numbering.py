"""Line numbers of text files, counted where the lines are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from claimtrail.operators.joins import lookup_join
from claimtrail.sources.scratch import settle

_FILE, _SPLIT, _ID = "_file", "_split", "_id"


def numbered_lines(spark: SparkSession, path: str, fmt: str = "csv", number_col: str = "row_no", **options: str) -> DataFrame:
    """The rows of a file, or of a folder's files in order of their names, with their place from 1 on in ``number_col``.

    A file is read in splits by many tasks. Each row keeps its file, the split's place in the file and a number that rises within the
    split; rows are counted per split, and a running sum over the splits (one row each) tells how many lines come before. The rows are
    written once in between, so that a lost task can't number them anew in another order.
    """
    raw = spark.read.format(fmt).options(**options).load(path)
    if number_col.lower() in {c.lower() for c in raw.columns}:
        raise ValueError(f"the file already has a column {number_col}")
    rows = raw.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_SPLIT))
    rows = settle(rows.withColumn(_ID, F.monotonically_increasing_id()), "lines")
    splits = rows.groupBy(_FILE, _SPLIT).agg(F.min(_ID).alias("_first"), F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy(_FILE, _SPLIT)) - F.col("_rows")
    splits = splits.select(_FILE, _SPLIT, (before - F.col("_first") + 1).alias("_shift"))
    numbered = lookup_join(rows, splits, [_FILE, _SPLIT])
    return numbered.select(*[F.col(f"`{c}`") for c in raw.columns], (F.col(_ID) + F.col("_shift")).alias(number_col))
