"""Tables of intervals (stays, enrolment spells) laid out so that a window reads only the files that can touch it.

An interval touches a window if it ends after the window begins and begins before the window ends. A layout by one year prunes one of the
two; here rows are partitioned by the years of both ends and files are ordered by (end, begin), so that both comparisons skip partitions and,
inside the window's first and last years, row groups. Intervals without an end (or begin) are a partition of their own, which is always read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

BEGIN_YEAR, END_YEAR = "begin_year", "end_year"
YEARS = (BEGIN_YEAR, END_YEAR)


def with_years(df: DataFrame, begin_col: str, end_col: str) -> DataFrame:
    """``df`` with the years in which its intervals begin and end."""
    return df.withColumns({BEGIN_YEAR: F.year(F.col(begin_col).cast("date")), END_YEAR: F.year(F.col(end_col).cast("date"))})


def select_years(df: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """The rows whose years can touch the window, if the table has these columns; a missing year can always."""
    if not {*YEARS} <= {c.lower() for c in df.columns}:
        return df
    if start is not None:
        df = df.where((F.col(END_YEAR) >= start.year) | F.col(END_YEAR).isNull())
    if end is not None:
        df = df.where((F.col(BEGIN_YEAR) <= end.year) | F.col(BEGIN_YEAR).isNull())
    return df
