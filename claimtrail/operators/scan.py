"""Claim scans: rows in a date window that carry one of a list of medical codes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimtrail.functions.codes import (
    MAX_INLINE_BYTES, as_list, by_length, distinct_codes, has_prefix, inline_codes, is_listed, prefix_of, starts_with_any,
)
from claimtrail.functions.dates import date_filter, interval_overlap
from claimtrail.operators.index import MAX_INDEX_BYTES, CodeIndex, code_index
from claimtrail.operators.joins import lookup_join, saved
from claimtrail.sources.intervals import select_years
from claimtrail.sources.shards import select_shards

Codes = str | Iterable[str] | DataFrame
Names = str | Sequence[str]


def _present(columns: Names, df: DataFrame) -> list[str]:
    have = {c.lower() for c in df.columns}
    found = [c.lower() for c in as_list(columns) if c.lower() in have]
    if not found:
        raise ValueError(f"none of {as_list(columns)} is a column of the table")
    return found


def _given(codes: Codes | None) -> bool:
    return codes is not None and (isinstance(codes, DataFrame) or bool(as_list(codes)))


def _explode_matches(df: DataFrame, candidates: list[Column], code_col: str) -> DataFrame:
    """One output row per distinct non-NULL candidate of each input row, however many columns repeat it."""
    exploded = df.withColumn(code_col, F.explode(F.array_distinct(F.array(*candidates))))
    return exploded.where(F.col(code_col).isNotNull())


def _free(df: DataFrame, code_col: str) -> None:
    if code_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table already has a column {code_col}; name another code_col")


def prefix_join(
    df: DataFrame,
    codes: Codes,
    columns: Names,
    code_col: str = "matched_code",
    max_inline: int = MAX_INLINE_BYTES,
    max_index: int = MAX_INDEX_BYTES,
) -> DataFrame:
    """Inner join on "one of ``columns``, as text, starts with the code": one row per (claim, matching code).

    The rows are the same however long the list is. A list of up to ``max_inline`` bytes becomes hashed IN-sets on the column
    prefixes: no join and no shuffle, and claims without a match are gone before anything is exploded. A larger one, up to ``max_index``
    bytes, is a hashed index that every task holds, with the same plan otherwise. Only beyond that it is an equi-join on the exploded
    distinct prefixes. Repeated codes in the list count once. ``code_col`` must be a new column.
    """
    columns = _present(columns, df)
    _free(df, code_col)
    known = inline_codes(codes, max_inline)
    if known is not None:
        hit = F.lit(False)
        for name in columns:
            hit = hit | starts_with_any(name, known)
        candidates = [
            F.when(has_prefix(name, length, group), prefix_of(name, length))
            for name in columns
            for length, group in by_length(known).items()
        ]
        if not candidates:
            return df.withColumn(code_col, F.lit(None).cast("string")).where(F.lit(False))
        return _explode_matches(df.where(hit), candidates, code_col)

    listed = saved(_code_frame(df, codes, code_col), "codes")
    index = code_index(listed, max_index)
    if index is not None:
        return _indexed_matches(df, [prefix_of(c, n) for c in columns for n in index.lengths], index, code_col)
    lengths = _code_lengths(listed, code_col)
    return lookup_join(_explode_matches(df, _prefixes(columns, lengths), code_col), listed, [code_col]).select(*df.columns, code_col)


def _any(tests: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _indexed_matches(df: DataFrame, texts: list[Column], index: CodeIndex, code_col: str) -> DataFrame:
    """Claims with a listed text, one row per distinct listed text; nothing is exploded for the other claims.

    A prefix longer than its column is the whole column, which the list holds just if a prefix of its own length is held.
    """
    kept = df.where(_any(index.holds(t) for t in texts))
    return _explode_matches(kept, [F.when(index.holds(t), t) for t in texts] or [F.lit(None).cast("string")], code_col)


def _code_lengths(listed: DataFrame, name: str) -> list[int]:
    """The code lengths of a list: a handful of numbers."""
    return sorted(r[0] for r in listed.select(F.length(name)).distinct().collect())


def _prefixes(columns: Iterable[str], lengths: list[int]) -> list[Column]:
    return [F.when(F.length(F.col(c).cast("string")) >= n, prefix_of(c, n)) for c in columns for n in lengths]


def equal_join(
    df: DataFrame,
    codes: Codes,
    columns: Names,
    code_col: str = "matched_code",
    max_inline: int = MAX_INLINE_BYTES,
    max_index: int = MAX_INDEX_BYTES,
) -> DataFrame:
    """Inner join on "one of ``columns``, as text, equals the code": one row per (claim, matching code).

    The rows are the same however long the list is; see ``prefix_join``.
    """
    columns = _present(columns, df)
    _free(df, code_col)
    known = inline_codes(codes, max_inline)
    if known is None:
        texts = [F.col(name).cast("string") for name in columns]
        listed = saved(_code_frame(df, codes, code_col), "codes")
        index = code_index(listed, max_index)
        if index is not None:
            return _indexed_matches(df, texts, index, code_col)
        return lookup_join(_explode_matches(df, texts, code_col), listed, [code_col]).select(*df.columns, code_col)
    if not known:
        return df.withColumn(code_col, F.lit(None).cast("string")).where(F.lit(False))
    hit = F.lit(False)
    for name in columns:
        hit = hit | is_listed(name, known)
    kept = df.where(hit)
    if len(columns) == 1:
        return kept.withColumn(code_col, F.col(columns[0]).cast("string"))
    return _explode_matches(kept, [F.when(is_listed(c, known), F.col(c).cast("string")) for c in columns], code_col)


def _code_frame(df: DataFrame, codes: Codes, name: str) -> DataFrame:
    if not isinstance(codes, DataFrame):
        codes = df.sparkSession.createDataFrame([(c,) for c in as_list(codes)], f"{name} string")
    return distinct_codes(codes, name)


def code_list_df(spark, codes: str | Iterable[str], name: str) -> DataFrame:
    """A Python code list as a one-column table, without repeats."""
    return distinct_codes(spark.createDataFrame([(c,) for c in as_list(codes)], f"{name} string"))


def scan_dx(
    claims: DataFrame,
    codes: Codes | None = None,
    dx_cols: Names | None = None,
    start: date | None = None,
    end: date | None = None,
    date_col: str = "svcdate",
    end_col: str | None = None,
    sources: Names | None = None,
    scopes: Names | None = None,
    years: Sequence[int] | None = None,
    year_col: str = "year",
    coalesce_end: bool = False,
    code_col: str | None = None,
) -> DataFrame:
    """Claims in the window whose diagnosis starts with a listed code; without codes, just the window."""
    if _given(codes) != bool(dx_cols):
        raise ValueError("give both codes and dx_cols, or neither")
    finish = F.col(end_col) if end_col else None
    found = select_shards(claims, sources, scopes, years, year_col)
    found = (select_years(found, start, end) if end_col else found).where(
        interval_overlap(F.col(date_col), finish, start, end, coalesce_end)
    )
    if not dx_cols:
        return found
    matched = prefix_join(found, codes, dx_cols, code_col or "matched_code")
    return matched if code_col else matched.drop("matched_code")


def scan_rx(
    claims: DataFrame,
    codes: Codes | None = None,
    rx_cols: Names | None = None,
    start: date | None = None,
    end: date | None = None,
    date_col: str = "svcdate",
    sources: Names | None = None,
    scopes: Names | None = None,
    years: Sequence[int] | None = None,
    year_col: str = "year",
    code_col: str | None = None,
) -> DataFrame:
    """Claims in the window that carry a listed drug or procedure code exactly; without codes, just the window."""
    if _given(codes) != bool(rx_cols):
        raise ValueError("give both codes and rx_cols, or neither")
    found = select_shards(claims, sources, scopes, years, year_col).where(date_filter(F.col(date_col), start, end))
    if not rx_cols:
        return found
    matched = equal_join(found, codes, rx_cols, code_col or "matched_code")
    return matched if code_col else matched.drop("matched_code")


def scan_enrollment(
    enrollment: DataFrame,
    start: date | None = None,
    end: date | None = None,
    begin_col: str = "dtstart",
    end_col: str = "dtend",
    sources: Names | None = None,
    scopes: Names | None = None,
    years: Sequence[int] | None = None,
    year_col: str = "year",
) -> DataFrame:
    """Enrolment spells that touch the window."""
    return select_years(select_shards(enrollment, sources, scopes, years, year_col), start, end).where(
        interval_overlap(F.col(begin_col), F.col(end_col), start, end)
    )


def flag_prefix(
    df: DataFrame, conditions: dict[str, Column], codes: Codes, flag_col: str, max_inline: int = MAX_INLINE_BYTES,
    max_index: int = MAX_INDEX_BYTES,
) -> DataFrame:
    """Add a boolean: some column of ``conditions``, as text, starts with a code where its condition holds.

    Row count never changes. A list too large to inline is a hashed index, looked up in the scan. For a list over ``max_index`` bytes
    the distinct prefixes of all columns are exploded for one left equi-join with the codes; a row comes together again by two hashes
    of its columns, copies of a row as often as they were.
    """
    known = inline_codes(codes, max_inline)
    if known is not None:
        hit = F.lit(False)
        for name, condition in conditions.items():
            hit = hit | (starts_with_any(name, known) & condition)
        return df.withColumn(flag_col, F.coalesce(hit, F.lit(False)))

    listed = saved(_code_frame(df, codes, "_listed"), "codes")
    index = code_index(listed, max_index)
    if index is not None:
        hits = [condition & index.holds(prefix_of(name, n)) for name, condition in conditions.items() for n in index.lengths]
        return df.withColumn(flag_col, F.coalesce(_any(hits), F.lit(False)))
    lengths = _code_lengths(listed, "_listed")
    found = [F.when(conditions[c], p) for c in conditions for p in _prefixes([c], lengths)]
    rows = df.select(
        F.struct(*df.columns).alias("_row"), F.xxhash64(*df.columns).alias("_h1"), F.xxhash64(F.lit(1), *df.columns).alias("_h2"),
        F.array_compact(F.array_distinct(F.array(*found))).alias("_found"),
    )
    # the first element stands for the row itself; it is no code, and differs from row to row so that it makes no hot key
    marker = F.concat(F.lit("\u0000"), F.col("_h1").cast("string"))
    parts = rows.select("_row", "_h1", "_h2", F.posexplode(F.concat(F.array(marker), "_found")).alias("_pos", "_listed"))
    matched = lookup_join(parts, listed.withColumn("_mark", F.lit(True)), ["_listed"], "left")
    back = matched.groupBy("_h1", "_h2").agg(
        F.first("_row").alias("_row"), F.count_if(F.col("_pos") == 0).alias("_copies"), F.max(F.col("_mark").isNotNull()).alias(flag_col)
    )
    return back.select("_row.*", flag_col, F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")).alias("_n")).drop("_n")


def restrict_to(df: DataFrame, cohort: DataFrame, id_col: str = "enrolid") -> DataFrame:
    """Rows of the patients in the cohort."""
    return lookup_join(df, cohort.select(id_col), [id_col], "left_semi")


def exclude(df: DataFrame, others: DataFrame, id_col: str = "enrolid") -> DataFrame:
    """Rows of the patients not in ``others``."""
    return lookup_join(df, others.select(id_col), [id_col], "left_anti")


def attach_generic(
    claims: DataFrame, code_list: DataFrame, claim_col: str, list_col: str, extra: Sequence[str] = ()
) -> DataFrame:
    """Inner join to a code list for its generic name; a code listed twice yields two rows."""
    named = code_list.select(F.col(list_col).alias(claim_col), "generic_name", *extra)
    return lookup_join(claims, named, [claim_col])
