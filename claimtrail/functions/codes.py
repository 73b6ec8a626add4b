"""Column functions that bring medical codes into the form the claims tables use."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

# A code list of up to so many bytes is put into the plan as hashed IN-sets (no join at all); a larger one is joined.
# Both give the same rows.
MAX_INLINE_BYTES = 16 << 10
_CODE_OVERHEAD = 8


def clean_icd9(code: Column) -> Column:
    """Drop the padding letter ``x`` and the dot: ``696.1x`` -> ``6961``."""
    return F.translate(code, "x.", "")


def zfill(text: Column, width: int) -> Column:
    """Left-pad with zeros, leaving longer text whole (``lpad`` alone would cut it)."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def ndc_11(ndc: Column) -> Column:
    """11-character NDC: a three-part code is padded 5-4-2, anything else is joined and padded to 11."""
    parts = F.split(ndc, "-")
    padded = F.concat(*[zfill(parts.getItem(i), w) for i, w in enumerate((5, 4, 2))])
    return F.when(F.size(parts) == 3, padded).otherwise(zfill(F.translate(ndc, "-", ""), 11))


def as_list(names: str | Iterable[str]) -> list[str]:
    """A list, also from text with commas or blanks between the names: ``"pdx, dx1 dx2"``."""
    return names.replace(",", " ").split() if isinstance(names, str) else list(names)


def inline_codes(codes: str | Iterable[str] | DataFrame, max_bytes: int = MAX_INLINE_BYTES) -> list[str] | None:
    """The distinct non-empty codes as a Python list, or ``None`` when they take more than ``max_bytes``.

    Each code counts its bytes and 8 more, so a DataFrame is read with a limit and the driver never holds much over the bound.
    """
    if isinstance(codes, DataFrame):
        found = [r[0] for r in distinct_codes(codes).limit(max_bytes // (_CODE_OVERHEAD + 1) + 1).collect()]
    else:
        found = list(dict.fromkeys(c for c in as_list(codes) if c))
    size = sum(len(c.encode()) + _CODE_OVERHEAD for c in found)
    return sorted(found) if size <= max_bytes else None


def distinct_codes(codes: DataFrame, name: str | None = None) -> DataFrame:
    """One-column code list without NULL, empty or repeated codes."""
    first = codes.columns[0]
    return codes.select(F.col(first).cast("string").alias(name or first)).where(F.col(name or first) != "").distinct()


def by_length(codes: Iterable[str]) -> dict[int, list[str]]:
    groups: dict[int, list[str]] = {}
    for code in codes:
        groups.setdefault(len(code), []).append(code)
    return dict(sorted(groups.items()))


def _listed(codes: Iterable[str]) -> str:
    return ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in codes)


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def is_listed(column: str, codes: Iterable[str]) -> Column:
    """The column is one of ``codes``. The list goes in as text, so a long one costs one call and one hashed set."""
    return F.expr(f"CAST({_name(column)} AS STRING) IN ({_listed(codes)})")


def prefix_of(column: str, length: int) -> Column:
    return F.substring(F.col(column).cast("string"), 1, length)


def has_prefix(column: str, length: int, codes: Iterable[str]) -> Column:
    """The first ``length`` characters of the column are one of ``codes``."""
    return F.expr(f"substring(CAST({_name(column)} AS STRING), 1, {length}) IN ({_listed(codes)})")


def starts_with_any(column: str, codes: Iterable[str]) -> Column:
    """True when the column begins with one of ``codes``; never NULL. One hashed set per code length."""
    hit = F.lit(False)
    for length, group in by_length(codes).items():
        hit = hit | has_prefix(column, length, group)
    return F.coalesce(hit, F.lit(False))
