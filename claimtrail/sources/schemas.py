"""One schema for tables of different types, found from their schemas alone; no data is read for it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_FRACTION = [T.FloatType, T.DoubleType]
_PLAIN = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType, T.BinaryType)
MAX_DIGITS = 38


@dataclass(frozen=True)
class Clash:
    """A column that has several types: the type in each table, and the one all take."""

    column: str
    types: tuple[tuple[str, str], ...]
    taken: str


def _decimal(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of a whole or decimal type."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    digits = _WHOLE_DIGITS.get(type(kind))
    return None if digits is None else (digits, 0)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds every value of both without loss: numbers widen among themselves, anything else becomes text.

    It doesn't matter in which order types are put together. Nested types have no such bound unless they are equal.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if not (isinstance(a, _PLAIN) and isinstance(b, _PLAIN)):
        raise ValueError(f"{a.simpleString()} and {b.simpleString()} have no common type")
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max((a, b), key=lambda t: _WHOLE.index(type(t)))
    if kinds & set(_FRACTION) and kinds <= {*_FRACTION, *_WHOLE[:3]}:  # a double holds every 32-bit number, not every 64-bit one
        return T.DoubleType()
    if T.DecimalType in kinds and kinds <= {T.DecimalType, *_WHOLE}:
        (before, after), (more_before, more_after) = _decimal(a), _decimal(b)
        before, after = max(before, more_before), max(after, more_after)
        return T.DecimalType(before + after, after) if before + after <= MAX_DIGITS else T.StringType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return T.StringType()


def as_text(value: Column, kind: T.DataType, width: int | None = None) -> Column:
    """A value as text. Whole numbers have no decimal point; with ``width``, numbers get back the zeros that a code of that width begins with."""
    if isinstance(kind, T.BinaryType):
        return value.cast("string")
    text = value.cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e18)
        text = F.when(whole, value.cast("decimal(20,0)").cast("string")).otherwise(text)
    if width is None or not isinstance(kind, T.NumericType):
        return text
    return F.when(text.rlike("^[0-9]+$") & (F.length(text) < width), F.lpad(text, width, "0")).otherwise(text)


def _lower(df: DataFrame, name: str) -> DataFrame:
    names = [c.lower() for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"table {name} has columns whose names differ in letter case only: {', '.join(twice)}")
    return df.toDF(*names)


def reconcile(tables: Mapping[str, DataFrame], code_widths: Mapping[str, int] | None = None) -> tuple[T.StructType, list[Clash]]:
    """The schema that all tables fit into, lower-case names in the order first seen, and the columns that have several types.

    Columns in ``code_widths`` are codes, hence text, whatever they are in the tables.
    """
    widths = {c.lower(): w for c, w in (code_widths or {}).items()}
    seen: dict[str, dict[str, T.DataType]] = {}
    for name, df in tables.items():
        for field in _lower(df, name).schema.fields:
            seen.setdefault(field.name, {})[name] = field.dataType
    fields, clashes = [], []
    for column, kinds in seen.items():
        taken: T.DataType = T.StringType() if column in widths else T.NullType()
        try:
            for kind in kinds.values():
                taken = wider(taken, kind)
        except ValueError as problem:
            raise ValueError(f"column {column}: {problem}, in {', '.join(kinds)}") from None
        fields.append(T.StructField(column, taken))
        if len(set(kinds.values())) > 1:
            clashes.append(Clash(column, tuple((t, k.simpleString()) for t, k in kinds.items()), taken.simpleString()))
    return T.StructType(fields), clashes


def conform(df: DataFrame, schema: T.StructType, code_widths: Mapping[str, int] | None = None, name: str = "") -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``; columns that it doesn't have are NULL."""
    widths = {c.lower(): w for c, w in (code_widths or {}).items()}
    df = _lower(df, name)
    own = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        if field.name not in own:
            value = F.lit(None).cast(field.dataType)
        elif isinstance(field.dataType, T.StringType) and not isinstance(own[field.name], T.StringType):
            value = as_text(F.col(f"`{field.name}`"), own[field.name], widths.get(field.name))
        else:
            value = F.col(f"`{field.name}`").cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def clash_report(spark: SparkSession, clashes: list[Clash]) -> DataFrame:
    """``column, table, type, taken``: a row for each table that has a column of several types."""
    rows = [(c.column, table, kind, c.taken) for c in clashes for table, kind in c.types]
    return spark.createDataFrame(rows, "column string, table string, type string, taken string")
