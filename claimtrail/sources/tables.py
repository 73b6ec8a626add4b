"""Reading, writing and listing the study's tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from claimtrail.functions.codes import as_list
from claimtrail.functions.dates import days_since_1960
from claimtrail.sources.buckets import buckets_of, hottest, into_buckets
from claimtrail.sources.intervals import YEARS, with_years
from claimtrail.sources.manifest import STAGED, digest, drop_entry, entry_of, list_folder, recover, set_entry, staged, swap_in
from claimtrail.sources.schemas import as_text

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def normalize(
    df: DataFrame, date_cols: Sequence[str] = (), string_cols: Sequence[str] = (), code_widths: Mapping[str, int] | None = None
) -> DataFrame:
    """Lower-case column names, named date columns as DATE, named code columns as text.

    Numbers in a column of ``code_widths`` get back the leading zeros of a code of that width.
    """
    out = df.toDF(*[c.lower() for c in df.columns])
    casts = {c: F.col(c).cast("date") for c in date_cols if c in out.columns}
    widths = dict.fromkeys(string_cols) | dict(code_widths or {})
    casts |= {c: as_text(F.col(c), out.schema[c].dataType, width) for c, width in widths.items() if c in out.columns}
    return out.withColumns(casts) if casts else out


def dates_to_day_numbers(df: DataFrame) -> DataFrame:
    """Every date and timestamp column as whole days from 1960-01-01."""
    dated = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({name: days_since_1960(F.col(name)) for name in dated}) if dated else df


def create_libraries(spark: SparkSession, names: Iterable[str], folder: str | None = None) -> None:
    """Databases of the given names, under ``folder`` if given, else in the warehouse."""
    for name in names:
        place = f" LOCATION '{folder}/{name}'" if folder else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def drop_libraries(spark: SparkSession, names: Iterable[str]) -> None:
    """Drop databases with all their tables and files."""
    for name in names:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def ingest_table(
    spark: SparkSession,
    path: str,
    table: str,
    fmt: str = "parquet",
    if_exists: str = "fail",
    date_cols: Sequence[str] = (),
    string_cols: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    code_widths: Mapping[str, int] | None = None,
    interval: tuple[str, str] | None = None,
    entry: Mapping[str, object] | None = None,
    **options: str,
) -> int:
    """Load one file (or folder) into a table. ``if_exists`` is ``fail``, ``replace`` or ``append``.

    ``interval`` names the columns of begin and end of a table of intervals, which is then laid out by the years of both.
    """
    rows = normalize(spark.read.format(fmt).options(**options).load(path), date_cols, string_cols, code_widths)
    if interval is None:
        return materialize(rows, table, if_exists, partition_by, entry=entry)
    begin, end = interval
    return materialize(with_years(rows, begin, end), table, if_exists, (*partition_by, *YEARS), (end, begin), entry)


def ingest_library(
    spark: SparkSession,
    files: dict[str, str],
    library: str,
    fmt: str = "parquet",
    refresh: bool = False,
    intervals: Mapping[str, tuple[str, str]] | None = None,
    **options,
) -> dict[str, int | None]:
    """Load named files into a library. A table that exists is left alone (``None``) unless ``refresh`` is set.

    ``intervals`` gives, by a shard's scope letter, the columns of begin and end of shards that hold intervals.
    """
    loaded: dict[str, int | None] = {}
    for name, path in files.items():
        table = f"{library}.{name}"
        if spark.catalog.tableExists(table) and not refresh:
            loaded[name] = None
            continue
        interval = (intervals or {}).get(name[4:5].lower())
        loaded[name] = ingest_table(spark, path, table, fmt, "replace" if refresh else "fail", interval=interval, **options)
    return loaded


def ingest_folder(
    spark: SparkSession,
    folder: str,
    library: str,
    fmt: str = "parquet",
    suffix: str | None = None,
    intervals: Mapping[str, tuple[str, str]] | None = None,
    **options,
) -> dict[str, int | None]:
    """Load the files of a folder that are new or have changed since they were loaded, or are loaded in another way; the others are ``None``.

    A changed file replaces its table, which stays whole until the new one is. Tables of files that are gone stay.
    """
    loaded: dict[str, int | None] = {}
    for name, (path, state) in list_folder(spark, folder, suffix or f".{fmt}").items():
        table, interval = f"{library}.{name}", (intervals or {}).get(name[4:5].lower())
        wanted = {"inputs": state, "parameters": digest(path, fmt, interval, sorted(options.items()))}
        recover(spark, table)
        held = entry_of(spark, table)
        if all(held.get(k) == v for k, v in wanted.items()):
            loaded[name] = None
            continue
        loaded[name] = ingest_table(spark, path, table, fmt, "replace", interval=interval, entry=wanted, **options)
    return loaded


def library_files(paths: Iterable[str], suffix: str = ".parquet") -> dict[str, str]:
    """Table name -> path, for the paths with the given suffix."""
    return {PurePosixPath(p).name.removesuffix(suffix).lower(): p for p in paths if p.endswith(suffix)}


def materialize(
    df: DataFrame, table: str, if_exists: str = "replace", partition_by: Sequence[str] = (), order_by: Sequence[str] = (),
    entry: Mapping[str, object] | None = None, bucket_by: tuple[str, int] | None = None, watch: str | None = None,
) -> int:
    """Write a table and return its row count, counted while writing. With ``order_by``, files hold ranges of these columns, in order.

    A replaced table is written beside the old one and swapped in when whole: if the job fails the old table stays, and ``df`` may read it.
    ``partitions`` replaces only the partitions that ``df`` has rows for. ``entry`` is kept with the table (see ``manifest``). With
    ``bucket_by`` (column, number) the table is stored in buckets, sorted by the column; what is appended keeps to them. ``watch`` names a
    column whose most frequent value is looked for in the written table, by a scan of this column; its number of rows is kept as ``hottest``.
    """
    if if_exists not in ("replace", "append", "fail", "partitions"):
        raise ValueError("if_exists must be replace, append, fail or partitions")
    if bucket_by and (partition_by or order_by):
        raise ValueError("a table in buckets has neither partitions nor ranges")
    spark = df.sparkSession
    recover(spark, table)
    exists = spark.catalog.tableExists(table)
    if exists and if_exists == "fail":
        raise ValueError(f"table {table} exists")
    if exists and if_exists != "replace":
        bucket_by = buckets_of(spark, table)
    written, counted = _counted(df, partition_by, order_by, bucket_by)
    if exists and if_exists != "replace":
        drop_entry(spark, table)  # what was known of the table no longer holds, but for its buckets
        if bucket_by:
            set_entry(spark, table, _layout(bucket_by))
        if if_exists == "append":
            _arranged(written.write.mode("append"), partition_by, bucket_by).saveAsTable(table)
        else:
            columns = [F.col(f"`{c}`") for c in spark.table(table).columns]
            before = spark.conf.get(OVERWRITE_MODE)  # of inserts into tables only the session's setting counts
            spark.conf.set(OVERWRITE_MODE, "dynamic")
            try:
                written.select(*columns).write.insertInto(table, overwrite=True)
            finally:
                spark.conf.set(OVERWRITE_MODE, before)
        return counted.get["rows"]
    version = staged(table)
    _arranged(written.write, partition_by, bucket_by).saveAsTable(version)
    seen = {"hottest": spark.table(version).agg(hottest(watch)).first()[0] or 0} if watch else {}
    set_entry(spark, version, {"rows": counted.get["rows"], **seen, **_layout(bucket_by), **(entry or {})})
    swap_in(spark, version, table)
    return counted.get["rows"]


def _layout(bucket_by: tuple[str, int] | None) -> dict[str, str]:
    return {"buckets": f"{bucket_by[0]}:{bucket_by[1]}"} if bucket_by else {}


def _arranged(writer: DataFrameWriter, partition_by: Sequence[str], bucket_by: tuple[str, int] | None) -> DataFrameWriter:
    if bucket_by:
        column, count = bucket_by
        writer = writer.bucketBy(count, column).sortBy(column)
    return writer.partitionBy(*partition_by) if partition_by else writer


def write_folder(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> int:
    """Write a Parquet folder and return its row count, counted while writing."""
    written, counted = _counted(df, partition_by)
    writer = written.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return counted.get["rows"]


def _counted(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str] = (), bucket_by: tuple[str, int] | None = None
) -> tuple[DataFrame, Observation]:
    counted = Observation()
    if order_by:
        df = df.repartitionByRange(*partition_by, *order_by).sortWithinPartitions(*partition_by, *order_by)
        return df.observe(counted, F.count(F.lit(1)).alias("rows")), counted  # above the exchange, whose bounds are sampled first
    out = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if bucket_by:
        return into_buckets(out, *bucket_by), counted
    # rebalance gathers each partition value into few files and lets AQE split a value that holds most of the rows
    return (out.hint("rebalance", *partition_by) if partition_by else out), counted


def list_tables(spark: SparkSession, library: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(library) if not t.isTemporary and STAGED not in t.name)


def list_columns(df: DataFrame) -> list[str]:
    return [c.lower() for c in df.columns]


def column_dtypes(df: DataFrame) -> list[tuple[str, str]]:
    return [(name.lower(), dtype) for name, dtype in df.dtypes]


def expand_var_range(df: DataFrame, names: str | Sequence[str]) -> list[str]:
    """``"age, dx1-dx4"`` -> column names in the list's order. ``dx1-dx4`` is a numbered range."""
    parts = as_list(names)
    have = list_columns(df)
    found: list[str] = []
    for part in (p.lower() for p in parts):
        members = [part] if part in have else _numbered_range(part)
        missing = [m for m in members if m not in have]
        if missing:
            raise ValueError(f"no such column: {', '.join(missing)}")
        found.extend(m for m in members if m not in found)
    return found


def _numbered_range(part: str) -> list[str]:
    first, _, last = part.partition("-")
    stem = first.rstrip("0123456789")
    if not last or not last.startswith(stem) or not first[len(stem):] or not last[len(stem):].isdigit():
        return [part]
    return [f"{stem}{i}" for i in range(int(first[len(stem):]), int(last[len(stem):]) + 1)]


def classify_variables(
    df: DataFrame, categorical: Sequence[str] = (), exclude: Sequence[str] = ()
) -> dict[str, list[str]]:
    """Sort columns by the statistics they get: named ones categorical, other text and booleans dichotomous, numbers and dates continuous.

    A column of any other type (a timestamp, an array) has no statistics and must be excluded by name.
    """
    named = {c.lower() for c in categorical}
    skipped = {c.lower() for c in exclude}
    kinds: dict[str, list[str]] = {"continuous": [], "dichotomous": [], "categorical": []}
    for field in df.schema.fields:
        name = field.name.lower()
        if name in skipped:
            continue
        if name in named:
            kinds["categorical"].append(field.name)
        elif isinstance(field.dataType, (T.NumericType, T.DateType)):
            kinds["continuous"].append(field.name)
        elif isinstance(field.dataType, (T.StringType, T.BooleanType)):
            kinds["dichotomous"].append(field.name)
        else:
            raise ValueError(f"no statistics for {field.name} of type {field.dataType.simpleString()}; exclude it")
    return kinds
