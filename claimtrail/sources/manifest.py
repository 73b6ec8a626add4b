"""What is stored, and what it was made from: listings of folders, whole replacement of tables, and their entries in the catalog.

A table's entry (the state of its inputs, the parameters, the row count) is set as table properties once the table is whole, so it comes
and goes with the table and a table without an entry is never taken for finished.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PREFIX = "claimtrail."
STAGED = "__staged"


def _files(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, length, modificationTime`` of the files below the paths, through the session's file system; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return found.select("path", "length", "modificationTime")


def _state() -> Column:
    """One number for a set of files: it changes when a file comes, goes, or changes in size or time."""
    return F.hex(F.coalesce(F.bit_xor(F.xxhash64("path", "length", F.unix_micros("modificationTime"))), F.lit(0)))


def list_folder(spark: SparkSession, folder: str, suffix: str = ".parquet") -> dict[str, tuple[str, str]]:
    """Table name -> (path, state) of the files, or folders of files, in ``folder`` whose name ends with ``suffix`` in any case.

    Everything else in the folder is left alone. The folder must be given from the root; two entries of one table name are refused.
    """
    folder = folder.rstrip("/")
    bare = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "", folder)
    if not bare.startswith("/"):
        raise ValueError(f"give the whole path of {folder}")
    behind = F.expr("substr(path, locate(_folder, path) + length(_folder))")
    entry = F.substring_index(behind, "/", 1).alias("entry")
    found = _files(spark, folder).withColumn("_folder", F.lit(bare + "/")).select(entry, "path", "length", "modificationTime")
    wanted = found.where(F.lower("entry").endswith(suffix.lower())).groupBy("entry").agg(_state().alias("state"))
    listed: dict[str, tuple[str, str]] = {}
    for row in wanted.orderBy("entry").collect():  # a row per table
        name = row["entry"][: -len(suffix)].lower()
        if name in listed:
            raise ValueError(f"{folder} holds {name} twice")
        listed[name] = (f"{folder}/{row['entry']}", row["state"])
    return listed


def state_at(spark: SparkSession, path: str) -> str:
    """State of the files at or below a path."""
    return _files(spark, path).agg(_state().alias("state")).first()["state"]


def state_of(df: DataFrame) -> str:
    """State of the files a table is read from. Selections from them aren't seen."""
    files = df.inputFiles()
    if not files:
        raise ValueError("only a table that is read from files has a state")
    return _files(df.sparkSession, *files).agg(_state().alias("state")).first()["state"]


def digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps([str(p) for p in parts]).encode()).hexdigest()


def _quoted(table: str) -> str:
    return ".".join(f"`{part}`" for part in table.split("."))


def entry_of(spark: SparkSession, table: str) -> dict[str, str]:
    """The entry of a table; empty if there is no such table, or it was not finished."""
    if not spark.catalog.tableExists(table):
        return {}
    held = spark.sql(f"SHOW TBLPROPERTIES {_quoted(table)}").collect()
    return {r["key"].removeprefix(PREFIX): r["value"] for r in held if r["key"].startswith(PREFIX)}


def set_entry(spark: SparkSession, table: str, entry: Mapping[str, object]) -> None:
    text = lambda value: "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
    held = ", ".join(f"{text(PREFIX + key)} = {text(value)}" for key, value in entry.items())
    spark.sql(f"ALTER TABLE {_quoted(table)} SET TBLPROPERTIES ({held})")


def drop_entry(spark: SparkSession, table: str) -> None:
    held = ", ".join(f"'{PREFIX}{key}'" for key in entry_of(spark, table))
    if held:
        spark.sql(f"ALTER TABLE {_quoted(table)} UNSET TBLPROPERTIES IF EXISTS ({held})")


def staged(table: str) -> str:
    """A new name to write the next version of a table under. What a killed job leaves in its folder is in nobody's way."""
    return f"{table}{STAGED}_{uuid.uuid4().hex[:12]}"


def swap_in(spark: SparkSession, version: str, table: str) -> None:
    """Put a finished version in the place of the table. Until then the old one stays whole."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(table)}")
    spark.sql(f"ALTER TABLE {_quoted(version)} RENAME TO {_quoted(table)}")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.sql(f"MSCK REPAIR TABLE {_quoted(table)} SYNC PARTITIONS")  # a catalog may still look for them where they were written


def recover(spark: SparkSession, table: str) -> None:
    """Finish a swap that was broken off, and drop versions that were never finished."""
    library, _, name = table.rpartition(".")
    for found in spark.catalog.listTables(library or None, f"{name}{STAGED}_*".lower()):
        version = f"{library}.{found.name}" if library else found.name
        if entry_of(spark, version):
            swap_in(spark, version, table)
        else:
            spark.sql(f"DROP TABLE {_quoted(version)}")
