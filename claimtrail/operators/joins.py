"""Joins of a large table to a smaller one that stay even when one key holds much of the large table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from claimtrail.operators.index import common_types, key_filter, key_hash
from claimtrail.sources.scratch import settle

MAX_BROADCAST_BYTES = 8 << 20  # of files; some times that in memory
BYTES_PER_TASK = 32 << 20  # of stored files; some ten times that in memory once it is unpacked and sorted
ROWS_PER_TASK = 1_000_000
MAX_HOT_KEYS = 10_000  # broadcast with their salts: 10,000 short rows
TRACKED = 10_000  # keys of a sketch
MERGERS = 64  # tasks that merge the sketches before the last one
_THROUGH = ("Project", "Filter", "SubqueryAlias")


def saved_bytes(df: DataFrame) -> int | None:
    """Size of the stored files that a table is read from, or ``None`` if it is more than a selection from one of them."""
    plan = df._jdf.queryExecution().optimizedPlan()
    node = plan
    while node.nodeName() in _THROUGH:
        node = node.children().apply(0)
    return int(str(node.stats().sizeInBytes())) if node.nodeName().startswith("LogicalRelation") else None


def saved(df: DataFrame, name: str = "small") -> DataFrame:
    """The table itself if it is stored, else a written copy of it, so that its size is known and it is computed once."""
    return df if saved_bytes(df) is not None else settle(df, name)


def spread_over(*tables: DataFrame, bytes_per_task: int = BYTES_PER_TASK) -> int | None:
    """How many tasks the rows of stored tables need, or ``None`` where an exchange has as many anyway or not all leaves are stored files."""
    spark, total = tables[0].sparkSession, 0
    for table in tables:
        leaves = table._jdf.queryExecution().optimizedPlan().collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            if not leaf.nodeName().startswith("LogicalRelation"):
                return None
            total += int(str(leaf.stats().sizeInBytes()))
    wanted = -(-total // bytes_per_task)
    return wanted if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def spread_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """Inner join of two large stored tables, in so many tasks that none sorts more than ``bytes_per_task`` of their files, whatever the
    session's number of shuffle partitions."""
    n = spread_over(left, right, bytes_per_task=bytes_per_task)
    if n:
        left, right = left.repartition(n, left_key), right.repartition(n, right_key)
    return left.join(right, F.col(left_key) == F.col(right_key))


def spread_distinct(df: DataFrame, bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """Distinct rows, in so many tasks that the rows each holds don't grow with the table, whatever the session's number of shuffle partitions."""
    n = spread_over(df, bytes_per_task=bytes_per_task)
    return (df.repartition(n, *df.columns) if n else df).distinct()


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK, kinds: Sequence[T.DataType] | None = None) -> DataFrame:
    """``_key, _salts``: hashes of the keys with more rows than a task should hold, and how many salts bring each under that.

    Found by a mergeable sketch of the most frequent keys, so only the key columns are read and no key is shuffled, just one sketch of
    at most ``TRACKED`` keys per task; sketches are merged in two steps. A key with over one row in 2,500 is never missed; counts are
    estimates, which only changes the number of salts.
    """
    hashed = df.select(key_hash(keys, kinds or [df.schema[k].dataType for k in keys]).alias("_key"))
    parts = hashed.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("_part")).agg(F.expr(f"approx_top_k_accumulate(_key, {TRACKED})").alias("_s"))
    merged = parts.groupBy(F.lit(0).alias("_one")).agg(F.expr(f"approx_top_k_combine(_s, {TRACKED})").alias("_s"))  # no row without sketches
    found = merged.select(F.expr(f"inline(approx_top_k_estimate(_s, {MAX_HOT_KEYS}))")).where(F.col("count") > rows_per_task)
    return found.select(F.col("item").alias("_key"), F.ceil(F.col("count") / rows_per_task).cast("int").alias("_salts"))


def split_join(
    df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Shuffle join in which the rows of a hot key go to as many tasks as they need.

    Where rows without a partner are dropped, a Bloom filter of the keys of ``small`` drops nearly all of them in the scan, before the
    exchange. A semi join writes what passes once, so a large table is scanned once; its hot keys are then looked for in the written rows.
    Only the hot keys' rows of ``small`` are repeated, once per salt; all other keys have the one salt 0. The salt is a hash of the row,
    so a recomputed task sends its rows to the same places. ``how`` may be any join that keeps or drops rows of ``df`` one by one.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot split a {how} join")
    keys = list(keys)
    kinds = common_types(df, small, keys)
    if how in ("inner", "left_semi"):
        partners = key_filter(settle(small.select(key_hash(keys, kinds).alias("_key")).distinct(), "keys"))
        if partners:
            df = df.where(partners.may_hold(key_hash(keys, kinds)))
            df = settle(df, "candidates") if how == "left_semi" else df
    hot = saved(hot_keys(df, keys, rows_per_task, kinds), "hot-keys")
    salts = F.coalesce("_salts", F.lit(1))
    left = df.withColumn("_key", key_hash(keys, kinds)).join(F.broadcast(hot), "_key", "left")
    left = left.withColumn("_salt", F.when(salts > 1, F.pmod(F.xxhash64(*df.columns), salts).cast("int")).otherwise(0)).drop("_salts", "_key")
    right = small.withColumn("_key", key_hash(keys, kinds)).join(F.broadcast(hot), "_key", "left")
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts", "_key")
    joined = left.join(right, [*keys, "_salt"], how).drop("_salt")
    return joined.select(*keys, *[c for c in joined.columns if c not in keys])


def lookup_join(
    df: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join to a patient or code table: broadcast when its stored size fits the bound, otherwise with hot keys split.

    A ``small`` that is not stored yet is written once, for semi and anti joins without repeats.
    """
    if how in ("left_semi", "left_anti") and saved_bytes(small) is None:
        small = small.select(*keys).distinct()
    small = saved(small)
    if saved_bytes(small) <= max_bytes:
        return df.join(F.broadcast(small), list(keys), how)
    return split_join(df, small, keys, how, rows_per_task)
