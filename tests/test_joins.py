from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimtrail.operators.index import key_filter
from claimtrail.operators.joins import hot_keys, lookup_join, saved, saved_bytes, split_join
from claimtrail.sources.scratch import settle
from tests.conftest import rows


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_paths_agree(spark, how, plan):
    hot = [(7, i % 5) for i in range(300)] + [(i, i) for i in range(30)] + [(None, 1)]
    df = spark.createDataFrame(hot, "enrolid int, v int")
    columns = "enrolid int" if how in ("left_semi", "left_anti") else "enrolid int, w string"
    small = spark.createDataFrame([(7, "a"), (7, "b"), (3, "c"), (99, "d"), (None, "e")], "enrolid int, w string")
    small = small.select(*[c.split()[0] for c in columns.split(", ")])
    wanted = rows(df.join(small, "enrolid", how))
    broadcast = lookup_join(df, small, ["enrolid"], how)
    salted = lookup_join(df, small, ["enrolid"], how, max_bytes=1, rows_per_task=50)
    assert rows(broadcast) == wanted and rows(salted) == wanted
    assert "BroadcastHashJoin" in plan(broadcast) and "_salt" in plan(salted)


def test_split_join_refuses_right_side_joins(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        split_join(df, df, ["id"], "full")


def test_only_hot_keys_are_salted(spark):
    df = spark.createDataFrame([(7,)] * 95 + [(8,)] * 10 + [(9,)], "enrolid int")
    hot = df.select(F.xxhash64(F.lit(7))).first()[0]
    assert rows(hot_keys(df, ["enrolid"], 10)) == [(hot, 10)]
    assert rows(hot_keys(df.where("enrolid < 0"), ["enrolid"], 10)) == []


def test_hot_keys_are_not_shuffled(spark, plan):
    """Many keys: each task sends a sketch, and no exchange is keyed on the key."""
    df = spark.range(0, 50_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("enrolid"))
    found = hot_keys(df, ["enrolid"], 5_000)
    assert len(rows(found)) == 1 and 3 <= found.first()["_salts"] <= 5
    assert "hashpartitioning(_key" not in plan(found)


def test_key_filter_passes_every_key_and_few_others(spark):
    keys = settle(spark.range(0, 20_000, 2).select(F.xxhash64("id").alias("_key")))
    bloom = key_filter(keys)
    tested = spark.range(0, 20_000).withColumn("hit", bloom.may_hold(F.xxhash64("id")))
    hits = {bool(r["even"]): r["n"] for r in tested.where("hit").groupBy((F.col("id") % 2 == 0).alias("even")).agg(F.count("*").alias("n")).collect()}
    assert hits[True] == 10_000 and hits.get(False, 0) < 300
    assert key_filter(keys, 1 << 15) is None
    nothing = key_filter(settle(keys.where("false")))
    assert tested.where(nothing.may_hold(F.xxhash64("id"))).count() == 0


def test_a_semi_join_scans_the_large_table_once(spark, tmp_path, plan):
    """What is written, searched for hot keys and joined are the rows that pass the filter, near the cohort's."""
    spark.range(0, 30_000).selectExpr("cast(id % 3000 as int) enrolid", "id v").write.parquet(str(tmp_path / "claims"))
    claims = spark.read.parquet(str(tmp_path / "claims")).where("v > 5")
    cohort = spark.range(0, 300).selectExpr("id * 10 AS enrolid")  # bigint beside int
    found = lookup_join(claims, cohort, ["enrolid"], "left_semi", max_bytes=1)
    assert str(tmp_path / "claims") not in plan(found)
    read = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in found.inputFiles() if "/candidates-" in f})
    assert read.count() < 1.1 * found.count()
    assert rows(found) == rows(claims.where("enrolid % 10 = 0"))
    inner = lookup_join(claims, cohort.selectExpr("enrolid", "enrolid + 1 AS w"), ["enrolid"], max_bytes=1)
    assert rows(inner, "enrolid", "v") == rows(found)


def test_keys_of_different_types(spark):
    texts = spark.createDataFrame([("7", 1), ("07", 2), ("8", 3)], "enrolid string, v int")
    numbers = spark.createDataFrame([(7,), (9,)], "enrolid int")
    wanted = rows(texts.join(numbers, "enrolid", "left_semi"))
    assert len(wanted) == 2 and rows(lookup_join(texts, numbers, ["enrolid"], "left_semi", max_bytes=1, rows_per_task=1)) == wanted


def test_stored_tables_know_their_size(spark, tmp_path):
    df = spark.createDataFrame([(i, "a") for i in range(50)], "enrolid int, w string")
    assert saved_bytes(df) is None
    stored = saved(df)
    assert 0 < saved_bytes(stored) < 10_000 and saved_bytes(stored.select("enrolid")) is not None
    assert saved(stored) is stored and saved_bytes(stored.distinct()) is None
