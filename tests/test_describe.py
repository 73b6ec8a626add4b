from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from claimtrail.operators.describe import (
    desc_stat_c, desc_stat_d, desc_stat_n, descriptive_stats, freq_sparse, quantiles, summary_rollup,
)
from claimtrail.operators.reshape import outer_union, to_long, vec2mat, with_pseudo_group
from tests.conftest import rows


def definition_5(values, p):
    ordered = sorted(values)
    place = len(ordered) * p
    whole = int(place)
    if place == whole:
        return (ordered[max(whole, 1) - 1] + ordered[whole]) / 2 if whole else ordered[0]
    return ordered[whole]


def samples():
    rng = random.Random(5)
    yield "one", [3.0]
    yield "two", [1.0, 2.0]
    yield "four", [1.0, 2.0, 3.0, 4.0]
    yield "constant", [7.5] * 9
    yield "signs", [rng.uniform(-5, 5) for _ in range(201)] + [0.0] * 40
    yield "heavy", [rng.lognormvariate(0, 6) for _ in range(400)]
    yield "offset", [1e9 + rng.randrange(1000) for _ in range(300)]
    yield "hot", [5.0] * 400 + [rng.uniform(4.9999, 5.0001) for _ in range(200)]
    yield "tiny", [rng.uniform(-1e-9, 1e-9) for _ in range(100)]


def test_quantiles_are_exact(spark):
    data = [(name, "x", v) for name, values in samples() for v in values] + [("one", "x", None), ("one", "x", float("nan"))]
    df = spark.createDataFrame(data, "group string, varname string, v double")
    got = {r["group"]: r for r in quantiles(df, {"a": 0.25, "b": 0.5, "c": 0.75, "d": 0.9}).collect()}
    for name, values in samples():
        for column, p in (("a", 0.25), ("b", 0.5), ("c", 0.75)):
            assert got[name][column] == pytest.approx(definition_5(values, p), rel=1e-15), (name, p)


def test_desc_stat_n(spark):
    df = spark.createDataFrame([("g", 1), ("g", 2), ("g", 3), ("g", 4), ("h", 5), (None, 100)], "grp string, age int")
    got = {(r["group"], r["stat"]): r["value"] for r in desc_stat_n(df, ["age"], "grp").collect()}
    assert (got["g", "Mean"], got["g", "Median"], got["g", "Q1"], got["g", "Q3"]) == (2.5, 2.5, 1.5, 3.5)
    assert got["g", "Std"] == pytest.approx(statistics.stdev([1, 2, 3, 4]))
    assert got["h", "Std"] is None and got["h", "Q1"] == 5.0
    assert {g for g, _ in got} == {"g", "h"}


def test_desc_stat_c_and_d(spark):
    df = spark.createDataFrame(
        [("g", "a", "1"), ("g", "b", "0"), ("g", " ", "1"), ("h", "a", None), (None, "a", "1")], "grp string, c string, d string"
    )
    labelled = df.withColumn("c", F.col("c").alias("c", metadata={"label": "Category"}))
    got = {(r["group"], r["varlvl"], r["stat"]): r["value"] for r in desc_stat_c(labelled, ["c"], "grp").collect()}
    assert got == {
        ("g", "a", "N"): 1, ("g", "a", "Perc"): 50, ("g", "b", "N"): 1, ("g", "b", "Perc"): 50, ("h", "b", "N"): 0, ("h", "b", "Perc"): 0, ("h", "a", "N"): 1,
        ("h", "a", "Perc"): 100, ("Overall", "a", "N"): 2, ("Overall", "a", "Perc"): None, ("Overall", "b", "N"): 1,
        ("Overall", "b", "Perc"): None,
    }
    assert {r["varname"] for r in desc_stat_c(labelled, ["c"], "grp").collect()} == {"Category"}
    got = {(r["group"], r["stat"]): r["value"] for r in desc_stat_d(df, ["d"], "grp").collect()}
    assert got == {
        ("g", "N"): 2, ("g", "Perc"): pytest.approx(2 / 3), ("h", "N"): 0, ("h", "Perc"): 0,
        ("Overall", "N"): 3, ("Overall", "Perc"): 0.6,
    }


def test_rollup_and_sparse(spark):
    df = spark.createDataFrame([("g", 1.0, "x"), ("g", 3.0, "y"), ("h", 5.0, "x")], "grp string, v double, lvl string")
    got = {(r["group"], r["stat"]): r["value"] for r in summary_rollup(df, "v", "grp").collect()}
    assert got["Overall", "N"] == 3 and got["Overall", "MEAN"] == 3 and got["g", "MAX"] == 3 and got["h", "STD"] is None
    assert rows(freq_sparse(df, "grp", "lvl")) == [("g", "x", 1), ("g", "y", 1), ("h", "x", 1), ("h", "y", 0)]


def test_descriptive_stats_by_kind(spark):
    df = spark.createDataFrame([("g", 1, "1", "x", 9), ("h", 2, "0", "y", 8)], "grp string, age int, flag string, cat string, id int")
    stats = descriptive_stats(df, ["cat"], ["id"], "grp", "All")
    assert {r["varname"] for r in stats.collect()} == {"age", "flag", "cat"}
    assert {r["group"] for r in stats.where("varname = 'age'").collect()} == {"g", "h", "All"}
    with pytest.raises(ValueError):
        descriptive_stats(df.select("grp"), [], [], "grp")


def test_reshape(spark):
    a = spark.createDataFrame([(1, 2)], "id int, x int")
    b = spark.createDataFrame([(3, "y")], "id int, z string")
    assert rows(outer_union(a, b)) == [(1, 2, None), (3, None, "y")]
    assert rows(to_long(a, ["id"], ["x"])) == [(1, "x", 2)]
    assert rows(with_pseudo_group(a, "grp", "All"), "id", "grp") == [(1, "All"), (1, None)]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 3.0), ("g", float("nan")), ("h", float("nan"))], "grp string, v double")
    got = {(r["group"], r["stat"]): r["value"] for r in desc_stat_n(df, ["v"], "grp").collect()}
    assert (got["g", "Mean"], got["g", "Median"], got["h", "Mean"], got["h", "Q1"]) == (2, 2, None, None)


def test_overall_counts_everyone_once(spark):
    df = spark.createDataFrame([("g", "a", "1"), ("h", "b", "0"), ("h", "b", "1")], "grp string, c string, d string")
    got = {(r["varname"], r["group"], r["varlvl"], r["stat"]): r["value"] for r in descriptive_stats(df, ["c"], [], "grp", "All").collect()}
    assert got["c", "Overall", "b", "N"] == 2 and got["c", "All", "b", "N"] == 2 and got["c", "g", "b", "N"] == 0
    assert got["d", "Overall", "Overall", "N"] == 2 and got["d", "Overall", "Overall", "Perc"] == pytest.approx(2 / 3)


def test_dates_and_booleans_have_statistics(spark):
    df = spark.sql("SELECT * FROM VALUES ('g', date'1970-01-03', true), ('g', date'1970-01-05', false) AS t(grp, day, yes)")
    got = {(r["varname"], r["stat"]): r["value"] for r in descriptive_stats(df, [], [], "grp").where("group = 'g'").collect()}
    assert got["day", "Mean"] == 3 and got["yes", "N"] == 1 and got["yes", "Perc"] == 0.5
    with pytest.raises(ValueError):
        descriptive_stats(df.withColumn("at", F.current_timestamp()), [], [], "grp")


def test_sparse_crosstab_of_awkward_levels(spark):
    df = spark.createDataFrame([("g", "1.5"), ("g", None), ("h", "null"), (None, " "), (None, "1.5")], "grp string, lvl string")
    assert rows(freq_sparse(df, "grp", "lvl")) == sorted(
        [("g", "1.5", 1), ("g", "null", 0), ("h", "1.5", 0), ("h", "null", 1), (None, "1.5", 1), (None, "null", 0)], key=repr)
    tiled = freq_sparse(df, "grp", "lvl", 1, 1)
    assert rows(tiled) == rows(freq_sparse(df, "grp", "lvl"))
    many = spark.range(20_000).select(F.lit("g").alias("grp"), F.col("id").cast("string").alias("lvl"))
    assert freq_sparse(many, "grp", "lvl").count() == 20_000 and freq_sparse(many, "grp", "lvl", 1, 500).count() == 20_000
    assert freq_sparse(df.where("false"), "grp", "lvl").count() == 0


def test_sparse_crosstab_meets_levels_without_a_constant_key(spark, plan):
    df = spark.range(3_000).selectExpr("id % 7 AS grp", "id % 500 AS lvl")
    for found in (freq_sparse(df, "grp", "lvl"), freq_sparse(df, "grp", "lvl", 1, 100)):
        text = plan(found)
        assert "NestedLoop" not in text and "Cartesian" not in text and "_all" not in text
        assert found.count() == 3_500 and found.where("count = 0").count() == 500


def test_flags_of_a_long_dictionary(spark):
    df = spark.createDataFrame([(1, "v.5"), (1, None), (2, "other")], "id int, v string")
    wide = vec2mat(df, "id", "v", {f"v.{i}": f"f{i}" for i in range(2_500)})
    assert rows(wide, "id", "f5", "f6") == [(1, 1, 0), (2, 0, 0)] and len(wide.columns) == 2_501
