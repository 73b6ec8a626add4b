"""Schemas of shards that differ, line numbers of text files, years of shards."""

import itertools
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtrail.sources.numbering import numbered_lines
from claimtrail.sources.schemas import Clash, clash_report, reconcile, wider
from claimtrail.sources.shards import select_shards, shard_parts, union_columns
from claimtrail.sources.tables import ingest_table, normalize
from tests.conftest import rows

TYPES = [
    T.NullType(), T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(9, 2), T.DecimalType(38, 0),
    T.StringType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(),
]


def test_common_types_form_a_lattice():
    for a, b in itertools.product(TYPES, repeat=2):
        assert wider(a, b) == wider(b, a)
        assert wider(wider(a, b), b) == wider(a, b)
    for a, b, c in itertools.product(TYPES, repeat=3):
        assert wider(wider(a, b), c) == wider(a, wider(b, c)), (a, b, c)
    assert wider(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert wider(T.LongType(), T.DoubleType()) == T.StringType()  # a double doesn't hold every long number
    assert wider(T.IntegerType(), T.DecimalType(9, 2)) == T.DecimalType(12, 2)
    with pytest.raises(ValueError, match="no common type"):
        wider(T.ArrayType(T.IntegerType()), T.IntegerType())


def test_text_wins_over_numbers_and_codes_keep_their_zeros(spark):
    shards = {
        "ccaed071": spark.createDataFrame([(1, "00012345678", 450.0, 4019), (2, None, None, None)], "enrolid int, ndcnum string, revcode double, dx1 int"),
        "ccaed081": spark.createDataFrame([(3, 12345678, "0450", "V4341"), (4, 98765432101, "45X", "")], "ENROLID long, ndcnum long, revcode string, dx1 string"),
        "ccaed091": spark.createDataFrame([(5, 7)], "enrolid int, qty int"),
    }
    both = union_columns(shards, {"NDCNUM": 11, "revcode": 4})
    assert both.dtypes == [("enrolid", "bigint"), ("ndcnum", "string"), ("revcode", "string"), ("dx1", "string"), ("tb_name", "string"), ("qty", "int")]
    assert rows(both.select("enrolid", "ndcnum", "revcode", "dx1", "qty", "tb_name")) == sorted([
        (1, "00012345678", "0450", "4019", None, "ccaed071"), (2, None, None, None, None, "ccaed071"), (3, "00012345678", "0450", "V4341", None, "ccaed081"),
        (4, "98765432101", "45X", "", None, "ccaed081"), (5, None, None, None, 7, "ccaed091"),
    ], key=repr)
    _, clashes = reconcile(shards, {"ndcnum": 11})
    assert Clash("dx1", (("ccaed071", "int"), ("ccaed081", "string")), "string") in clashes
    assert {c.column for c in clashes} == {"enrolid", "ndcnum", "revcode", "dx1"}
    report = rows(clash_report(spark, clashes).where("column = 'ndcnum'"))
    assert report == [("ndcnum", "ccaed071", "string", "string"), ("ndcnum", "ccaed081", "bigint", "string")]
    assert clash_report(spark, []).count() == 0


def test_numbers_as_text(spark):
    shards = {
        "a": spark.createDataFrame([(1.5, 10.0, True, date(2007, 1, 2), -5)], "x double, y float, z boolean, d date, n int"),
        "b": spark.createDataFrame([("t", "u", "v", datetime(2007, 1, 2, 3), "-7")], "x string, y string, z string, d timestamp_ntz, n string"),
    }
    both = union_columns(shards, {"n": 4})
    assert rows(both, "x", "y", "z", "n") == [("1.5", "10", "true", "-5"), ("t", "u", "v", "-7")]
    assert dict(both.dtypes)["d"] == "timestamp_ntz"


def test_schemas_come_from_footers(spark, tmp_path, plan):
    for i, kind in enumerate(("int", "string")):
        spark.createDataFrame([(i, str(i))], "enrolid int, ndcnum string").select("enrolid", F.col("ndcnum").cast(kind)).write.parquet(str(tmp_path / f"s{i}"))
    both = union_columns({f"ccaed07{i}": spark.read.parquet(str(tmp_path / f"s{i}")) for i in (0, 1)}, {"ndcnum": 11})
    assert rows(both, "ndcnum") == [("00000000000",), ("1",)]
    only = plan(both.select("enrolid"))
    assert "ReadSchema: struct<enrolid:int>" in only and "ndcnum" not in only.split("ReadSchema")[1]


def test_awkward_schemas(spark):
    with pytest.raises(ValueError, match="letter case"):
        union_columns({"a": spark.range(1).selectExpr("id as `a.x`", "id as X", "id as x")})
    dotted = union_columns({"a": spark.range(1).selectExpr("id as `a.b`"), "b": spark.range(1).selectExpr("cast(id as string) as `A.B`")})
    assert rows(dotted) == [("0", "a"), ("0", "b")]
    with pytest.raises(ValueError, match="column v: .* in a, b"):
        union_columns({"a": spark.range(1).selectExpr("array(id) as v"), "b": spark.range(1).selectExpr("id as v")})


def test_ingest_pads_declared_codes(spark, tmp_path):
    spark.createDataFrame([(1, 123, 450.0), (2, None, None)], "ENROLID int, ndcnum int, revcode double").write.parquet(str(tmp_path / "d"))
    spark.sql("create database if not exists padded")
    assert ingest_table(spark, str(tmp_path / "d"), "padded.d", code_widths={"ndcnum": 11, "revcode": 4, "none": 2}, if_exists="replace") == 2
    assert rows(spark.table("padded.d")) == sorted([(1, "00000000123", "0450"), (2, None, None)], key=repr)
    assert normalize(spark.range(1), string_cols=["id"]).dtypes == [("id", "string")]


def test_lines_are_numbered_over_splits_and_files(spark, tmp_path):
    for part in range(3):
        lines = [f"{part},{i},{'x' * (i % 37)}" for i in range(2_000 + part)]
        (tmp_path / f"part-{part}.csv").write_text("part,line,text\n" + "\n".join(lines) + "\n")
    (tmp_path / "part-9.csv").write_text("part,line,text\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert spark.read.csv(str(tmp_path), header=True).rdd.getNumPartitions() > 8
        found = numbered_lines(spark, str(tmp_path), header="true")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found.columns == ["part", "line", "text", "row_no"]
    got = sorted((r.row_no, int(r.part), int(r.line)) for r in found.collect())
    assert got == [(n, *pair) for n, pair in enumerate(((p, i) for p in range(3) for i in range(2_000 + p)), 1)]
    with pytest.raises(ValueError, match="already has"):
        numbered_lines(spark, str(tmp_path), number_col="LINE", header="true")


def test_years_of_shards(spark):
    names = spark.createDataFrame([("ccaeo991",), ("ccaeo001",), ("ccaeo691",), ("raw.mdcro701",), ("ccaeoxx",)], "n string")
    assert rows(names.select("n", shard_parts(F.col("n"))["year"])) == sorted(
        [("ccaeo991", 1999), ("ccaeo001", 2000), ("ccaeo691", 2069), ("raw.mdcro701", 1970), ("ccaeoxx", None)], key=repr
    )
    claims = spark.createDataFrame([("ccae", "o", 2007, 1), ("ccae", "o", None, 2), ("ccae", "o", 2009, 3), ("mdcr", "o", None, 4)], "source string, scope string, year int, n int")
    assert rows(select_shards(claims, "ccae", ["o", "s"], [2006, 2007]), "n") == [(1,), (2,)]
