from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from claimtrail.operators.enrollment import age_filter, continuous_enrollment, enrolled_spells
from claimtrail.operators.ordered import first_last, forward_fill, row_number_global, top_n_with_ties
from claimtrail.sources import scratch
from claimtrail.sources.code_lists import codes_of, load_code_lists
from claimtrail.sources.shards import select_shards, shard_parts, union_columns
from claimtrail.sources.tables import (
    classify_variables, column_dtypes, create_libraries, expand_var_range, ingest_library, ingest_table, library_files, list_columns,
    list_tables, materialize, write_folder,
)
from tests.conftest import rows


@pytest.fixture(scope="module")
def library(spark):
    create_libraries(spark, ["raw_t", "scd_t"])
    create_libraries(spark, ["raw_t"])
    return "raw_t"


def test_ingest_modes(spark, library, tmp_path):
    path = str(tmp_path / "d081.parquet")
    spark.sql("SELECT 7L AS ENROLID, timestamp'2006-05-04' AS SvcDate, 123L AS NDCNUM").write.parquet(path)
    table = f"{library}.ccaed081"
    assert ingest_table(spark, path, table, date_cols=["svcdate"], string_cols=["ndcnum"]) == 1
    assert column_dtypes(spark.table(table)) == [("enrolid", "bigint"), ("svcdate", "date"), ("ndcnum", "string")]
    assert list_columns(spark.table(table)) == ["enrolid", "svcdate", "ndcnum"]
    with pytest.raises(Exception, match="(?i)exist"):
        ingest_table(spark, path, table)
    assert ingest_table(spark, path, table, if_exists="append", date_cols=["svcdate"], string_cols=["ndcnum"]) == 1
    assert spark.table(table).count() == 2
    assert ingest_table(spark, path, table, if_exists="replace") == 1
    assert spark.table(table).count() == 1
    with pytest.raises(ValueError):
        ingest_table(spark, path, table, if_exists="sometimes")


def test_ingest_library(spark, library, tmp_path):
    for name in ("ccaeo081", "MDCRS081"):
        spark.range(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    files = library_files([str(p) for p in tmp_path.iterdir()] + ["/x/readme.txt"])
    assert sorted(files) == ["ccaeo081", "mdcrs081"]
    assert ingest_library(spark, files, library) == {"ccaeo081": 3, "mdcrs081": 3}
    assert ingest_library(spark, files, library) == {"ccaeo081": None, "mdcrs081": None}
    assert ingest_library(spark, files, library, refresh=True) == {"ccaeo081": 3, "mdcrs081": 3}
    assert {"ccaeo081", "mdcrs081"} <= set(list_tables(spark, library))


def test_code_lists(spark, library, tmp_path):
    sheets = {
        "icd9": "row_no,TA,ICD9\n1,PSORIASIS,696.1x\n2,,696.0\n3,RA,714.xx\n4,,\n",
        "ndc": "NDC,Generic_name\n1234-567-8,gx\n",
        "hcpcs": "HCPCS,Generic_name\nJ1438,gy\n",
    }
    for name, text in sheets.items():
        (tmp_path / f"{name}.csv").write_text(text)
    paths = {name: str(tmp_path / f"{name}.csv") for name in sheets}
    assert load_code_lists(spark, paths, "scd_t") == {"icd9": 3, "ndc": 1, "hcpcs": 1}
    assert load_code_lists(spark, paths, "scd_t")["icd9"] == 3
    assert rows(spark.table("scd_t.icd9"), "ta", "icd9") == [("PSORIASIS", "6960"), ("PSORIASIS", "6961"), ("RA", "714")]
    assert rows(codes_of(spark.table("scd_t.icd9"), "icd9", "psoriasis")) == [("6960",), ("6961",)]
    assert rows(spark.table("scd_t.ndc"), "ndc") == [("01234056708",)]


def test_partition_pruning(spark, tmp_path, plan):
    shards = ["ccaeo081", "ccaes081", "mdcro091"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shards)], "enrolid int, tb_name string")
    named = df.withColumns(shard_parts(F.concat(F.lit("raw."), F.col("tb_name"))))
    assert rows(named, "source", "scope", "year", "version")[0] == ("ccae", "o", 2008, "1")
    path = str(tmp_path / "claims")
    assert write_folder(named, path, partition_by=["source", "scope", "year"]) == 3
    kept = select_shards(spark.read.parquet(path), ["ccae"], ["o", "s"], [2008])
    assert rows(kept, "enrolid") == [(0,), (1,)]
    filters = [line for line in plan(kept).splitlines() if "PartitionFilters" in line][0]
    assert "source" in filters.split("PushedFilters")[0].split("PartitionFilters")[1]


def test_union_columns(spark):
    a = spark.createDataFrame([(1, "x")], "ENROLID int, PDX string")
    b = spark.createDataFrame([(2, 101)], "enrolid int, procgrp int")
    both = union_columns({"raw.s": a, "raw.o": b})
    assert both.columns == ["enrolid", "pdx", "tb_name", "procgrp"]
    assert rows(both) == [(1, "x", "raw.s", None), (2, None, "raw.o", 101)]
    with pytest.raises(ValueError):
        union_columns({})


def test_materialize_counts(spark, library):
    assert materialize(spark.range(5), f"{library}.numbers") == 5
    assert materialize(spark.range(4), f"{library}.numbers") == 4
    assert spark.table(f"{library}.numbers").count() == 4


def test_variable_lists(spark):
    df = spark.sql("SELECT 1 AS id, 'a' AS dx1, 'b' AS dx2, 'c' AS dx3, 2.0D AS cost, 'x' AS sex")
    assert expand_var_range(df, "dx1-dx3, COST") == ["dx1", "dx2", "dx3", "cost"]
    assert expand_var_range(df, ["dx2", "dx1-dx2"]) == ["dx2", "dx1"]
    with pytest.raises(ValueError):
        expand_var_range(df, "dx1-dx4")
    kinds = classify_variables(df, ["SEX"], ["id"])
    assert kinds == {"continuous": ["cost"], "dichotomous": ["dx1", "dx2", "dx3"], "categorical": ["sex"]}


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_forward_fill(spark, block):
    rng = random.Random(block)
    data = [(i, rng.choice([None, None, None, "a", "b"])) for i in range(60)]
    last, wanted = None, []
    for i, v in data:
        last = v or last
        wanted.append((i, last))
    df = spark.createDataFrame(data, "row_no long, ta string")
    assert sorted(tuple(r) for r in forward_fill(df, "ta", "row_no", block).collect()) == wanted


def test_first_last_and_numbering(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, None)], "id int, day int, v string")
    assert rows(first_last(df, ["id"], ["day"], ["v"])) == [(1, "a", "c"), (2, None, None)]
    assert rows(row_number_global(df, [F.desc("day")]), "day", "row_num") == [(1, 4), (2, 3), (3, 2), (5, 1)]
    assert rows(top_n_with_ties(spark.createDataFrame([("a", 2), ("b", 1), ("c", 1)], "k string, freq int"), 2, "freq"), "k") == [("a",), ("b",), ("c",)]


def test_enrollment(spark):
    spells = spark.sql(
        "SELECT * FROM VALUES (1, date'2006-01-01', date'2006-06-30'), (1, date'2006-08-15', date'2008-12-31'),"
        " (2, date'2006-01-01', date'2006-06-30'), (2, date'2006-08-16', date'2008-12-31'), (1, date'2006-02-01', date'2006-03-01')"
        " AS t(enrolid, dtstart, dtend)"
    )
    assert rows(enrolled_spells(spells, 45)) == [
        (1, date(2006, 1, 1), date(2008, 12, 31)), (2, date(2006, 1, 1), date(2006, 6, 30)), (2, date(2006, 8, 16), date(2008, 12, 31)),
    ]
    cohort = spark.sql("SELECT * FROM VALUES (1, date'2007-06-01', 17), (2, date'2007-06-01', 18), (2, date'2007-09-01', 18) AS t(enrolid, idxdate, age)")
    assert rows(continuous_enrollment(cohort, spells), "enrolid", "idxdate") == [(1, date(2007, 6, 1)), (2, date(2007, 9, 1))]
    assert rows(age_filter(cohort), "enrolid") == [(2,), (2,)]


def test_scratch_folder(spark):
    folder = scratch.shared_folder(spark)
    assert folder == scratch.shared_folder(spark)
    settled = scratch.settle(spark.range(3))
    assert settled.count() == 3
