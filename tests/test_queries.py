"""Registered queries against their SQL on the smallest data set, and what their plans must not contain."""

from __future__ import annotations

import contextlib
import io
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import rows_of
from claimtrail.plans import catalog
from claimtrail.plans.views import TABLES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test data not present")
WRITING = {"ingest_table", "ingest_library", "chunked_append", "materialize", "select_shards", "study_run", "libraries", "list_tables"}
COMPARED = sorted(set(catalog.QUERIES) - WRITING)[::6] + ["study_run", "select_shards", "chunked_append"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() == 342
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", COMPARED)
def test_rows_equal_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", ["prefix", "treatment", "statistics", "baseline"])
def test_plans_stay_in_spark(spark, plan, name):
    groups = {
        "prefix": ["dx_prefix_join", "dx_prefix_join_long_list", "rx_code_join_columns", "pull_dx"],
        "treatment": ["adherence", "persistence", "clean_supply_days", "exposure", "index_cohort"],
        "statistics": ["desc_stat_n", "desc_stat_c", "desc_stat_d", "km_survival"],
        "baseline": ["charlson", "visit_counts", "hospitalization", "outcomes_ru", "variables"],
    }
    for query in groups[name]:
        text = plan(entry.queries()[query](spark, DATA))
        for word in ("BroadcastNestedLoopJoin", "CartesianProduct", "Python"):
            assert word not in text, query


@pytest.mark.parametrize("name", ["charlson", "baseline", "visit_counts", "hospitalization", "dx_prefix_join"])
def test_generated_methods_can_be_compiled(spark, name):
    """HotSpot leaves methods above 8,000 bytes to the interpreter, several times slower."""
    shown = io.StringIO()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(shown):
            entry.queries()[name](spark, DATA).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert sizes and max(sizes) < 8_000
