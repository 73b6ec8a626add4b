"""Tasks that don't grow with the tables, whatever the session's number of shuffle partitions."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from claimtrail.operators.conditions import patient_conditions
from claimtrail.operators.joins import spread_distinct, spread_join, spread_over
from claimtrail.plans.views import Views
from tests.conftest import rows


@pytest.fixture()
def given(spark, tmp_path):
    """A folder with order lines of its own; the last order has no line, the last line no order."""
    orders = [(k, 1 + k % 7, datetime(1996 + k % 5, 1 + k % 12, 1 + k % 28)) for k in range(1, 60)]
    lines = [
        (k, 1 + (k + n) % 9, 1 + (3 * k + n) % 11, n, float(11 + (k * n) % 40), "R" if k % 3 else "N", datetime(1996 + k % 5, 1 + k % 12, 28))
        for k in [*range(1, 59), 99] for n in range(1, 8)
    ]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    kinds = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_tasks_of_distinct_rows_and_joins_follow_the_stored_bytes(spark, given, plan):
    lines, orders = (spark.read.parquet(f"{given}/{name}.parquet") for name in ("lineitem", "orders"))
    bits = lines.select("l_partkey", "l_suppkey")
    n = spread_over(bits, bytes_per_task=100)
    assert n > 4 and spread_over(bits) is None and spread_over(spark.range(3), bytes_per_task=1) is None
    assert "hashpartitioning(l_partkey#" in plan(spread_distinct(bits, 100)) and f", {n}), REPARTITION_BY_NUM" in plan(spread_distinct(bits, 100))
    assert rows(spread_distinct(bits, 100)) == rows(bits.distinct())
    joined = spread_join(lines, orders, "l_orderkey", "o_orderkey", 100)
    assert "ENSURE_REQUIREMENTS" not in plan(joined.hint("merge"))
    assert rows(joined) == rows(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))) != []


def test_patient_conditions_are_dealt_by_the_bytes_read(spark, given, plan, monkeypatch):
    claims = Views(spark, given).claims
    usual = patient_conditions(claims)
    monkeypatch.setattr(spread_distinct, "__defaults__", (100,))
    assert "REPARTITION_BY_NUM" not in plan(usual) and "REPARTITION_BY_NUM" in plan(patient_conditions(claims))
    assert rows(patient_conditions(claims)) == rows(usual) != []
