"""Inputs that are joined, pruned and written once for all that read them."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from claimtrail.plans.queries_study import fills, near_claims
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
    parts = [(k, f"Brand{k % 4}", "TYPE") for k in range(1, 10)]
    spark.createDataFrame(parts, "p_partkey bigint, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def test_stored_views_have_the_same_rows_without_a_join(spark, given, plan):
    plain, stored = Views(spark, given), Views(spark, given).stored()
    for name in ("rx", "claims", "adm", "spells"):
        assert rows(getattr(plain, name)) == rows(getattr(stored, name)) != []
    for name in ("claims", "adm", "spells"):
        assert "Join" in plan(getattr(plain, name)) and "Join" not in plan(getattr(stored, name))


def test_near_claims_are_the_claims_of_both_windows_and_written(spark, given, plan):
    v = Views(spark, given)
    found = near_claims(v)
    assert "Join" not in plan(found)
    day, idx = F.col("svcdate"), F.col("idxdate")
    wanted = v.sddx.where((day >= F.date_sub(idx, v.cfg.baseline_days)) & (day <= F.date_add(idx, v.cfg.outcome_days)))
    assert rows(found) == rows(wanted, *found.columns) != []
    assert set(found.columns) < set(v.sddx.columns)


def test_fills_prune_the_days_that_no_index_date_reaches(spark, given, plan):
    v = Views(spark, given)
    assert "1999-12-31" in plan(fills(v))
    assert fills(v).agg(F.max("svcdate")).first()[0] <= date(1999, 12, 30)
