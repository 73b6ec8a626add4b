"""States of fill histories, put together in several ways, against a run over all fills."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimtrail.operators.histories import (
    adherence_from, adherence_states, period_states, persistence_from, save_states, whole_states,
)
from claimtrail.operators.treatment import adherence, persistence
from claimtrail.sources.tables import create_libraries
from tests.conftest import rows
from tests.test_treatment import random_fills

SCHEMA = "enrolid int, svcdate date, idxdate date, daysupp int"
PERIODS = {"year": "year(svcdate)", "quarter": "year(svcdate) * 4 + quarter(svcdate)", "week": "CAST(floor(unix_date(svcdate) / 7) AS INT)", "one": "0"}


@pytest.fixture(scope="module")
def fills(spark):
    return spark.createDataFrame(random_fills(5, 400, 900), SCHEMA).cache()


@pytest.mark.parametrize("period", ["year", "week"])
@pytest.mark.parametrize(("gap", "follow_up"), [(10, 300), (60, 720)])
def test_persistence_from_states(fills, period, gap, follow_up):
    states = whole_states(period_states(fills, ["enrolid"], gap, F.expr(PERIODS[period])), ["enrolid"])
    for lookforward in (True, False):
        assert rows(persistence_from(states, gap, follow_up, lookforward)) == rows(persistence(fills, gap, follow_up, lookforward))


@pytest.mark.parametrize("period", ["quarter", "one"])
def test_adherence_from_states(fills, period):
    states = whole_states(adherence_states(fills, 500, 60, F.expr(PERIODS[period])), ["enrolid", "idxdate"])
    names = adherence(fills, 500).columns
    assert rows(adherence_from(states, 500), *names) == rows(adherence(fills, 500))


def test_states_may_be_put_together_in_any_grouping(fills):
    small = period_states(fills, ["enrolid"], 30, F.expr(PERIODS["week"]))
    first, rest = small.where("period < 1960"), small.where("period >= 1960")  # weeks: most histories begin before
    halves = [whole_states(df, ["enrolid"]).withColumn("period", F.lit(n)) for n, df in ((2, rest), (1, first))]
    assert rows(whole_states(halves[0].unionByName(halves[1]), ["enrolid"])) == rows(whole_states(small, ["enrolid"]))
    assert first.count() and rest.count()


def test_a_new_year_extends_stored_states(spark, fills):
    create_libraries(spark, ["out_h"])
    made = lambda df: period_states(df, ["enrolid"], 60, F.expr(PERIODS["year"]))
    wanted = rows(persistence(fills, 60, 720))
    save_states(spark, made(fills.where("year(svcdate) = 2007 AND day(svcdate) < 20")), "out_h.states")
    save_states(spark, made(fills.where("year(svcdate) >= 2008")), "out_h.states")
    assert rows(persistence_from(whole_states(spark.table("out_h.states"), ["enrolid"]), 60, 720)) != wanted
    save_states(spark, made(fills.where("year(svcdate) = 2007")), "out_h.states")  # replaces the year
    assert rows(persistence_from(whole_states(spark.table("out_h.states"), ["enrolid"]), 60, 720)) == wanted


def test_states_are_bounded_by_days_not_by_fills(spark):
    many = spark.range(20_000).selectExpr("1 AS enrolid", "date_add(DATE '2007-01-01', CAST(id % 300 AS INT)) AS svcdate", "DATE '2007-01-01' AS idxdate", "1 AS daysupp")
    state = period_states(many, ["enrolid"], 5, F.expr(PERIODS["year"])).first()["state"]
    assert (state["n"], state["total"], len(state["cover"])) == (300, 20_000, 1) and len(state["stops"]) == 1
    undated = spark.createDataFrame([(1, None, None, 30)], SCHEMA)
    assert period_states(undated, ["enrolid"], 5, F.expr(PERIODS["year"])).count() == 0 == whole_states(period_states(undated, ["enrolid"], 5, F.expr(PERIODS["year"])), ["enrolid"]).count()
