from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from claimtrail.config import StudyConfig
from claimtrail.operators.treatment import (
    adherence, cohort_treatment, covered_days, est_refill_chain, multi_treatment_patients, outcomes_tp, persistence,
)
from tests.conftest import rows

START = date(2007, 1, 1)


def random_fills(seed, patients, horizon=420):
    """Fill histories with the first fill on the index day, repeated days and long gaps."""
    rng = random.Random(seed)
    fills = []
    for patient in range(patients):
        days = [0] + [rng.randrange(horizon) for _ in range(rng.randrange(0, 9))]
        days += rng.sample(days, k=min(len(days), rng.randrange(0, 3)))
        fills += [(patient, START + timedelta(d), START, rng.choice([1, 7, 30, 30, 90, 120])) for d in days]
    return fills


def loop_adherence(fills, follow_up):
    """One patient, walked day by day in order."""
    start = fills[0][2]
    per_day = {}
    for _, day, _, supply in fills:
        offset = (day - start).days
        if 0 <= offset <= follow_up:
            per_day[offset] = per_day.get(offset, 0) + supply
    order = sorted(per_day)
    stock = 0
    for day in range(order[-1]):
        stock = max(stock + per_day.get(day, 0) - 1, 0)
    est = order[-1] + stock  # what is in stock is used up first
    total, last = sum(per_day.values()), order[-1]
    last_supply = per_day[last]
    covered = len({d for day in order for d in range(day, min(day + per_day[day], follow_up))})
    several = len(order) > 1
    return (
        int(several),
        min(total / (last + last_supply), 1) if several else None,
        min((total - last_supply) / last, 1) if several else None,
        (total - last_supply - max(0, est - last)) / last if several else None,
        covered / follow_up,
        (total - max(0, est + last_supply - follow_up)) / follow_up,
        min(total / follow_up, 1),
    )


def loop_persistence(fills, gap, follow_up, lookforward):
    """One patient's stock, a day at a time, until over ``gap`` days without any end with a fill, or the last fill is used up."""
    start = min(f[1] for f in fills)
    received = {}
    for _, day, _, supply in fills:
        received[(day - start).days] = received.get((day - start).days, 0) + supply
    today = stock = without = 0
    while stock or today <= max(received):
        if today in received and without > gap:
            break
        stock += received.get(today, 0)
        without = 0 if stock else without + 1
        stock = max(stock - 1, 0)
        today += 1
    held = today - without
    if held >= follow_up or (not lookforward and follow_up - held <= gap):
        return follow_up, 0
    return held, 1


def by_patient(fills):
    groups = {}
    for fill in fills:
        groups.setdefault(fill[0], []).append(fill)
    return groups


def fill_frame(spark, fills):
    return spark.createDataFrame(fills, "enrolid int, svcdate date, idxdate date, daysupp int")


def test_adherence_equals_loop(spark):
    fills = random_fills(1, 1500)
    got = {r["enrolid"]: tuple(r)[1:] for r in adherence(fill_frame(spark, fills), 364).collect()}
    for patient, own in by_patient(fills).items():
        assert got[patient] == pytest.approx(loop_adherence(own, 364), abs=1e-12), own


@pytest.mark.parametrize("lookforward", [True, False])
@pytest.mark.parametrize("gap", [0, 60])
def test_persistence_equals_loop(spark, lookforward, gap):
    fills = random_fills(2, 1500)
    got = {r[0]: (r[1], r[2]) for r in persistence(fill_frame(spark, fills), gap, 300, lookforward).collect()}
    for patient, own in by_patient(fills).items():
        assert got[patient] == loop_persistence(own, gap, 300, lookforward), own


@pytest.mark.parametrize(
    "later, wanted",
    [
        ([(90, 30)], (120, 1)),  # gap of exactly 60 days
        ([(91, 30)], (30, 1)),  # one day more
        ([(91, 30), (92, 300)], (30, 1)),  # coming back does not count
        ([(10, 300)], (300, 0)),
    ],
)
def test_persistence_gap(spark, later, wanted):
    fills = [(1, START, START, 30)] + [(1, START + timedelta(d), START, s) for d, s in later]
    assert rows(persistence(fill_frame(spark, fills), 60, 300)) == [(1, *wanted)]


def test_single_fill_and_last_day(spark):
    fills = [(1, START, START, 30), (2, START, START, 30), (2, START + timedelta(364), START, 30), (2, START + timedelta(365), START, 30)]
    got = {r["enrolid"]: r for r in adherence(fill_frame(spark, fills), 364).collect()}
    assert got[1]["mpr_flag"] == 0 and got[1]["mpr_df1"] is None and got[1]["pdc_df1"] == 30 / 364
    assert got[2]["mpr_flag"] == 1 and got[2]["mpr_df1"] == 60 / 394 and got[2]["pdc_df1"] == 30 / 364
    assert got[2]["pdc_df2"] == 30 / 364


def test_chain_columns(spark):
    fills = [(1, START, START, 30), (1, START + timedelta(20), START, 30)]
    daily = fill_frame(spark, fills).drop("idxdate")
    chain = est_refill_chain(daily, ["enrolid"]).orderBy("svcdate").collect()
    epoch = date(1970, 1, 1)
    assert [(r["est_start"] - (START - epoch).days, r["supply_before"]) for r in chain] == [(0, 0), (30, 30)]
    covered = covered_days(daily, ["enrolid"], F.lit(START + timedelta(45))).orderBy("svcdate").collect()
    assert [r["covered"] for r in covered] == [30, 15]


def test_cohort_treatment(spark):
    cohort = spark.createDataFrame(
        [(1, START, "a", "M"), (1, START, "a", "F"), (2, START, "a", "M"), (2, START, "b", "M"), (3, START, None, "M")],
        "enrolid int, idxdate date, idxtreatment string, sex string",
    )
    exposures = spark.createDataFrame(
        [(1, START, "a", 30), (1, START, "a", 30), (1, START + timedelta(365), "a", 30), (1, START, "b", 30), (2, START, "a", 30)],
        "enrolid int, svcdate date, generic_name string, daysupp int",
    )
    assert rows(multi_treatment_patients(cohort)) == [(2, 2)]
    found = cohort_treatment(exposures, cohort, StudyConfig())
    assert rows(found, "enrolid", "svcdate", "idxtreatment", "daysupp") == [(1, START, "a", 30)] * 2


def test_outcomes_tp_labels(spark):
    fills = fill_frame(spark, [(1, START, START, 30)])
    table = outcomes_tp(adherence(fills, 364), persistence(fills, 60, 300))
    assert rows(table) == [(1, 30 / 364, "0", 30)]
    assert table.schema["persistence_flag"].metadata["label"] == "Persistence Flag"


def test_no_python_and_one_shuffle_per_step(spark, plan):
    text = plan(adherence(fill_frame(spark, random_fills(3, 2)), 364))
    assert "Python" not in text
    assert text.count("Exchange hashpartitioning") == 2  # per day, then per patient for all windows and the result
