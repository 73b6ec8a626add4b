from __future__ import annotations

from datetime import date

from claimtrail.config import StudyConfig
from claimtrail.operators.exposure import exposure, index_cohort, index_join
from claimtrail.operators.supply import clean_supply_days, dedupe_keep_max_supply, supply_mode
from tests.conftest import rows

D1, D2, D3 = date(2007, 3, 1), date(2007, 4, 1), date(2008, 2, 1)


def test_clean_supply(spark, plan):
    data = [
        (1, D1, "a", 30, "M"), (1, D1, "a", 60, "F"), (1, D1, "a", None, "M"),  # largest kept
        (2, D1, "a", None, "M"), (2, D2, "a", 0, "M"), (3, D1, "a", -5, "M"), (4, D1, "a", 30, "M"),  # tie 30/60: smallest
        (1, D1, "b", 0, "M"), (2, D1, "b", None, "M"),  # never positive: dropped
        (5, D1, None, 30, "M"),
    ]
    df = spark.createDataFrame(data, "enrolid int, svcdate date, ndcnum string, daysupp int, sex string")
    cleaned = clean_supply_days(df, keep=["sex"])
    assert rows(cleaned) == [
        (1, D1, "a", 60, "F"), (2, D1, "a", 30, "M"), (2, D2, "a", 30, "M"), (3, D1, "a", 30, "M"), (4, D1, "a", 30, "M"),
    ]
    assert rows(clean_supply_days(df)) == [r[:4] for r in rows(cleaned)]
    assert "WindowGroupLimit" in plan(dedupe_keep_max_supply(df, ["enrolid", "svcdate", "ndcnum"], keep=["sex"]))


def test_supply_mode_counts_only_positive(spark):
    data = [("a", -1)] * 5 + [("a", 90)] * 2 + [("a", 30)] * 2 + [("b", 0)]
    assert rows(supply_mode(spark.createDataFrame(data, "ndcnum string, daysupp int"))) == [("a", 30)]


def test_exposure_and_cohort(spark):
    people = ("M", 1970, 37, 6.0, "1")
    drugs = spark.createDataFrame(
        [(1, D2, "n1", 30, *people), (2, D3, "n1", 30, *people), (1, D2, "n2", 30, *people), (9, D1, "zz", 30, *people)],
        "enrolid int, svcdate date, ndcnum string, daysupp int, sex string, dobyr int, age int, plantyp double, region string",
    )
    procs = spark.createDataFrame(
        [(1, D2, "J1", *people), (1, D1, "J1", *people), (1, D1, "J1", *people), (3, D1, "J2", *people)],
        "enrolid int, svcdate date, proc1 string, sex string, dobyr int, age int, plantyp double, region string",
    )
    ndc = spark.createDataFrame([("n1", "gx"), ("n2", "gy")], "ndc string, generic_name string")
    hcpcs = spark.createDataFrame([("J1", "gz", 56)], "hcpcs string, generic_name string, daysupp int")
    both = exposure(drugs, procs, ndc, hcpcs)
    assert rows(both, "enrolid", "svcdate", "generic_name", "daysupp") == [
        (1, D1, "gz", 56), (1, D1, "gz", 56), (1, D2, "gx", 30), (1, D2, "gy", 30), (1, D2, "gz", 56), (2, D3, "gx", 30),
    ]
    without = exposure(drugs, procs, ndc, hcpcs.drop("daysupp"))
    assert [r for r in rows(without, "enrolid", "generic_name", "daysupp") if r[1] == "gz"] == [(1, "gz", None)] * 3
    cohort = index_cohort(both, StudyConfig())
    assert rows(cohort, "enrolid", "idxdate", "idxtreatment") == [(1, D1, "gz")]
    later = index_cohort(both.where("generic_name <> 'gz'"), StudyConfig())
    assert rows(later, "enrolid", "idxdate", "idxtreatment") == [(1, D2, "gx"), (1, D2, "gy")]
    assert rows(index_join(both, "enrolid", "svcdate"), "enrolid", "svcdate") == [(1, D1), (1, D1), (2, D3)]
