from __future__ import annotations

from datetime import date

import pytest

from claimtrail.operators.utilization import hospitalization, outcomes_ru, visit_counts, visits
from tests.conftest import rows

IDX = date(2007, 6, 1)


def adm_frame(spark, data):
    return spark.createDataFrame(
        [(r[0], IDX, *r[1:]) for r in data],
        "enrolid int, idxdate date, admdate date, disdate date, pdx string, proc1 string, proc2 string",
    )


def test_hospitalization(spark):
    day, later = date(2007, 7, 1), date(2007, 8, 1)
    data = [
        (1, day, day, "6961", None, None), (1, day, day, "6961", "99222", None), (1, later, None, "401", "99222", None),
        (2, day, day, "6961", None, "  "), (3, day, day, "69610", "80053", "36415"), (4, day, day, "6961", "80053", "99222"),
        (5, date(2007, 5, 20), IDX, "6961", "99222", None), (5, date(2007, 5, 1), date(2007, 5, 31), "6961", "99222", None),
        (6, date(2008, 5, 30), None, "6961", "99222", None), (6, date(2008, 5, 31), None, "6961", "99222", None),
        (7, date(2007, 5, 20), None, "6961", "99222", None),
    ]
    got = rows(hospitalization(adm_frame(spark, data), ["6961"], proc_cols=["proc1", "proc2"]))
    assert got == [(1, 2, 1), (2, 1, 0), (3, 1, 0), (4, 1, 1), (5, 1, 1), (6, 1, 1)]


CLAIMS = "enrolid int, idxdate date, svcdate date, scope string, year int, stdplac int, stdprov int, stdsvc int, procgrp int, proctyp string, proc1 string, revcode string, svcscat string, pdx string, dx1 string, dx2 string"


def visit_frame(spark):
    def claim(pid, day, scope, proc=None, plac=None, pdx=None, dx1=None, dx2=None):
        return (pid, IDX, day, scope, 2007, plac, None, None, None, None, proc, None, None, pdx, dx1, dx2)

    d1, d2 = date(2007, 6, 1), date(2007, 6, 2)
    return spark.createDataFrame(
        [
            claim(1, d1, "O", "99213", dx1="6961"), claim(1, d1, "O", "99213"), claim(1, d2, "O", "99213"),
            claim(1, d1, "O", "11111", dx2="6961"), claim(1, d1, "S", plac=23, pdx="6961"), claim(1, d2, "S", plac=23, dx1="6961"),
            claim(2, d1, "S", "99213"), claim(3, date(2007, 5, 31), "O", "99213"), claim(4, d1, "O", "80053", dx1="6961"),
        ],
        CLAIMS,
    )


@pytest.mark.parametrize("as_frame", [False, True])
def test_visits(spark, as_frame):
    codes = spark.createDataFrame([("6961",)], "icd9 string") if as_frame else ["6961"]
    counts = visit_counts(visits(visit_frame(spark), codes))
    assert rows(counts) == [(1, 2, 2, 1, 1, 1, 1), (4, None, None, 1, None, None, None)]


def test_outcomes_ru(spark):
    cohort = spark.createDataFrame([(1,), (1,), (2,), (9,)], "enrolid int")
    hospital = spark.createDataFrame([(1, 2, 0)], "enrolid int, all_hospitalization long, dis_hospitalization long")
    table = outcomes_ru(cohort, hospital, visit_counts(visits(visit_frame(spark), ["6961"])))
    got = {r["enrolid"]: r for r in table.collect()}
    assert len(got) == table.count() == 3
    assert got[1]["all_hospitalization"] == 2 and got[1]["with_dis_hospitalization"] == "0" and got[1]["with_dis_er"] == "1"
    assert got[9]["all_er"] == 0 and got[9]["with_all_er"] == "0"
    assert table.schema["dis_er"].metadata["label"] == "Frequency of Psoriasis ER Visits"


def test_visit_counts_plan(spark, plan):
    text = plan(visit_counts(visits(visit_frame(spark), ["6961"])))
    assert "Expand" not in text and text.count("Exchange hashpartitioning") == 2
