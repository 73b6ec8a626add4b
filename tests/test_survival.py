from __future__ import annotations

import math
import random

import pytest

from claimtrail.operators.survival import km_at_risk, km_quartiles, km_survival
from tests.conftest import rows


def loop_km(data):
    survival, var, out = 1.0, 0.0, []
    for day in sorted({t for t, _ in data}):
        n = sum(t >= day for t, _ in data)
        d = sum(t == day and e == 1 for t, e in data)
        survival *= (n - d) / n
        var += d / (n * (n - d)) if n > d else 0
        out.append((day, n, d, sum(t == day for t, _ in data) - d, survival, survival * math.sqrt(var) if survival > 0 else None))
    return out


CASES = {
    "all events at the last day": [(1, 0), (2, 1), (5, 1), (5, 1)],
    "all censored": [(3, 0), (4, 0)],
    "event and censoring on one day": [(3, 1), (3, 0), (4, 1), (9, 0)],
    "random": [(random.Random(i).randrange(40), random.Random(i + 1000).randrange(2)) for i in range(400)],
}


@pytest.mark.parametrize("name", CASES)
def test_km(spark, name):
    df = spark.createDataFrame(CASES[name], "time int, disc_flag int")
    got = [tuple(r) for r in km_survival(df).orderBy("time").collect()]
    for mine, wanted in zip(got, loop_km(CASES[name]), strict=True):
        assert mine == pytest.approx(wanted, abs=1e-12)


def test_quartiles(spark):
    df = spark.createDataFrame([(t, 1) for t in (10, 20, 30, 40)], "time int, disc_flag int")
    assert rows(km_quartiles(km_survival(df))) == [(0.25, 15.0), (0.5, 25.0), (0.75, 35.0)]
    early = spark.createDataFrame([(10, 1), (20, 0), (30, 0)], "time int, disc_flag int")
    assert rows(km_quartiles(km_survival(early))) == [(0.25, 10.0), (0.5, None), (0.75, None)]


def test_at_risk(spark):
    df = spark.createDataFrame([(10, 1), (20, 0), (30, 0)], "time int, disc_flag int")
    assert rows(km_at_risk(df, [0, 10, 11, 30, 31])) == [(0, 3), (10, 3), (11, 2), (30, 1), (31, 0)]


def test_needs_whole_days(spark):
    with pytest.raises(TypeError):
        km_survival(spark.createDataFrame([(1.5, 1)], "time double, disc_flag int"))
