from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from claimtrail.functions.dates import days_since_1960, is_in_baseline, is_in_outcome
from claimtrail.functions.formats import plan_group_label, plantyp_label, region_label, sex_label
from claimtrail.functions.predicates import (
    claim_columns, disease_flag, is_er, is_lab, is_office_visit, is_op_visit, is_radiology, is_ruleout, visit_type,
)

SCHEMA = "scope string, year int, stdplac int, stdprov int, stdsvc int, procgrp int, proctyp string, proc1 string, revcode string, svcscat string"


def claim(spark, **values):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(values.get(n) for n in names)], SCHEMA)


def value(df, column):
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "fields, wanted",
    [
        ({"stdplac": 23}, True),  # a missing year counts as an early one
        ({"stdplac": 23, "year": 2010}, True),
        ({"stdplac": 23, "year": 2011}, False),
        ({"svcscat": "11120", "year": 2011}, True),
        ({"svcscat": " 11120", "year": 2011}, True),
        ({"svcscat": "11120", "year": 2010}, False),
        ({"svcscat": "11120"}, False),
        ({"stdplac": 21, "stdprov": 220}, True),  # a missing service differs from 104
        ({"stdplac": 21, "stdprov": 220, "stdsvc": 104}, False),
        ({"stdplac": 21, "stdsvc": 77}, True),
        ({"stdplac": 11, "stdsvc": 77}, False),
        ({"stdplac": 28, "stdprov": 240, "stdsvc": 1}, False),
        ({"procgrp": 111}, True),
        ({"revcode": "450"}, True),
        ({"revcode": "0450"}, True),
        ({"revcode": "4500"}, False),
        ({"revcode": "045"}, False),
        ({}, False),
    ],
)
def test_er(spark, fields, wanted):
    assert value(claim(spark, **fields), is_er(claim_columns())) is wanted


@pytest.mark.parametrize(
    "proc, wanted",
    [
        ("70010", True), ("76999", True), ("77000", False), ("78000", True), ("78799", True), ("78800", False),
        ("80000", True), ("89999", True), ("90000", False), ("36400", True), ("36425", True), ("36426", False),
        ("S9529", True), ("G0001", True), ("G0002", False), ("8000", False), ("800000", False), ("80000 ", True),
        ("", False), (None, False),
    ],
)
def test_ruleout(spark, proc, wanted):
    assert value(claim(spark, proc1=proc), is_ruleout(F.col("proc1"))) is wanted


@pytest.mark.parametrize(
    "fields, office, op, kind",
    [
        ({"scope": "O", "proc1": "99213"}, True, True, "Office"),
        ({"scope": "o", "proc1": "99429"}, True, True, "Office"),
        ({"scope": "O", "proc1": "99216"}, False, False, "Others"),
        ({"scope": "O", "stdplac": 22, "procgrp": 104}, True, True, "Office"),
        ({"scope": "O", "stdplac": 22}, False, False, "Others"),
        ({"scope": "O", "revcode": "0988"}, False, True, "Office"),
        ({"scope": "S", "revcode": "0988"}, False, True, None),
        ({"scope": "S", "proc1": "99213"}, False, False, None),
        ({"scope": "S", "stdplac": 23}, False, False, "ER"),
        ({"scope": "O", "stdplac": 23, "proc1": "99213"}, True, True, "ER"),
        ({"proc1": "99213"}, False, False, None),
    ],
)
def test_visits(spark, fields, office, op, kind):
    row = claim(spark, **fields)
    assert value(row, is_office_visit(claim_columns())) is office
    assert value(row, is_op_visit(claim_columns())) is op
    assert value(row, visit_type(claim_columns())) == kind


@pytest.mark.parametrize(
    "fields, lab, radiology",
    [
        ({"scope": "s", "proctyp": "1", "proc1": "80053"}, True, False),
        ({"scope": "S", "procgrp": 339}, True, False),
        ({"scope": "O", "procgrp": 339}, False, False),
        ({"scope": "s", "revcode": "0301"}, True, False),
        ({"scope": "s", "revcode": "310"}, True, False),
        ({"proctyp": "1", "proc1": "71020"}, False, True),
        ({"proctyp": "6", "proc1": "71020"}, False, False),
        ({"proc1": "0073T"}, False, True),
        ({"procgrp": 299}, False, True),
        ({"procgrp": 300}, False, False),
        ({"revcode": "0330"}, False, True),
        ({}, False, False),
    ],
)
def test_lab_and_radiology(spark, fields, lab, radiology):
    row = claim(spark, **fields)
    assert value(row, is_lab(claim_columns())) is lab
    assert value(row, is_radiology(claim_columns())) is radiology


@pytest.mark.parametrize(
    "scope, pdx, dx1, dx2, proc1, wanted",
    [
        ("S", "6961", None, None, None, True),
        ("S", None, "6961", None, None, False),
        ("O", None, "69610", None, None, True),
        ("O", None, None, "6961", "99213", True),
        ("O", "6961", None, None, None, False),
        ("O", None, "6961", None, "80053", False),
        (None, "6961", "6961", None, None, False),
    ],
)
def test_disease_flag(spark, scope, pdx, dx1, dx2, proc1, wanted):
    df = spark.createDataFrame([(scope, pdx, dx1, dx2, proc1)], "scope string, pdx string, dx1 string, dx2 string, proc1 string")
    assert value(df, disease_flag(["6961", "6960"])) is wanted


def test_windows(spark):
    df = spark.sql(
        "SELECT explode(sequence(date'2006-12-30', date'2008-01-02')) AS d, date'2007-01-01' AS idx"
    )
    seen = df.where(is_in_outcome(F.col("d"), F.col("idx"), 364)).agg(F.min("d"), F.max("d")).first()
    assert seen == (date(2007, 1, 1), date(2007, 12, 31))
    before = df.where(is_in_baseline(F.col("d"), F.col("idx"), 1)).agg(F.min("d"), F.max("d")).first()
    assert before == (date(2006, 12, 31), date(2006, 12, 31))


def test_days_since_1960(spark):
    df = spark.sql("SELECT * FROM VALUES (timestamp'1960-01-01 23:00:00'), (timestamp'1959-12-31 12:00:00'), (timestamp'1970-01-01') AS t(c)")
    assert [r[0] for r in df.select(days_since_1960(F.col("c"))).collect()] == [0, -1, 3653]


def test_formats(spark):
    df = spark.createDataFrame([(4.0, "1", "2"), (None, "9", " "), (1.0, None, None)], "p double, r string, s string")
    shown = df.select(
        plantyp_label(F.col("p")), plan_group_label(F.col("p")), region_label(F.col("r")), sex_label(F.col("s"))
    ).collect()
    assert [tuple(r) for r in shown] == [
        ("4-HMO", "3-HMO and POS capitation", "1-Northeast Region", "2-Female"),
        (".-Missing/Unknown", "2-Unknown", "9", "Missing/Unknown"),
        ("1-Basic/Major Medical", "1-Fee for service", None, "Missing/Unknown"),
    ]
