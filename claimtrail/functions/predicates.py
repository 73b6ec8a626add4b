"""Service-type predicates over one claim row.

Every predicate is true or false, never NULL. A missing number counts as smaller than any number and as
different from any number, so ``year <= 2010`` and ``stdsvc <> 104`` hold for a missing value.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from claimtrail.functions.codes import starts_with_any

# ---- fixed values: code ranges and code sets of the service types ----
RULEOUT_RANGES = (("70010", "76999"), ("78000", "78799"), ("80000", "89999"), ("36400", "36425"))
RULEOUT_CODES = ("S9529", "G0001")
OFFICE_PROC_RANGES = (
    ("99201", "99215"),
    ("99241", "99245"),
    ("99381", "99387"),
    ("99391", "99397"),
    ("99401", "99404"),
    ("99411", "99412"),
    ("99420", "99429"),
)
OFFICE_PLACES = (11, 22, 95)
OFFICE_PROC_GROUPS = (101, 104, 109)
OUTPATIENT_REVENUE_CODES = (
    "0450", "0510", "0515", "0517", "0520", "0521", "0523", "0526", "0760",
    "0761", "0762", "0769", "0770", "0779", "0982", "0983", "0988",
)
ER_PLACE = 23
ER_HOSPITAL_PLACES = (21, 22, 28)
ER_PROC_GROUPS = (110, 111, 114)
ER_REVENUE = ("45",)
LAB_PROC_GROUPS = (301, 302, 303, 331, 332, 334, 335, 336, 338, 339)
LAB_REVENUE = ("30", "31")
RADIOLOGY_CODES = ("0073T", "0082T", "0083T")
RADIOLOGY_PROC_GROUPS = (201, 299)
RADIOLOGY_REVENUE = ("32", "33")

CLAIM_COLUMNS = (
    "scope", "year", "stdplac", "stdprov", "stdsvc", "procgrp", "proctyp", "proc1", "revcode", "svcscat",
)


def _sure(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _in_ranges(code: Column, ranges: Iterable[tuple[str, str]]) -> Column:
    hit = F.lit(False)
    for low, high in ranges:
        hit = hit | code.between(low, high)
    return hit


def _revenue(revcode: Column, starts: Iterable[str]) -> Column:
    """Three-character revenue codes that begin with one of ``starts``, or four-character ones after a zero."""
    size = F.length(F.trim(revcode))
    short, long = F.lit(False), F.lit(False)
    for start in starts:
        short = short | revcode.startswith(start)
        long = long | revcode.startswith("0" + start)
    return ((size == 3) & short) | ((size == 4) & long)


def _scope_is(scope: Column, letter: str) -> Column:
    return F.upper(scope) == letter


def is_ruleout(proc: Column) -> Column:
    """A five-character procedure that only rules a diagnosis out (imaging, laboratory, blood draw)."""
    code = F.rtrim(proc)
    return _sure((F.length(code) == 5) & (_in_ranges(code, RULEOUT_RANGES) | code.isin(*RULEOUT_CODES)))


def is_er(c: Mapping[str, Column]) -> Column:
    """Emergency room: place/provider/service codes up to 2010, service subcategory from 2011 on."""
    old_rule = (
        _sure(c["stdplac"] == ER_PLACE)
        | _sure(
            c["stdplac"].isin(*ER_HOSPITAL_PLACES)
            & (
                (_sure(c["stdprov"] == 220) & ~c["stdsvc"].eqNullSafe(104))
                | _sure(c["stdsvc"] == 77)
            )
        )
        | _sure(c["procgrp"].isin(*ER_PROC_GROUPS))
        | _sure(_revenue(c["revcode"], ER_REVENUE))
    )
    new_rule = _sure(F.substring(F.ltrim(c["svcscat"]), 4, 2) == "20")
    return (F.coalesce(c["year"] <= 2010, F.lit(True)) & old_rule) | (_sure(c["year"] >= 2011) & new_rule)


def is_office_visit(c: Mapping[str, Column]) -> Column:
    """Outpatient office visit, by place and procedure group or by evaluation-and-management code."""
    code = F.rtrim(c["proc1"])
    by_place = _sure(c["stdplac"].isin(*OFFICE_PLACES) & c["procgrp"].isin(*OFFICE_PROC_GROUPS))
    by_code = _sure((F.length(code) == 5) & _in_ranges(code, OFFICE_PROC_RANGES))
    return _sure(_scope_is(c["scope"], "O")) & (by_place | by_code)


def is_op_visit(c: Mapping[str, Column]) -> Column:
    """Office visit, or a clinic/treatment-room revenue code."""
    return is_office_visit(c) | _sure(c["revcode"].isin(*OUTPATIENT_REVENUE_CODES))


def is_lab(c: Mapping[str, Column]) -> Column:
    """Laboratory test on an inpatient-service claim."""
    return _sure(_scope_is(c["scope"], "S")) & (
        _sure((c["proctyp"] == "1") & c["proc1"].startswith("8"))
        | _sure(c["procgrp"].isin(*LAB_PROC_GROUPS))
        | _sure(_revenue(c["revcode"], LAB_REVENUE))
    )


def is_radiology(c: Mapping[str, Column]) -> Column:
    """Radiology service."""
    return (
        _sure((c["proctyp"] == "1") & c["proc1"].startswith("7"))
        | _sure(c["proc1"].isin(*RADIOLOGY_CODES))
        | _sure(c["procgrp"].between(*RADIOLOGY_PROC_GROUPS))
        | _sure(_revenue(c["revcode"], RADIOLOGY_REVENUE))
    )


def visit_type(c: Mapping[str, Column]) -> Column:
    """``ER`` for any scope, else ``Office`` or ``Others`` for outpatient claims, else NULL."""
    outpatient = _sure(_scope_is(c["scope"], "O"))
    return (
        F.when(is_er(c), "ER")
        .when(outpatient & is_op_visit(c), "Office")
        .when(outpatient, "Others")
    )


def disease_columns() -> dict[str, Column]:
    """Where each diagnosis column counts for the disease: principal inpatient, first two outpatient, no rule-outs."""
    counts = ~is_ruleout(F.col("proc1"))
    inpatient = counts & _sure(_scope_is(F.col("scope"), "S"))
    outpatient = counts & _sure(_scope_is(F.col("scope"), "O"))
    return {"pdx": inpatient, "dx1": outpatient, "dx2": outpatient}


def disease_flag(codes: Iterable[str]) -> Column:
    """A claim with a disease code where it counts."""
    codes = list(codes)
    hit = F.lit(False)
    for column, condition in disease_columns().items():
        hit = hit | (condition & starts_with_any(column, codes))
    return hit


def claim_columns(*names: str) -> dict[str, Column]:
    """The named columns as the mapping the predicates read; by default all a service predicate may need."""
    return {name: F.col(name) for name in (names or CLAIM_COLUMNS)}
