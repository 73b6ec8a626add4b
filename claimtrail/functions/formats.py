"""Value formats: code -> label."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values: labels ----
PLAN_TYPE = {
    1: "1-Basic/Major Medical",
    2: "2-Comprehensive",
    3: "3-EPO",
    4: "4-HMO",
    5: "5-POS",
    6: "6-PPO",
    7: "7-POS with Capitation",
    8: "8-CDHP",
    9: "9-HDHP",
}
PLAN_TYPE_MISSING = ".-Missing/Unknown"
PLAN_GROUP = {
    "1-Fee for service": (1, 2, 3, 5, 6, 8, 9),
    "3-HMO and POS capitation": (4, 7),
}
PLAN_GROUP_OTHER = "2-Unknown"
REGION = {
    "1": "1-Northeast Region",
    "2": "2-North Central Region",
    "3": "3-South Region",
    "4": "4-West Region",
    "5": "5-Unknown Region",
}
SEX = {"1": "1-Male", "2": "2-Female"}
SEX_MISSING = "Missing/Unknown"


def _labelled(value: Column, labels: dict, text: Column) -> Column:
    """CASE over the labels; a value without a label is shown as itself."""
    out = None
    for code, label in labels.items():
        out = F.when(value == code, label) if out is None else out.when(value == code, label)
    return out.otherwise(text)


def plantyp_label(plantyp: Column) -> Column:
    whole = plantyp.cast("long")
    shown = _labelled(plantyp, PLAN_TYPE, F.when(plantyp == whole, whole.cast("string")).otherwise(plantyp.cast("string")))
    return F.when(plantyp.isNull(), PLAN_TYPE_MISSING).otherwise(shown)


def plan_group_label(plantyp: Column) -> Column:
    out = None
    for label, members in PLAN_GROUP.items():
        out = F.when(plantyp.isin(*members), label) if out is None else out.when(plantyp.isin(*members), label)
    return out.otherwise(PLAN_GROUP_OTHER)


def region_label(region: Column) -> Column:
    return _labelled(region, REGION, region)


def sex_label(sex: Column) -> Column:
    return F.when(F.coalesce(F.trim(sex), F.lit("")) == "", SEX_MISSING).otherwise(_labelled(sex, SEX, sex))
