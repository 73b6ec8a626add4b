from __future__ import annotations

from datetime import date

from claimtrail.config import StudyConfig
from claimtrail.operators.charlson import GROUPS, charlson, rules
from claimtrail.operators.conditions import (
    baseline, baseline_claims, common_conditions, condition_frequency, patient_conditions, rank_labels_top_n,
)
from claimtrail.operators.reshape import vec2mat
from tests.conftest import rows


def flags_of(spark, codes):
    """Groups hit by each code, one code per patient."""
    df = spark.createDataFrame(list(enumerate(codes)), "enrolid int, dx1 string")
    got = {r["enrolid"]: r for r in charlson(df, dx_cols=["dx1"], char_flags=False).collect()}
    return [({n for n, *_ in GROUPS if got[i][f"cc_grp_{n}"]}, got[i]["charlson_index"]) for i in range(len(codes))]


def step(code, by):
    """The neighbouring code of the same length, for codes that end in a digit."""
    digits = len(code) - len(code.lstrip("VE"))
    return code[:digits] + str(int(code[digits:]) + by).zfill(len(code) - digits)


def test_every_rule_edge(spark):
    inside, outside = [], []
    for group, _, low, high in rules():
        inside += [(low, group), (high, group), (low.ljust(5, "0"), group)]
        outside += [(step(low, -1), group), (step(high, 1), group)]
    hits = flags_of(spark, [c for c, _ in inside])
    for (code, group), (found, _) in zip(inside, hits):
        assert group in found, code
    covered = {group: [(n, lo, hi) for g, n, lo, hi in rules() if g == group] for group, *_ in GROUPS}
    for (code, group), (found, _) in zip(outside, flags_of(spark, [c for c, _ in outside])):
        assert (group in found) == any(lo <= code[:n] <= hi for n, lo, hi in covered[group]), code


def test_weights_case_blanks_and_no_hierarchy(spark):
    data = [
        (1, "  v56.", "410"), (2, "07022", "4560"), (3, None, ""), (4, "042", "196"), (4, "042", None), (5, "2500", "2504"),
    ]
    df = spark.createDataFrame(data, "enrolid int, dx1 string, dx2 string")
    got = {r["enrolid"]: r for r in charlson(df).collect()}
    assert {k: r["charlson_index"] for k, r in got.items()} == {1: 3, 2: 4, 3: 0, 4: 12, 5: 3}
    assert got[1]["cc_grp_13"] == "1" and got[1]["cc_grp_2"] == "0"
    assert sum(w for *_, w, _ in GROUPS) == 10 + 8 + 3 + 12


def test_one_shuffle(spark, plan):
    df = spark.createDataFrame([(1, "410", None)], "enrolid int, dx1 string, dx2 string")
    text = plan(charlson(df))
    assert text.count("Exchange") == 1 and "partial_bit_or" in text and "Python" not in text


def test_conditions(spark):
    data = [
        (1, "4011", None), (1, "4019", " 250"), (2, "401", ""), (3, None, None), (4, "6961", "250"), (5, "6962", "99"),
    ]
    df = spark.createDataFrame(data, "enrolid int, dx1 string, dx2 string")
    pairs = patient_conditions(df)
    assert (1, "") in rows(pairs) and (3, "") in rows(pairs)
    expected = [("250", 2), ("401", 2), ("99", 1)]
    assert rows(condition_frequency(pairs, ["6961"])) == expected
    assert rows(condition_frequency(pairs, spark.createDataFrame([("6961",)], "icd9 string"))) == expected
    top = rank_labels_top_n(condition_frequency(pairs, ["6961"]), 2)
    assert rows(top, "icd9_3", "icd9_3_rank") == [("250", "ICD93d_Top_1"), ("401", "ICD93d_Top_2")]
    flags = common_conditions(pairs, top)
    assert flags.columns == ["enrolid", "ICD93d_Top_1", "ICD93d_Top_2"]
    assert rows(flags) == [(1, "1", "1"), (2, "0", "1"), (3, "0", "0"), (4, "1", "0"), (5, "0", "0")]


def test_ties_across_the_last_place(spark):
    freq = spark.createDataFrame([(f"{i:03d}", 5 if i < 9 else 3) for i in range(13)], "icd9_3 string, freq long")
    assert rank_labels_top_n(freq, 10).count() == 13
    assert rank_labels_top_n(freq, 9).count() == 9


def test_baseline_window_and_ruleout(spark):
    idx = date(2007, 6, 1)
    data = [
        (1, date(2007, 5, 31), "410", None, None), (1, idx, "196", None, None), (1, date(2006, 6, 1), "042", None, None),
        (1, date(2006, 5, 31), "290", None, None), (2, date(2007, 5, 1), "196", None, "80053"), (3, date(2007, 5, 1), None, "401", "99213"),
    ]
    claims = spark.createDataFrame([(*r[:2], idx, *r[2:]) for r in data], "enrolid int, svcdate date, idxdate date, dx1 string, dx2 string, proc1 string")
    assert baseline_claims(claims).count() == 3
    table = baseline(claims, ["6961"], StudyConfig())
    assert rows(table, "enrolid", "charlson_index") == [(1, 7), (3, 0)]


def test_vec2mat_labels(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "z")], "id int, v string")
    wide = vec2mat(df, "id", "v", {"a": "has_a", "b": "has_b"})
    assert rows(wide) == [(1, 1, 1), (2, 0, 0)]
    assert wide.schema["has_a"].metadata["label"] == "has_a (a)"
    assert rows(vec2mat(df, "id", "v", {"a": "has_a"}, numeric=False)) == [(1, "1"), (2, "0")]
    assert rows(vec2mat(df, "id", "v", {})) == [(1,), (2,)]
