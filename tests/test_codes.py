from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from claimtrail.functions.codes import clean_icd9, inline_codes, ndc_11, starts_with_any
from claimtrail.operators.index import code_index
from claimtrail.operators.scan import (
    attach_generic, code_list_df, equal_join, exclude, flag_prefix, prefix_join, restrict_to, scan_dx, scan_enrollment, scan_rx,
)
from tests.conftest import rows


def test_clean_icd9(spark):
    df = spark.createDataFrame([("696.1x",), ("X12.xx",), ("4280",), (None,)], "c string")
    assert [r[0] for r in df.select(clean_icd9(F.col("c"))).collect()] == ["6961", "X12", "4280", None]


@pytest.mark.parametrize(
    "given, wanted",
    [
        ("1234-567-8", "01234056708"),
        ("12345-6789-01", "12345678901"),
        ("123456789", "00123456789"),
        ("123456-7-8", "123456000708"),
        ("12-34", "00000001234"),
        ("1234567890123", "1234567890123"),
        (None, None),
    ],
)
def test_ndc_11(spark, given, wanted):
    assert spark.createDataFrame([(given,)], "c string").select(ndc_11(F.col("c"))).first()[0] == wanted


def test_inline_codes_is_bounded(spark):
    codes = spark.createDataFrame([("a",), ("b",), ("b",), ("",), (None,)], "c string")
    assert inline_codes(codes) == ["a", "b"]
    assert inline_codes(codes, max_bytes=9) is None
    assert inline_codes(["b", "", "a", "a"]) == ["a", "b"]


def test_quotes_in_codes(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",), ("other",)], "c string")
    assert {r[0] for r in df.where(starts_with_any("c", ["it'", "a\\"])).collect()} == {"a\\b", "it's"}


CODES = ["41", "410", "4101", "V4", "9", ""]


def brute_force(claims, codes):
    out = []
    for claim in claims:
        for code in sorted({c for c in codes if c}):
            if any(dx is not None and dx.startswith(code) for dx in claim[1:]):
                out.append((*claim, code))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_inline", [1000, 2])
def test_prefix_join_equals_theta_join(spark, max_inline, plan):
    rng = random.Random(3)
    pool = [None, "", "4", "41", "410", "41011", "4102", "V42", "v42", "9", "98", "1410"]
    claims = [(i // 2, rng.choice(pool), rng.choice(pool), rng.choice(pool)) for i in range(300)]
    claims += [(7, "4101", "4101", None)] * 3
    df = spark.createDataFrame(claims, "id int, pdx string, dx1 string, dx2 string")
    for codes in (CODES + ["410"], spark.createDataFrame([(c,) for c in CODES + ["410", None]], "c string")):
        found = prefix_join(df, codes, ["pdx", "DX1", "dx2", "absent"], "code", max_inline)
        assert rows(found) == brute_force(claims, CODES)
        assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)


@pytest.mark.parametrize("max_inline", [1000, 1])
def test_equal_join(spark, max_inline, plan):
    data = [(1, "a", "a"), (2, "a", "b"), (3, None, "b"), (4, "c", ""), (4, "c", "")]
    df = spark.createDataFrame(data, "id int, p1 string, p2 string")
    found = equal_join(df, ["a", "b", "b", "", "zz"], ["p1", "p2"], "code", max_inline)
    assert rows(found, "id", "code") == [(1, "a"), (2, "a"), (2, "b"), (3, "b")]
    assert "NestedLoop" not in plan(found)
    assert found.columns == ["id", "p1", "p2", "code"]


@pytest.mark.parametrize("max_inline", [1000, 1])
def test_flag_prefix_keeps_rows(spark, max_inline):
    data = [(1, "410", None, True), (2, "999", "41", True), (3, "410", "41", False), (4, None, None, True), (1, "410", None, True)]
    df = spark.createDataFrame(data, "id int, a string, b string, ok boolean")
    flagged = flag_prefix(df, {"a": F.col("ok"), "b": F.col("ok")}, ["41", "4"], "hit", max_inline)
    assert rows(flagged, "id", "hit") == [(1, True), (1, True), (2, True), (3, False), (4, False)]


def test_empty_code_list(spark):
    df = spark.createDataFrame([("a",)], "p string")
    assert prefix_join(df, [""], ["p"]).count() == 0
    assert equal_join(df, [""], ["p"]).count() == 0
    assert flag_prefix(df, {"p": F.lit(True)}, [""], "hit").first()["hit"] is False


def test_scan_arguments(spark):
    df = spark.sql("SELECT 'a' AS p, date'2006-05-05' AS svcdate, 'ccae' AS source, 'o' AS scope")
    for scan, arg in ((scan_dx, "dx_cols"), (scan_rx, "rx_cols")):
        with pytest.raises(ValueError):
            scan(df, codes=["a"])
        with pytest.raises(ValueError):
            scan(df, **{arg: ["p"]})
        assert scan(df, ["a"], ["p"]).columns == df.columns
        assert scan(df).count() == 1
        assert scan(df, sources=["mdcr"]).count() == 0
    with pytest.raises(ValueError):
        scan_dx(df, ["a"], ["absent"])


def test_interval_ends(spark):
    from datetime import date

    df = spark.sql(
        "SELECT * FROM VALUES (1, date'2006-01-01', date'2006-02-01'), (2, date'2006-03-01', null), (3, date'2005-01-01', date'2005-12-31')"
        " AS t(id, b, e)"
    )
    window = {"start": date(2006, 1, 15), "end": date(2006, 12, 31)}
    assert rows(scan_dx(df, date_col="b", end_col="e", **window), "id") == [(1,)]
    assert rows(scan_dx(df, date_col="b", end_col="e", coalesce_end=True, **window), "id") == [(1,), (2,)]
    assert rows(scan_enrollment(df, begin_col="b", end_col="e", **window), "id") == [(1,)]


def test_generic_fans_out_and_id_filters(spark):
    claims = spark.createDataFrame([(1, "a"), (2, "b"), (None, "a")], "enrolid int, code string")
    listed = spark.createDataFrame([("a", "x"), ("a", "y")], "ndc string, generic_name string")
    assert rows(attach_generic(claims, listed, "code", "ndc"), "enrolid", "generic_name") == [
        (1, "x"), (1, "y"), (None, "x"), (None, "y"),
    ]
    others = spark.createDataFrame([(1,), (1,), (None,)], "enrolid int")
    assert rows(restrict_to(claims, others)) == [(1, "a")]
    assert rows(exclude(claims, others)) == [(2, "b"), (None, "a")]


def test_code_list_df(spark):
    assert rows(code_list_df(spark, ["b", "a", "b", ""], "rx")) == [("a",), ("b",)]


def test_lists_as_text(spark):
    df = spark.createDataFrame([("4101", "9", "ccae", "o"), ("5", "69", "mdcr", "s")], "pdx string, dx1 string, source string, scope string")
    assert rows(prefix_join(df, "410, 69", "pdx dx1", "code"), "code") == [("410",), ("69",)]
    assert rows(equal_join(df, "5 9", "pdx,dx1", "code", 1), "code") == [("5",), ("9",)]
    assert scan_dx(df, "410,69", "pdx, dx1", sources="ccae,mdcr", scopes="s").count() == 1


@pytest.mark.parametrize("size", [0, 1, 30, 31, 32, 200])
def test_both_code_paths_agree_around_the_bound(spark, size):
    """Integer and text columns, copies of rows, NULL, and lists just under and over what is inlined."""
    df = spark.createDataFrame([(i % 9, i, str(i % 40) if i % 5 else None) for i in range(120)] + [(1, 10, "10")] * 2, "k int, a int, b string")
    codes = [str(i) for i in range(size)] + ["007", "7"]
    bound = sum(len(c) + 8 for c in dict.fromkeys(codes[:31]))
    for join in (prefix_join, equal_join):
        found = [rows(join(df, codes, ["a", "b"], "code", *limits)) for limits in ((1 << 20,), (bound,), (0,), (0, 0))]
        assert found[0] == found[1] == found[2] == found[3]
        for limits in ((0,), (0, 0)):
            assert join(df, codes, ["a", "b"], "code", *limits).dtypes == join(df, codes, ["a", "b"], "code", 1 << 20).dtypes
    conditions = {"a": F.col("k") > 2, "b": F.col("k") < 5}
    flagged = [rows(flag_prefix(df, conditions, codes, "hit", *limits)) for limits in ((1 << 20,), (bound,), (0,), (0, 0))]
    assert flagged[0] == flagged[1] == flagged[2] == flagged[3] and len(flagged[0]) == 122


def test_long_list_plan_has_one_join(spark, plan):
    df = spark.createDataFrame([(1, "41", "4")], "k int, a string, b string")
    listed = spark.createDataFrame([("41",), ("4",), ("412",)], "c string")
    conditions = {"a": F.lit(True), "b": F.lit(True)}
    for found in (flag_prefix(df, conditions, listed, "hit", 0, 0), prefix_join(df, listed, ["a", "b"], "code", 0, 0)):
        assert plan(found).count("Join ") == 1


def test_indexed_list_plan_has_no_join_and_no_exchange(spark, plan):
    """A list of a quarter of a megabyte: claims stay where they are, and only matching claims are exploded."""
    df = spark.range(2_000).select(F.col("id").cast("string").alias("a"), (F.col("id") * 3).cast("string").alias("b"))
    listed = spark.range(7, 40_000, 4).select(F.col("id").cast("string").alias("c"))
    conditions = {"a": F.lit(True), "b": F.col("a") > "5"}
    flagged, joined, equal = flag_prefix(df, conditions, listed, "hit"), prefix_join(df, listed, ["a", "b"], "code"), equal_join(df, listed, ["a", "b"], "code")
    assert "Generate" not in plan(flagged)
    for found in (flagged, joined, equal):
        assert "Join" not in plan(found) and "Exchange" not in plan(found)
    codes = {str(i) for i in range(7, 40_000, 4)}
    held = lambda text: {text[:n] for n in range(1, len(text) + 1)} & codes
    claims = [(str(i), str(i * 3)) for i in range(2_000)]
    assert rows(flagged) == sorted(((a, b, bool(held(a) or (a > "5" and held(b)))) for a, b in claims), key=repr)
    assert rows(joined) == sorted(((a, b, c) for a, b in claims for c in held(a) | held(b)), key=repr)
    assert rows(equal) == sorted(((a, b, c) for a, b in claims for c in {a, b} & codes), key=repr)


def test_code_index_bounds(spark):
    listed = spark.createDataFrame([("41",), ("4",)], "c string")
    assert code_index(listed, 66) is None and code_index(listed, 67).lengths == (1, 2)
    nothing = code_index(listed.where("c = ''"))
    assert nothing.lengths == () and not spark.range(1).select(nothing.holds(F.lit("4"))).first()[0]


def test_a_clashing_code_column_is_refused(spark):
    df = spark.createDataFrame([("41", "x")], "a string, code string")
    for join in (prefix_join, equal_join):
        for limit in (1 << 20, 0):
            with pytest.raises(ValueError):
                join(df, ["4"], ["a"], "code", limit)
