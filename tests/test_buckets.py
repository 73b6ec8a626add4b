"""Tables stored by patient: joins without exchanges, and patients with too many rows."""

from __future__ import annotations


import pytest
from pyspark.sql import functions as F

from claimtrail.config import StudyConfig
from claimtrail.operators.treatment import adherence, persistence
from claimtrail.operators.utilization import hospitalization, outcomes_ru, visit_counts, visits
from claimtrail.plans.study import BY_PATIENT, folder_saver, study_run, table_saver, variables
from claimtrail.sources.buckets import bucket_count, buckets_of, together
from claimtrail.sources.manifest import entry_of
from claimtrail.sources.tables import create_libraries, materialize
from tests.conftest import rows
from tests.test_study import START, make_inputs

CFG = StudyConfig()


@pytest.fixture(scope="module", autouse=True)
def libraries(spark):
    create_libraries(spark, ["out_b", "rds", "sds", "ads"])


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucket_count():
    assert [bucket_count(n, 10) for n in (0, 1, 10, 11, 20, 21, 40, 41)] == [1, 1, 1, 2, 2, 4, 4, 8]
    assert bucket_count(10**15) == 1 << 16


def test_joins_of_buckets_need_no_exchange(spark, plan, no_broadcast):
    left = spark.range(1000).selectExpr("id % 97 AS enrolid", "id AS x")
    right = spark.range(97).selectExpr("id AS enrolid", "id * 2 AS y")
    for name, df in (("a", left), ("b", right)):
        materialize(df, f"out_b.{name}", bucket_by=("enrolid", 8))
    materialize(right, "out_b.c", bucket_by=("enrolid", 4))
    a, b, c = (spark.table(f"out_b.{n}") for n in "abc")
    assert buckets_of(spark, "out_b.a") == ("enrolid", 8)
    assert together(spark, "out_b.a", "out_b.b") and not together(spark, "out_b.a", "out_b.c")
    assert "Exchange" not in plan(a.join(b, "enrolid"))
    assert "Exchange" not in plan(a.groupBy("enrolid", "x").count().groupBy("enrolid").agg(F.sum("count")))
    assert "Exchange" in plan(a.join(c, "enrolid"))
    assert rows(a.join(b, "enrolid")) == rows(left.join(right, "enrolid")) == rows(a.join(c, "enrolid"))


def test_what_is_appended_keeps_to_the_buckets(spark, plan, no_broadcast):
    materialize(spark.range(50).selectExpr("id AS enrolid"), "out_b.d", bucket_by=("enrolid", 4))
    materialize(spark.range(50, 80).selectExpr("id AS enrolid"), "out_b.d", "append")
    d = spark.table("out_b.d")
    assert d.count() == 80 and buckets_of(spark, "out_b.d") == ("enrolid", 4)
    assert "Exchange" not in plan(d.groupBy("enrolid").count()) and rows(d.groupBy("enrolid").count()) == [(i, 1) for i in sorted(range(80), key=lambda i: repr((i, 1)))]
    with pytest.raises(ValueError, match="neither"):
        materialize(d, "out_b.e", partition_by=["enrolid"], bucket_by=("enrolid", 4))


def test_the_most_frequent_patient_is_kept(spark):
    skewed = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("enrolid"))
    assert materialize(skewed, "out_b.f", watch="enrolid") == 3000
    assert entry_of(spark, "out_b.f") == {"rows": "3000", "hottest": "1000"}
    materialize(skewed.limit(0), "out_b.f", watch="enrolid")
    assert entry_of(spark, "out_b.f") == {"rows": "0", "hottest": "0"}


@pytest.fixture(scope="module")
def stored(spark):
    return study_run(spark, make_inputs(spark), CFG, table_saver(spark, id_col="enrolid", rows_per_bucket=7))


def test_analysis_of_stored_tables_moves_no_patient(spark, plan, stored, no_broadcast):
    assert len({buckets_of(spark, name) for name in BY_PATIENT}) == 1 and buckets_of(spark, "ads.variables") == ("enrolid", 4)
    parts = [stored[f"ads.{n}"] for n in ("baseline", "outcomes_ru", "outcomes_tp")]
    codes, claims, stays, fills = ["6961"], stored["sds.sddx"], stored["sds.sdadm"], stored["sds.cohort_treatment"]
    counts, hospital = visit_counts(visits(claims, codes, CFG)), hospitalization(stays, codes, CFG, ["proc1", "proc2"])
    for df in (
        variables(stored["rds.allpt"], *parts), outcomes_ru(stored["sds.sddm"], hospital, counts, CFG),
        adherence(fills, CFG.outcome_days), persistence(fills, CFG.refill_gap, CFG.drug_followup_days),
    ):
        assert "Exchange" not in plan(df), plan(df)


def test_the_layout_changes_no_row(spark, stored):
    plain = study_run(spark, make_inputs(spark), CFG, folder_saver(spark))
    for name in (*BY_PATIENT, "ads.km"):
        assert rows(stored[name]) == rows(plain[name]), name


def test_a_patient_with_too_many_rows(spark):
    """Claims of a patient that fill more than a bucket are stored as they come; the results are the same."""
    made = make_inputs(spark)
    claim = made.services.where("enrolid = 1 AND dx1 = '6961'").limit(1)
    many = claim.drop("svcdate").crossJoin(spark.range(40).selectExpr(f"date_add(DATE '{START}', CAST(id AS INT)) AS svcdate")).select(*made.services.columns)
    made = type(made)(**vars(made) | {"services": made.services.unionByName(many)})
    out = study_run(spark, made, CFG, table_saver(spark, id_col="enrolid", rows_per_bucket=20))
    assert buckets_of(spark, "sds.sddx") is None and buckets_of(spark, "sds.sdadm") == buckets_of(spark, "rds.allpt") is not None
    assert int(entry_of(spark, "rds.alldx")["hottest"]) > 40
    plain = study_run(spark, made, CFG, folder_saver(spark))
    assert rows(out["ads.variables"]) == rows(plain["ads.variables"])
    assert out["ads.outcomes_ru"].where("enrolid = 1").first()["all_office"] == 40
