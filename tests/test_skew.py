"""One patient, or copies of one claim, hold a third or more of the rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from claimtrail.operators.conditions import patient_conditions
from claimtrail.operators.exposure import index_cohort
from claimtrail.operators.joins import split_join
from claimtrail.operators.supply import clean_supply_days, dedupe_keep_max_supply, supply_mode
from claimtrail.operators.treatment import adherence, persistence
from tests.conftest import rows

ROWS = 30_000


def skewed(spark):
    """Half of the rows are patient 0, most of them copies of one fill."""
    base = spark.range(0, ROWS, 1, 8)
    hot = F.col("id") % 2 == 0
    day = F.when(hot & (F.col("id") % 10 != 0), 0).otherwise(F.col("id") % 300).cast("int")
    return base.select(
        F.when(hot, 0).otherwise(F.col("id") % 200 + 1).cast("int").alias("enrolid"),
        F.date_add(F.lit(date(2007, 1, 1)), day).alias("svcdate"),
        F.lit(date(2007, 1, 1)).alias("idxdate"),
        F.concat(F.lit("n"), (F.col("id") % 3).cast("string")).alias("ndcnum"),
        F.lit(30).alias("daysupp"),
        F.lit("drug").alias("generic_name"),
        F.lit("4280").alias("dx1"),
    )


def most_rows_in_a_partition(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_copies_are_merged_before_the_shuffle(spark):
    cleaned = clean_supply_days(skewed(spark))
    assert cleaned.where("enrolid = 0").count() == skewed(spark).where("enrolid = 0").select("svcdate", "ndcnum").distinct().count()
    pairs = patient_conditions(skewed(spark), dx_cols=["dx1"])
    assert pairs.count() == 101
    cohort = index_cohort(skewed(spark), demographics=[])
    assert rows(cohort.where("enrolid = 0")) == [(0, date(2007, 1, 1), "drug")]


def test_split_join_spreads_the_hot_patient(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        varied = skewed(spark).withColumn("row", F.monotonically_increasing_id())
        patients = varied.select("enrolid").distinct()
        plain = most_rows_in_a_partition(varied.join(patients, "enrolid"))
        spread = most_rows_in_a_partition(split_join(varied, patients, ["enrolid"], rows_per_task=1_000))
        assert plain >= ROWS / 2 and spread < plain / 3
        assert split_join(varied, patients, ["enrolid"], rows_per_task=1_000).count() == ROWS
    finally:
        for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_windows_hold_days_not_rows(spark):
    fills = skewed(spark)
    assert adherence(fills, 364).where("enrolid = 0").first()["pdc_df1"] == 1
    assert rows(persistence(fills, 60, 300).where("enrolid = 0"), "time", "disc_flag") == [(300, 0)]


def test_hot_drug_code(spark):
    """A drug code with half of the fills: cleaned alike whether its usual supply is broadcast or its rows are split."""
    hot = skewed(spark).withColumn("ndcnum", F.when(F.col("enrolid") % 2 == 0, "hot").otherwise(F.col("ndcnum")))
    hot = hot.withColumn("daysupp", F.when(F.col("enrolid") % 3 == 0, 0).otherwise(F.col("daysupp")))
    fills = dedupe_keep_max_supply(hot, ["enrolid", "svcdate", "ndcnum"])
    usual = supply_mode(fills)
    cleaned = clean_supply_days(hot)
    supply = F.when(F.col("daysupp") > 0, F.col("daysupp")).otherwise(F.col("mode_supply")).alias("daysupp")
    split = split_join(fills, usual, ["ndcnum"], rows_per_task=100).select("enrolid", "svcdate", "ndcnum", supply)
    assert rows(split) == rows(cleaned) and cleaned.where("ndcnum = 'hot'").count() > 300
