"""Eligibility extensions named by the study's parameters: age and continuous enrolment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from claimtrail.config import StudyConfig
from claimtrail.operators.scan import restrict_to


def age_filter(df: DataFrame, cfg: StudyConfig = StudyConfig(), age_col: str = "age") -> DataFrame:
    return df.where(F.col(age_col) >= cfg.min_age)


def enrolled_spells(
    enrollment: DataFrame, gap: int, id_col: str = "enrolid", begin_col: str = "dtstart", end_col: str = "dtend"
) -> DataFrame:
    """Enrolment periods with interruptions of up to ``gap`` days closed.

    Periods that begin on one day are merged first, so a patient's window holds at most one row per day.
    """
    per_day = enrollment.groupBy(id_col, begin_col).agg(F.max(end_col).alias(end_col))
    ordered = Window.partitionBy(id_col).orderBy(begin_col)
    reached = F.max(end_col).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.datediff(F.col(begin_col), reached) - 1 > gap, F.lit(True))
    numbered = per_day.withColumn("_opens", opens.cast("int")).withColumn(
        "_spell", F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        numbered.groupBy(id_col, "_spell")
        .agg(F.min(begin_col).alias(begin_col), F.max(end_col).alias(end_col))
        .drop("_spell")
    )


def continuous_enrollment(cohort: DataFrame, enrollment: DataFrame, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """Cohort rows whose patient is enrolled, small gaps aside, over the baseline and outcome windows."""
    own = restrict_to(enrollment, cohort, cfg.id_col)
    spells = enrolled_spells(own, cfg.enrollment_gap, cfg.id_col)
    days = cohort.select(cfg.id_col, "idxdate").distinct()
    covered = spells.join(days, cfg.id_col).where(
        (F.col("dtstart") <= F.date_sub("idxdate", cfg.baseline_days))
        & (F.col("dtend") >= F.date_add("idxdate", cfg.outcome_days))
    )
    return cohort.join(covered.select(cfg.id_col, "idxdate"), [cfg.id_col, "idxdate"], "left_semi")
