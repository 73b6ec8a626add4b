"""Treatment pattern: follow-up fills, adherence (MPR, PDC) and persistence.

The fill histories are running sums and running maxima over a patient's fill days. With fills 1..n on days s_k with
supply d_k and S_k = d_1 + ... + d_k, the day fill k starts to be used is S_{k-1} + max over j <= k of (s_j - S_{j-1}).
Fills are summed per patient and day before any window, so a window holds at most one row per calendar day.
Supplies must be positive, which the cleaning step guarantees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from claimtrail.config import StudyConfig
from claimtrail.functions.dates import is_in_outcome
from claimtrail.operators.joins import lookup_join


ADHERENCE_LABELS = {
    **{f"mpr_df{i}": f"Medication Possession Ratio, Definition {i}" for i in (1, 2, 3)},
    **{f"pdc_df{i}": f"Proportion of Days Covered, Definition {i}" for i in (1, 2, 3)},
}


def multi_treatment_patients(
    cohort: DataFrame, id_col: str = "enrolid", treatment_col: str = "idxtreatment"
) -> DataFrame:
    """Patients with more than one distinct index treatment, and how many."""
    per_treatment = cohort.where(F.col(treatment_col).isNotNull()).select(id_col, treatment_col).distinct()
    return per_treatment.groupBy(id_col).agg(F.count(F.lit(1)).alias("index_freq")).where("index_freq > 1")


def cohort_treatment(
    exposures: DataFrame,
    cohort: DataFrame,
    cfg: StudyConfig = StudyConfig(),
    date_col: str = "svcdate",
    treatment_col: str = "generic_name",
) -> DataFrame:
    """Exposures to the index treatment in the outcome window, for patients with a single index treatment."""
    multiple = multi_treatment_patients(cohort, cfg.id_col)
    indexed = (
        cohort.select(cfg.id_col, "idxdate", F.col("idxtreatment").alias(treatment_col))
        .distinct()
        .join(multiple.select(cfg.id_col), cfg.id_col, "left_anti")
    )
    return (
        lookup_join(exposures, indexed, [cfg.id_col, treatment_col])
        .where(is_in_outcome(F.col(date_col), F.col("idxdate"), cfg.outcome_days))
        .withColumnRenamed(treatment_col, "idxtreatment")
    )


def sum_same_day_supply(
    fills: DataFrame, keys: Sequence[str], date_col: str = "svcdate", days_col: str = "daysupp"
) -> DataFrame:
    """One row per key and day with the day's total supply."""
    return fills.groupBy(*keys, date_col).agg(F.coalesce(F.sum(days_col), F.lit(0)).cast("long").alias(days_col))


def est_refill_chain(
    daily: DataFrame,
    keys: Sequence[str],
    date_col: str = "svcdate",
    days_col: str = "daysupp",
    start_col: str = "est_start",
    before_col: str = "supply_before",
) -> DataFrame:
    """Add the supply of earlier days and the day number (from 1970) on which each day's supply starts to be used."""
    ordered = Window.partitionBy(*keys).orderBy(date_col)
    to_here = ordered.rowsBetween(Window.unboundedPreceding, 0)
    day = F.unix_date(date_col)
    before = F.sum(days_col).over(to_here) - F.col(days_col)
    return daily.withColumn(before_col, before).withColumn(
        start_col, F.col(before_col) + F.max(day - F.col(before_col)).over(to_here)
    )


def covered_days(
    daily: DataFrame,
    keys: Sequence[str],
    end_day,
    date_col: str = "svcdate",
    days_col: str = "daysupp",
    covered_col: str = "covered",
) -> DataFrame:
    """Add the days each row newly covers: the union of [day, day + supply), cut at ``end_day``."""
    earlier = Window.partitionBy(*keys).orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    day = F.unix_date(date_col)
    until = F.least(day + F.col(days_col), F.unix_date(end_day))
    reached = F.greatest(day, F.max(until).over(earlier))
    return daily.withColumn(covered_col, F.greatest(F.lit(0), until - reached))


def adherence(
    fills: DataFrame,
    follow_up_days: int,
    id_col: str = "enrolid",
    date_col: str = "svcdate",
    idx_col: str = "idxdate",
    days_col: str = "daysupp",
) -> DataFrame:
    """Medication possession ratio (three definitions, NULL with a single fill day) and proportion of days covered."""
    keys = [id_col, idx_col]
    in_window = fills.where(is_in_outcome(F.col(date_col), F.col(idx_col), follow_up_days))
    daily = sum_same_day_supply(in_window, keys, date_col, days_col)
    end_day = F.date_add(idx_col, follow_up_days)
    history = covered_days(est_refill_chain(daily, keys, date_col, days_col), keys, end_day, date_col, days_col)
    per_patient = history.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(days_col).alias("_total"),
        F.sum("covered").alias("_covered"),
        F.max(F.unix_date(date_col)).alias("_last"),
        F.max_by(days_col, date_col).alias("_last_days"),
        F.max("est_start").alias("_est"),
    )
    return adherence_measures(per_patient, follow_up_days, id_col, idx_col)


def adherence_measures(per_patient: DataFrame, follow_up_days: int, id_col: str, idx_col: str) -> DataFrame:
    """The measures from a patient's fill days (``_n``), supply, covered days, last fill and the day its supply starts to be used (``_est``)."""
    end_day = F.date_add(idx_col, follow_up_days)
    total, last_days, last, est = (F.col(c) for c in ("_total", "_last_days", "_last", "_est"))
    span = last - F.unix_date(idx_col)
    refilled = F.col("_n") > 1
    zero, one = F.lit(0), F.lit(1.0)
    overrun = F.greatest(zero, est + last_days - F.unix_date(end_day))
    measures = per_patient.select(
        id_col,
        refilled.cast("int").alias("mpr_flag"),
        F.when(refilled, F.least(total / (span + last_days), one)).alias("mpr_df1"),
        F.when(refilled, F.least(F.try_divide(total - last_days, span), one)).alias("mpr_df2"),
        F.when(refilled, F.try_divide(total - last_days - F.greatest(zero, est - last), span)).alias("mpr_df3"),
        (F.col("_covered") / follow_up_days).alias("pdc_df1"),
        ((total - overrun) / follow_up_days).alias("pdc_df2"),
        F.least(total / follow_up_days, one).alias("pdc_df3"),
    )
    return measures.select(*[F.col(c).alias(c, metadata={"label": ADHERENCE_LABELS[c]}) if c in ADHERENCE_LABELS else F.col(c) for c in measures.columns])


def persistence_chain(
    daily: DataFrame, keys: Sequence[str], gap: int, date_col: str = "svcdate", days_col: str = "daysupp"
) -> DataFrame:
    """Add the day number each row's supply lasts to (``supply_end``) and whether the patient had stopped by then.

    ``stopped`` turns true at the first fill that comes more than ``gap`` days after the supply ran out, and stays so.
    """
    ordered = Window.partitionBy(*keys).orderBy(date_col)
    to_here = ordered.rowsBetween(Window.unboundedPreceding, 0)
    chained = est_refill_chain(daily, keys, date_col, days_col)
    ending = chained.withColumn("supply_end", F.col("est_start") + F.col(days_col))
    late = F.unix_date(date_col) - F.lag("supply_end").over(ordered) > gap
    return (
        ending.withColumn("_late", F.coalesce(late, F.lit(False)))
        .withColumn("stopped", F.max("_late").over(to_here))
        .drop("_late", "est_start", "supply_before")
    )


def persistence(
    fills: DataFrame,
    gap: int,
    follow_up_days: int,
    lookforward: bool = True,
    id_col: str = "enrolid",
    date_col: str = "svcdate",
    days_col: str = "daysupp",
) -> DataFrame:
    """Days from the first fill to discontinuation, or to the end of follow-up with ``disc_flag`` 0 (censored).

    Without lookforward the input ends with follow-up, so a supply that runs out within ``gap`` days of it is censored.
    """
    daily = sum_same_day_supply(fills, [id_col], date_col, days_col)
    chain = persistence_chain(daily, [id_col], gap, date_col, days_col)
    spell = chain.groupBy(id_col).agg(
        F.min(F.unix_date(date_col)).alias("_start"),
        F.max(F.when(~F.col("stopped"), F.col("supply_end"))).alias("_end"),
    )
    return persistence_measures(spell, gap, follow_up_days, lookforward, id_col)


def persistence_measures(spell: DataFrame, gap: int, follow_up_days: int, lookforward: bool, id_col: str) -> DataFrame:
    """Time and event from the days a patient's supply begins (``_start``) and runs out or is stopped (``_end``)."""
    held = F.col("_end") - F.col("_start")
    complete = held >= follow_up_days
    if not lookforward:
        complete = complete | (follow_up_days - held <= gap)
    return spell.select(
        id_col,
        F.when(complete, F.lit(follow_up_days)).otherwise(held).cast("long").alias("time"),
        F.when(complete, 0).otherwise(1).alias("disc_flag"),
    )


def outcomes_tp(adhere: DataFrame, persist: DataFrame, id_col: str = "enrolid") -> DataFrame:
    """Adherence and persistence per patient as one table."""
    flag = (1 - F.col("disc_flag")).cast("string")
    return adhere.join(persist, id_col).select(
        id_col,
        F.col("pdc_df2").alias("pdc_df2", metadata={"label": ADHERENCE_LABELS["pdc_df2"]}),
        flag.alias("persistence_flag", metadata={"label": "Persistence Flag"}),
        F.col("time").alias("time", metadata={"label": "Time to discontinuation"}),
    )
