"""Kaplan-Meier estimate of time to discontinuation.

Times are whole days, so after counting patients per day what is ordered has at most one row per day of follow-up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

QUARTILES = (0.25, 0.5, 0.75)
_SAME = 1e-9  # two survival values closer than this are one step


def _per_day(df: DataFrame, time_col: str, event_col: str) -> DataFrame:
    if not isinstance(df.schema[time_col].dataType, T.IntegralType):
        raise TypeError(f"{time_col} must be whole days")
    return (
        df.where(F.col(time_col).isNotNull())
        .groupBy(F.col(time_col).cast("long").alias("time"))
        .agg(F.count_if(F.col(event_col) == 1).alias("n_event"), F.count(F.lit(1)).alias("_n"))
    )


def km_survival(df: DataFrame, time_col: str = "time", event_col: str = "disc_flag") -> DataFrame:
    """Product-limit survival per observed day, with the Greenwood standard error (NULL once survival is 0)."""
    later = Window.orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, 0)
    so_far = Window.orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    counted = _per_day(df, time_col, event_col).withColumn("n_risk", F.sum("_n").over(later))
    left = F.col("n_risk") - F.col("n_event")
    hazard_var = F.sum(F.when(left > 0, F.col("n_event") / (F.col("n_risk") * left))).over(so_far)
    survival = F.product(left / F.col("n_risk")).over(so_far)
    return (
        counted.withColumn("survival", survival)
        .withColumn("_var", hazard_var)
        .select(
            "time",
            "n_risk",
            "n_event",
            (F.col("_n") - F.col("n_event")).alias("n_censor"),
            "survival",
            F.when(F.col("survival") > 0, F.col("survival") * F.sqrt("_var")).alias("std_err"),
        )
    )


def km_quartiles(curve: DataFrame, fractions: Sequence[float] = QUARTILES) -> DataFrame:
    """Day by which each fraction has had the event: the first day survival falls below 1 - fraction.

    Where the curve rests exactly on 1 - fraction it is the midpoint of that step. NULL if the curve never gets there.
    """
    names, found = [], []
    for i, fraction in enumerate(fractions):
        level = 1 - fraction
        below = F.min(F.when(F.col("survival") < level - _SAME, F.col("time")))
        on = F.min(F.when(F.abs(F.col("survival") - level) <= _SAME, F.col("time")))
        names.append((fraction, f"_q{i}"))
        found.append(((F.coalesce(on, below) + below) / 2).alias(f"_q{i}"))
    row = curve.agg(*found)
    pairs = F.array(*[F.struct(F.lit(f).alias("fraction"), F.col(n).alias("time")) for f, n in names])
    return row.select(F.inline(pairs))


def km_at_risk(df: DataFrame, ticks: Sequence[int], time_col: str = "time", event_col: str = "disc_flag") -> DataFrame:
    """Patients still at risk just before each tick day."""
    counts = _per_day(df, time_col, event_col).agg(
        *[F.coalesce(F.sum(F.when(F.col("time") >= t, F.col("_n"))), F.lit(0)).alias(f"_t{i}") for i, t in enumerate(ticks)]
    )
    pairs = F.array(*[F.struct(F.lit(t).alias("tick"), F.col(f"_t{i}").alias("n_risk")) for i, t in enumerate(ticks)])
    return counts.select(F.inline(pairs))
