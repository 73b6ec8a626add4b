"""Fill histories that go on: a small state per patient and period, put together in order of time.

The states of earlier periods are stored, and a new period's fills are reduced to one more state; adherence and persistence follow from the
states alone, and are those of a run over all fills. Reducing neighbouring states to one is associative, so they can be put together in any
grouping. If the supply received before a period lasts until day ``x``,

* the period's own lasts until max(x + total, fresh), where ``fresh`` is the day it lasts to with nothing in stock before;
* a fill comes more than the gap after the supply ran out (a stop) if x is below its ``limit``. Only stops with a higher limit than all
  before can be the first one for some x, so no others are kept; the supply then lasted until max(x + its total, its fresh).

``cover`` holds the separate stretches of days that fills cover without carrying supply over. All of a state is bounded by the days of its
period, whatever number of fills it had. Supplies must be positive, as in ``treatment``; fills without a date are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimtrail.functions.dates import is_in_outcome
from claimtrail.operators.treatment import adherence_measures, persistence_measures, sum_same_day_supply
from claimtrail.sources.tables import materialize

STOPS = "array<struct<limit: bigint, total: bigint, fresh: bigint>>"
COVER = "array<struct<since: bigint, until: bigint>>"
STATE = f"struct<first: bigint, last: bigint, n: bigint, total: bigint, last_days: bigint, fresh: bigint, stops: {STOPS}, cover: {COVER}>"


def day_state(day: Column, supply: Column, gap: int) -> Column:
    """State of a single fill day."""
    stop = F.struct(day - gap, F.lit(0), F.lit(None))
    return F.struct(day, day, F.lit(1), supply, supply, day + supply, F.array(stop), F.array(F.struct(day, day + supply))).cast(STATE)


def _last(items: Column) -> Column:
    return F.get(items, F.size(items) - 1)


def _rising(stops: Column) -> Column:
    """The stops whose limit is higher than those of all stops before."""
    higher = lambda kept, s: (F.size(kept) == 0) | (s["limit"] > _last(kept)["limit"])
    return F.aggregate(stops, F.array().cast(STOPS), lambda kept, s: F.when(higher(kept, s), F.concat(kept, F.array(s))).otherwise(kept))


def _merged(cover: Column) -> Column:
    """Stretches in order of their begin, those that touch as one."""

    def add(kept: Column, c: Column) -> Column:
        whole = F.struct(_last(kept)["since"].alias("since"), F.greatest(_last(kept)["until"], c["until"]).alias("until"))
        touching = (F.size(kept) > 0) & (c["since"] <= _last(kept)["until"])
        return F.when(touching, F.concat(F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))), F.array(whole))).otherwise(F.concat(kept, F.array(c)))

    return F.aggregate(cover, F.array().cast(COVER), add)


def join_states(a: Column, b: Column) -> Column:
    """The state of two neighbouring periods, ``a`` before ``b``."""
    behind = F.filter(b["stops"], lambda s: s["limit"] > a["fresh"])
    shifted = F.transform(behind, lambda s: F.struct(
        (s["limit"] - a["total"]).alias("limit"), (s["total"] + a["total"]).alias("total"), F.greatest(a["fresh"] + s["total"], s["fresh"]).alias("fresh"),
    ))
    return F.struct(
        a["first"], b["last"], a["n"] + b["n"], a["total"] + b["total"], b["last_days"], F.greatest(a["fresh"] + b["total"], b["fresh"]),
        _rising(F.concat(a["stops"], shifted)), _merged(F.concat(a["cover"], b["cover"])),
    ).cast(STATE)


def _reduced(states: Column) -> Column:
    later = F.slice(states, 2, F.greatest(F.size(states) - 1, F.lit(0)))
    return F.aggregate(later, F.get(states, F.lit(0)), join_states)


def period_states(
    fills: DataFrame, keys: Sequence[str], gap: int, period: Column, date_col: str = "svcdate", days_col: str = "daysupp"
) -> DataFrame:
    """``keys, period, state``. ``period`` must grow with the date: a year, a quarter.

    Fills are summed by day first, so at most one row per calendar day of the period is gathered for a patient.
    """
    dated = fills.where(F.col(date_col).isNotNull()).withColumn("period", period)
    daily = sum_same_day_supply(dated, [*keys, "period"], date_col, days_col)
    found = daily.groupBy(*keys, "period").agg(F.array_sort(F.collect_list(F.struct(F.unix_date(date_col).alias("day"), F.col(days_col).alias("supply")))).alias("_days"))
    return found.select(*keys, "period", _reduced(F.transform("_days", lambda d: day_state(d["day"], d["supply"], gap))).alias("state"))


def whole_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One ``state`` per key from those of its periods, of which each comes once: a row per key and period is shuffled, no fills."""
    found = states.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("period", F.col("state").alias("s")))).alias("_all"))
    return found.select(*keys, _reduced(F.col("_all")["s"]).alias("state"))


def save_states(spark: SparkSession, states: DataFrame, table: str) -> int:
    """Store states by period and return their number. Periods that the table has already are replaced, the others stay."""
    return materialize(states, table, "partitions" if spark.catalog.tableExists(table) else "fail", ["period"])


def persistence_from(states: DataFrame, gap: int, follow_up_days: int, lookforward: bool = True, id_col: str = "enrolid") -> DataFrame:
    """``treatment.persistence`` from one state per patient; ``gap`` must be that of the states."""
    s = F.col("state")
    stop = F.get(F.filter(s["stops"], lambda p: p["limit"] > s["first"]), F.lit(0))
    end = F.when(stop.isNull(), s["fresh"]).otherwise(F.greatest(s["first"] + stop["total"], stop["fresh"]))
    return persistence_measures(states.select(id_col, s["first"].alias("_start"), end.alias("_end")), gap, follow_up_days, lookforward, id_col)


def adherence_states(
    fills: DataFrame, follow_up_days: int, gap: int, period: Column, id_col: str = "enrolid", date_col: str = "svcdate",
    idx_col: str = "idxdate", days_col: str = "daysupp",
) -> DataFrame:
    """``id, idxdate, period, state`` of the fills in the outcome window."""
    in_window = fills.where(is_in_outcome(F.col(date_col), F.col(idx_col), follow_up_days))
    return period_states(in_window, [id_col, idx_col], gap, period, date_col, days_col)


def adherence_from(states: DataFrame, follow_up_days: int, id_col: str = "enrolid", idx_col: str = "idxdate") -> DataFrame:
    """``treatment.adherence`` from one state per patient and index date."""
    s, end = F.col("state"), F.unix_date(F.date_add(idx_col, follow_up_days)).cast("bigint")
    lengths = F.transform(s["cover"], lambda c: F.greatest(F.lit(0).cast("bigint"), F.least(c["until"], end) - c["since"]))
    covered = F.aggregate(lengths, F.lit(0).cast("bigint"), lambda total, n: total + n)
    per_patient = states.select(
        id_col, idx_col, s["n"].alias("_n"), s["total"].alias("_total"), covered.alias("_covered"), s["last"].alias("_last"),
        s["last_days"].alias("_last_days"), (s["fresh"] - s["last_days"]).alias("_est"),
    )
    return adherence_measures(per_patient, follow_up_days, id_col, idx_col)
