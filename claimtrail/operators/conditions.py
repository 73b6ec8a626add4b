"""Most common baseline conditions (three-character diagnoses) and the baseline table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from claimtrail.config import StudyConfig
from claimtrail.functions.dates import is_in_baseline
from claimtrail.functions.predicates import is_ruleout
from claimtrail.operators.charlson import charlson
from claimtrail.operators.joins import saved, spread_distinct
from claimtrail.operators.reshape import flag_dictionary, vec2mat


def baseline_claims(claims: DataFrame, cfg: StudyConfig = StudyConfig(), date_col: str = "svcdate") -> DataFrame:
    """Study claims of the baseline period that are not rule-out claims."""
    in_window = is_in_baseline(F.col(date_col), F.col("idxdate"), cfg.baseline_days)
    return claims.where(in_window & ~is_ruleout(F.col("proc1")))


def condition_heads(dx: DataFrame, id_col: str = "enrolid", dx_cols: Sequence[str] = ("dx1", "dx2")) -> DataFrame:
    """(patient, three-character diagnosis) for every diagnosis field; a missing diagnosis is a blank one."""
    heads = [F.coalesce(F.substring(F.trim(c), 1, 3), F.lit("")) for c in dx_cols]
    return dx.select(id_col, F.explode(F.array(*heads)).alias("icd9_3"))


def patient_conditions(dx: DataFrame, id_col: str = "enrolid", dx_cols: Sequence[str] = ("dx1", "dx2")) -> DataFrame:
    """Distinct (patient, three-character diagnosis)."""
    return spread_distinct(condition_heads(dx, id_col, dx_cols))


def condition_frequency(conditions: DataFrame, excluded: DataFrame | Iterable[str] = ()) -> DataFrame:
    """Patients per three-character diagnosis, without blanks and without the disease's own codes."""
    counted = (
        conditions.where(F.col("icd9_3") != "").groupBy("icd9_3").agg(F.count(F.lit(1)).alias("freq"))
    )
    if not isinstance(excluded, DataFrame):
        heads = sorted({c[:3] for c in excluded})
        return counted.where(~F.col("icd9_3").isin(heads)) if heads else counted
    heads = excluded.select(F.substring(F.col(excluded.columns[0]), 1, 3).alias("icd9_3")).distinct()
    return counted.join(heads, "icd9_3", "left_anti")


def rank_labels_top_n(frequency: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent conditions and all that tie with the last, labelled ``ICD93d_Top_1`` and on.

    The input has one row per three-character code, so ordering it in one task is bounded by the coding system.
    """
    by_freq = Window.orderBy(F.desc("freq"))
    numbered = frequency.withColumn("_rank", F.rank().over(by_freq)).withColumn(
        "_n", F.row_number().over(Window.orderBy(F.desc("freq"), F.asc("icd9_3")))
    )
    label = F.concat(F.lit("ICD93d_Top_"), F.col("_n").cast("string"))
    return numbered.where(F.col("_rank") <= n).select("icd9_3", "freq", label.alias("icd9_3_rank"), F.col("_n").alias("position"))


def common_conditions(conditions: DataFrame, top: DataFrame, id_col: str = "enrolid") -> DataFrame:
    """A ``'0'``/``'1'`` flag per top condition for every patient with a baseline claim, in rank order.

    ``conditions`` may repeat its rows: the flags combine before the shuffle.
    """
    dictionary = flag_dictionary(top, "icd9_3", "icd9_3_rank")
    ordered = dict(sorted(dictionary.items(), key=lambda kv: int(kv[1].rsplit("_", 1)[1])))
    return vec2mat(conditions, id_col, "icd9_3", ordered, numeric=False)


def baseline(
    claims: DataFrame,
    disease_codes: DataFrame | Iterable[str],
    cfg: StudyConfig = StudyConfig(),
    dx_cols: Sequence[str] = ("dx1", "dx2"),
) -> DataFrame:
    """Comorbidity flags, the Charlson index and the common-condition flags per patient."""
    dx = baseline_claims(claims, cfg).select(cfg.id_col, *dx_cols)
    # the claims are read once, for the distinct diagnoses of each patient; all that follows reads these
    fields = [F.coalesce(F.col(c), F.lit("")) for c in dx_cols]
    own = saved(dx.select(cfg.id_col, F.explode(F.array(*fields)).alias("dx")).distinct(), "diagnoses")
    heads = condition_heads(own, cfg.id_col, ["dx"])
    top = rank_labels_top_n(condition_frequency(heads.distinct(), disease_codes), cfg.top_conditions)
    # written, else the flags of both parts make one method too large to compile
    index = saved(charlson(own, cfg.id_col, ["dx"]), "charlson")
    common = saved(common_conditions(heads, top, cfg.id_col), "common-conditions")
    return index.join(common, cfg.id_col)
