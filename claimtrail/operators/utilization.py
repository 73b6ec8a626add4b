"""Health-care use in the outcome window: hospital stays and visits."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from claimtrail.config import StudyConfig
from claimtrail.functions.dates import is_in_outcome
from claimtrail.functions.predicates import claim_columns, disease_columns, is_ruleout, visit_type
from claimtrail.operators.scan import flag_prefix

VISIT_TYPES = ("ER", "Office", "Others")
PROCEDURE_COLUMNS = tuple(f"proc{i}" for i in range(1, 16))


def hospitalization(
    admissions: DataFrame,
    disease_codes: DataFrame | Iterable[str],
    cfg: StudyConfig = StudyConfig(),
    proc_cols: Sequence[str] = PROCEDURE_COLUMNS,
) -> DataFrame:
    """Admission days per patient, and those with the disease as principal diagnosis and a real procedure.

    Rows of one admission day are merged first, before and after the shuffle, so the count per patient runs over days.
    """
    stays = admissions.where(is_in_outcome(F.col("admdate"), F.col("idxdate"), cfg.outcome_days, F.col("disdate")))
    # over an array, not fifteen times in a row: that would outgrow what the JVM compiles
    procs = F.array(*[F.coalesce(F.rtrim(F.col(c)), F.lit("")) for c in proc_cols])
    real_procedure = F.exists(procs, lambda p: (p != "") & ~is_ruleout(p))
    flagged = flag_prefix(stays, {"pdx": real_procedure}, disease_codes, "_disease")
    days = flagged.groupBy(cfg.id_col, "admdate").agg(F.max("_disease").alias("_disease"))
    return days.groupBy(cfg.id_col).agg(
        F.count(F.lit(1)).alias("all_hospitalization"),
        F.count_if("_disease").alias("dis_hospitalization"),
    )


def visits(claims: DataFrame, disease_codes: DataFrame | Iterable[str], cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """Claims of the outcome window with ``visit_type`` and ``disease_flag``."""
    in_window = claims.where(is_in_outcome(F.col("svcdate"), F.col("idxdate"), cfg.outcome_days))
    typed = in_window.withColumn("visit_type", visit_type(claim_columns()))
    return flag_prefix(typed, disease_columns(), disease_codes, "disease_flag")


def visit_counts(typed: DataFrame, id_col: str = "enrolid", date_col: str = "svcdate") -> DataFrame:
    """Days with each visit type per patient, over all visits and over disease visits; NULL where there is none.

    Claims are first merged to one row per (patient, day), so the six distinct-day counts share one pass and the
    second shuffle carries days, not claims. Patients without any visit are dropped after counting: a filter on the
    visit type would be pushed below the joins and evaluate the whole classification twice.
    """
    marks = {}
    for kind in VISIT_TYPES:
        is_kind = F.col("visit_type") == kind
        marks[f"all_{kind.lower()}"] = is_kind
        marks[f"dis_{kind.lower()}"] = is_kind & F.col("disease_flag")
    days = (
        typed.where(F.col(date_col).isNotNull())
        .groupBy(id_col, date_col)
        .agg(*[F.max(mark.cast("int")).alias(name) for name, mark in marks.items()])
    )
    ordered = [f"{prefix}_{kind.lower()}" for prefix in ("all", "dis") for kind in VISIT_TYPES]
    counts = days.groupBy(id_col).agg(*[F.nullif(F.sum(name), F.lit(0)).alias(name) for name in ordered])
    return counts.where(F.coalesce(*ordered).isNotNull())


def outcomes_ru(cohort: DataFrame, hospital: DataFrame, visit: DataFrame, cfg: StudyConfig = StudyConfig()) -> DataFrame:
    """Eight counts and eight ``'0'``/``'1'`` flags per cohort patient; nothing found counts as 0."""
    patients = cohort.select(cfg.id_col).distinct()
    joined = patients.join(hospital, cfg.id_col, "left").join(visit, cfg.id_col, "left")
    disease = cfg.disease.title()
    kinds = {"hospitalization": "Hospitalization", "er": "ER Visits", "office": "Office Visits", "others": "Other Visits"}
    names = ["all_hospitalization", "dis_hospitalization"]
    names += [f"{prefix}_{kind.lower()}" for prefix in ("all", "dis") for kind in VISIT_TYPES]
    counts, flags = [], []
    for name in names:
        prefix, kind = name.split("_", 1)
        subject = f"{'any' if prefix == 'all' else disease} {kinds[kind]}"
        value = F.coalesce(F.col(name), F.lit(0)).cast("long")
        counts.append(value.alias(name, metadata={"label": f"Frequency of {subject}"}))
        flags.append(
            F.when(value > 0, "1").otherwise("0").alias(f"with_{name}", metadata={"label": f"Had {subject}"})
        )
    return joined.select(cfg.id_col, *counts, *flags)
