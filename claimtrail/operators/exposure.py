"""Exposure to the treatments of interest and the cohort indexed on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from claimtrail.config import StudyConfig
from claimtrail.functions.dates import date_filter
from claimtrail.operators.scan import attach_generic


def exposure(
    drug_claims: DataFrame,
    proc_claims: DataFrame,
    ndc: DataFrame,
    hcpcs: DataFrame,
    cfg: StudyConfig = StudyConfig(),
    date_col: str = "svcdate",
    ndc_col: str = "ndcnum",
    proc_col: str = "proc1",
    supply_col: str = "daysupp",
) -> DataFrame:
    """Cleaned drug fills and procedure claims as one table with their generic name; every row is kept.

    Procedures take their supply from the code list where it has one.
    """
    columns = [cfg.id_col, date_col, *cfg.demographics, "generic_name", supply_col]
    drugs = attach_generic(drug_claims, ndc, ndc_col, "ndc").select(*columns)
    if supply_col in hcpcs.columns:
        base = proc_claims.drop(supply_col) if supply_col in proc_claims.columns else proc_claims
        procs = attach_generic(base, hcpcs, proc_col, "hcpcs", [supply_col])
    else:
        procs = attach_generic(proc_claims, hcpcs, proc_col, "hcpcs")
        procs = procs.withColumn(supply_col, F.lit(None).cast(drugs.schema[supply_col].dataType))
    return drugs.unionByName(procs.select(*columns))


def index_cohort(
    exposures: DataFrame,
    cfg: StudyConfig = StudyConfig(),
    date_col: str = "svcdate",
    treatment_col: str = "generic_name",
    demographics: Sequence[str] | None = None,
) -> DataFrame:
    """Every distinct treatment and demographic record of a patient's first exposure day in the index period.

    Copies are merged before the patient's rows meet, so what is ranked per patient is bounded by days and treatments.
    """
    demographics = list(cfg.demographics if demographics is None else demographics)
    seen = (
        exposures.where(date_filter(F.col(date_col), cfg.index_start, cfg.index_end))
        .select(
            cfg.id_col,
            F.col(date_col).alias("idxdate"),
            *demographics,
            F.col(treatment_col).alias("idxtreatment"),
        )
        .distinct()
    )
    by_day = Window.partitionBy(cfg.id_col).orderBy("idxdate")
    return seen.withColumn("_r", F.rank().over(by_day)).where(F.col("_r") == 1).drop("_r")


def index_join(df: DataFrame, id_col: str, date_col: str) -> DataFrame:
    """All rows of each patient's earliest day. Map tasks drop the rows of later days before the shuffle."""
    by_day = Window.partitionBy(id_col).orderBy(date_col)
    ranked = df.where(F.col(id_col).isNotNull() & F.col(date_col).isNotNull()).withColumn("_r", F.rank().over(by_day))
    return ranked.where(F.col("_r") == 1).drop("_r")
