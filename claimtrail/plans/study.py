"""The whole study: code lists and claims in, study tables and analysis tables out."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, fields
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimtrail.config import StudyConfig
from claimtrail.functions.codes import inline_codes
from claimtrail.operators.conditions import baseline
from claimtrail.operators.describe import descriptive_stats
from claimtrail.operators.exposure import exposure, index_cohort
from claimtrail.operators.joins import lookup_join, saved
from claimtrail.operators.scan import restrict_to, scan_dx, scan_enrollment, scan_rx
from claimtrail.operators.supply import clean_supply_days
from claimtrail.operators.survival import km_at_risk, km_quartiles, km_survival
from claimtrail.operators.treatment import adherence, cohort_treatment, outcomes_tp, persistence
from claimtrail.operators.utilization import hospitalization, outcomes_ru, visit_counts, visits
from claimtrail.sources.buckets import ROWS_PER_BUCKET, bucket_count
from claimtrail.sources.code_lists import codes_of, load_code_lists
from claimtrail.sources.intervals import YEARS
from claimtrail.sources.manifest import digest, entry_of, recover, state_of
from claimtrail.sources.scratch import scratch_path
from claimtrail.sources.shards import shard_columns, union_columns
from claimtrail.sources.tables import create_libraries, ingest_folder, ingest_library, list_tables, materialize, write_folder

Build = DataFrame | Callable[[], DataFrame]
Save = Callable[[str, Build], DataFrame]


@dataclass(frozen=True)
class StudyInputs:
    """Claims tables by scope and the three code lists."""

    services: DataFrame  # outpatient and inpatient services, with ``source`` and ``scope``
    drugs: DataFrame
    admissions: DataFrame
    enrollment: DataFrame
    icd9: DataFrame
    ndc: DataFrame
    hcpcs: DataFrame


def _built(df: Build) -> DataFrame:
    return df if isinstance(df, DataFrame) else df()


def keep_lazy(name: str, df: Build) -> DataFrame:
    return _built(df)


#: Tables that are grouped and joined by patient -> the table written before whose most frequent patient tells whether one has too many rows;
#: None where a patient has a row, or one per index treatment.
BY_PATIENT = {
    "rds.allpt": None, "sds.sddm": None, "ads.baseline": None, "ads.outcomes_ru": None, "ads.outcomes_tp": None, "ads.variables": None,
    "sds.sddx": "rds.alldx", "sds.sdadm": "rds.alladm", "sds.cohort_treatment": "rds.interest_tx",
}
WATCHED = {origin for origin in BY_PATIENT.values() if origin}


def table_saver(spark: SparkSession, key: str | None = None, id_col: str | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> Save:
    """Write each reused result as ``library.table`` and go on from the written table.

    With a ``key`` (see ``study_key``) a result that was finished under the same key is neither built nor written again. With ``id_col`` the
    tables of ``BY_PATIENT`` are stored by patient (see ``buckets``), in as many buckets as the study's exposures need.
    """

    def buckets(name: str) -> tuple[str, int] | None:
        exposures = entry_of(spark, "rds.interest_tx")
        if not id_col or name not in BY_PATIENT or "rows" not in exposures:
            return None
        origin = BY_PATIENT[name]
        if origin and int(entry_of(spark, origin).get("hottest", rows_per_bucket + 1)) > rows_per_bucket:
            return None
        return id_col, bucket_count(int(exposures["rows"]), rows_per_bucket)

    def save(name: str, df: Build) -> DataFrame:
        recover(spark, name)
        if key is None or entry_of(spark, name).get("study") != key:
            watch = id_col if name in WATCHED else None
            materialize(_built(df), name, "replace", entry={"study": key} if key else None, bucket_by=buckets(name), watch=watch)
        return spark.table(name)

    return save


def study_key(inputs: StudyInputs, cfg: StudyConfig) -> str:
    """Stands for a study's parameters and the files of its inputs, all of which must be read from files."""
    return digest(cfg, *[state_of(getattr(inputs, f.name)) for f in fields(inputs)])


def folder_saver(spark: SparkSession, folder: str | None = None) -> Save:
    """Write each reused result as a Parquet folder, by default in the shared scratch folder, and go on from it."""
    folder = folder or scratch_path(spark, "study")

    def save(name: str, df: Build) -> DataFrame:
        path = f"{folder}/{name}"
        df = _built(df)
        write_folder(df, path)
        return spark.read.schema(df.schema).parquet(path)

    return save


#: Scopes of a shard: outpatient and inpatient services, drugs, admissions, enrolment.
SERVICES, DRUGS, ADMISSIONS, ENROLLMENT = ("o", "s"), ("d",), ("i",), ("t",)
#: Begin and end of the rows in shards of intervals.
INTERVALS = {"i": ("admdate", "disdate"), "t": ("dtstart", "dtend")}


def shards_of(table: DataFrame, cfg: StudyConfig, scopes: Sequence[str], by_year: bool = True) -> dict:
    """Scan arguments that select the study's sources, the scopes, and (``by_year``) the years of the study period, by the shard columns there are.

    A shard's year isn't exactly the year of service, so the years beside the period are read too; the window on the date decides.
    """
    have = set(table.columns)
    chosen: dict = {}
    if "source" in have:
        chosen["sources"] = list(cfg.sources)
    if "scope" in have:
        chosen["scopes"] = list(scopes)
    if cfg.year_col in have and by_year:
        chosen |= {"years": list(range(cfg.study_start.year - 1, cfg.study_end.year + 2)), "year_col": cfg.year_col}
    return chosen


def study_exposure(inputs: StudyInputs, cfg: StudyConfig) -> DataFrame:
    """Exposures of the study period: coded procedures, and coded drug fills with cleaned supply."""
    window = {"start": cfg.study_start, "end": cfg.study_end}
    procs = scan_rx(inputs.services, codes_of(inputs.hcpcs, "hcpcs"), ["proc1"], **window, **shards_of(inputs.services, cfg, SERVICES))
    fills = scan_rx(inputs.drugs, codes_of(inputs.ndc, "ndc"), ["ndcnum"], **window, **shards_of(inputs.drugs, cfg, DRUGS))
    cleaned = clean_supply_days(fills, cfg.id_col, keep=cfg.demographics)
    return exposure(cleaned, procs, inputs.ndc, inputs.hcpcs, cfg)


def pull_dx(inputs: StudyInputs, cohort: DataFrame, cfg: StudyConfig, dx_cols: Sequence[str] = ("pdx", "dx1", "dx2")) -> DataFrame:
    """Service claims of cohort patients with a study diagnosis in the study period."""
    shards = shards_of(inputs.services, cfg, SERVICES)
    found = scan_dx(inputs.services, codes_of(inputs.icd9, "icd9"), dx_cols, cfg.study_start, cfg.study_end, **shards)
    return restrict_to(found, cohort, cfg.id_col)


def pull_admissions(inputs: StudyInputs, cohort: DataFrame, cfg: StudyConfig) -> DataFrame:
    """Stays of cohort patients that touch the study period. A stay may begin in any earlier year; ``intervals`` prunes by the years of both ends."""
    shards = shards_of(inputs.admissions, cfg, ADMISSIONS, by_year=False)
    stays = scan_dx(inputs.admissions, start=cfg.study_start, end=cfg.study_end, date_col="admdate", end_col="disdate", **shards)
    return restrict_to(stays.drop(*YEARS), cohort, cfg.id_col)


def pull_enrollment(inputs: StudyInputs, cohort: DataFrame, cfg: StudyConfig) -> DataFrame:
    """Enrolment spells of cohort patients that touch the study period; pruned like stays."""
    shards = shards_of(inputs.enrollment, cfg, ENROLLMENT, by_year=False)
    spells = scan_enrollment(inputs.enrollment, cfg.study_start, cfg.study_end, **shards)
    return restrict_to(spells.drop(*YEARS), cohort, cfg.id_col)


def study_claims(claims: DataFrame, cohort: DataFrame, id_col: str = "enrolid") -> DataFrame:
    """Claims of cohort patients with their index date."""
    return lookup_join(claims, cohort.select(id_col, "idxdate").distinct(), [id_col])


def pull_study(inputs: StudyInputs, cfg: StudyConfig = StudyConfig(), save: Save = keep_lazy) -> dict[str, DataFrame]:
    """Exposure, cohort and the cohort's claims."""
    out = {"rds.interest_tx": save("rds.interest_tx", lambda: study_exposure(inputs, cfg))}
    out["rds.allpt"] = cohort = save("rds.allpt", lambda: index_cohort(out["rds.interest_tx"], cfg))

    @cache
    def patients() -> DataFrame:  # written once for the three pulls
        return saved(cohort.select(cfg.id_col).distinct(), "patients")

    out["rds.alldx"] = save("rds.alldx", lambda: pull_dx(inputs, patients(), cfg))
    out["rds.alladm"] = save("rds.alladm", lambda: pull_admissions(inputs, patients(), cfg))
    out["rds.allce"] = save("rds.allce", lambda: pull_enrollment(inputs, patients(), cfg))
    return out


def variables(cohort: DataFrame, base: DataFrame, use: DataFrame, pattern: DataFrame, id_col: str = "enrolid") -> DataFrame:
    """The analysis table: cohort patients that have all three parts."""
    return cohort.join(base, id_col).join(use, id_col).join(pattern, id_col)


def analyse_study(
    cohort: DataFrame,
    claims: DataFrame,
    admissions: DataFrame,
    exposures: DataFrame,
    icd9: DataFrame,
    cfg: StudyConfig = StudyConfig(),
    proc_cols: Sequence[str] | None = None,
    group_col: str | None = None,
    save: Save = keep_lazy,
) -> dict[str, DataFrame]:
    """Analysis tables from the study cohort and its claims (which carry ``idxdate``)."""
    listed = codes_of(icd9, "icd9", cfg.disease)
    inlined = inline_codes(listed)
    disease = listed if inlined is None else inlined
    proc_cols = proc_cols or [c for c in admissions.columns if re.fullmatch(r"proc[0-9]+", c)]
    out = {"ads.baseline": save("ads.baseline", lambda: baseline(claims, disease, cfg))}

    def use() -> DataFrame:
        counts = visit_counts(visits(claims, disease, cfg), cfg.id_col)
        return outcomes_ru(cohort, hospitalization(admissions, disease, cfg, proc_cols), counts, cfg)

    out["ads.outcomes_ru"] = save("ads.outcomes_ru", use)
    out["sds.cohort_treatment"] = fills = save("sds.cohort_treatment", lambda: cohort_treatment(exposures, cohort, cfg))

    @cache
    def persist() -> DataFrame:  # written once for the curve, the patients at risk and the treatment pattern
        return saved(persistence(fills, cfg.refill_gap, cfg.drug_followup_days, True, cfg.id_col), "persistence")

    times = range(0, cfg.drug_followup_days + 1, cfg.at_risk_step)
    out["ads.km"] = curve = save("ads.km", lambda: km_survival(persist()))
    out["ads.km_quartiles"] = save("ads.km_quartiles", lambda: km_quartiles(curve))
    out["ads.km_at_risk"] = save("ads.km_at_risk", lambda: km_at_risk(persist(), times))
    pattern = lambda: outcomes_tp(adherence(fills, cfg.outcome_days, cfg.id_col), persist(), cfg.id_col)
    out["ads.outcomes_tp"] = save("ads.outcomes_tp", pattern)
    parts = [out[name] for name in ("ads.baseline", "ads.outcomes_ru", "ads.outcomes_tp")]
    out["ads.variables"] = save("ads.variables", lambda: variables(cohort, *parts, cfg.id_col))
    group_col = group_col or "idxtreatment"
    categorical = [c for c in ("sex", "plantyp", "region", "idxtreatment") if c != group_col]
    skipped = [cfg.id_col, "dobyr", "idxdate"]
    out["ads.statistics"] = save("ads.statistics", lambda: descriptive_stats(out["ads.variables"], categorical, skipped, group_col, "All"))
    return out


def study_run(
    spark: SparkSession, inputs: StudyInputs, cfg: StudyConfig = StudyConfig(), save: Save | None = None, resume: bool = False
) -> dict[str, DataFrame]:
    """All tables of a study. Each reused result is written once and read from there on.

    With ``resume`` the tables that an earlier run finished from the same files and parameters are taken as they are. The inputs must then be
    read from files; selections from them are not noticed, so they must be the same.
    """
    save = save or table_saver(spark, study_key(inputs, cfg) if resume else None, cfg.id_col)
    out = pull_study(inputs, cfg, save)
    cohort, exposures = out["rds.allpt"], out["rds.interest_tx"]
    claims = save("sds.sddx", lambda: study_claims(out["rds.alldx"], cohort, cfg.id_col))
    stays = save("sds.sdadm", lambda: study_claims(out["rds.alladm"], cohort, cfg.id_col))
    out |= {"sds.sddm": save("sds.sddm", cohort), "sds.sddx": claims, "sds.sdadm": stays}
    return out | analyse_study(cohort, claims, stays, exposures, inputs.icd9, cfg, save=save)


def library_inputs(spark: SparkSession, raw: str = "raw", codes: str = "scd", cfg: StudyConfig = StudyConfig()) -> StudyInputs:
    """The study's inputs from its libraries: the shards of each scope as one table, whatever their types, and the code lists."""
    names = list_tables(spark, raw)

    def scope(letters: str) -> DataFrame:
        shards = {n: shard_columns(spark.table(f"{raw}.{n}"), n) for n in names if n[4:5] in letters}
        if not shards:
            raise ValueError(f"library {raw} has no table of scope {' or '.join(letters)}")
        return union_columns(shards, dict(cfg.code_widths))

    lists = [spark.table(f"{codes}.{name}") for name in ("icd9", "ndc", "hcpcs")]
    return StudyInputs(scope("os"), scope("d"), scope("i"), scope("t"), *lists)


def study_from_files(
    spark: SparkSession, shards: dict[str, str] | str, sheets: dict[str, str], cfg: StudyConfig = StudyConfig(),
    shard_fmt: str = "parquet", sheet_fmt: str = "csv", folder: str | None = None, resume: bool = False, **ingest,
) -> dict[str, DataFrame]:
    """The whole study from claims files (shard name -> path, or a folder of them) and code sheets: libraries, ingest, code lists, all study tables.

    Shards of stays and spells are laid out by the years of both ends. Of a folder only new and changed files are loaded; with ``resume``
    the study goes on from the tables that were finished.
    """
    create_libraries(spark, cfg.libraries, folder)
    raw, _, codes, *_ = cfg.libraries
    options = {"code_widths": dict(cfg.code_widths), "intervals": INTERVALS} | ingest
    if isinstance(shards, str):
        ingest_folder(spark, shards, raw, shard_fmt, **options)
    else:
        ingest_library(spark, shards, raw, shard_fmt, **options)
    load_code_lists(spark, sheets, codes, sheet_fmt)
    return study_run(spark, library_inputs(spark, raw, codes, cfg), cfg, resume=resume)
