"""Study parameters, passed explicitly to the operators that need them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class StudyConfig:
    """Dates, windows and gaps (in days) of one retrospective claims study."""

    # fixed values: the study's default calendar and windows
    index_start: date = date(2007, 1, 1)
    index_end: date = date(2007, 12, 31)
    study_start: date = date(2006, 1, 1)
    study_end: date = date(2008, 12, 31)
    baseline_days: int = 365
    outcome_days: int = 364
    drug_followup_days: int = 300
    min_age: int = 18
    enrollment_gap: int = 45
    refill_gap: int = 60

    disease: str = "PSORIASIS"
    sources: tuple[str, ...] = ("ccae", "mdcr")
    libraries: tuple[str, ...] = ("raw", "rds", "scd", "sds", "ads")

    at_risk_step: int = 50
    year_col: str = "year"
    #: Characters of codes that some shards hold as numbers, which have lost their leading zeros.
    code_widths: tuple[tuple[str, int], ...] = (("ndcnum", 11), ("revcode", 4))

    id_col: str = "enrolid"
    demographics: tuple[str, ...] = ("sex", "dobyr", "age", "plantyp", "region")
    top_conditions: int = 10
