"""Cohort, exposure and outcome operators over health-insurance claims tables, as Spark DataFrame functions."""

from claimtrail.config import StudyConfig

__all__ = ["StudyConfig"]
