"""The study's code lists: diagnoses with their therapeutic area, drugs and procedures with their generic name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimtrail.functions.codes import clean_icd9, ndc_11
from claimtrail.operators.ordered import forward_fill
from claimtrail.sources.manifest import digest, entry_of, state_at
from claimtrail.sources.numbering import numbered_lines
from claimtrail.sources.tables import materialize, normalize


def icd9_list(sheet: DataFrame, order_col: str = "row_no") -> DataFrame:
    """Fill a missing therapeutic area from the row above, clean the code, drop empty codes."""
    filled = forward_fill(sheet, "ta", order_col)
    return filled.withColumn("icd9", clean_icd9(F.col("icd9"))).where(F.col("icd9") != "")


def ndc_list(sheet: DataFrame) -> DataFrame:
    return sheet.where(F.col("ndc").isNotNull()).withColumn("ndc", ndc_11(F.col("ndc")))


def hcpcs_list(sheet: DataFrame) -> DataFrame:
    return sheet.where(F.col("hcpcs") != "")


def load_code_lists(spark: SparkSession, paths: dict[str, str], library: str = "scd", fmt: str = "csv") -> dict[str, int]:
    """Read the three sheets as text, clean them and replace the code tables of the sheets that changed. Returns the tables' row counts.

    The ``icd9`` sheet is filled downwards in the order of its lines, or of its column ``row_no`` if it has one.
    """
    clean = {"icd9": icd9_list, "ndc": ndc_list, "hcpcs": hcpcs_list}
    options = {"header": "true", "inferSchema": "false"} if fmt == "csv" else {}
    counts = {}
    for name, path in paths.items():
        table, made_of = f"{library}.{name}", {"inputs": state_at(spark, path), "parameters": digest(path, fmt)}
        held = entry_of(spark, table)
        if all(held.get(k) == v for k, v in made_of.items()):
            counts[name] = int(held["rows"])
            continue
        sheet = normalize(spark.read.format(fmt).options(**options).load(path))
        if name == "icd9":
            if "row_no" not in sheet.columns:
                sheet = normalize(numbered_lines(spark, path, fmt, **options))
            sheet = sheet.withColumn("row_no", F.col("row_no").cast("long"))
        counts[name] = materialize(clean[name](sheet), table, "replace", entry=made_of)
    return counts


def codes_of(code_list: DataFrame, column: str, ta: str | None = None) -> DataFrame:
    """One column of a code list, for one therapeutic area if given (any letter case)."""
    rows = code_list if ta is None else code_list.where(F.upper("ta") == ta.upper())
    return rows.select(column)
