"""Claims-shaped views over the given order and event tables.

A view is a list of SQL expressions that Spark and the checking engine both understand, so both sides see the same rows.
Customers play the patients, order dates the service dates; codes and service fields are computed from the keys.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimtrail.config import StudyConfig
from claimtrail.operators.exposure import index_cohort
from claimtrail.operators.joins import lookup_join, spread_join
from claimtrail.sources.scratch import settle

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

CONFIG = replace(
    StudyConfig(),
    index_start=date(1998, 1, 1),
    index_end=date(1998, 12, 31),
    study_start=date(1997, 1, 1),
    study_end=date(1999, 12, 31),
    disease="ASIA",
    year_col="shardyear",
)

PATIENT = (
    "o_custkey AS enrolid",
    "CASE WHEN o_custkey % 2 = 0 THEN '1' ELSE '2' END AS sex",
    "CAST(1930 + o_custkey % 60 AS INT) AS dobyr",
    "CAST(68 - o_custkey % 60 AS INT) AS age",
    "CAST(1 + o_custkey % 9 AS DOUBLE) AS plantyp",
    "CAST(1 + o_custkey % 5 AS STRING) AS region",
)
SERVICE_DAY = "CAST(o_orderdate AS DATE) AS svcdate"
SHARD = (
    "CASE WHEN l_suppkey % 7 = 3 THEN 'mcdd' WHEN l_suppkey % 2 = 0 THEN 'ccae' ELSE 'mdcr' END AS source",
    "CASE WHEN l_returnflag = 'R' THEN 's' ELSE 'o' END AS scope",
)


def _five(expression: str) -> str:
    return f"lpad(CAST(({expression}) % 100000 AS STRING), 5, '0')"


RX = (
    *PATIENT,
    SERVICE_DAY,
    "l_linenumber",
    "p_brand AS ndcnum",
    "CAST(l_quantity AS INT) - 10 AS daysupp",
    "p_type AS generic_name",
)
CLAIMS = (
    *PATIENT,
    SERVICE_DAY,
    *SHARD,
    "CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS shardyear",
    "CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) + 12 AS year",
    f"{_five('l_partkey * 487 + l_linenumber * 131 + l_suppkey * 17')} AS dx1",
    f"CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE {_five('l_partkey * 311 + l_suppkey * 53 + l_linenumber')} END AS dx2",
    f"{_five('l_partkey * 97 + l_orderkey * 3')} AS pdx",
    "CASE WHEN l_linenumber = 1 THEN '99213' WHEN l_linenumber = 2 THEN '80053' WHEN l_linenumber = 3 THEN NULL"
    f" WHEN l_linenumber = 4 THEN '36415' ELSE {_five('l_partkey * 37')} END AS proc1",
    "CAST(CASE l_partkey % 8 WHEN 0 THEN 23 WHEN 1 THEN 21 WHEN 2 THEN 22 WHEN 3 THEN 11 WHEN 4 THEN 95 WHEN 5 THEN NULL"
    " ELSE 81 END AS INT) AS stdplac",
    "CAST(CASE WHEN l_suppkey % 3 = 0 THEN 220 ELSE 240 END AS INT) AS stdprov",
    "CAST(CASE l_orderkey % 4 WHEN 0 THEN 104 WHEN 1 THEN 77 WHEN 2 THEN NULL ELSE 20 END AS INT) AS stdsvc",
    "CAST(100 + l_partkey % 240 AS INT) AS procgrp",
    "CASE WHEN l_linenumber % 2 = 0 THEN '1' ELSE '6' END AS proctyp",
    "CASE l_suppkey % 10 WHEN 0 THEN '450' WHEN 1 THEN '0450' WHEN 2 THEN '0510' WHEN 3 THEN '301' WHEN 4 THEN '0301'"
    " WHEN 5 THEN '320' WHEN 6 THEN '0320' ELSE '0120' END AS revcode",
    "CASE WHEN l_linenumber % 3 = 0 THEN '11120' ELSE '11130' END AS svcscat",
)
ADMISSIONS = (
    "o_custkey AS enrolid",
    "CAST(LEAST(o_orderdate, l_shipdate) AS DATE) AS admdate",
    "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(GREATEST(o_orderdate, l_shipdate) AS DATE) END AS disdate",
    f"{_five('l_partkey * 97 + l_orderkey * 3')} AS pdx",
    "CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE '80053' END AS proc1",
    "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE '36415' END AS proc2",
    f"CASE WHEN l_suppkey % 2 = 0 THEN '  ' ELSE {_five('l_partkey * 37')} END AS proc3",
)
SPELLS = (
    "o_custkey AS enrolid",
    "CAST(LEAST(o_orderdate, l_shipdate) AS DATE) AS dtstart",
    "CAST(GREATEST(o_orderdate, l_shipdate) AS DATE) AS dtend",
)
ICD9 = (
    "n_nationkey AS row_no",
    "CASE WHEN n_nationkey % 3 = 1 THEN NULL ELSE r_name END AS ta",
    "CASE WHEN n_nationkey % 4 = 3 THEN lpad(CAST(n_nationkey * 37 AS STRING), 3, '0') || '.0x'"
    " ELSE lpad(CAST(n_nationkey * 37 AS STRING), 3, '0') || '.xx' END AS icd9",
)

LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"
#: What the views read of an order line.
LINE_COLUMNS = (
    "o_custkey", "o_orderdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate",
)
VIEW_SQL = {
    "rx": f"SELECT {', '.join(RX)} FROM {LINES} JOIN part ON l_partkey = p_partkey",
    "claims": f"SELECT {', '.join(CLAIMS)} FROM {LINES}",
    "adm": f"SELECT {', '.join(ADMISSIONS)} FROM {LINES}",
    "spells": f"SELECT {', '.join(SPELLS)} FROM {LINES}",
    "icd9_sheet": f"SELECT {', '.join(ICD9)} FROM nation JOIN region ON n_regionkey = r_regionkey",
    "ndc": "SELECT p_brand AS ndc, min(p_type) AS generic_name FROM part GROUP BY p_brand",
    "hcpcs": f"SELECT {_five('p_partkey * 37')} AS hcpcs, min(p_type) AS generic_name, 30 AS daysupp FROM part"
    " GROUP BY 1",
    "disease": "SELECT DISTINCT replace(replace(icd9, 'x', ''), '.', '') AS icd9 FROM icd9_sheet WHERE ta = 'ASIA'",
    "icd9": "SELECT row_no, ta, replace(replace(icd9, 'x', ''), '.', '') AS icd9 FROM icd9_sheet",
    "idx": "SELECT enrolid, min(svcdate) AS idxdate FROM rx"
    " WHERE svcdate BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' GROUP BY enrolid",
    "cohort": "SELECT DISTINCT r.enrolid, r.svcdate AS idxdate, r.sex, r.dobyr, r.age, r.plantyp, r.region,"
    " r.generic_name AS idxtreatment FROM rx r JOIN idx i ON r.enrolid = i.enrolid AND r.svcdate = i.idxdate",
    "sddx": "SELECT c.*, i.idxdate FROM claims c JOIN idx i ON c.enrolid = i.enrolid",
    "sdadm": "SELECT a.*, i.idxdate FROM adm a JOIN idx i ON a.enrolid = i.enrolid",
    "visits_days": "SELECT user_id AS enrolid, CAST(ts AS DATE) AS svcdate, event_type AS kind FROM events",
}
NEEDS = {
    "disease": ["icd9_sheet"],
    "icd9": ["icd9_sheet"],
    "idx": ["rx"],
    "cohort": ["rx", "idx"],
    "sddx": ["rx", "idx", "claims"],
    "sdadm": ["rx", "idx", "adm"],
}


class Views:
    """The given tables of one folder, and the claims-shaped views over them, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.cfg = CONFIG
        self._read: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(self.path(name))
        return self._read[name]

    @cached_property
    def lines(self) -> DataFrame:
        return spread_join(self.table("lineitem"), self.table("orders"), "l_orderkey", "o_orderkey")

    def stored(self) -> Views:
        """The same views over order lines that are joined and written once, for queries that read them many times."""
        views = Views(self.spark, self.sf_dir)
        views.lines = settle(self.lines.select(*LINE_COLUMNS), "lines")
        return views

    @cached_property
    def rx(self) -> DataFrame:
        return self.lines.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey")).selectExpr(*RX)

    @cached_property
    def claims(self) -> DataFrame:
        return self.lines.selectExpr(*CLAIMS)

    @cached_property
    def adm(self) -> DataFrame:
        return self.lines.selectExpr(*ADMISSIONS)

    @cached_property
    def spells(self) -> DataFrame:
        return self.lines.selectExpr(*SPELLS)

    @cached_property
    def icd9_sheet(self) -> DataFrame:
        regions = self.table("region")
        return self.table("nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(*ICD9)

    @cached_property
    def icd9(self) -> DataFrame:
        return self.icd9_sheet.withColumn("icd9", F.translate("icd9", "x.", ""))

    @cached_property
    def disease(self) -> DataFrame:
        return self.icd9.where(F.col("ta") == self.cfg.disease).select("icd9").distinct()

    @cached_property
    def ndc(self) -> DataFrame:
        return self.table("part").groupBy(F.col("p_brand").alias("ndc")).agg(F.min("p_type").alias("generic_name"))

    @cached_property
    def hcpcs(self) -> DataFrame:
        code = F.expr(_five("p_partkey * 37")).alias("hcpcs")
        return self.table("part").groupBy(code).agg(F.min("p_type").alias("generic_name"), F.lit(30).alias("daysupp"))

    @cached_property
    def cohort(self) -> DataFrame:
        return settle(index_cohort(self.rx, self.cfg))

    @cached_property
    def idx(self) -> DataFrame:
        in_year = self.rx.where(F.col("svcdate").between(self.cfg.index_start, self.cfg.index_end))
        return settle(in_year.groupBy("enrolid").agg(F.min("svcdate").alias("idxdate")))

    @cached_property
    def sddx(self) -> DataFrame:
        return lookup_join(self.claims, self.idx, ["enrolid"])

    @cached_property
    def sdadm(self) -> DataFrame:
        return lookup_join(self.adm, self.idx, ["enrolid"])

    @cached_property
    def visits_days(self) -> DataFrame:
        return self.table("events").selectExpr(
            "user_id AS enrolid", "CAST(ts AS DATE) AS svcdate", "event_type AS kind"
        )


def with_views(*names: str, **extra: str) -> str:
    """``WITH`` clause of the named views (and what they need), then extra ones in the order given."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [f"{name} AS ({VIEW_SQL[name]})" for name in ordered] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n"
