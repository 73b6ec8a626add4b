"""Queries over date windows, service predicates, projections and formats."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from claimtrail.functions.dates import date_filter, interval_overlap, is_in_baseline, is_in_outcome
from claimtrail.functions.formats import plan_group_label, plantyp_label, region_label, sex_label
from claimtrail.functions.predicates import (
    claim_columns, is_er, is_lab, is_office_visit, is_op_visit, is_radiology, is_ruleout, visit_type,
)
from claimtrail.operators.utilization import visits
from claimtrail.plans.registry import query
from claimtrail.plans.views import Views, with_views
from claimtrail.sources.tables import expand_var_range

OFFICE_SQL = """coalesce((stdplac IN (11, 22, 95) AND procgrp IN (101, 104, 109)), false) OR coalesce(length(proc1) = 5 AND (
 proc1 BETWEEN '99201' AND '99215' OR proc1 BETWEEN '99241' AND '99245' OR proc1 BETWEEN '99381' AND '99387'
 OR proc1 BETWEEN '99391' AND '99397' OR proc1 BETWEEN '99401' AND '99404' OR proc1 BETWEEN '99411' AND '99412'
 OR proc1 BETWEEN '99420' AND '99429'), false)"""
OFFICE_SQL = f"(scope = 'o' AND ({OFFICE_SQL}))"
OP_SQL = f"""({OFFICE_SQL} OR revcode IN ('0450','0510','0515','0517','0520','0521','0523','0526','0760','0761','0762',
 '0769','0770','0779','0982','0983','0988'))"""
RULEOUT_SQL = """coalesce(length(proc1) = 5 AND (proc1 IN ('S9529', 'G0001') OR proc1 BETWEEN '70010' AND '76999'
 OR proc1 BETWEEN '78000' AND '78799' OR proc1 BETWEEN '80000' AND '89999' OR proc1 BETWEEN '36400' AND '36425'), false)"""
ER_SQL = """CASE WHEN year <= 2010 THEN coalesce(stdplac = 23, false)
  OR coalesce(stdplac IN (21, 22, 28) AND (stdprov = 220 AND stdsvc IS DISTINCT FROM 104 OR stdsvc IS NOT DISTINCT FROM 77), false)
  OR procgrp IN (110, 111, 114) OR revcode LIKE '45_' OR revcode LIKE '045_'
 ELSE substr(svcscat, 4, 2) = '20' END"""
VISIT_SQL = f"CASE WHEN {ER_SQL} THEN 'ER' WHEN scope = 'o' AND {OP_SQL} THEN 'Office' WHEN scope = 'o' THEN 'Others' END"
DISEASE_SQL = f"""(NOT {RULEOUT_SQL} AND (
  (scope = 's' AND EXISTS (SELECT 1 FROM disease d WHERE starts_with(c.pdx, d.icd9)))
  OR (scope = 'o' AND EXISTS (SELECT 1 FROM disease d WHERE starts_with(c.dx1, d.icd9) OR starts_with(c.dx2, d.icd9)))))"""


def _counted(df, keys, flag_name, flag):
    return df.select(*keys, flag.alias(flag_name)).groupBy(*keys, flag_name).agg(F.count(F.lit(1)).alias("n"))


@query("date_filter", with_views("rx") + """
SELECT svcdate, count(*) AS n FROM rx WHERE svcdate >= DATE '1998-01-01' AND svcdate <= DATE '1998-12-31' GROUP BY 1""")
def date_filter_query(v: Views):
    kept = v.rx.where(date_filter(F.col("svcdate"), v.cfg.index_start, v.cfg.index_end))
    return kept.groupBy("svcdate").agg(F.count(F.lit(1)).alias("n"))


@query("interval_overlap", with_views("spells") + """
SELECT enrolid, dtstart, dtend FROM spells WHERE NOT (dtend < DATE '1998-01-01' OR dtstart > DATE '1998-12-31')""")
def interval_overlap_query(v: Views):
    hit = interval_overlap(F.col("dtstart"), F.col("dtend"), v.cfg.index_start, v.cfg.index_end)
    return v.spells.where(hit)


@query("interval_overlap_open_end", with_views("adm") + """
SELECT admdate, disdate, count(*) AS n FROM adm WHERE coalesce(disdate, admdate) >= DATE '1998-06-01' GROUP BY ALL""")
def interval_overlap_open_end(v: Views):
    hit = interval_overlap(F.col("admdate"), F.col("disdate"), date(1998, 6, 1), coalesce_end=True)
    return v.adm.where(hit).groupBy("admdate", "disdate").agg(F.count(F.lit(1)).alias("n"))


@query("is_in_outcome", with_views("sddx") + """
SELECT enrolid, count(*) AS n FROM sddx WHERE date_diff('day', idxdate, svcdate) BETWEEN 0 AND 364 GROUP BY 1""")
def in_outcome(v: Views):
    hit = is_in_outcome(F.col("svcdate"), F.col("idxdate"), v.cfg.outcome_days)
    return v.sddx.where(hit).groupBy("enrolid").agg(F.count(F.lit(1)).alias("n"))


@query("is_in_outcome_interval", with_views("sdadm") + """
SELECT enrolid, count(*) AS n FROM sdadm WHERE idxdate <= coalesce(disdate, admdate) AND admdate <= idxdate + 364 GROUP BY 1""")
def in_outcome_interval(v: Views):
    hit = is_in_outcome(F.col("admdate"), F.col("idxdate"), v.cfg.outcome_days, F.col("disdate"))
    return v.sdadm.where(hit).groupBy("enrolid").agg(F.count(F.lit(1)).alias("n"))


@query("is_in_baseline", with_views("sddx") + """
SELECT enrolid, count(*) AS n FROM sddx WHERE date_diff('day', svcdate, idxdate) BETWEEN 1 AND 365 GROUP BY 1""")
def in_baseline(v: Views):
    hit = is_in_baseline(F.col("svcdate"), F.col("idxdate"), v.cfg.baseline_days)
    return v.sddx.where(hit).groupBy("enrolid").agg(F.count(F.lit(1)).alias("n"))


@query("is_ruleout", with_views("claims") + f"""
SELECT proc1, {RULEOUT_SQL} AS ruleout, count(*) AS n FROM claims GROUP BY ALL""")
def ruleout(v: Views):
    return _counted(v.claims, ["proc1"], "ruleout", is_ruleout(F.col("proc1")))


ER_KEYS = ["year", "stdplac", "stdprov", "stdsvc", "procgrp", "revcode", "svcscat"]


@query("is_er", with_views("claims") + f"SELECT {', '.join(ER_KEYS)}, {ER_SQL} AS er, count(*) AS n FROM claims GROUP BY ALL")
def er(v: Views):
    return _counted(v.claims, ER_KEYS, "er", is_er(claim_columns()))


OFFICE_KEYS = ["scope", "stdplac", "procgrp", "proc1"]


@query("is_office_visit", with_views("claims") + f"""
SELECT {', '.join(OFFICE_KEYS)}, {OFFICE_SQL} AS office, count(*) AS n FROM claims GROUP BY ALL""")
def office(v: Views):
    return _counted(v.claims, OFFICE_KEYS, "office", is_office_visit(claim_columns()))


@query("is_op_visit", with_views("claims") + f"""
SELECT {', '.join(OFFICE_KEYS)}, revcode, {OP_SQL} AS op, count(*) AS n FROM claims GROUP BY ALL""")
def op_visit(v: Views):
    return _counted(v.claims, [*OFFICE_KEYS, "revcode"], "op", is_op_visit(claim_columns()))


@query("is_lab", with_views("claims") + """
SELECT scope, proctyp, proc1, procgrp, revcode, (scope = 's' AND (coalesce(proctyp = '1' AND proc1 LIKE '8%', false)
  OR procgrp IN (301,302,303,331,332,334,335,336,338,339) OR revcode LIKE '30_' OR revcode LIKE '31_'
  OR revcode LIKE '030_' OR revcode LIKE '031_')) AS lab, count(*) AS n FROM claims GROUP BY ALL""")
def lab(v: Views):
    return _counted(v.claims, ["scope", "proctyp", "proc1", "procgrp", "revcode"], "lab", is_lab(claim_columns()))


@query("is_radiology", with_views("claims") + """
SELECT proctyp, proc1, procgrp, revcode, (coalesce(proctyp = '1' AND proc1 LIKE '7%', false)
  OR coalesce(proc1 IN ('0073T', '0082T', '0083T'), false) OR procgrp BETWEEN 201 AND 299 OR revcode LIKE '32_'
  OR revcode LIKE '33_' OR revcode LIKE '032_' OR revcode LIKE '033_') AS radiology, count(*) AS n FROM claims GROUP BY ALL""")
def radiology(v: Views):
    return _counted(v.claims, ["proctyp", "proc1", "procgrp", "revcode"], "radiology", is_radiology(claim_columns()))


@query("visit_type", with_views("claims") + f"""
SELECT enrolid, svcdate, {VISIT_SQL} AS visit_type, count(*) AS n FROM claims GROUP BY ALL""")
def visit_type_query(v: Views):
    return _counted(v.claims, ["enrolid", "svcdate"], "visit_type", visit_type(claim_columns()))


@query("disease_flag", with_views("sddx", "disease") + f"""
SELECT enrolid, svcdate, {DISEASE_SQL} AS disease_flag, count(*) AS n FROM sddx c
WHERE date_diff('day', idxdate, svcdate) BETWEEN 0 AND 364 GROUP BY ALL""")
def disease_flag_query(v: Views):
    return _counted(visits(v.sddx, v.disease, v.cfg), ["enrolid", "svcdate"], "disease_flag", F.col("disease_flag"))


@query("project", with_views("rx") + "SELECT enrolid AS benrolid, svcdate AS filldate, daysupp FROM rx")
def project(v: Views):
    renames = {"enrolid": "benrolid", "svcdate": "filldate"}
    return v.rx.withColumnsRenamed(renames).select("benrolid", "filldate", "daysupp")


@query("expand_var_range", with_views("adm") + """
SELECT proc1, proc2, proc3, pdx, count(*) AS n FROM adm GROUP BY ALL""")
def expand_var_range_query(v: Views):
    return v.adm.groupBy(*expand_var_range(v.adm, "proc1-proc3, pdx")).agg(F.count(F.lit(1)).alias("n"))


@query("distinct_rows", with_views("rx") + "SELECT DISTINCT enrolid, sex, generic_name FROM rx")
def distinct_rows(v: Views):
    return v.rx.select("enrolid", "sex", "generic_name").distinct()


@query("in_list", with_views("rx") + """
SELECT ndcnum, count(*) AS n FROM rx WHERE ndcnum IN ('Brand#1', 'Brand#2', 'Brand#17', 'Brand#21') GROUP BY 1""")
def in_list(v: Views):
    kept = v.rx.where(F.col("ndcnum").isin("Brand#1", "Brand#2", "Brand#17", "Brand#21"))
    return kept.groupBy("ndcnum").agg(F.count(F.lit(1)).alias("n"))


@query("not_in_list", with_views("rx") + """
SELECT ndcnum, count(*) AS n FROM rx WHERE ndcnum NOT IN ('Brand#1', 'Brand#2') GROUP BY 1""")
def not_in_list(v: Views):
    return v.rx.where(~F.col("ndcnum").isin("Brand#1", "Brand#2")).groupBy("ndcnum").agg(F.count(F.lit(1)).alias("n"))


@query("between", with_views("claims") + """
SELECT procgrp, count(*) AS n FROM claims WHERE procgrp >= 201 AND procgrp <= 299 GROUP BY 1""")
def between(v: Views):
    return v.claims.where(F.col("procgrp").between(201, 299)).groupBy("procgrp").agg(F.count(F.lit(1)).alias("n"))


@query("point_lookup", with_views("rx") + "SELECT svcdate, ndcnum, daysupp FROM rx WHERE enrolid = 17")
def point_lookup(v: Views):
    return v.rx.where(F.col("enrolid") == 17).select("svcdate", "ndcnum", "daysupp")


@query("apply_format", """WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_custkey % 11 AS DOUBLE) END AS plantyp,
  CAST(c_custkey % 7 AS STRING) AS region, CASE WHEN c_custkey % 4 = 3 THEN ' ' ELSE CAST(c_custkey % 4 AS STRING) END AS sex FROM customer)
SELECT c_custkey, CASE WHEN plantyp IS NULL THEN '.-Missing/Unknown' WHEN plantyp BETWEEN 1 AND 9 THEN
  ['1-Basic/Major Medical','2-Comprehensive','3-EPO','4-HMO','5-POS','6-PPO','7-POS with Capitation','8-CDHP','9-HDHP'][CAST(plantyp AS INT)]
  ELSE CAST(CAST(plantyp AS BIGINT) AS VARCHAR) END AS plantyp_label,
 CASE WHEN plantyp IN (4, 7) THEN '3-HMO and POS capitation' WHEN plantyp BETWEEN 1 AND 9 THEN '1-Fee for service' ELSE '2-Unknown' END AS plan_label,
 CASE WHEN region BETWEEN '1' AND '5' THEN ['1-Northeast Region','2-North Central Region','3-South Region','4-West Region','5-Unknown Region'][CAST(region AS INT)]
  ELSE region END AS region_label,
 CASE sex WHEN '1' THEN '1-Male' WHEN '2' THEN '2-Female' WHEN ' ' THEN 'Missing/Unknown' ELSE sex END AS sex_label FROM p""")
def apply_format(v: Views):
    people = v.table("customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_custkey % 11 AS DOUBLE) END AS plantyp",
        "CAST(c_custkey % 7 AS STRING) AS region",
        "CASE WHEN c_custkey % 4 = 3 THEN ' ' ELSE CAST(c_custkey % 4 AS STRING) END AS sex",
    )
    return people.select(
        "c_custkey",
        plantyp_label(F.col("plantyp")).alias("plantyp_label"),
        plan_group_label(F.col("plantyp")).alias("plan_label"),
        region_label(F.col("region")).alias("region_label"),
        sex_label(F.col("sex")).alias("sex_label"),
    )
