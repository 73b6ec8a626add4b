"""Queries over code scans, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimtrail.operators.conditions import baseline_claims
from claimtrail.operators.exposure import index_join
from claimtrail.operators.joins import lookup_join
from claimtrail.operators.reshape import distinct_values, outer_union, to_long, vec2mat, with_pseudo_group
from claimtrail.operators.scan import (
    attach_generic, equal_join, exclude, prefix_join, restrict_to, scan_dx, scan_enrollment, scan_rx,
)
from claimtrail.operators.supply import supply_mode
from claimtrail.operators.treatment import multi_treatment_patients
from claimtrail.plans.queries_predicates import RULEOUT_SQL
from claimtrail.plans.registry import query
from claimtrail.plans.views import Views, with_views

STUDY_SQL = "svcdate BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"


def _count(df, *keys):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query("dx_prefix_join", with_views("claims", "icd9") + f"""
SELECT c.enrolid, c.svcdate, i.icd9 AS code, count(*) AS n FROM claims c
JOIN (SELECT DISTINCT icd9 FROM icd9) i ON starts_with(c.pdx, i.icd9) OR starts_with(c.dx1, i.icd9) OR starts_with(c.dx2, i.icd9)
WHERE {STUDY_SQL} AND source IN ('ccae', 'mdcr') AND scope IN ('s', 'o') GROUP BY ALL""")
def dx_prefix_join(v: Views):
    found = scan_dx(
        v.claims, v.icd9.select("icd9"), ["pdx", "dx1", "dx2"], v.cfg.study_start, v.cfg.study_end,
        sources=v.cfg.sources, scopes=["s", "o"], code_col="code",
    )
    return _count(found, "enrolid", "svcdate", "code")


@query("dx_prefix_join_nested_codes", """
SELECT p_partkey, p_brand, code FROM part
JOIN (VALUES ('Brand#1'), ('Brand#2'), ('Brand#17'), ('Brand#21')) c(code) ON starts_with(p_brand, code)""")
def dx_prefix_join_nested_codes(v: Views):
    codes = ["Brand#1", "Brand#2", "Brand#17", "Brand#21", ""]
    return prefix_join(v.table("part").select("p_partkey", "p_brand"), codes, ["p_brand"], "code")


HEADS_SQL = ", ".join(f"substr({c}, 1, {n})" for c in ("pdx", "dx1", "dx2") for n in range(1, 6))


@query("dx_prefix_join_long_list", with_views("claims", "hcpcs") + f"""
SELECT enrolid, code, count(*) AS n FROM (SELECT enrolid, unnest(list_distinct([{HEADS_SQL}])) AS code FROM claims)
WHERE code IN (SELECT hcpcs FROM hcpcs) GROUP BY ALL""")
def dx_prefix_join_long_list(v: Views):
    found = prefix_join(v.claims, v.hcpcs.select("hcpcs"), ["pdx", "dx1", "dx2"], "code")
    return _count(found, "enrolid", "code")


@query("rx_code_join", with_views("rx", "ndc") + f"""
SELECT r.enrolid, r.ndcnum, count(*) AS n FROM rx r JOIN (SELECT DISTINCT ndc FROM ndc) d ON r.ndcnum = d.ndc
WHERE {STUDY_SQL} GROUP BY ALL""")
def rx_code_join(v: Views):
    found = scan_rx(v.rx, v.ndc.select("ndc"), ["ndcnum"], v.cfg.study_start, v.cfg.study_end)
    return _count(found, "enrolid", "ndcnum")


@query("rx_code_join_columns", with_views("claims", "hcpcs") + """
SELECT enrolid, code, count(*) AS n FROM (SELECT enrolid, unnest(list_distinct([proc1, pdx, dx1])) AS code FROM claims)
WHERE code IN (SELECT hcpcs FROM hcpcs) GROUP BY ALL""")
def rx_code_join_columns(v: Views):
    return _count(equal_join(v.claims, v.hcpcs.select("hcpcs"), ["proc1", "pdx", "dx1"], "code"), "enrolid", "code")


@query("rx_code_join_long_list", with_views("claims", "hcpcs") + """
SELECT enrolid, code, count(*) AS n FROM (SELECT enrolid, unnest(list_distinct([proc1, pdx, dx1])) AS code FROM claims)
WHERE code IN (SELECT hcpcs FROM hcpcs) GROUP BY ALL""")
def rx_code_join_long_list(v: Views):
    found = equal_join(v.claims, v.hcpcs.select("hcpcs"), ["proc1", "pdx", "dx1"], "code")
    return _count(found, "enrolid", "code")


@query("scan_no_codes", with_views("adm") + """
SELECT enrolid, admdate, disdate, pdx FROM adm WHERE disdate >= DATE '1997-01-01' AND admdate <= DATE '1999-12-31'""")
def scan_no_codes(v: Views):
    found = scan_dx(v.adm, start=v.cfg.study_start, end=v.cfg.study_end, date_col="admdate", end_col="disdate")
    return found.select("enrolid", "admdate", "disdate", "pdx")


@query("scan_enrollment", with_views("spells") + """
SELECT * FROM spells WHERE dtend >= DATE '1997-01-01' AND dtstart <= DATE '1999-12-31'""")
def scan_enrollment_query(v: Views):
    return scan_enrollment(v.spells, v.cfg.study_start, v.cfg.study_end)


@query("attach_generic", with_views("rx", "ndc") + """
SELECT enrolid, svcdate, ndcnum, (SELECT generic_name FROM ndc WHERE ndc = ndcnum) AS generic_name, daysupp FROM rx""")
def attach_generic_query(v: Views):
    return attach_generic(v.rx.drop("generic_name"), v.ndc, "ndcnum", "ndc").select(
        "enrolid", "svcdate", "ndcnum", "generic_name", "daysupp"
    )


@query("index_join", with_views("rx") + """
SELECT enrolid, svcdate, ndcnum, daysupp FROM rx
QUALIFY svcdate = min(svcdate) OVER (PARTITION BY enrolid)""")
def index_join_query(v: Views):
    return index_join(v.rx, "enrolid", "svcdate").select("enrolid", "svcdate", "ndcnum", "daysupp")


@query("semi_join", with_views("adm", "idx") + """
SELECT enrolid, count(*) AS n FROM adm WHERE enrolid IN (SELECT enrolid FROM idx) GROUP BY 1""")
def semi_join(v: Views):
    return _count(restrict_to(v.adm, v.idx), "enrolid")


@query("anti_join", with_views("adm", "idx") + """
SELECT enrolid, count(*) AS n FROM adm WHERE enrolid NOT IN (SELECT enrolid FROM idx) GROUP BY 1""")
def anti_join(v: Views):
    return _count(exclude(v.adm, v.idx), "enrolid")


@query("window_equi_join", with_views("rx", "cohort") + """
SELECT r.enrolid, r.svcdate, r.generic_name, c.idxdate, count(*) AS n FROM rx r
JOIN (SELECT DISTINCT enrolid, idxdate, idxtreatment FROM cohort) c ON r.enrolid = c.enrolid AND r.generic_name = c.idxtreatment
 AND r.svcdate BETWEEN c.idxdate AND c.idxdate + 364 GROUP BY ALL""")
def window_equi_join(v: Views):
    indexed = v.cohort.select("enrolid", "idxdate", F.col("idxtreatment").alias("generic_name")).distinct()
    joined = lookup_join(v.rx, indexed, ["enrolid", "generic_name"])
    kept = joined.where((F.col("idxdate") <= F.col("svcdate")) & (F.col("svcdate") <= F.date_add("idxdate", 364)))
    return _count(kept, "enrolid", "svcdate", "generic_name", "idxdate")


@query("left_range_join", with_views("claims", "idx") + f"""
SELECT i.enrolid, c.svcdate, c.dx1, c.dx2, count(*) AS n FROM idx i LEFT JOIN claims c ON i.enrolid = c.enrolid
WHERE i.idxdate - 365 <= c.svcdate AND c.svcdate < i.idxdate AND NOT {RULEOUT_SQL.replace('proc1', 'c.proc1')} GROUP BY ALL""")
def left_range_join(v: Views):
    return _count(baseline_claims(v.sddx, v.cfg), "enrolid", "svcdate", "dx1", "dx2")


@query("multi_left_join", with_views("rx", "claims", "idx") + """
SELECT i.enrolid, f.fills, s.inpatient, o.outpatient FROM idx i
LEFT JOIN (SELECT enrolid, count(*) AS fills FROM rx WHERE daysupp > 0 GROUP BY 1) f ON i.enrolid = f.enrolid
LEFT JOIN (SELECT enrolid, count(DISTINCT svcdate) AS inpatient FROM claims WHERE scope = 's' GROUP BY 1) s ON i.enrolid = s.enrolid
LEFT JOIN (SELECT enrolid, count(DISTINCT svcdate) AS outpatient FROM claims WHERE scope = 'o' GROUP BY 1) o ON i.enrolid = o.enrolid""")
def multi_left_join(v: Views):
    days = v.claims.groupBy("enrolid", "svcdate").agg(
        F.max((F.col("scope") == "s").cast("int")).alias("s"), F.max((F.col("scope") == "o").cast("int")).alias("o")
    )
    use = days.groupBy("enrolid").agg(
        F.nullif(F.sum("s"), F.lit(0)).alias("inpatient"), F.nullif(F.sum("o"), F.lit(0)).alias("outpatient")
    )
    fills = v.rx.where("daysupp > 0").groupBy("enrolid").agg(F.count(F.lit(1)).alias("fills"))
    joined = v.idx.join(fills, "enrolid", "left").join(use, "enrolid", "left")
    return joined.select("enrolid", "fills", "inpatient", "outpatient")


@query("inner_merge", with_views("rx", "claims", "idx") + """
SELECT enrolid, idxdate, fills, n_claims FROM idx JOIN (SELECT enrolid, count(*) AS fills FROM rx GROUP BY 1) USING (enrolid)
JOIN (SELECT enrolid, count(*) AS n_claims FROM claims GROUP BY 1) USING (enrolid)""")
def inner_merge(v: Views):
    fills = v.rx.groupBy("enrolid").agg(F.count(F.lit(1)).alias("fills"))
    claims = v.claims.groupBy("enrolid").agg(F.count(F.lit(1)).alias("n_claims"))
    return v.idx.join(fills, "enrolid").join(claims, "enrolid")


@query("full_merge", """
SELECT coalesce(o.custkey, e.custkey) AS enrolid, o.n_orders, e.n_events FROM
 (SELECT o_custkey AS custkey, count(*) AS n_orders FROM orders GROUP BY 1) o FULL JOIN
 (SELECT user_id AS custkey, count(*) AS n_events FROM events GROUP BY 1) e ON o.custkey = e.custkey""")
def full_merge(v: Views):
    orders = v.table("orders").groupBy(F.col("o_custkey").alias("enrolid")).agg(F.count(F.lit(1)).alias("n_orders"))
    events = v.table("events").groupBy(F.col("user_id").alias("enrolid")).agg(F.count(F.lit(1)).alias("n_events"))
    return orders.join(events, "enrolid", "full")


@query("keyed_lookup", with_views("rx") + """
, best AS (SELECT ndcnum, min(daysupp) AS usual FROM (SELECT ndcnum, daysupp, f, max(f) OVER (PARTITION BY ndcnum) AS top
   FROM (SELECT ndcnum, daysupp, count(*) AS f FROM rx WHERE daysupp > 35 GROUP BY ALL)) WHERE f = top GROUP BY 1)
SELECT enrolid, svcdate, r.ndcnum, coalesce((SELECT usual FROM best b WHERE b.ndcnum = r.ndcnum), 0) AS usual FROM rx r""")
def keyed_lookup(v: Views):
    usual = supply_mode(v.rx.where("daysupp > 35"))
    looked_up = lookup_join(v.rx, usual, ["ndcnum"], "left")
    return looked_up.select("enrolid", "svcdate", "ndcnum", F.coalesce("mode_supply", F.lit(0)).alias("usual"))


@query("union_all", with_views("rx", "claims") + """
SELECT enrolid, svcdate, kind, count(*) AS n FROM (SELECT enrolid, svcdate, 'drug' AS kind FROM rx UNION ALL
 SELECT enrolid, svcdate, 'service' FROM claims) GROUP BY ALL""")
def union_all(v: Views):
    drugs = v.rx.select("enrolid", "svcdate", F.lit("drug").alias("kind"))
    services = v.claims.select("enrolid", "svcdate", F.lit("service").alias("kind"))
    return _count(drugs.unionByName(services), "enrolid", "svcdate", "kind")


@query("union_distinct", with_views("claims") + "SELECT enrolid, dx1 AS dx FROM claims UNION SELECT enrolid, dx2 FROM claims")
def union_distinct(v: Views):
    return distinct_values(v.claims, "enrolid", ["dx1", "dx2"], "dx")


@query("outer_union_corr", """
SELECT segment, balance_kind, count(*) AS n FROM (SELECT c_mktsegment AS segment, NULL AS balance_kind FROM customer UNION ALL
 SELECT NULL, CASE WHEN s_acctbal < 0 THEN 'debt' ELSE 'credit' END FROM supplier) GROUP BY ALL""")
def outer_union_corr(v: Views):
    customers = v.table("customer").select(F.col("c_mktsegment").alias("segment"))
    suppliers = v.table("supplier").select(F.when(F.col("s_acctbal") < 0, "debt").otherwise("credit").alias("balance_kind"))
    return _count(outer_union(customers, suppliers), "segment", "balance_kind")


@query("pseudo_group", "SELECT c_mktsegment AS grp, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT 'Grp1', count(*) FROM customer")
def pseudo_group(v: Views):
    return _count(with_pseudo_group(v.table("customer").withColumnRenamed("c_mktsegment", "grp"), "grp", "Grp1"), "grp")


KINDS = {"view": "had_view", "signup": "had_signup", "click": "had_click", "purchase": "had_purchase", "error": "had_error"}


@query("vec2mat", with_views("visits_days") + "SELECT enrolid, " + ", ".join(
    f"CAST(max(CASE WHEN kind = '{k}' THEN 1 ELSE 0 END) AS INT) AS {n}" for k, n in KINDS.items()) + " FROM visits_days GROUP BY 1")
def vec2mat_query(v: Views):
    return vec2mat(v.visits_days, "enrolid", "kind", KINDS)


@query("vec2mat_char", with_views("claims") + """
SELECT enrolid, CASE WHEN count(*) FILTER (WHERE substr(dx1, 1, 3) = '250') > 0 THEN '1' ELSE '0' END AS dx_250,
 CASE WHEN count(*) FILTER (WHERE substr(dx1, 1, 3) = '410') > 0 THEN '1' ELSE '0' END AS dx_410 FROM claims GROUP BY 1""")
def vec2mat_char(v: Views):
    heads = v.claims.select("enrolid", F.substring("dx1", 1, 3).alias("head"))
    return vec2mat(heads, "enrolid", "head", {"250": "dx_250", "410": "dx_410"}, numeric=False)


@query("transpose_long", """
SELECT c_custkey, 'c_acctbal' AS stat, c_acctbal AS value FROM customer UNION ALL
SELECT c_custkey, 'nation', CAST(c_nationkey AS DOUBLE) FROM customer""")
def transpose_long(v: Views):
    wide = v.table("customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").cast("double").alias("nation"))
    return to_long(wide, ["c_custkey"], ["c_acctbal", "nation"], "stat", "value")


@query("insert_rows", with_views("claims") + """
SELECT 'dx1' AS varname, substr(dx1, 1, 1) AS varlvl, count(*) AS value FROM claims GROUP BY ALL
UNION ALL SELECT 'pdx', substr(pdx, 1, 1), count(*) FROM claims GROUP BY ALL
UNION ALL SELECT 'proc1', substr(proc1, 1, 1), count(*) FROM claims GROUP BY ALL""")
def insert_rows(v: Views):
    heads = v.claims.select(*[F.substring(c, 1, 1).alias(c) for c in ("dx1", "pdx", "proc1")])
    long = to_long(heads, [], ["dx1", "pdx", "proc1"], "varname", "varlvl")
    return long.groupBy("varname", "varlvl").agg(F.count(F.lit(1)).alias("value"))


@query("count_distinct_having", with_views("cohort") + """
SELECT enrolid, count(DISTINCT idxtreatment) AS index_freq FROM cohort GROUP BY 1 HAVING index_freq > 1""")
def count_distinct_having(v: Views):
    return multi_treatment_patients(v.cohort)
