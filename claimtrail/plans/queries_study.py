"""Queries over the composite study operators and descriptive statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from claimtrail.functions.dates import is_in_baseline, is_in_outcome
from claimtrail.functions.predicates import CLAIM_COLUMNS
from claimtrail.operators.charlson import charlson
from claimtrail.operators.conditions import (
    baseline, baseline_claims, common_conditions, condition_frequency, patient_conditions, rank_labels_top_n,
)
from claimtrail.operators.describe import (
    desc_stat_c, desc_stat_d, desc_stat_n, descriptive_stats, freq_sparse, summary_rollup,
)
from claimtrail.operators.enrollment import age_filter, continuous_enrollment
from claimtrail.operators.exposure import index_cohort
from claimtrail.operators.histories import adherence_from, adherence_states, period_states, persistence_from, save_states, whole_states
from claimtrail.operators.joins import saved
from claimtrail.operators.supply import clean_supply_days
from claimtrail.operators.survival import km_at_risk, km_quartiles, km_survival
from claimtrail.operators.treatment import adherence, cohort_treatment, outcomes_tp, persistence
from claimtrail.operators.utilization import hospitalization, outcomes_ru, visit_counts, visits
from claimtrail.plans.queries_ordered import charlson_sql
from claimtrail.plans.queries_predicates import DISEASE_SQL, RULEOUT_SQL, VISIT_SQL
from claimtrail.plans.queries_sources import library
from claimtrail.plans.registry import query
from claimtrail.plans.study import (
    StudyInputs, folder_saver, pull_admissions, pull_dx, pull_enrollment, pull_study, study_claims, study_exposure, study_run,
    variables,
)
from claimtrail.plans.stock_sql import covered_sql, ends_sql, stock_sql
from claimtrail.plans.views import Views, with_views

PROCS = ["proc1", "proc2", "proc3"]


def inputs(v: Views) -> StudyInputs:
    return StudyInputs(v.claims, v.rx.drop("generic_name"), v.adm, v.spells, v.icd9, v.ndc, v.hcpcs)


def around_index(day, until, cfg, before: int, after: int):
    """The days touch those that are in the reach of some index date. Index dates lie in the index period, so this drops nothing that a window keeps."""
    return (until >= F.date_sub(F.lit(cfg.index_start), before)) & (day <= F.date_add(F.lit(cfg.index_end), after))


def fills(v: Views):
    day = F.col("svcdate")
    return cohort_treatment(v.rx.where((F.col("daysupp") > 0) & around_index(day, day, v.cfg, 0, v.cfg.outcome_days)), v.cohort, v.cfg)


def persisted(v: Views):
    return persistence(fills(v), v.cfg.refill_gap, v.cfg.drug_followup_days)


def rounded(df, *columns, places=9):
    return df.withColumns({c: F.round(c, places) for c in columns})


def chain(*parts: str) -> str:
    return ",\n".join(p.strip() for p in parts)


# ---- SQL building blocks ----
DEDUPED_SQL = """deduped AS (SELECT enrolid, svcdate, ndcnum, daysupp, sex, dobyr, age, plantyp, region FROM rx
 QUALIFY row_number() OVER (PARTITION BY enrolid, svcdate, ndcnum ORDER BY daysupp DESC NULLS LAST) = 1)"""
CLEANED_SQL = """usual AS (SELECT ndcnum, daysupp AS u FROM (SELECT ndcnum, daysupp,
  row_number() OVER (PARTITION BY ndcnum ORDER BY count(*) DESC, daysupp) AS k FROM deduped WHERE daysupp > 0 GROUP BY ndcnum, daysupp)
 WHERE k = 1),
cleaned AS (SELECT d.* REPLACE (CASE WHEN daysupp > 0 THEN daysupp ELSE u END AS daysupp) FROM deduped d JOIN usual USING (ndcnum))"""
OWN_SQL = "source <> 'mcdd' AND scope IN ('s', 'o')"
STUDY_DAYS = "BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'"
EXPOSURE_SQL = f"""rx_all AS (SELECT * FROM rx WHERE svcdate {STUDY_DAYS}),
{DEDUPED_SQL.replace('FROM rx', 'FROM rx_all')},
{CLEANED_SQL},
interest_tx AS (SELECT enrolid, svcdate, sex, dobyr, age, plantyp, region, n.generic_name, daysupp FROM cleaned c JOIN ndc n ON c.ndcnum = n.ndc
 UNION ALL SELECT enrolid, svcdate, sex, dobyr, age, plantyp, region, h.generic_name, h.daysupp FROM claims c JOIN hcpcs h ON c.proc1 = h.hcpcs
 WHERE svcdate {STUDY_DAYS} AND {OWN_SQL})"""
ALLPT_SQL = """first_day AS (SELECT enrolid, min(svcdate) AS idxdate FROM interest_tx
  WHERE svcdate BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' GROUP BY 1),
allpt AS (SELECT DISTINCT t.enrolid, f.idxdate, sex, dobyr, age, plantyp, region, generic_name AS idxtreatment
 FROM interest_tx t JOIN first_day f ON t.enrolid = f.enrolid AND t.svcdate = f.idxdate)"""
FILLS_SQL = """multi AS (SELECT enrolid FROM cohort GROUP BY 1 HAVING count(DISTINCT idxtreatment) > 1),
fills AS (SELECT r.enrolid, c.idxdate, r.generic_name AS idxtreatment, r.svcdate, r.daysupp FROM rx r
 JOIN (SELECT DISTINCT enrolid, idxdate, idxtreatment FROM cohort) c ON r.enrolid = c.enrolid AND r.generic_name = c.idxtreatment
 WHERE r.daysupp > 0 AND r.svcdate BETWEEN c.idxdate AND c.idxdate + 364 AND r.enrolid NOT IN (SELECT enrolid FROM multi))"""
ADHERENCE_SQL = ",\n".join([
    "daily AS (SELECT enrolid, idxdate, svcdate, CAST(sum(daysupp) AS INT) AS d FROM fills GROUP BY ALL)",
    stock_sql("daily", "stock"), covered_sql("daily", "cover", "idxdate + 364"),
    """taken AS (SELECT enrolid, any_value(idxdate) AS idxdate, count(*) AS fill_days, sum(d) AS total, max(svcdate) AS last, arg_max(d, svcdate) AS last_d
 FROM daily GROUP BY 1),
adhere AS (SELECT t.enrolid, CAST(fill_days > 1 AS INT) AS mpr_flag,
 CASE WHEN fill_days > 1 THEN least(total / (last - idxdate + last_d), 1.0) END AS mpr_df1,
 CASE WHEN fill_days > 1 THEN least((total - last_d) / (last - idxdate), 1.0) END AS mpr_df2,
 CASE WHEN fill_days > 1 THEN (total - last_d - held) / (last - idxdate) END AS mpr_df3,
 covered / 364 AS pdc_df1, (total - greatest(0, last + held + last_d - (idxdate + 364))) / 364 AS pdc_df2, least(total / 364, 1.0) AS pdc_df3
 FROM taken t JOIN stock s ON s.enrolid = t.enrolid AND s.day = t.last JOIN cover c ON c.enrolid = t.enrolid)""",
])
PERSIST_SQL = ",\n".join([
    "filled AS (SELECT enrolid, svcdate, CAST(sum(daysupp) AS INT) AS d FROM fills GROUP BY ALL)", stock_sql("filled", "supply"), ends_sql("supply", "ends"),
    """persist AS (SELECT enrolid, CAST(least(supply_end - first_day, 300) AS BIGINT) AS time, CAST(supply_end - first_day < 300 AS INT) AS disc_flag FROM ends)""",
])
BASE_DX_SQL = f"""base AS (SELECT enrolid, dx1, dx2 FROM sddx WHERE idxdate - 365 <= svcdate AND svcdate < idxdate AND NOT {RULEOUT_SQL})"""
PAIRS_SQL = """pairs AS (SELECT enrolid, coalesce(substr(dx1, 1, 3), '') AS icd9_3 FROM base UNION
 SELECT enrolid, coalesce(substr(dx2, 1, 3), '') FROM base),
freq AS (SELECT icd9_3, count(*) AS freq FROM pairs WHERE icd9_3 <> '' AND icd9_3 NOT IN (SELECT substr(icd9, 1, 3) FROM disease) GROUP BY 1),
top AS (SELECT icd9_3, row_number() OVER (ORDER BY freq DESC, icd9_3) AS k FROM freq QUALIFY rank() OVER (ORDER BY freq DESC) <= 10)"""
HOSPITAL_SQL = f"""stays AS (SELECT enrolid, admdate, bool_or(
  EXISTS (SELECT 1 FROM disease d WHERE starts_with(a.pdx, d.icd9)) AND (
   {' OR '.join(f"(trim(coalesce({p}, '')) <> '' AND NOT {RULEOUT_SQL.replace('proc1', p)})" for p in PROCS)})) AS dis
 FROM sdadm a WHERE idxdate <= coalesce(disdate, admdate) AND admdate <= idxdate + 364 GROUP BY ALL),
hospital AS (SELECT enrolid, count(*) AS all_hospitalization, count(*) FILTER (WHERE dis) AS dis_hospitalization FROM stays GROUP BY 1)"""
VISITS_SQL = f"""typed AS (SELECT enrolid, svcdate, {VISIT_SQL} AS kind, {DISEASE_SQL} AS dis FROM sddx c
 WHERE idxdate <= svcdate AND svcdate <= idxdate + 364),
""" + ",\n".join(
    f"{p}_{k.lower()} AS (SELECT enrolid, count(DISTINCT svcdate) AS {p}_{k.lower()} FROM typed WHERE kind = '{k}'"
    f"{' AND dis' if p == 'dis' else ''} GROUP BY 1)"
    for p in ("all", "dis") for k in ("ER", "Office", "Others")
)
COUNTS = ["all_er", "all_office", "all_others", "dis_er", "dis_office", "dis_others"]
VISIT_JOINS = " ".join(f"LEFT JOIN {c} USING (enrolid)" for c in COUNTS)
ALL_COUNTS = ["all_hospitalization", "dis_hospitalization", *COUNTS]
RU_SQL = f"""ru AS (SELECT enrolid, {', '.join(f'coalesce({c}, 0) AS {c}' for c in ALL_COUNTS)},
 {', '.join(f"CASE WHEN coalesce({c}, 0) > 0 THEN '1' ELSE '0' END AS with_{c}" for c in ALL_COUNTS)}
 FROM idx LEFT JOIN hospital USING (enrolid) {VISIT_JOINS})"""


def study_sql(*parts: str, views: tuple[str, ...]) -> str:
    return with_views(*views).rstrip() + ",\n" + chain(*parts) + "\n"


# ---- supply, exposure, cohort, pulls ----
@query("clean_supply_days", study_sql(DEDUPED_SQL, CLEANED_SQL, views=("rx",)) + "SELECT enrolid, svcdate, ndcnum, daysupp, sex FROM cleaned")
def clean_supply(v: Views):
    return clean_supply_days(v.rx, keep=["sex"])


@query("exposure", study_sql(EXPOSURE_SQL, views=("rx", "claims", "ndc", "hcpcs")) + "SELECT * FROM interest_tx")
def exposure_query(v: Views):
    return study_exposure(inputs(v), v.cfg)


@query("index_cohort", with_views("cohort") + "SELECT * FROM cohort")
def index_cohort_query(v: Views):
    return index_cohort(v.rx, v.cfg)


@query("pull_dx", with_views("claims", "icd9", "cohort") + f"""
SELECT c.enrolid, c.svcdate, c.pdx, c.dx1, c.dx2, count(*) AS n FROM claims c JOIN (SELECT DISTINCT icd9 FROM icd9) i
 ON starts_with(c.pdx, i.icd9) OR starts_with(c.dx1, i.icd9) OR starts_with(c.dx2, i.icd9)
WHERE svcdate {STUDY_DAYS} AND {OWN_SQL} AND c.enrolid IN (SELECT enrolid FROM cohort) GROUP BY ALL""")
def pull_dx_query(v: Views):
    found = pull_dx(inputs(v), v.cohort, v.cfg)
    return found.groupBy("enrolid", "svcdate", "pdx", "dx1", "dx2").agg(F.count(F.lit(1)).alias("n"))


@query("pull_admissions", with_views("adm", "cohort") + """
SELECT enrolid, admdate, disdate, pdx FROM adm WHERE disdate >= DATE '1997-01-01' AND admdate <= DATE '1999-12-31'
 AND enrolid IN (SELECT enrolid FROM cohort)""")
def pull_admissions_query(v: Views):
    return pull_admissions(inputs(v), v.cohort, v.cfg).select("enrolid", "admdate", "disdate", "pdx")


@query("pull_enrollment", with_views("spells", "cohort") + """
SELECT * FROM spells WHERE dtend >= DATE '1997-01-01' AND dtstart <= DATE '1999-12-31' AND enrolid IN (SELECT enrolid FROM cohort)""")
def pull_enrollment_query(v: Views):
    return pull_enrollment(inputs(v), v.cohort, v.cfg)


# ---- baseline ----
@query("charlson", with_views("sddx").rstrip() + ",\n" + BASE_DX_SQL + "\n" + charlson_sql("base", ["dx1", "dx2"]))
def charlson_query(v: Views):
    return charlson(baseline_claims(v.sddx, v.cfg))


@query("common_conditions", study_sql(BASE_DX_SQL, PAIRS_SQL, views=("sddx", "disease")) + """
SELECT p.enrolid, 'ICD93d_Top_' || CAST(t.k AS VARCHAR) AS condition, max(CASE WHEN p.icd9_3 = t.icd9_3 THEN '1' ELSE '0' END) AS flag
FROM pairs p CROSS JOIN top t GROUP BY ALL""")
def common_conditions_query(v: Views):
    pairs = patient_conditions(baseline_claims(v.sddx, v.cfg))
    top = rank_labels_top_n(condition_frequency(pairs, v.disease), v.cfg.top_conditions)
    wide = common_conditions(pairs, top)
    return wide.unpivot("enrolid", [c for c in wide.columns if c != "enrolid"], "condition", "flag")


BASELINE_SQL = (
    "cci AS (" + charlson_sql("base", ["dx1", "dx2"]) + """),
common AS (SELECT enrolid, coalesce(string_agg(CAST(t.k AS VARCHAR), ' ' ORDER BY t.k), '') AS top_conditions
 FROM pairs p LEFT JOIN top t USING (icd9_3) GROUP BY 1)"""
)


@query("baseline", study_sql(BASE_DX_SQL, PAIRS_SQL, BASELINE_SQL, views=("sddx", "disease")) + "SELECT * FROM cci JOIN common USING (enrolid)")
def baseline_query(v: Views):
    return with_top_list(baseline(v.sddx, v.disease, v.cfg))


def with_top_list(wide):
    """The top-condition flags as one list of the numbers that are set."""
    flags = [c for c in wide.columns if c.startswith("ICD93d_Top_")]
    listed = F.concat_ws(" ", *[F.when(F.col(c) == "1", c.rsplit("_", 1)[1]) for c in flags])
    return wide.withColumn("top_conditions", listed).drop(*flags)


# ---- utilization ----
def hospital(v: Views):
    stays = v.sdadm.where(around_index(F.col("admdate"), F.coalesce("disdate", "admdate"), v.cfg, 0, v.cfg.outcome_days))
    return hospitalization(stays, v.disease, v.cfg, PROCS)


def visit(v: Views):
    return visit_counts(visits(v.sddx, v.disease, v.cfg))


@query("hospitalization", study_sql(HOSPITAL_SQL, views=("sdadm", "disease")) + "SELECT * FROM hospital")
def hospitalization_query(v: Views):
    return hospital(v)


@query("hospital_counts", study_sql(HOSPITAL_SQL, views=("sdadm", "disease")) + """
SELECT all_hospitalization, dis_hospitalization, count(*) AS patients FROM hospital GROUP BY ALL""")
def hospital_counts(v: Views):
    return hospital(v).groupBy("all_hospitalization", "dis_hospitalization").agg(F.count(F.lit(1)).alias("patients"))


@query("visit_counts", study_sql(VISITS_SQL, views=("sddx", "disease")) + f"""
SELECT enrolid, {', '.join(COUNTS)} FROM idx {VISIT_JOINS} WHERE all_er > 0 OR all_office > 0 OR all_others > 0""")
def visit_counts_query(v: Views):
    return visit(v)


@query("outcomes_ru", study_sql(HOSPITAL_SQL, VISITS_SQL, RU_SQL, views=("sddx", "sdadm", "disease")) + "SELECT * FROM ru")
def outcomes_ru_query(v: Views):
    return outcomes_ru(v.idx, hospital(v), visit(v), v.cfg)


# ---- treatment pattern ----
@query("cohort_treatment", study_sql(FILLS_SQL, views=("rx", "cohort")) + "SELECT enrolid, idxdate, idxtreatment, svcdate, daysupp FROM fills")
def cohort_treatment_query(v: Views):
    return fills(v).select("enrolid", "idxdate", "idxtreatment", "svcdate", "daysupp")


RATES = ["mpr_df1", "mpr_df2", "mpr_df3", "pdc_df1", "pdc_df2", "pdc_df3"]


@query("adherence", study_sql(FILLS_SQL, ADHERENCE_SQL, views=("rx", "cohort")) + f"""
SELECT enrolid, mpr_flag, {', '.join(f'round({r}, 9) AS {r}' for r in RATES)} FROM adhere""")
def adherence_query(v: Views):
    return rounded(adherence(fills(v), v.cfg.outcome_days), *RATES)


@query("persistence", study_sql(FILLS_SQL, PERSIST_SQL, views=("rx", "cohort")) + "SELECT * FROM persist")
def persistence_query(v: Views):
    return persisted(v)


@query("persistence_no_lookforward", study_sql(FILLS_SQL, PERSIST_SQL, views=("rx", "cohort")) + """
SELECT enrolid, CASE WHEN time >= 240 THEN 300 ELSE time END AS time, CASE WHEN time >= 240 THEN 0 ELSE disc_flag END AS disc_flag FROM persist""")
def persistence_no_lookforward(v: Views):
    return persistence(fills(v), v.cfg.refill_gap, v.cfg.drug_followup_days, lookforward=False)


def stored_by_year(v: Views, home: str, states_of):
    """States of all fills, stored in two goes: the years before the last one, then the last one as an extension."""
    all_fills = fills(v)
    year = F.year("svcdate")
    last = all_fills.agg(F.max(year)).first()[0]
    table = f"{library(v, home)}.states"
    for part in (year < last, year == last):
        save_states(v.spark, states_of(all_fills.where(part), year), table)
    return v.spark.table(table)


@query("adherence_by_year", study_sql(FILLS_SQL, ADHERENCE_SQL, views=("rx", "cohort")) + f"""
SELECT enrolid, mpr_flag, {', '.join(f'round({r}, 9) AS {r}' for r in RATES)} FROM adhere""")
def adherence_by_year(v: Views):
    days, gap = v.cfg.outcome_days, v.cfg.refill_gap
    states = stored_by_year(v, "q_adherence_by_year", lambda df, year: adherence_states(df, days, gap, year))
    return rounded(adherence_from(whole_states(states, ["enrolid", "idxdate"]), days), *RATES)


@query("persistence_by_year", study_sql(FILLS_SQL, PERSIST_SQL, views=("rx", "cohort")) + "SELECT * FROM persist")
def persistence_by_year(v: Views):
    gap = v.cfg.refill_gap
    states = stored_by_year(v, "q_persistence_by_year", lambda df, year: period_states(df, ["enrolid"], gap, year))
    return persistence_from(whole_states(states, ["enrolid"]), gap, v.cfg.drug_followup_days)


KM_SQL = """days AS (SELECT time, count(*) FILTER (WHERE disc_flag = 1) AS d, count(*) AS n FROM persist GROUP BY 1),
risk AS (SELECT time, d, n, (SELECT sum(b.n) FROM days b WHERE b.time >= a.time) AS r FROM days a),
curve AS (SELECT time, CAST(r AS BIGINT) AS n_risk, d AS n_event, n - d AS n_censor,
 (SELECT product((b.r - b.d) / b.r) FROM risk b WHERE b.time <= a.time) AS survival,
 (SELECT sum(b.d / (b.r * (b.r - b.d))) FROM risk b WHERE b.time <= a.time AND b.r > b.d) AS v FROM risk a)"""


@query("km_survival", study_sql(FILLS_SQL, PERSIST_SQL, KM_SQL, views=("rx", "cohort")) + """
SELECT time, n_risk, n_event, n_censor, round(survival, 9) AS survival,
 CASE WHEN survival > 0 THEN round(survival * sqrt(v), 9) END AS std_err FROM curve""")
def km_survival_query(v: Views):
    return rounded(km_survival(persisted(v)), "survival", "std_err")


@query("km_quartiles", study_sql(FILLS_SQL, PERSIST_SQL, KM_SQL, views=("rx", "cohort")) + """
SELECT f AS fraction, CASE WHEN o IS NULL THEN b ELSE (o + b) / 2 END AS time FROM (SELECT f,
 (SELECT CAST(min(time) AS DOUBLE) FROM curve WHERE survival < 1 - f - 1e-9) AS b,
 (SELECT CAST(min(time) AS DOUBLE) FROM curve WHERE abs(survival - (1 - f)) <= 1e-9) AS o
 FROM (VALUES (CAST(0.25 AS DOUBLE)), (0.5), (0.75)) q(f))""")
def km_quartiles_query(v: Views):
    return km_quartiles(km_survival(persisted(v)))


@query("km_at_risk", study_sql(FILLS_SQL, PERSIST_SQL, views=("rx", "cohort")) + """
SELECT t AS tick, (SELECT count(*) FROM persist WHERE time >= t) AS n_risk FROM (VALUES (0), (50), (100), (150), (200), (250), (300)) k(t)""")
def km_at_risk_query(v: Views):
    return km_at_risk(persisted(v), range(0, 301, 50))


@query("outcomes_tp", study_sql(FILLS_SQL, ADHERENCE_SQL, PERSIST_SQL, views=("rx", "cohort")) + """
SELECT enrolid, round(pdc_df2, 9) AS pdc_df2, CAST(1 - disc_flag AS VARCHAR) AS persistence_flag, time FROM adhere JOIN persist USING (enrolid)""")
def outcomes_tp_query(v: Views):
    pattern = outcomes_tp(adherence(fills(v), v.cfg.outcome_days), persisted(v))
    return rounded(pattern, "pdc_df2")


# ---- analysis table ----
VARIABLE_COLUMNS = [
    "enrolid", "idxdate", "sex", "age", "plantyp", "region", "idxtreatment", "charlson_index",
    *[f"cc_grp_{i}" for i in range(1, 18)], "top_conditions", *ALL_COUNTS, *[f"with_{c}" for c in ALL_COUNTS], "pdc_df2", "persistence_flag", "time",
]

SHOWN = {"pdc_df2": "round(pdc_df2, 9) AS pdc_df2", "persistence_flag": "CAST(1 - disc_flag AS VARCHAR) AS persistence_flag"}
VARIABLES_SELECT = ", ".join(SHOWN.get(c, c) for c in VARIABLE_COLUMNS)


def near_claims(v: Views):
    """The claims of both windows with the fields that baseline and visits read, joined to the index dates and written once for both."""
    day = F.col("svcdate")
    reads = ["enrolid", "idxdate", "svcdate", "scope", "pdx", "dx1", "dx2", *CLAIM_COLUMNS]
    near = v.sddx.where(around_index(day, day, v.cfg, v.cfg.baseline_days, v.cfg.outcome_days)).select(*dict.fromkeys(reads))
    in_window = is_in_baseline(day, F.col("idxdate"), v.cfg.baseline_days) | is_in_outcome(day, F.col("idxdate"), v.cfg.outcome_days)
    return saved(near.where(in_window), "near-claims")


@query("variables", study_sql(
    FILLS_SQL, ADHERENCE_SQL, PERSIST_SQL, BASE_DX_SQL, PAIRS_SQL, BASELINE_SQL, HOSPITAL_SQL, VISITS_SQL, RU_SQL,
    views=("rx", "cohort", "sddx", "sdadm", "disease"),
) + f"""SELECT {VARIABLES_SELECT}
FROM cohort JOIN cci USING (enrolid) JOIN common USING (enrolid) JOIN ru USING (enrolid) JOIN adhere USING (enrolid) JOIN persist USING (enrolid)""")
def variables_query(v: Views):
    v = v.stored()
    filled = saved(fills(v), "fills")
    pattern = outcomes_tp(adherence(filled, v.cfg.outcome_days), persistence(filled, v.cfg.refill_gap, v.cfg.drug_followup_days))
    claims = near_claims(v)
    use = outcomes_ru(v.idx, hospital(v), visit_counts(visits(claims, v.disease, v.cfg)), v.cfg)
    table = variables(v.cohort, baseline(claims, v.disease, v.cfg), use, pattern)
    return rounded(with_top_list(table).select(*VARIABLE_COLUMNS), "pdc_df2")


# ---- descriptive statistics ----
ANALYSIS = (
    "CASE WHEN o_orderkey % 13 > 0 THEN c_mktsegment END AS grp", "o_totalprice AS cost", "CAST(o_custkey % 60 AS INT) AS age", "o_orderpriority AS priority",
    "CASE WHEN o_custkey % 11 = 0 THEN ' ' ELSE CAST(o_custkey % 5 AS STRING) END AS region",
    "CASE WHEN o_orderstatus = 'F' THEN '1' ELSE '0' END AS filled", "CASE WHEN c_acctbal < 0 THEN '1' ELSE '0' END AS debt",
    "CASE WHEN c_mktsegment = 'BUILDING' THEN 'own' ELSE 'other' END AS kind", "o_totalprice > 150000 AS large", "CAST(o_orderdate AS DATE) AS day",
)
ANALYSIS_SQL = f"WITH a AS (SELECT {', '.join(ANALYSIS)} FROM orders JOIN customer ON o_custkey = c_custkey)"
BOTH_SQL = ANALYSIS_SQL + ",\nb AS (SELECT * FROM a UNION ALL SELECT * REPLACE ('All' AS grp) FROM a)"


def analysis(v: Views):
    joined = v.table("orders").join(v.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.selectExpr(*ANALYSIS)


def stat_n_sql(source: str, columns: list[str]) -> str:
    value = {"day": "day - DATE '1970-01-01'"}
    long = " UNION ALL ".join(f"SELECT grp, '{c}' AS varname, CAST({value.get(c, c)} AS DOUBLE) AS x FROM {source} WHERE grp IS NOT NULL" for c in columns)
    at = "CASE WHEN n % {d} = 0 AND (n * {m}) % {d} = 0 THEN (s[CAST(n * {m} // {d} AS INT)] + s[CAST(n * {m} // {d} + 1 AS INT)]) / 2 ELSE s[CAST(n * {m} // {d} + 1 AS INT)] END"
    at = at.replace("n % {d} = 0 AND ", "")
    q1, md, q3 = at.format(m=1, d=4), at.format(m=1, d=2), at.format(m=3, d=4)
    return f"""SELECT varname, grp AS "group", 'Overall' AS varlvl, stat, round(value, 6) AS value FROM (
 SELECT grp, varname, unnest(['Mean', 'Median', 'Std', 'Q1', 'Q3']) AS stat, unnest([m, {md}, sd, {q1}, {q3}]) AS value FROM (
  SELECT grp, varname, list_sort(list(x)) AS s, count(*) AS n, avg(x) AS m, stddev_samp(x) AS sd FROM ({long}) GROUP BY ALL))"""


def stat_c_sql(source: str, columns: list[str]) -> str:
    long = " UNION ALL ".join(
        f"SELECT grp, '{c}' AS varname, CAST({c} AS VARCHAR) AS lvl FROM {source} WHERE trim({c}) <> '' AND grp IS NOT NULL" for c in columns
    )
    return f"""SELECT varname, grp AS "group", lvl AS varlvl, unnest(['N', 'Perc']) AS stat, unnest([n, round(perc, 6)]) AS value FROM (
 WITH l AS ({long}), g AS (SELECT DISTINCT varname, grp FROM l), k AS (SELECT DISTINCT varname, lvl FROM l)
 SELECT varname, grp, lvl, CAST(n AS DOUBLE) AS n, 100.0 * n / b AS perc FROM (SELECT g.varname, g.grp, k.lvl,
   (SELECT count(*) FROM l WHERE l.varname = g.varname AND l.grp = g.grp AND l.lvl = k.lvl) AS n,
   (SELECT count(*) FROM l WHERE l.varname = g.varname AND l.grp = g.grp) AS b FROM g JOIN k USING (varname))
 UNION ALL SELECT varname, 'Overall', lvl, CAST(count(*) AS DOUBLE), NULL FROM l WHERE grp <> 'All' GROUP BY ALL)"""


def stat_d_sql(source: str, columns: list[str]) -> str:
    long = " UNION ALL ".join(f"SELECT grp, '{c}' AS varname, CAST({c} AS VARCHAR) AS f FROM {source}" for c in columns)
    counts = "count(*) FILTER (WHERE f IN ('1', 'true')) AS n1, count(*) AS n"
    return f"""SELECT varname, grp AS "group", 'Overall' AS varlvl, unnest(['N', 'Perc']) AS stat, unnest([CAST(n1 AS DOUBLE), round(n1 / n, 6)]) AS value FROM (
 SELECT varname, grp, {counts} FROM ({long}) WHERE grp IS NOT NULL GROUP BY ALL
 UNION ALL SELECT varname, 'Overall', {counts} FROM ({long}) WHERE grp IS DISTINCT FROM 'All' GROUP BY ALL)"""


@query("desc_stat_n", ANALYSIS_SQL + stat_n_sql("a", ["cost", "age"]))
def desc_stat_n_query(v: Views):
    return rounded(desc_stat_n(analysis(v), ["cost", "age"], "grp"), "value", places=6)


@query("desc_stat_c", ANALYSIS_SQL + stat_c_sql("a", ["priority", "region", "kind"]))
def desc_stat_c_query(v: Views):
    return rounded(desc_stat_c(analysis(v), ["priority", "region", "kind"], "grp"), "value", places=6)


@query("desc_stat_d", ANALYSIS_SQL + stat_d_sql("a", ["filled", "debt", "large"]))
def desc_stat_d_query(v: Views):
    return rounded(desc_stat_d(analysis(v), ["filled", "debt", "large"], "grp"), "value", places=6)


@query("descriptive_stats", BOTH_SQL + f"""SELECT * FROM ({stat_n_sql('b', ['cost', 'age', 'day'])})
UNION ALL SELECT * FROM ({stat_c_sql('b', ['priority', 'region', 'kind'])})
UNION ALL SELECT * FROM ({stat_d_sql('b', ['filled', 'debt', 'large'])})""")
def descriptive_stats_query(v: Views):
    stats = descriptive_stats(analysis(v), ["priority", "region", "kind"], [], "grp", "All")
    return rounded(stats, "value", places=6)


@query("summary_rollup", ANALYSIS_SQL + """
SELECT 'cost' AS varname, coalesce(grp, 'Overall') AS "group", 'Overall' AS varlvl, unnest(['N', 'MIN', 'MAX', 'MEAN', 'STD']) AS stat,
 unnest([round(n, 6), round(lo, 6), round(hi, 6), round(m, 6), round(sd, 6)]) AS value
FROM (SELECT grp, CAST(count(cost) AS DOUBLE) AS n, min(cost) AS lo, max(cost) AS hi, avg(cost) AS m, stddev_samp(cost) AS sd FROM a WHERE grp IS NOT NULL GROUP BY ROLLUP (grp))""")
def summary_rollup_query(v: Views):
    return rounded(summary_rollup(analysis(v), "cost", "grp"), "value", places=6)


@query("freq_sparse", with_views("claims") + """
SELECT g.stdsvc AS svc, l.revcode, (SELECT count(*) FROM claims c WHERE c.stdsvc IS NOT DISTINCT FROM g.stdsvc AND c.revcode = l.revcode) AS count
FROM (SELECT DISTINCT stdsvc FROM claims) g CROSS JOIN (SELECT DISTINCT revcode FROM claims) l""")
def freq_sparse_query(v: Views):
    return freq_sparse(v.claims.withColumnRenamed("stdsvc", "svc"), "svc", "revcode")


# ---- eligibility and the whole study ----
@query("age_filter", with_views("cohort") + "SELECT enrolid, age, idxtreatment FROM cohort WHERE age >= 18")
def age_filter_query(v: Views):
    return age_filter(v.cohort, v.cfg).select("enrolid", "age", "idxtreatment")


@query("continuous_enrollment", study_sql("""days AS (SELECT enrolid, dtstart, max(dtend) AS dtend FROM spells GROUP BY ALL),
sn AS (SELECT *, row_number() OVER (PARTITION BY enrolid ORDER BY dtstart) AS k FROM days),
walk AS (SELECT enrolid, k, dtstart AS b, dtend AS e FROM sn WHERE k = 1 UNION ALL
 SELECT n.enrolid, n.k, CASE WHEN n.dtstart - w.e - 1 > 45 THEN n.dtstart ELSE w.b END,
  CASE WHEN n.dtstart - w.e - 1 > 45 THEN n.dtend ELSE greatest(w.e, n.dtend) END FROM walk w JOIN sn n ON n.enrolid = w.enrolid AND n.k = w.k + 1)""",
    views=("spells", "cohort")) + """SELECT enrolid, idxdate, idxtreatment FROM cohort c WHERE EXISTS (SELECT 1 FROM walk w
 WHERE w.enrolid = c.enrolid AND w.b <= c.idxdate - 365 AND w.e >= c.idxdate + 364)""")
def continuous_enrollment_query(v: Views):
    return continuous_enrollment(v.cohort, v.spells, v.cfg).select("enrolid", "idxdate", "idxtreatment")


@query("study_tables", with_views("sddx", "sdadm", "idx") + """
SELECT 'sddm' AS name, enrolid, idxdate, count(*) AS n FROM idx GROUP BY ALL UNION ALL
SELECT 'sddx', enrolid, idxdate, count(*) FROM sddx GROUP BY ALL UNION ALL
SELECT 'sdadm', enrolid, idxdate, count(*) FROM sdadm GROUP BY ALL""")
def study_tables(v: Views):
    cohort = v.cohort
    tables = {
        "sddm": cohort.select("enrolid", "idxdate").distinct(),
        "sddx": study_claims(v.claims, cohort),
        "sdadm": study_claims(v.adm, cohort),
    }
    counted = [
        df.groupBy("enrolid", "idxdate").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "enrolid", "idxdate", "n")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


@query("study_pull", study_sql(EXPOSURE_SQL, ALLPT_SQL, views=("rx", "claims", "ndc", "hcpcs", "adm", "spells", "icd9")) + f"""
SELECT 'rds.interest_tx' AS name, enrolid, count(*) AS n FROM interest_tx GROUP BY ALL
UNION ALL SELECT 'rds.allpt', enrolid, count(*) FROM allpt GROUP BY ALL
UNION ALL SELECT 'rds.alldx', enrolid, count(*) FROM claims c JOIN (SELECT DISTINCT icd9 FROM icd9) i
 ON starts_with(c.pdx, i.icd9) OR starts_with(c.dx1, i.icd9) OR starts_with(c.dx2, i.icd9)
 WHERE svcdate {STUDY_DAYS} AND {OWN_SQL} AND enrolid IN (SELECT enrolid FROM allpt) GROUP BY ALL
UNION ALL SELECT 'rds.alladm', enrolid, count(*) FROM adm WHERE disdate >= DATE '1997-01-01' AND admdate <= DATE '1999-12-31'
 AND enrolid IN (SELECT enrolid FROM allpt) GROUP BY ALL
UNION ALL SELECT 'rds.allce', enrolid, count(*) FROM spells WHERE dtend >= DATE '1997-01-01' AND dtstart <= DATE '1999-12-31'
 AND enrolid IN (SELECT enrolid FROM allpt) GROUP BY ALL""")
def study_pull(v: Views):
    tables = pull_study(inputs(v), v.cfg, folder_saver(v.spark))
    counted = [
        df.groupBy("enrolid").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "enrolid", "n")
        for name, df in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counted)


STUDY_INPUTS_SQL = f"""cohort AS (SELECT * FROM allpt),
alldx AS (SELECT c.* FROM claims c JOIN (SELECT DISTINCT icd9 FROM icd9) i
 ON starts_with(c.pdx, i.icd9) OR starts_with(c.dx1, i.icd9) OR starts_with(c.dx2, i.icd9)
 WHERE svcdate {STUDY_DAYS} AND {OWN_SQL} AND enrolid IN (SELECT enrolid FROM allpt)),
idx AS (SELECT DISTINCT enrolid, idxdate FROM allpt),
sddx AS (SELECT c.*, i.idxdate FROM alldx c JOIN idx i USING (enrolid)),
sdadm AS (SELECT a.*, i.idxdate FROM adm a JOIN idx i USING (enrolid)
 WHERE disdate >= DATE '1997-01-01' AND admdate <= DATE '1999-12-31'),
disease AS (SELECT DISTINCT icd9 FROM icd9 WHERE ta = 'ASIA')"""
STUDY_FILLS_SQL = FILLS_SQL.replace("FROM rx r", "FROM interest_tx r")


@query("study_run", study_sql(
    EXPOSURE_SQL, ALLPT_SQL, STUDY_INPUTS_SQL, STUDY_FILLS_SQL, ADHERENCE_SQL, PERSIST_SQL, BASE_DX_SQL, PAIRS_SQL,
    BASELINE_SQL, HOSPITAL_SQL, VISITS_SQL, RU_SQL, views=("rx", "claims", "ndc", "hcpcs", "adm", "icd9"),
) + f"""SELECT {VARIABLES_SELECT}
FROM cohort JOIN cci USING (enrolid) JOIN common USING (enrolid) JOIN ru USING (enrolid) JOIN adhere USING (enrolid) JOIN persist USING (enrolid)""")
def study_run_query(v: Views):
    tables = study_run(v.spark, inputs(v), v.cfg, folder_saver(v.spark))
    return rounded(with_top_list(tables["ads.variables"]).select(*VARIABLE_COLUMNS), "pdc_df2")


@query("study_run_tables", study_sql(
    EXPOSURE_SQL, ALLPT_SQL, STUDY_INPUTS_SQL, STUDY_FILLS_SQL, ADHERENCE_SQL, PERSIST_SQL, BASE_DX_SQL, PAIRS_SQL,
    BASELINE_SQL, HOSPITAL_SQL, VISITS_SQL, RU_SQL, views=("rx", "claims", "ndc", "hcpcs", "adm", "icd9", "spells"),
) + """SELECT 'rds.interest_tx' AS name, count(*) AS n FROM interest_tx UNION ALL SELECT 'rds.allpt', count(*) FROM allpt
UNION ALL SELECT 'sds.sddm', count(*) FROM allpt UNION ALL SELECT 'rds.alldx', count(*) FROM alldx UNION ALL SELECT 'sds.sddx', count(*) FROM sddx
UNION ALL SELECT 'sds.sdadm', count(*) FROM sdadm UNION ALL SELECT 'sds.cohort_treatment', count(*) FROM fills
UNION ALL SELECT 'ads.baseline', count(*) FROM cci UNION ALL SELECT 'ads.outcomes_ru', count(*) FROM ru
UNION ALL SELECT 'ads.outcomes_tp', count(*) FROM adhere JOIN persist USING (enrolid)
UNION ALL SELECT 'ads.km', count(DISTINCT time) FROM persist UNION ALL SELECT 'ads.km_quartiles', 3 UNION ALL SELECT 'ads.km_at_risk', 7""")
def study_run_tables(v: Views):
    tables = study_run(v.spark, inputs(v), v.cfg, folder_saver(v.spark))
    listed = ["rds.interest_tx", "rds.allpt", "rds.alldx", "sds.sddm", "sds.sddx", "sds.sdadm", "sds.cohort_treatment", "ads.baseline",
              "ads.outcomes_ru", "ads.outcomes_tp", "ads.km", "ads.km_quartiles", "ads.km_at_risk"]
    counted = [tables[n].agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in listed]
    return reduce(lambda a, b: a.unionByName(b), counted)
