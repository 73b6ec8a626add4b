"""Queries over aggregates, ordered computation, sorting and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimtrail.operators.charlson import charlson
from claimtrail.operators.conditions import condition_frequency, patient_conditions, rank_labels_top_n
from claimtrail.operators.joins import lookup_join
from claimtrail.operators.ordered import first_last, row_number_global, top_n_with_ties
from claimtrail.operators.supply import dedupe_keep_max_supply, supply_mode
from claimtrail.operators.treatment import covered_days, est_refill_chain, persistence_chain, sum_same_day_supply
from claimtrail.operators.utilization import visit_counts
from claimtrail.plans.registry import query
from claimtrail.plans.stock_sql import covered_sql, ends_sql, stock_sql
from claimtrail.plans.views import Views, with_views

DAILY_SQL = "daily AS (SELECT enrolid, svcdate, CAST(sum(daysupp) AS INT) AS d FROM rx WHERE daysupp > 0 GROUP BY ALL)"


def daily(*parts: str) -> str:
    """The daily fills of ``rx`` and further CTEs on them."""
    return with_views("rx").rstrip() + ",\n" + ",\n".join([DAILY_SQL, *parts]) + "\n"


def positive_days(v: Views):
    return sum_same_day_supply(v.rx.where("daysupp > 0"), ["enrolid"])


@query("count_rows", with_views("rx") + "SELECT count(*) AS n FROM rx")
def count_rows(v: Views):
    return v.rx.agg(F.count(F.lit(1)).alias("n"))


@query("group_min", with_views("rx") + "SELECT enrolid, min(svcdate) AS first_day FROM rx GROUP BY 1")
def group_min(v: Views):
    return v.rx.groupBy("enrolid").agg(F.min("svcdate").alias("first_day"))


@query("group_count", with_views("rx") + "SELECT ndcnum, daysupp, count(*) AS freq FROM rx WHERE daysupp > 0 GROUP BY ALL")
def group_count(v: Views):
    return v.rx.where("daysupp > 0").groupBy("ndcnum", "daysupp").agg(F.count(F.lit(1)).alias("freq"))


@query("supply_mode", with_views("rx") + """
SELECT ndcnum, daysupp AS mode_supply FROM (SELECT ndcnum, daysupp, row_number() OVER (PARTITION BY ndcnum ORDER BY freq DESC, daysupp) AS k
 FROM (SELECT ndcnum, daysupp, count(*) AS freq FROM rx WHERE daysupp > 0 GROUP BY ALL)) WHERE k = 1""")
def supply_mode_query(v: Views):
    return supply_mode(v.rx)


VISITS_SQL = """SELECT enrolid, svcdate, kind, mod(dayofmonth(svcdate), 2) = 0 AS disease_flag FROM visits_days"""


@query("unique_date_visits", with_views("visits_days", typed=VISITS_SQL) + """
SELECT enrolid, nullif(count(DISTINCT CASE WHEN kind = 'view' THEN svcdate END), 0) AS all_er,
 nullif(count(DISTINCT CASE WHEN kind = 'click' THEN svcdate END), 0) AS all_office,
 nullif(count(DISTINCT CASE WHEN kind = 'purchase' THEN svcdate END), 0) AS all_others,
 nullif(count(DISTINCT CASE WHEN kind = 'view' AND disease_flag THEN svcdate END), 0) AS dis_er,
 nullif(count(DISTINCT CASE WHEN kind = 'click' AND disease_flag THEN svcdate END), 0) AS dis_office,
 nullif(count(DISTINCT CASE WHEN kind = 'purchase' AND disease_flag THEN svcdate END), 0) AS dis_others
FROM typed WHERE kind IN ('view', 'click', 'purchase') GROUP BY 1""")
def unique_date_visits(v: Views):
    kind = (
        F.when(F.col("kind") == "view", "ER").when(F.col("kind") == "click", "Office").when(F.col("kind") == "purchase", "Others")
    )
    typed = v.visits_days.withColumn("visit_type", kind).withColumn("disease_flag", F.dayofmonth("svcdate") % 2 == 0)
    return visit_counts(typed)


@query("sum_same_day_supply", with_views("rx", "idx") + """
SELECT r.enrolid, i.idxdate, r.svcdate, CAST(sum(r.daysupp) AS BIGINT) AS daysupp FROM rx r JOIN idx i ON r.enrolid = i.enrolid
WHERE r.daysupp > 0 GROUP BY ALL""")
def sum_same_day(v: Views):
    return sum_same_day_supply(lookup_join(v.rx.where("daysupp > 0"), v.idx, ["enrolid"]), ["enrolid", "idxdate"])


@query("conditional_counts", with_views("claims") + """
SELECT scope, count(*) AS n, count(*) FILTER (WHERE proctyp = '1') AS ones, count(*) FILTER (WHERE proctyp = '1') / count(*) AS share
FROM claims GROUP BY 1""")
def conditional_counts(v: Views):
    return v.claims.groupBy("scope").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("proctyp") == "1").alias("ones"),
        (F.count_if(F.col("proctyp") == "1") / F.count(F.lit(1))).alias("share"),
    )


@query("top_n_with_ties", with_views("claims") + """
SELECT head, freq FROM (SELECT substr(dx1, 1, 3) AS head, count(*) AS freq FROM claims GROUP BY 1)
WHERE freq >= (SELECT min(freq) FROM (SELECT count(*) AS freq FROM claims GROUP BY substr(dx1, 1, 3) ORDER BY freq DESC LIMIT 10))""")
def top_n(v: Views):
    freq = v.claims.groupBy(F.substring("dx1", 1, 3).alias("head")).agg(F.count(F.lit(1)).alias("freq"))
    return top_n_with_ties(freq, 10, "freq")


@query("dedupe_keep_max_supply", with_views("rx") + """
SELECT enrolid, svcdate, ndcnum, daysupp, generic_name FROM rx
QUALIFY row_number() OVER (PARTITION BY enrolid, svcdate, ndcnum ORDER BY daysupp DESC NULLS LAST, generic_name) = 1""")
def dedupe(v: Views):
    return dedupe_keep_max_supply(v.rx, ["enrolid", "svcdate", "ndcnum"], "daysupp", ["generic_name"])


@query("first_last", with_views("rx") + """
SELECT enrolid, arg_min(daysupp, (svcdate, daysupp)) AS first_daysupp, min(svcdate) AS first_svcdate,
 arg_max(daysupp, (svcdate, daysupp)) AS last_daysupp, max(svcdate) AS last_svcdate FROM rx GROUP BY 1""")
def first_last_query(v: Views):
    return first_last(v.rx, ["enrolid"], ["svcdate", "daysupp"], ["daysupp", "svcdate"])


@query("row_number_global", with_views("rx") + """
SELECT ndcnum, daysupp, freq, CAST(row_number() OVER (ORDER BY ndcnum, freq DESC, daysupp) AS INT) AS row_num
FROM (SELECT ndcnum, daysupp, count(*) AS freq FROM rx WHERE daysupp > 0 GROUP BY ALL)""")
def row_number_query(v: Views):
    freq = v.rx.where("daysupp > 0").groupBy("ndcnum", "daysupp").agg(F.count(F.lit(1)).alias("freq"))
    return row_number_global(freq, [F.asc("ndcnum"), F.desc("freq"), F.asc("daysupp")])


@query("est_refill_chain", daily(stock_sql("daily", "stock")) + """
SELECT enrolid, day AS svcdate, day + held AS est_start, CAST(sum(got) OVER (PARTITION BY enrolid ORDER BY day) AS BIGINT) AS total
FROM stock WHERE got > 0""")
def est_refill_query(v: Views):
    chain = est_refill_chain(positive_days(v), ["enrolid"])
    return chain.select(
        "enrolid", "svcdate", F.date_from_unix_date(F.col("est_start").cast("int")).alias("est_start"),
        (F.col("supply_before") + F.col("daysupp")).alias("total"),
    )


@query("covered_days", daily(covered_sql("daily", "cover", "DATE '1999-12-31'")) + "SELECT enrolid, covered FROM cover")
def covered_days_query(v: Views):
    covered = covered_days(positive_days(v), ["enrolid"], F.to_date(F.lit("1999-12-31")))
    return covered.groupBy("enrolid").agg(F.sum("covered").cast("bigint").alias("covered"))


@query("persistence_chain", daily(stock_sql("daily", "stock"), ends_sql("stock", "ends")) + "SELECT enrolid, supply_end, stopped FROM ends")
def persistence_chain_query(v: Views):
    chain = persistence_chain(positive_days(v), ["enrolid"], 60)
    ended = chain.groupBy("enrolid").agg(
        F.max(F.when(~F.col("stopped"), F.col("supply_end"))).alias("_end"), F.max("stopped").alias("stopped")
    )
    return ended.select("enrolid", F.date_from_unix_date(F.col("_end").cast("int")).alias("supply_end"), "stopped")


TOP_SQL = """freq AS (SELECT icd9_3, count(*) AS freq FROM (SELECT enrolid, substr(dx1, 1, 3) AS icd9_3 FROM claims
 UNION SELECT enrolid, substr(dx2, 1, 3) FROM claims) p WHERE icd9_3 IS NOT NULL
 AND icd9_3 NOT IN (SELECT substr(icd9, 1, 3) FROM disease) GROUP BY 1)"""


@query("rank_labels_top_n", with_views("claims", "disease").rstrip() + ",\n" + TOP_SQL + """
SELECT icd9_3, freq, 'ICD93d_Top_' || CAST(row_number() OVER (ORDER BY freq DESC, icd9_3) AS VARCHAR) AS icd9_3_rank FROM freq
QUALIFY rank() OVER (ORDER BY freq DESC) <= 10""")
def rank_labels(v: Views):
    frequency = condition_frequency(patient_conditions(v.claims), v.disease)
    return rank_labels_top_n(frequency, 10).drop("position")


@query("retain_flags", with_views("visits_days") + """
SELECT enrolid, CASE WHEN bool_or(kind = 'error') THEN '1' ELSE '0' END AS any_error,
 CASE WHEN bool_or(kind = 'purchase') THEN '1' ELSE '0' END AS any_purchase FROM visits_days GROUP BY 1""")
def retain_flags(v: Views):
    return v.visits_days.groupBy("enrolid").agg(
        F.max(F.when(F.col("kind") == "error", "1").otherwise("0")).alias("any_error"),
        F.max(F.when(F.col("kind") == "purchase", "1").otherwise("0")).alias("any_purchase"),
    )


@query("sort", with_views("rx") + "SELECT enrolid, svcdate, ndcnum, daysupp FROM rx ORDER BY enrolid, svcdate, ndcnum, daysupp DESC")
def sort(v: Views):
    return v.rx.select("enrolid", "svcdate", "ndcnum", "daysupp").orderBy("enrolid", "svcdate", "ndcnum", F.desc("daysupp"))


@query("limit", with_views("rx") + """
SELECT enrolid, svcdate, ndcnum, daysupp FROM rx ORDER BY daysupp DESC, enrolid, svcdate, ndcnum LIMIT 25""")
def limit(v: Views):
    fills = v.rx.select("enrolid", "svcdate", "ndcnum", "daysupp")
    return fills.orderBy(F.desc("daysupp"), "enrolid", "svcdate", "ndcnum").limit(25)


# ---- fixed values: the comorbidity rules once more, written out for the checking SQL ----
# fixed values: weight and ICD-9 codes of each group
CHARLSON_RULES = {
    1: (1, "left(c, 3) IN ('410', '412')"),
    2: (1, "left(c, 4) BETWEEN '4254' AND '4259' OR left(c, 5) IN ('39891', '40201', '40211', '40291', '40401', '40403', '40411', '40413', '40491', '40493') OR left(c, 3) IN ('428')"),
    3: (1, "left(c, 4) BETWEEN '4431' AND '4439' OR left(c, 4) IN ('0930', '4373', '4471', '5571', '5579', 'V434') OR left(c, 3) IN ('440', '441')"),
    4: (1, "left(c, 3) BETWEEN '430' AND '438' OR left(c, 5) IN ('36234')"),
    5: (1, "left(c, 4) IN ('2941', '3312') OR left(c, 3) IN ('290')"),
    6: (1, "left(c, 3) BETWEEN '490' AND '505' OR left(c, 4) IN ('4168', '4169', '5064', '5081', '5088')"),
    7: (1, "left(c, 4) BETWEEN '7100' AND '7104' OR left(c, 4) BETWEEN '7140' AND '7142' OR left(c, 4) IN ('4465', '7148') OR left(c, 3) IN ('725')"),
    8: (1, "left(c, 3) BETWEEN '531' AND '534'"),
    9: (1, "left(c, 5) IN ('07022', '07023', '07032', '07033', '07044', '07054') OR left(c, 4) IN ('0706', '0709', '5733', '5734', '5738', '5739', 'V427') OR left(c, 3) IN ('570', '571')"),
    10: (1, "left(c, 4) BETWEEN '2500' AND '2503' OR left(c, 4) IN ('2508', '2509')"),
    11: (2, "left(c, 4) BETWEEN '2504' AND '2507'"),
    12: (2, "left(c, 4) BETWEEN '3440' AND '3446' OR left(c, 4) IN ('3341', '3449') OR left(c, 3) IN ('342', '343')"),
    13: (2, "left(c, 4) BETWEEN '5830' AND '5837' OR left(c, 5) IN ('40301', '40311', '40391', '40402', '40403', '40412', '40413', '40492', '40493') OR left(c, 4) IN ('5880', 'V420', 'V451') OR left(c, 3) IN ('582', '585', '586', 'V56')"),
    14: (2, "left(c, 4) BETWEEN '1740' AND '1958' OR left(c, 3) BETWEEN '140' AND '172' OR left(c, 3) BETWEEN '200' AND '208' OR left(c, 4) IN ('2386')"),
    15: (3, "left(c, 4) BETWEEN '4560' AND '4562' OR left(c, 4) BETWEEN '5722' AND '5728'"),
    16: (6, "left(c, 3) BETWEEN '196' AND '199'"),
    17: (6, "left(c, 3) BETWEEN '042' AND '044'"),
}


def charlson_sql(source: str, dx_cols: list[str], char_flags: bool = True) -> str:
    """The index as one CASE per group over the unpivoted codes."""
    codes = " UNION ALL ".join(f"SELECT enrolid, upper(ltrim({d})) AS c FROM {source}" for d in dx_cols)
    flags = ", ".join(f"max(CASE WHEN {rule} THEN 1 ELSE 0 END) AS g{n}" for n, (_, rule) in CHARLSON_RULES.items())
    kind = "VARCHAR" if char_flags else "INT"
    shown = ", ".join(f"CAST(g{n} AS {kind}) AS cc_grp_{n}" for n in CHARLSON_RULES)
    index = " + ".join(f"g{n} * {weight}" for n, (weight, _) in CHARLSON_RULES.items())
    return f"SELECT enrolid, {shown}, CAST({index} AS INT) AS charlson_index FROM (SELECT enrolid, {flags} FROM ({codes}) GROUP BY 1)"


@query("group_max_flags", with_views("claims") + charlson_sql("claims", ["dx1", "dx2"], False))
def group_max_flags(v: Views):
    return charlson(v.claims, char_flags=False)
