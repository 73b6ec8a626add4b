"""Queries over scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimtrail.functions.codes import clean_icd9, ndc_11
from claimtrail.plans.queries_sources import ICD9_SHEET, NDC_SHEET, _sheet
from claimtrail.plans.registry import query
from claimtrail.plans.views import Views, with_views
from claimtrail.sources.tables import classify_variables, dates_to_day_numbers, list_columns, normalize


@query("clean_icd9", f"WITH i AS ({ICD9_SHEET}) SELECT row_no, icd9, regexp_replace(icd9, '[x.]', '', 'g') AS cleaned FROM i")
def clean_icd9_query(v: Views):
    return _sheet(v, ICD9_SHEET).select("row_no", "icd9", clean_icd9(F.col("icd9")).alias("cleaned"))


@query("ndc_11", f"""WITH n AS (SELECT row_no, ndc, string_split(ndc, '-') AS p FROM ({NDC_SHEET}))
SELECT row_no, ndc, CASE WHEN len(p) = 3 THEN repeat('0', greatest(0, 5 - length(p[1]))) || p[1]
  || repeat('0', greatest(0, 4 - length(p[2]))) || p[2] || repeat('0', greatest(0, 2 - length(p[3]))) || p[3]
 ELSE repeat('0', greatest(0, 11 - length(replace(ndc, '-', '')))) || replace(ndc, '-', '') END AS ndc11 FROM n""")
def ndc_11_query(v: Views):
    return _sheet(v, NDC_SHEET).select("row_no", "ndc", ndc_11(F.col("ndc")).alias("ndc11"))


@query("lower_names", "SELECT s_suppkey, s_acctbal FROM supplier")
def lower_names(v: Views):
    suppliers = v.table("supplier").select("s_suppkey", "s_acctbal")
    return normalize(suppliers.toDF("S_SuppKey", "S_ACCTBAL"))


@query("string_functions", """
SELECT p_partkey, strpos(p_name, 'i') AS at, left(p_name, 3) AS head, upper(trim(p_type)) AS shout, length(p_brand) AS size,
 p_brand || '/' || p_type AS joined, p_brand LIKE 'Brand#1%' AS starts FROM part""")
def string_functions(v: Views):
    return v.table("part").select(
        "p_partkey",
        F.instr("p_name", "i").cast("long").alias("at"),
        F.substring("p_name", 1, 3).alias("head"),
        F.upper(F.trim("p_type")).alias("shout"),
        F.length("p_brand").cast("long").alias("size"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.col("p_brand").startswith("Brand#1").alias("starts"),
    )


@query("scan_countw", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, string_split(p_name, ' ')[2] AS second_word,
 len(string_split(p_name, ' ')) AS words FROM part""")
def scan_countw(v: Views):
    words = F.split("p_name", " ")
    return v.table("part").select(
        "p_partkey",
        words.getItem(0).alias("first_word"),
        F.get(words, 1).alias("second_word"),
        F.size(words).cast("long").alias("words"),
    )


@query("ifn_ifc_coalesce", with_views("claims") + """
SELECT stdplac, dx2 IS NULL AS no_dx2, CASE WHEN stdplac > 22 THEN 'late' ELSE 'early' END AS part,
 coalesce(dx2, dx1, 'none') AS dx, count(*) AS n FROM claims GROUP BY ALL""")
def ifn_ifc_coalesce(v: Views):
    shown = v.claims.select(
        "stdplac",
        F.col("dx2").isNull().alias("no_dx2"),
        F.when(F.col("stdplac") > 22, "late").otherwise("early").alias("part"),
        F.coalesce("dx2", "dx1", F.lit("none")).alias("dx"),
    )
    return shown.groupBy(*shown.columns).agg(F.count(F.lit(1)).alias("n"))


@query("put_input", with_views("claims") + """
SELECT pdx, CAST(pdx AS INT) AS pdx_number, CAST(procgrp AS VARCHAR) AS procgrp_text, count(*) AS n FROM claims GROUP BY ALL""")
def put_input(v: Views):
    shown = v.claims.select(
        "pdx", F.col("pdx").cast("int").alias("pdx_number"), F.col("procgrp").cast("string").alias("procgrp_text")
    )
    return shown.groupBy(*shown.columns).agg(F.count(F.lit(1)).alias("n"))


@query("date_arithmetic", with_views("spells") + """
SELECT dtstart, dtend, dtend - dtstart AS days, CAST(dtstart + 364 AS DATE) AS year_on, count(*) AS n FROM spells GROUP BY ALL""")
def date_arithmetic(v: Views):
    shown = v.spells.select(
        "dtstart", "dtend",
        F.datediff("dtend", "dtstart").cast("long").alias("days"),
        F.date_add("dtstart", 364).alias("year_on"),
    )
    return shown.groupBy(*shown.columns).agg(F.count(F.lit(1)).alias("n"))


@query("days_since_1960", "SELECT event_id, date_diff('day', DATE '1960-01-01', CAST(ts AS DATE)) AS days FROM events")
def days_since_1960_query(v: Views):
    numbered = dates_to_day_numbers(v.table("events").select("event_id", "ts"))
    return numbered.select("event_id", F.col("ts").cast("long").alias("days"))


@query("row_min_max_sum", with_views("claims") + """
SELECT stdplac, stdsvc, procgrp, least(stdplac, stdsvc, procgrp) AS low, greatest(stdplac, stdsvc, procgrp) AS high,
 coalesce(stdplac, 0) + coalesce(stdsvc, 0) + coalesce(procgrp, 0) AS total, count(*) AS n FROM claims GROUP BY ALL""")
def row_min_max_sum(v: Views):
    columns = ["stdplac", "stdsvc", "procgrp"]
    total = sum((F.coalesce(c, F.lit(0)) for c in columns), F.lit(0))
    shown = v.claims.select(*columns, F.least(*columns).alias("low"), F.greatest(*columns).alias("high"), total.alias("total"))
    return shown.groupBy(*shown.columns).agg(F.count(F.lit(1)).alias("n"))


@query("calculated_alias", with_views("rx") + """
SELECT enrolid, svcdate, CASE WHEN daysupp <= 0 THEN 30 ELSE daysupp END AS supply,
 CASE WHEN daysupp <= 0 THEN 30 ELSE daysupp END > 30 AS long_supply FROM rx""")
def calculated_alias(v: Views):
    return v.spark.sql(
        "SELECT enrolid, svcdate, CASE WHEN daysupp <= 0 THEN 30 ELSE daysupp END AS supply, supply > 30 AS long_supply FROM {rx}",
        rx=v.rx,
    )


@query("string_range", with_views("claims") + """
SELECT left(dx1, 4) AS icd4, count(*) AS n FROM claims WHERE left(dx1, 4) >= '4254' AND left(dx1, 4) <= '4399' GROUP BY 1""")
def string_range(v: Views):
    heads = v.claims.select(F.substring("dx1", 1, 4).alias("icd4"))
    return heads.where(F.col("icd4").between("4254", "4399")).groupBy("icd4").agg(F.count(F.lit(1)).alias("n"))


@query("classify_variables", """SELECT 'continuous' AS kind, 'c_acctbal' AS varname, count(c_acctbal) AS n FROM customer
UNION ALL SELECT 'categorical', 'c_nationkey', count(c_nationkey) FROM customer
UNION ALL SELECT 'categorical', 'c_mktsegment', count(c_mktsegment) FROM customer
UNION ALL SELECT 'dichotomous', 'c_name', count(c_name) FROM customer""")
def classify_variables_query(v: Views):
    customers = v.table("customer")
    kinds = classify_variables(customers, ["C_NATIONKEY", "C_MKTSEGMENT"], ["c_custkey"])
    pairs = [(kind, name) for kind, names in kinds.items() for name in names]
    counted = customers.agg(*[F.count(name).alias(name) for _, name in pairs])
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("varname"), F.col(n).alias("n")) for k, n in pairs])
    return counted.select(F.inline(rows))


@query("list_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i} AS place, count({c}) AS filled FROM orders"
    for i, c in enumerate(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])))
def list_columns_query(v: Views):
    orders = v.table("orders")
    names = list_columns(orders)
    counted = orders.agg(*[F.count(name).alias(name) for name in names])
    rows = F.array(*[
        F.struct(F.lit(n).alias("column_name"), F.lit(i).alias("place"), F.col(n).alias("filled")) for i, n in enumerate(names)
    ])
    return counted.select(F.inline(rows))
