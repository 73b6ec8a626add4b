"""Queries over reading, writing, shards and code lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from claimtrail.operators.ordered import forward_fill
from claimtrail.operators.reshape import outer_union
from claimtrail.operators.scan import code_list_df
from claimtrail.plans.registry import query
from claimtrail.plans.views import TABLES, Views, with_views
from claimtrail.sources.code_lists import codes_of, load_code_lists
from claimtrail.sources.scratch import scratch_path
from claimtrail.sources.shards import select_shards, union_columns
from claimtrail.sources.tables import create_libraries, drop_libraries, ingest_library, ingest_table, list_tables, materialize, write_folder


def library(v: Views, name: str) -> str:
    """An empty library of a query's own name; what the query wrote before is removed."""
    drop_libraries(v.spark, [name])
    create_libraries(v.spark, [name], scratch_path(v.spark, "library"))
    return name


def row_counts(v: Views, home: str, names):
    counts = [v.spark.table(f"{home}.{t}").agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for t in names]
    return reduce(outer_union, counts)


@query("ingest_table", "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders")
def ingest_table_query(v: Views):
    home = library(v, "q_ingest_table")
    ingest_table(v.spark, v.path("orders"), f"{home}.orders", date_cols=["o_orderdate"])
    return v.spark.table(f"{home}.orders")


@query("ingest_library", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES))
def ingest_library_query(v: Views):
    home = library(v, "q_ingest_library")
    return row_counts(v, home, ingest_library(v.spark, {t: v.path(t) for t in TABLES}, home))


@query("list_tables", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("nation", "orders", "region")))
def list_tables_query(v: Views):
    home = library(v, "q_list_tables")
    ingest_library(v.spark, {t: v.path(t) for t in ("orders", "nation", "region")}, home)
    return row_counts(v, home, list_tables(v.spark, home))


@query("libraries", "SELECT 'q_raw' AS library, 'events' AS table_name, count(*) AS n_rows FROM events UNION ALL SELECT 'q_scd', 'part', count(*) FROM part")
def libraries_query(v: Views):
    parts = []
    for home, table in (("q_raw", "events"), ("q_scd", "part")):
        create_libraries(v.spark, [library(v, home)])  # an existing library stays
        ingest_library(v.spark, {table: v.path(table)}, home)
        parts.append(row_counts(v, home, list_tables(v.spark, home)).withColumn("library", F.lit(home)))
    return reduce(outer_union, parts)


CHUNKS = 4


@query("chunked_append", "SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem")
def chunked_append(v: Views):
    """Chunks by a hash of the row, so that every row is in one of them, appended one after another."""
    lines = v.table("lineitem")
    home = library(v, "q_chunked_append")
    for chunk in range(CHUNKS):
        path = scratch_path(v.spark, "chunk")
        write_folder(lines.where(F.pmod(F.xxhash64(*lines.columns), F.lit(CHUNKS)) == chunk), path)
        ingest_table(v.spark, path, f"{home}.lines", if_exists="append", date_cols=["l_shipdate"])
    return v.spark.table(f"{home}.lines")


@query("materialize", with_views("rx") + """
SELECT enrolid, svcdate, count(*) AS n FROM rx GROUP BY ALL""")
def materialize_query(v: Views):
    home = library(v, "q_materialize")
    materialize(v.rx.groupBy("enrolid", "svcdate").agg(F.count(F.lit(1)).alias("n")), f"{home}.days", "fail")
    return v.spark.table(f"{home}.days")


@query("select_shards", with_views("claims") + """
SELECT source, scope, CASE WHEN enrolid % 7 > 0 THEN year END AS year, count(*) AS n FROM claims
WHERE source IN ('ccae') AND scope IN ('s', 'o') AND (year IN (2009, 2010, 2011) OR enrolid % 7 = 0) GROUP BY ALL""")
def select_shards_query(v: Views):
    path = scratch_path(v.spark, "shards")
    shard = ["source", "scope", "year"]
    year = F.when(F.col("enrolid") % 7 > 0, F.col("year"))  # some claims have none
    write_folder(v.claims.select("enrolid", *shard).withColumn("year", year), path, partition_by=shard)
    kept = select_shards(v.spark.read.parquet(path), ["ccae"], ["s", "o"], [2009, 2010, 2011])
    return kept.groupBy(*shard).agg(F.count(F.lit(1)).alias("n")).withColumn("year", F.col("year").cast("int"))


@query("union_columns", with_views("claims") + """
SELECT 'ccaeo101' AS tb_name, enrolid, svcdate, dx1, NULL AS pdx, procgrp, lpad(CAST(enrolid AS VARCHAR), 11, '0') AS ndcnum,
 CAST(enrolid % 500 AS VARCHAR) AS revcode, CAST(enrolid AS DOUBLE) AS pay, count(*) AS n FROM claims WHERE scope = 'o' GROUP BY ALL
UNION ALL SELECT 'ccaes101', enrolid, svcdate, dx1, pdx, NULL, 'N' || CAST(enrolid AS VARCHAR), CAST(enrolid % 500 + 0.5 AS VARCHAR), enrolid + 0.25, count(*)
 FROM claims WHERE scope = 's' GROUP BY ALL""")
def union_columns_query(v: Views):
    """Shards that differ in names, columns and types: a code as number and as text, a whole and a broken number, an int and a double."""
    patient = F.col("enrolid").cast("int")
    outpatient = v.claims.where("scope = 'o'").select(
        "enrolid", "svcdate", "dx1", F.col("procgrp").alias("PROCGRP"), patient.alias("ndcnum"), (patient % 500).cast("double").alias("revcode"), patient.alias("pay")
    )
    inpatient = v.claims.where("scope = 's'").select(
        F.col("enrolid").alias("ENROLID"), "pdx", "dx1", F.col("svcdate").alias("SvcDate"), F.concat(F.lit("N"), "enrolid").alias("NDCNUM"),
        (patient % 500 + F.lit(0.5)).cast("decimal(5,1)").cast("string").alias("revcode"), (patient + F.lit(0.25)).cast("double").alias("pay"),
    )
    both = union_columns({"ccaeo101": outpatient, "ccaes101": inpatient}, {"ndcnum": 11})
    return both.groupBy("tb_name", "enrolid", "svcdate", "dx1", "pdx", "procgrp", "ndcnum", "revcode", "pay").agg(F.count(F.lit(1)).alias("n"))


NDC_SHEET = """SELECT p_partkey AS row_no, p_type AS generic_name, CASE p_partkey % 3
 WHEN 0 THEN CAST(1000 + p_partkey % 9000 AS STRING) || '-' || CAST(p_size AS STRING) || '-' || CAST(p_partkey % 10 AS STRING)
 WHEN 1 THEN CAST(p_partkey AS STRING) || '-' || CAST(p_size AS STRING)
 ELSE CAST(p_partkey AS STRING) END AS ndc FROM part"""
HCPCS_SHEET = "SELECT p_partkey AS row_no, p_type AS generic_name, CASE WHEN p_size = 1 THEN '' ELSE p_brand END AS hcpcs FROM part"
ICD9_SHEET = """SELECT p_partkey + 1 AS row_no, CASE WHEN p_size % 5 = 0 THEN p_type END AS ta,
 CAST(100 + p_partkey % 900 AS STRING) || '.' || CAST(p_size % 10 AS STRING) || 'x' AS icd9 FROM part"""


def _sheet(v: Views, sql: str):
    return v.spark.sql(sql.replace("FROM part", "FROM {part}"), part=v.table("part"))


@query("import_code_lists", f"""WITH i AS ({ICD9_SHEET}), n AS ({NDC_SHEET}), h AS ({HCPCS_SHEET})
SELECT 'icd9' AS list, row_no, replace(replace(icd9, '.', ''), 'x', '') AS code,
  last_value(ta IGNORE NULLS) OVER (ORDER BY row_no ROWS UNBOUNDED PRECEDING) AS label FROM i
UNION ALL SELECT 'ndc', row_no, CASE WHEN len(string_split(ndc, '-')) = 3 THEN
    right('00000' || string_split(ndc, '-')[1], greatest(5, length(string_split(ndc, '-')[1])))
    || right('0000' || string_split(ndc, '-')[2], greatest(4, length(string_split(ndc, '-')[2])))
    || right('00' || string_split(ndc, '-')[3], greatest(2, length(string_split(ndc, '-')[3])))
  ELSE right('00000000000' || replace(ndc, '-', ''), greatest(11, length(replace(ndc, '-', '')))) END, generic_name FROM n
UNION ALL SELECT 'hcpcs', row_no, hcpcs, generic_name FROM h WHERE hcpcs <> ''""")
def import_code_lists(v: Views):
    sheets = {"icd9": ICD9_SHEET, "ndc": NDC_SHEET, "hcpcs": HCPCS_SHEET}
    labels = {"icd9": "ta", "ndc": "generic_name", "hcpcs": "generic_name"}
    paths = {}
    for name, sql in sheets.items():
        paths[name] = scratch_path(v.spark, name)
        sheet = _sheet(v, sql)
        if name == "icd9":  # a plain sheet in several files, whose order is that of its lines
            sheet = sheet.repartitionByRange(3, "row_no").sortWithinPartitions("row_no").drop("row_no")
        sheet.write.option("header", True).csv(paths[name])
    home = library(v, "q_code_lists")
    load_code_lists(v.spark, paths, home)
    lists = [
        v.spark.table(f"{home}.{name}").select(
            F.lit(name).alias("list"), F.col("row_no").cast("long").alias("row_no"), F.col(name).alias("code"), F.col(label).alias("label")
        )
        for name, label in labels.items()
    ]
    return reduce(outer_union, lists)


@query("code_list_df", "SELECT DISTINCT p_brand AS rx FROM part WHERE p_brand <> ''")
def code_list(v: Views):
    brands = sorted(r[0] for r in v.table("part").select("p_brand").distinct().collect())  # a Python list is what it takes
    return code_list_df(v.spark, [*brands, *brands, ""], "rx")


@query("read_codes", with_views("icd9") + "SELECT icd9 FROM icd9 WHERE upper(ta) = 'ASIA'")
def read_codes(v: Views):
    return codes_of(v.icd9, "icd9", "Asia")


@query("forward_fill", """WITH sheet AS (SELECT o_orderkey AS row_no,
  CASE WHEN o_orderstatus = 'P' OR o_custkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS ta FROM orders)
SELECT row_no, last_value(ta IGNORE NULLS) OVER (ORDER BY row_no ROWS UNBOUNDED PRECEDING) AS ta FROM sheet""")
def forward_fill_query(v: Views):
    missing = (F.col("o_orderstatus") == "P") | (F.col("o_custkey") % 3 == 0)
    sheet = v.table("orders").select(
        F.col("o_orderkey").alias("row_no"), F.when(~missing, F.col("o_orderpriority")).alias("ta")
    )
    return forward_fill(sheet, "ta", "row_no", block=1_000)
