from __future__ import annotations

import re
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from claimtrail.config import StudyConfig
from claimtrail.operators.conditions import baseline
from claimtrail.operators.scan import scan_dx
from claimtrail.plans.study import (
    INTERVALS, StudyInputs, analyse_study, folder_saver, keep_lazy, library_inputs, pull_admissions, pull_dx, pull_enrollment, pull_study, study_exposure, study_from_files,
    study_run, table_saver,
)
from claimtrail.sources.code_lists import load_code_lists
from claimtrail.sources.tables import create_libraries, ingest_library, list_tables
from tests.conftest import rows

START = date(2007, 3, 1)
PERSON = "sex string, dobyr int, age int, plantyp double, region string"
CLAIM = f"enrolid int, svcdate date, source string, scope string, {PERSON}, year int, proc1 string, pdx string, dx1 string, dx2 string, stdplac int, stdprov int, stdsvc int, procgrp int, proctyp string, revcode string, svcscat string"


def person(pid):
    return ("1" if pid % 2 else "2", 1950 + pid, 57 - pid, float(1 + pid % 9), str(1 + pid % 4))


def make_inputs(spark):
    fills, services, stays, spells = [], [], [], []
    for pid in range(1, 7):
        for k in range(pid):
            fills.append((pid, START + timedelta(40 * k), "01234056708", 30 if k % 3 else 0, *person(pid)))
        fills.append((pid, START + timedelta(10), "99999999999", 30, *person(pid)))
        for offset, scope, proc, pdx, dx1 in (
            (-20, "o", "99213", None, "6961"), (-10, "o", None, None, "4280"), (5, "o", "99213", None, "6961"),
            (6, "s", "11111", "6961", None), (7, "o", "80053", None, "6961"), (8, "o", "11111", None, "9999"),
        ):
            services.append((pid, START + timedelta(offset), "ccae", scope, *person(pid), 2007, proc, pdx, dx1, None) + (None,) * 7)
        stays.append((pid, START + timedelta(30), START + timedelta(33), "6961", "99222", None))
        spells.append((pid, date(2006, 1, 1), date(2008, 12, 31)))
    fills.append((50, date(2008, 5, 1), "01234056708", 30, *person(5)))
    return StudyInputs(
        services=spark.createDataFrame(services, CLAIM),
        drugs=spark.createDataFrame(fills, f"enrolid int, svcdate date, ndcnum string, daysupp int, {PERSON}"),
        admissions=spark.createDataFrame(stays, "enrolid int, admdate date, disdate date, pdx string, proc1 string, proc2 string"),
        enrollment=spark.createDataFrame(spells, "enrolid int, dtstart date, dtend date"),
        icd9=spark.createDataFrame([("PSORIASIS", "6961"), ("CHF", "428")], "ta string, icd9 string"),
        ndc=spark.createDataFrame([("01234056708", "drug")], "ndc string, generic_name string"),
        hcpcs=spark.createDataFrame([("J0000", "infusion", 28)], "hcpcs string, generic_name string, daysupp int"),
    )


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return study_run(spark, make_inputs(spark), StudyConfig(), folder_saver(spark, str(tmp_path_factory.mktemp("study"))))


def test_cohort_and_claims(tables):
    assert rows(tables["rds.allpt"], "enrolid", "idxdate", "idxtreatment") == [(p, START, "drug") for p in range(1, 7)]
    assert tables["rds.interest_tx"].where("enrolid = 50").count() == 1
    assert tables["rds.alldx"].where("enrolid = 1").count() == 5  # the 9999 claim has no study diagnosis
    assert tables["rds.alladm"].count() == 6 and tables["rds.allce"].count() == 6


def test_analysis(tables):
    base = {r["enrolid"]: r for r in tables["ads.baseline"].collect()}
    assert base[1]["charlson_index"] == 1 and base[1]["ICD93d_Top_1"] == "1"
    use = {r["enrolid"]: r for r in tables["ads.outcomes_ru"].collect()}
    assert (use[1]["all_hospitalization"], use[1]["dis_hospitalization"]) == (1, 1)
    assert (use[1]["all_office"], use[1]["all_others"], use[1]["dis_office"], use[1]["dis_others"]) == (1, 1, 1, 0)
    pattern = {r["enrolid"]: r for r in tables["ads.outcomes_tp"].collect()}
    assert pattern[1]["time"] == 30 and pattern[1]["persistence_flag"] == "0"
    assert pattern[6]["time"] == 230 and pattern[6]["pdc_df2"] == pytest.approx(180 / 364)
    assert tables["ads.variables"].count() == 6
    assert tables["ads.km"].agg(F.max("n_risk")).first()[0] == 6
    stats = tables["ads.statistics"]
    assert {r["group"] for r in stats.select("group").distinct().collect()} == {"drug", "All", "Overall"}
    assert stats.where("varname = 'age' AND group = 'All' AND stat = 'Mean'").count() == 1


def test_lazy_run_gives_the_same(spark, tables):
    inputs = make_inputs(spark)
    pulled = pull_study(inputs, StudyConfig(), keep_lazy)
    for name, df in pulled.items():
        assert rows(df) == rows(tables[name].select(*df.columns)), name
    parts = analyse_study(
        pulled["rds.allpt"], tables["sds.sddx"], tables["sds.sdadm"], pulled["rds.interest_tx"], inputs.icd9, StudyConfig()
    )
    assert rows(parts["ads.variables"]) == rows(tables["ads.variables"].select(*parts["ads.variables"].columns))


def test_run_into_libraries(spark):
    cfg = replace(StudyConfig(), disease="psoriasis")
    create_libraries(spark, cfg.libraries)
    inputs = make_inputs(spark)
    for _ in range(2):
        study_run(spark, inputs, cfg)
    assert list_tables(spark, "rds") == ["alladm", "allce", "alldx", "allpt", "interest_tx"]
    assert list_tables(spark, "ads") == ["baseline", "km", "km_at_risk", "km_quartiles", "outcomes_ru", "outcomes_tp", "statistics", "variables"]
    assert "sddm" in list_tables(spark, "sds")
    assert table_saver(spark)("sds.copy", inputs.icd9).count() == 2


def test_only_numbered_procedures_count(spark, tables):
    inputs = make_inputs(spark)
    stays = tables["sds.sdadm"].withColumns({"proc1": F.lit(" "), "proc2": F.lit(None).cast("string"), "procgrp": F.lit(225)})
    out = analyse_study(tables["rds.allpt"], tables["sds.sddx"], stays, tables["rds.interest_tx"], inputs.icd9, StudyConfig())
    assert {r[0] for r in out["ads.outcomes_ru"].select("dis_hospitalization").collect()} == {0}


def test_measures_are_labelled(tables):
    names = {r[0] for r in tables["ads.statistics"].select("varname").distinct().collect()}
    assert "Proportion of Days Covered, Definition 2" in names and "pdc_df2" not in names


def partitioned(spark, df, tmp_path, name, scopes):
    rows_ = None
    for source in ("ccae", "mdcr", "mdcd"):
        for scope in scopes:
            for year in (2005, 2007, 2009):
                part = df.drop("source", "scope", "year").withColumns({"source": F.lit(source), "scope": F.lit(scope), "year": F.lit(year)})
                rows_ = part if rows_ is None else rows_.unionByName(part)
    path = str(tmp_path / name)
    rows_.write.partitionBy("source", "scope", "year").parquet(path)
    return spark.read.parquet(path)


def partition_filters(text):
    return "".join(re.findall(r"PartitionFilters: \[(.*?)\]", text))


def test_pulls_prune_by_shard_columns(spark, tmp_path, plan):
    inputs = make_inputs(spark)
    inputs = replace(
        inputs, services=partitioned(spark, inputs.services, tmp_path, "services", "os"), drugs=partitioned(spark, inputs.drugs, tmp_path, "drugs", "d"),
        admissions=partitioned(spark, inputs.admissions, tmp_path, "admissions", "i"), enrollment=partitioned(spark, inputs.enrollment, tmp_path, "enrollment", "t"),
    )
    cfg = StudyConfig()
    cohort = spark.createDataFrame([(1,)], "enrolid int")
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    for df, names in (
        (pull_dx(inputs, cohort, cfg), ("source", "scope", "year")), (pull_admissions(inputs, cohort, cfg), ("source", "scope")),
        (pull_enrollment(inputs, cohort, cfg), ("source", "scope")),
    ):
        filters = partition_filters(plan(df))
        assert all(n in filters for n in names), filters
    exposed = study_exposure(inputs, cfg)
    assert len(re.findall(r"PartitionFilters: \[[^\]]*source[^\]]*scope[^\]]*year", plan(exposed))) >= 2
    assert pull_dx(inputs, cohort, cfg).select("source", "scope", "year").distinct().count() == 2 * 2 * 3  # the years beside the period too


def test_claims_without_a_shard_year_or_in_the_next_years_shard_stay(spark, tmp_path):
    inputs = make_inputs(spark)
    cfg = StudyConfig()
    cohort = inputs.services.select("enrolid").distinct()
    want = pull_dx(inputs, cohort, cfg).count()
    years = {None: 1, cfg.study_start.year - 1: 1, cfg.study_end.year + 1: 1, cfg.study_end.year + 2: 0}
    for year, kept in years.items():
        path = str(tmp_path / f"services-{year}")
        inputs.services.withColumn("year", F.lit(year).cast("int")).write.partitionBy("year").parquet(path)
        claims = replace(inputs, services=spark.read.schema(inputs.services.withColumn("year", F.lit(1)).schema).parquet(path))
        assert pull_dx(claims, cohort, cfg).count() == want * kept, year
        path = str(tmp_path / f"drugs-{year}")
        inputs.drugs.withColumn("year", F.lit(year).cast("int")).write.partitionBy("year").parquet(path)
        fills = replace(inputs, drugs=spark.read.schema(inputs.drugs.withColumn("year", F.lit(1)).schema).parquet(path))
        assert study_exposure(fills, cfg).count() == study_exposure(inputs, cfg).count() * kept


def test_stays_are_pruned_by_both_years(spark, plan):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    cfg = StudyConfig()
    days = [("1996-05-01", "2006-02-01"), ("2006-12-30", "2007-01-02"), ("2008-12-31", "2012-01-01"), ("2001-01-01", "2005-12-31"), ("2009-01-01", "2009-02-01"),
            ("2007-03-01", None), (None, "2007-03-01"), ("1990-01-01", "2015-01-01")]
    rows_ = [(1, i, *(date.fromisoformat(d) if d else None for d in pair)) for i, pair in enumerate(days)] + [(2, 99, date(2007, 1, 1), date(2007, 1, 2))]
    stays = spark.createDataFrame(rows_, "enrolid int, n int, admdate date, disdate date")
    create_libraries(spark, ["iv"])
    stays.write.mode("overwrite").saveAsTable("iv.plain")
    files = spark.sql("describe extended iv.plain").where("col_name = 'Location'").first().data_type
    assert ingest_library(spark, {"ccaei071": files}, "iv", intervals=INTERVALS, refresh=True) == {"ccaei071": len(rows_)}
    table = spark.table("iv.ccaei071")
    cohort = spark.createDataFrame([(1,)], "enrolid int")
    pulled = pull_admissions(replace(make_inputs(spark), admissions=table), cohort, cfg)
    assert {r.n for r in pulled.collect()} == {r.n for r in pull_admissions(replace(make_inputs(spark), admissions=stays), cohort, cfg).collect()} == {0, 1, 2, 7}
    filters = partition_filters(plan(pulled))
    assert "begin_year" in filters and "end_year" in filters
    assert set(pulled.columns) == set(stays.columns)
    open_ended = scan_dx(table, start=cfg.study_start, end=cfg.study_end, date_col="admdate", end_col="disdate", coalesce_end=True)
    assert {r.n for r in open_ended.collect()} == {0, 1, 2, 5, 7, 99}
    early = scan_dx(table, end=date(1996, 12, 31), date_col="admdate", end_col="disdate")
    assert {r.n for r in early.collect()} == {0, 7}


def test_study_from_shards_of_other_types(spark, tmp_path):
    """Drug codes as numbers in one shard and text in another, and a plain code sheet, give the study of uniform ones."""
    inputs = make_inputs(spark)
    shards, sheets = {}, {}
    for name, df in (("ccaeo071", inputs.services), ("ccaei071", inputs.admissions), ("ccaet071", inputs.enrollment)):
        shards[name] = str(tmp_path / name)
        df.drop("source", "scope", "year").write.parquet(shards[name])
    drugs = inputs.drugs.drop("source", "scope", "year")
    as_number = F.regexp_replace("ndcnum", "[^0-9]", "1").cast("long")
    for name, df in (("ccaed071", drugs.withColumn("ndcnum", as_number)), ("ccaed081", drugs.limit(0))):
        shards[name] = str(tmp_path / name)
        df.write.parquet(shards[name])
    text = inputs.ndc.withColumn("ndc", F.lpad(F.regexp_replace("ndc", "[^0-9]", "1"), 11, "0"))
    for name, df in (("icd9", inputs.icd9.drop("row_no")), ("ndc", text), ("hcpcs", inputs.hcpcs)):
        sheets[name] = str(tmp_path / f"{name}.csv")
        df.coalesce(1).write.option("header", True).csv(sheets[name])
    cfg = StudyConfig(libraries=("raw7", "rds", "scd7", "sds", "ads"))
    create_libraries(spark, cfg.libraries)
    ingest_library(spark, shards, "raw7", refresh=True, code_widths=dict(cfg.code_widths), intervals=INTERVALS)
    load_code_lists(spark, sheets, "scd7")
    found = study_exposure(library_inputs(spark, "raw7", "scd7", cfg), cfg)
    plain = replace(inputs, drugs=inputs.drugs.withColumn("ndcnum", F.lpad(as_number.cast("string"), 11, "0")), ndc=text)
    assert rows(found, "enrolid", "svcdate", "generic_name", "daysupp") == rows(study_exposure(plain, cfg), "enrolid", "svcdate", "generic_name", "daysupp")
    assert found.count() > 0


def test_study_from_files(spark, tmp_path):
    inputs = make_inputs(spark)
    files = {}
    for name, df in {
        "ccaeo071": inputs.services.where("scope = 'o'"), "ccaes071": inputs.services.where("scope = 's'"), "ccaed071": inputs.drugs,
        "ccaei071": inputs.admissions, "ccaet071": inputs.enrollment,
    }.items():
        files[name] = str(tmp_path / name)
        df.drop("source", "scope").write.parquet(files[name])
    sheets = {}
    for name, df in {"icd9": inputs.icd9.withColumn("row_no", F.monotonically_increasing_id()), "ndc": inputs.ndc, "hcpcs": inputs.hcpcs}.items():
        sheets[name] = str(tmp_path / name)
        df.coalesce(1).write.option("header", True).csv(sheets[name])
    cfg = replace(StudyConfig(), libraries=("raw2", "rds", "scd2", "sds", "ads"))
    out = study_from_files(spark, files, sheets, cfg)
    assert out["ads.variables"].count() == 6
    wanted = study_run(spark, inputs, StudyConfig(), folder_saver(spark, str(tmp_path / "wanted")))
    assert rows(out["ads.outcomes_tp"]) == rows(wanted["ads.outcomes_tp"]) and rows(out["ads.outcomes_ru"]) == rows(wanted["ads.outcomes_ru"])


def test_baseline_reads_claims_once(spark, tables, tmp_path, plan):
    claims = tables["sds.sddx"]
    path = claims.inputFiles()[0].rsplit("/", 1)[0]
    out = baseline(claims, ["6961"], StudyConfig())
    assert path not in plan(out)  # what is left reads the written diagnoses
    assert out.count() == tables["ads.baseline"].count()


def test_stays_that_began_years_before_are_pulled(spark):
    cfg = StudyConfig()
    begun = date(cfg.study_start.year - 3, 5, 1)
    stays = [(1, begun, cfg.study_start + timedelta(5), begun.year), (2, cfg.study_start, cfg.study_start, None), (3, begun, begun, begun.year)]
    table = spark.createDataFrame(stays, "enrolid int, admdate date, disdate date, year int")
    cohort = spark.createDataFrame([(1,), (2,), (3,)], "enrolid int")
    found = pull_admissions(replace(make_inputs(spark), admissions=table), cohort, cfg)
    assert rows(found, "enrolid") == [(1,), (2,)]
