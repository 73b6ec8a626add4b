"""Folders of files, whole replacement of tables, and studies that go on from finished tables."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from claimtrail.config import StudyConfig
from claimtrail.plans import study
from claimtrail.plans.study import StudyInputs, study_from_files, study_run
from claimtrail.sources.manifest import entry_of, list_folder, recover, set_entry, staged, state_of
from claimtrail.sources.tables import create_libraries, ingest_folder, list_tables, materialize
from tests.conftest import rows
from tests.test_study import make_inputs


@pytest.fixture(scope="module", autouse=True)
def libraries(spark):
    create_libraries(spark, ["raw_m", "out_m", "rds", "sds", "ads"])


def broken(spark):
    return spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("bigint").alias("id"))


def test_folder_with_new_changed_and_foreign_files(spark, tmp_path):
    folder = tmp_path / "in"
    spark.range(3).write.parquet(str(folder / "CCAEO071.parquet"))
    spark.range(5).write.parquet(str(folder / "ccaed071.parquet"))
    (folder / "readme.txt").write_text("no shard")
    (folder / "old").mkdir()
    spark.range(9).write.parquet(str(folder / "old" / "ccaet071.parquet"))
    assert sorted(list_folder(spark, str(folder))) == ["ccaed071", "ccaeo071"]
    assert ingest_folder(spark, str(folder), "raw_m") == {"ccaeo071": 3, "ccaed071": 5}
    assert ingest_folder(spark, f"file://{folder}/", "raw_m") == {"ccaeo071": 3, "ccaed071": 5}  # from another path
    assert ingest_folder(spark, f"file://{folder}", "raw_m") == {"ccaeo071": None, "ccaed071": None}
    spark.range(2).write.mode("append").parquet(str(folder / "CCAEO071.parquet"))
    spark.range(1).write.parquet(str(folder / "ccaei071.parquet"))
    assert ingest_folder(spark, f"file://{folder}", "raw_m") == {"ccaeo071": 5, "ccaed071": None, "ccaei071": 1}
    assert ingest_folder(spark, f"file://{folder}", "raw_m", string_cols=["id"])["ccaed071"] == 5
    assert spark.table("raw_m.ccaed071").dtypes == [("id", "string")]
    assert spark.table("raw_m.ccaeo071").count() == 5 and list_tables(spark, "raw_m") == ["ccaed071", "ccaei071", "ccaeo071"]


def test_folders_that_are_refused(spark, tmp_path):
    for name in ("a.parquet", "A.parquet"):
        spark.range(1).write.parquet(str(tmp_path / name))
    with pytest.raises(ValueError, match="twice"):
        list_folder(spark, str(tmp_path))
    with pytest.raises(ValueError, match="whole path"):
        list_folder(spark, "some/folder")


def test_a_failed_replace_leaves_the_old_table(spark):
    assert materialize(spark.range(7), "out_m.t", entry={"inputs": "x"}) == 7
    assert entry_of(spark, "out_m.t") == {"rows": "7", "inputs": "x"}
    with pytest.raises(Exception, match="broken"):
        materialize(broken(spark), "out_m.t")
    assert spark.table("out_m.t").count() == 7 and entry_of(spark, "out_m.t")["inputs"] == "x"
    assert materialize(spark.table("out_m.t").where("id > 4"), "out_m.t") == 2  # from itself
    assert rows(spark.table("out_m.t")) == [(5,), (6,)] and entry_of(spark, "out_m.t") == {"rows": "2"}
    materialize(spark.range(1), "out_m.t", "append")
    assert entry_of(spark, "out_m.t") == {} and "t" in list_tables(spark, "out_m")


def test_a_swap_broken_off_is_finished(spark):
    materialize(spark.range(2), "out_m.s")
    half, whole = staged("out_m.s"), staged("out_m.s")
    spark.range(5).write.saveAsTable(half)
    recover(spark, "out_m.s")
    assert spark.table("out_m.s").count() == 2 and not spark.catalog.tableExists(half)
    spark.range(3).write.saveAsTable(whole)
    set_entry(spark, whole, {"rows": 3, "note": "it's \\ whole"})
    spark.sql("DROP TABLE out_m.s")
    assert "s" not in list_tables(spark, "out_m")
    recover(spark, "out_m.s")
    assert spark.table("out_m.s").count() == 3 and entry_of(spark, "out_m.s")["note"] == "it's \\ whole"


def test_single_partitions_are_replaced(spark):
    df = spark.createDataFrame([(1, "ccae"), (2, "ccae"), (3, "mdcr")], "id int, source string")
    materialize(df, "out_m.p", partition_by=["source"])
    materialize(df, "out_m.p", partition_by=["source"])
    assert rows(spark.table("out_m.p"), "id", "source") == rows(df) and spark.table("out_m.p").where("source = 'mdcr'").count() == 1
    assert materialize(df.selectExpr("source", "id * 10 AS id").where("id = 30"), "out_m.p", "partitions", ["source"]) == 1
    assert rows(spark.table("out_m.p"), "id", "source") == [(1, "ccae"), (2, "ccae"), (30, "mdcr")]


def test_state_of_a_table_needs_files(spark, tmp_path):
    with pytest.raises(ValueError, match="files"):
        state_of(spark.createDataFrame([(1,)], "id int"))
    spark.range(3).write.parquet(str(tmp_path / "t"))
    first = state_of(spark.read.parquet(str(tmp_path / "t")))
    spark.range(3).write.mode("append").parquet(str(tmp_path / "t"))
    assert first != state_of(spark.read.parquet(str(tmp_path / "t")))


def test_a_broken_study_goes_on(spark, tmp_path, monkeypatch):
    """Broken after rds.alldx: started again, the finished pulls are neither built nor written, and the results are those of a whole run."""
    made = make_inputs(spark)
    stored = {}
    for name, df in vars(made).items():
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    inputs, cfg = StudyInputs(**stored), StudyConfig()

    def stop(*args):
        raise RuntimeError("power cut")

    with monkeypatch.context() as m:
        m.setattr(study, "pull_admissions", stop)
        with pytest.raises(RuntimeError, match="power cut"):
            study_run(spark, inputs, cfg, resume=True)
    files = sorted(spark.table("rds.alldx").inputFiles())
    with monkeypatch.context() as m:
        for name in ("pull_dx", "study_exposure", "index_cohort"):
            m.setattr(study, name, stop)
        out = study_run(spark, inputs, cfg, resume=True)
    assert sorted(spark.table("rds.alldx").inputFiles()) == files
    def shown(tables):  # sums of floating point numbers depend on their order in the last digits
        stats = tables["ads.statistics"].withColumn("value", F.round("value", 9))
        return {name: rows(df) for name, df in {"variables": tables["ads.variables"], "statistics": stats, "km": tables["ads.km"]}.items()}

    first = shown(out)
    whole = shown(study_run(spark, inputs, cfg))
    assert whole == first
    with monkeypatch.context() as m:
        m.setattr(study, "pull_dx", stop)
        with pytest.raises(RuntimeError):  # other parameters, other results
            study_run(spark, inputs, replace(cfg, refill_gap=30), resume=True)


def test_a_study_from_a_folder_goes_on(spark, tmp_path, monkeypatch):
    made = make_inputs(spark)
    scopes = {"o": made.services.where("scope = 'o'"), "s": made.services.where("scope = 's'"), "d": made.drugs, "i": made.admissions, "t": made.enrollment}
    for scope, df in scopes.items():
        df.drop("source", "scope").write.parquet(str(tmp_path / "in" / f"ccae{scope}071.parquet"))
    sheets = {name: str(tmp_path / name) for name in ("icd9", "ndc", "hcpcs")}
    for name, path in sheets.items():
        getattr(made, name).coalesce(1).write.option("header", True).csv(path)
    cfg = replace(StudyConfig(), libraries=("raw9", "rds", "scd9", "sds", "ads"))
    out = study_from_files(spark, str(tmp_path / "in"), sheets, cfg, resume=True)
    wanted = rows(out["ads.variables"])
    assert len(wanted) == 6
    monkeypatch.setattr(study, "descriptive_stats", None)
    monkeypatch.setattr(study, "pull_dx", None)
    assert rows(study_from_files(spark, str(tmp_path / "in"), sheets, cfg, resume=True)["ads.variables"]) == wanted
