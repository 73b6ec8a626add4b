"""The pipeline on a small folder of tables: whole stages against what each must do."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from claimtrail.llm import line_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, docs_of, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first, *middle, last = corpus_pipeline.STAGES
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_dedup", "benchmark_decontamination", "sentencepiece"]
    kept = first[1](spark, docs, folder)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept.collect()}
    assert sum(labels.get(i) == 1 for i in ids) >= 0.9 * sum(q == 1 for q in labels.values())
    for _, stage in middle:
        after = stage(spark, kept, folder)
        assert after.dtypes == docs.dtypes
        assert {r.doc_id for r in after.select("doc_id").collect()} <= ids
        kept = after
    tokens = last[1](spark, kept, folder)
    assert tokens.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and tokens.count() == kept.count()


def test_run_and_registration(spark, folder):
    names = set(entry.queries())
    assert "pipeline" in names and {n for n in names if n.startswith("op")} == {
        "op1_quality_classifier", "op2_quality_rules", "op3_substring_dedup", "op4_sentencepiece", "op5_sharding", "op6_chat_format",
        "op7_line_dedup", "op8_simhash_dedup", "op9_pii_pseudonyms", "op10_benchmark_decontamination", "op11_turn_repair",
        "op12_minhash_dedup", "op13_merkle_manifest",
    }
    out = entry.queries()["pipeline"](spark, folder)
    assert 0 < out.count() <= spark.read.parquet(f"{folder}/documents.parquet").count()


def test_stages_take_odd_tables(spark, docs_of, odd_pairs, folder):
    for pairs in (odd_pairs, []):
        docs = docs_of(pairs)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, folder)
            assert after.dtypes == docs.dtypes
            after.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == len(pairs)


def test_line_stage_changes_text(spark, docs_of):
    line = "a line that stands in many documents"
    out = line_dedup.dedup_lines(docs_of([(i, f"{line}\nown {i}") for i in range(4)]))
    assert {(r.doc_id, r.text, r.n_chars) for r in out.collect()} == {(i, f"own {i}" if i < 3 else f"{line}\nown 3", 5 if i < 3 else len(line) + 6) for i in range(4)}
