"""The pipeline, stage by stage, and the queries' names."""

import pytest

import corpus_pipeline
from cliploom.llm import exthash, queries


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf).write.parquet(f"file://{folder}/{name}")
        docs = spark.read.parquet(f"file://{folder}/{name}")
        out.append((name, before, docs))
    return out


def test_stages_keep_the_columns_and_only_shrink(stages, spark, sf):
    columns = spark.read.parquet(f"{sf}/documents.parquet").columns
    for name, before, after in stages[:-1]:
        assert sorted(after.columns) == sorted(columns), name
        assert after.join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
        assert after.select("doc_id").distinct().count() == after.count()


def test_decisions_take_effect(stages):
    by = {name: (before, after) for name, before, after in stages}
    exact = by["exact_dedup"][1]
    assert exact.select("text").distinct().count() == exact.count()
    before, after = by["exact_dedup"]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(r["doc_id"] for r in exthash.exact_groups(before).where("kept").collect())
    packed, kept = by["packing"][1], by["packing"][0]
    assert packed.select("doc_id").distinct().count() == kept.count()
    language = by["language_id"]
    assert language[1].where("lang is null").count() == 0 and language[1].count() >= 0.98 * language[0].count()


def test_run_gives_the_last_stage(stages, spark, sf):
    assert corpus_pipeline.run(spark, sf).select("doc_id").distinct().count() == stages[-1][2].select("doc_id").distinct().count()


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_awkward_documents_pass_every_stage(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "plain words here to keep", None, "s", 24), (4, "plain words here to keep", "en", "s", 24), (5, "token=abcdefgh12345 and more plain words", "en", "s", 40), (6, "99 !!", "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), stage(spark, docs, "").schema)
        if name == "language_id":
            assert sorted(r["doc_id"] for r in docs.collect()) == [3, 4, 5]
        if name == "secret_scan":
            assert {r["doc_id"]: r["text"] for r in docs.collect()}[5] == "[assign] and more plain words"


def test_an_empty_table_passes_every_stage(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0
        docs = spark.createDataFrame([], out.schema)


def test_repeated_rows_do_not_break_a_stage(spark):
    row = (7, "plain words that repeat as a row", "en", "s", 32)
    docs = spark.createDataFrame([row, row, (8, "quite other words in this one", "en", "s", 29)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert {r["doc_id"] for r in docs.collect()} == {7, 8}
