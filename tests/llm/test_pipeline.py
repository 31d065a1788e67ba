"""Every stage of the pipeline on its own input, against a plain version."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelflow.llm import quality
from parcelflow.session import materialise
from test_decontaminate import brute as contained
from test_packing import sound
from test_simhash import plain_groups, plain_print

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(name, input rows, output rows) of each stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        made = materialise(stage(spark, docs, SF), name)
        assert name == "packing" or made.dtypes == docs.dtypes
        out[name] = (docs.collect(), made.collect())
        docs = made
    return out


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "decontaminate", "packing"]


def test_filters_only_take_rows_away(stages):
    for name in ("language", "quality", "near_duplicates", "decontaminate"):
        given, left = stages[name]
        assert set(map(tuple, left)) <= set(map(tuple, given)) and len(left) <= len(given)


def test_language_and_quality_keep_clean_documents(spark, stages):
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name in ("language", "quality"):
        given, left = ({r["doc_id"] for r in rows if truth.get(r["doc_id"]) == 1} for rows in stages[name])
        assert len(left) >= 0.97 * len(given)


def test_one_document_of_each_group_stays(stages):
    given, left = stages["near_duplicates"]
    rows = [(r["doc_id"], plain_print(r["text"])) for r in given]
    assert sorted(r["doc_id"] for r in left) == sorted(set(plain_groups(rows)))


def test_documents_with_benchmark_items_go(spark, stages):
    given, left = stages["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {d for d, *_ in contained([(r["doc_id"], r["text"]) for r in given], items)}
    assert sorted(r["doc_id"] for r in left) == sorted(r["doc_id"] for r in given if r["doc_id"] not in leaks)


def test_sequences_hold_what_is_left(stages):
    given, left = stages["packing"]
    used, least = sound(left, [(r["doc_id"], r["text"]) for r in given])
    assert used <= least * 1.02 + 1


def test_edge_rows_pass_through_all_stages(spark, docs, tmp_path):
    good = "the house is in the town and the people of the town are in the house " * 4
    rows = [(i, f"{good} {i} {'word ' * (i % 9)}", "en", "s", 1) for i in range(30)] + [(100, None, "en", "s", None), (101, "", None, None, 0), (102, "!!! 123", "en", "s", 7), (None, good + "other end", "en", "s", 3), (5, good, None, "s", 3), (5, good, None, "s", 3)]
    folder = f"{tmp_path}/in"
    docs(rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "quite another text that no document holds")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() > 0
    empty = f"{tmp_path}/empty"
    docs([]).write.parquet(f"{empty}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{empty}/{t}.parquet")
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_columns_of_any_name_pass_unchanged(spark, docs, tmp_path):
    """Every filtering stage returns extra columns as they were, whatever they are called."""
    good = "the house is in the town and the people of the town are in the house " * 4
    extra = {"_row": 9, "row": 8, "_d": 7, "_t": 6, "_l": 5, "_id": 4, "_text": 3, "score": 2, "Lang_Pred": 1, "a.b": 0, "leak_id": 11, "rejected_id": 12, "group": 13}
    table = docs([(i, f"{good} {i} {'word ' * (i % 9)}", "en", "s", 1) for i in range(20)])
    for name, value in extra.items():
        table = table.withColumn(name, F.lit(value) + F.col("doc_id"))
    folder = f"{tmp_path}/in"
    table.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "quite another text that no document holds")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    given = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, given, folder)
        assert left.columns == given.columns, name
        rows = left.collect()
        assert rows and all(r[n] == v + r["doc_id"] for r in rows for n, v in extra.items()), name
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_quality_reads_columns_of_other_names(spark, docs):
    good = "the house is in the town and the people of the town are in the house " * 4
    table = docs([(i, f"{good} {i}", "en", "s", 1) for i in range(20)] + [(50, None, "en", "s", 1)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id bigint, quality int, toxic int")
    stored = materialise(table.withColumnsRenamed({"doc_id": "id", "text": "body", "lang": "tongue"}), "renamed")
    got = quality.keep(stored, labels, id_col="id", text_col="body", lang_col="tongue")
    want = quality.keep(materialise(table, "plain"), labels)
    assert sorted(r["id"] for r in got.collect()) == sorted(r["doc_id"] for r in want.collect()) != []
