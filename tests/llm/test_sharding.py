"""Feistel shuffle: bijection, laws, reproducibility and edge rows."""

import zlib

import numpy as np
import pytest

from parcelflow.llm import queries, sharding

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_a_bijection_with_an_inverse(n):
    image = sharding.permute(np.arange(n), n, seed=5)
    assert sorted(image) == list(range(n))
    assert sharding.permute(image, n, 5, back=True).tolist() == list(range(n))
    shard, slot = sharding.places(np.arange(n), n, 8, 5)
    assert sharding.rows_at(shard, slot, n, 8, 5).tolist() == list(range(n))


def test_other_seed_gives_other_order():
    assert sharding.permute(np.arange(1000), 1000, 1).tolist() != sharding.permute(np.arange(1000), 1000, 2).tolist()


def _lawful(rows, n, shards=8):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sum(map(len, by.values())) == n
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_query_holds_all_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = queries.op4_sharding(spark, SF).collect()
    _lawful(rows, len(docs))
    want = sorted((d["doc_id"], len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode())) for d in docs)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want


def test_order_and_partitions_of_the_input_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    key = lambda r: (r["doc_id"], r["text"], r["shard"], r["slot"])
    a = sorted(map(key, sharding.assign(docs).collect()))
    assert a == sorted(map(key, sharding.assign(docs.repartition(7, "lang")).collect()))


def test_nulls_repeats_clashes_and_empty_tables(spark, docs):
    rows = [(1, "a"), (1, "a"), (1, "a"), (None, None), (None, None), (2, ""), (3, "x" * 100_000)]
    frame = docs(rows).withColumnRenamed("n_chars", "shard")
    out = sharding.assign(frame, 3).collect()
    _lawful(out, len(rows), 3)
    assert len({r["row_no"] for r in out}) == len(rows)
    assert sharding.assign(docs([]), 3).collect() == []


def test_written_shards_come_back(spark, docs, tmp_path):
    assigned = sharding.assign(docs([(i, f"t{i}") for i in range(50)]), 4)
    sharding.write_shards(assigned, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in back) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in assigned.collect())
