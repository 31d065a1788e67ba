"""Exact top-k search against brute force."""

import math
import random

import numpy as np
import pytest

from oracle import compare, duck
from parcelflow.llm import queries, topk

VECTORS = "vec_id bigint, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    sound = []
    for vec_id, e in rows:
        if vec_id is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            sound.append((vec_id, [math.floor(64 * float(np.float32(x))) for x in e]))
    out = []
    for i, (q, v) in enumerate(sound):
        if q % every:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), c) for j, (c, w) in enumerate(sound) if j != i and len(w) == len(v)]
        out += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(spark, rows, **how):
    frame = spark.createDataFrame([(i, e, 0) for i, e in rows], VECTORS)
    out = topk.top_k(topk.quantised(frame), topk.F.col("vec_id") % 20 == 0, **how)
    return sorted(tuple(r) for r in out.collect())


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(queries.op8_topk(spark, sf), duck(sf), queries.ORACLES["op8_topk"]) == []


@pytest.mark.parametrize("shard_rows,block_rows", [(4096, 1024), (90, 7)])
def test_shards_blocks_and_ties(spark, monkeypatch, shard_rows, block_rows):
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([-0.5, -0.25, 0.0, 0.1, 0.3]) for _ in range(4)]) for i in range(400)]
    rows += [(1000 + i, [0.3, 0.3, 0.3, 0.3]) for i in range(60)]
    assert found(spark, rows, k=20, shard_rows=shard_rows, block_rows=block_rows) == brute(rows)


def test_boxes_and_leaves():
    rng = np.random.default_rng(1)
    v = np.floor(64 * rng.normal(size=(3000, 6)) * np.array([3, 1, 1, 1, 1, 0.1])).astype(np.int64)
    ids = np.arange(3000)
    tree = topk.build(v, ids, ids)
    assert max(b - a for (a, b), k in zip(tree["spans"], tree["kids"]) if not k[0]) <= topk.LEAF_ROWS
    for i in (0, 17, 2999):
        nothing = np.zeros(0, np.int64)
        (scores, got, _), = topk.search(tree, v[i : i + 1], ids[i : i + 1], 5, [(nothing,) * 3])
        want = sorted((-int(v[i] @ v[j]), j) for j in range(3000) if j != i)[:5]
        assert [(-s, j) for s, j in zip(scores.tolist(), got.tolist())] == want


def test_edge_rows(spark):
    rows = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (None, [9.0, 9.0])]
    rows += [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (0, [-1.0, 0.5]), (100, [1.0, 2.0, 3.0]), (120, []), (2, [1e6, -1e6]), (3, [0.015625, -0.001])]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(20, [1.0])]) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float((i * 7919) % 100003) * 1e2, float(i) * 1e3]) for i in range(50)]
    assert found(spark, rows) == brute(rows)
