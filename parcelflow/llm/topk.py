"""Exact top-k search by inner product with one KD-tree per shard.

Vectors are turned into integers and dealt into shards of bounded size; each shard is stored as one KD-tree: median splits
along the widest side, tight bounding boxes, leaves of contiguous rows. Queries travel in blocks to the trees (a stated
query set against all rows). Within a tree a query goes through the boxes best first: a box can reach at most
sum(max(q*lo, q*hi)), and once that lies below the k-th score found so far the search ends. Every block first searches one tree;
the k-th scores found there travel on with it to all other trees.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import partitions
from parcelflow.session import materialise

LEAF_ROWS = 256
EXACT = 2**53  # integers below are exact as doubles
HITS = "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint"


def quantised(vectors: DataFrame, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(row, vec_id, v) with v = floor(scale * x) per component.

    Rows with a null id, a null vector or a null or non-finite component are left out. row tells equal ids apart.
    """
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(sound)
    v = F.transform(x, lambda c: F.floor(c * scale).cast("bigint"))
    return rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"))


def build(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> dict:
    """KD-tree of a shard. Nodes are listed parent first; kids are 0 at leaves."""
    order = np.arange(len(ids))
    spans, kids = [(0, len(ids))], [(0, 0)]
    at = 0
    while at < len(spans):
        a, b = spans[at]
        mine = vectors[order[a:b]]
        wide = mine.max(axis=0) - mine.min(axis=0) if b > a and mine.shape[1] else np.zeros(1)
        if b - a > LEAF_ROWS and wide.max() > 0:
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(mine[:, int(wide.argmax())], middle)]
            kids[at] = (len(spans), len(spans) + 1)
            spans += [(a, a + middle), (a + middle, b)]
            kids += [(0, 0), (0, 0)]
        at += 1
    vectors, ids, rows = vectors[order], ids[order], rows[order]
    low = np.array([vectors[a:b].min(axis=0) for a, b in spans])
    high = np.array([vectors[a:b].max(axis=0) for a, b in spans])
    return {"v": vectors, "ids": ids, "rows": rows, "spans": spans, "kids": kids, "low": low, "high": high, "least": [int(ids[a:b].min()) for a, b in spans]}


def _bounds(tree: dict, queries: np.ndarray, exact: bool) -> np.ndarray:
    """Most that each query can score in each node's box."""
    q, low, high = (x.astype(np.float64) for x in (queries, tree["low"], tree["high"]))
    most = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    return most if exact else most + 1 + np.abs(most) * 1e-6 + (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T) * 1e-9


def search(tree: dict, queries: np.ndarray, query_rows: np.ndarray, k: int, best: list) -> list:
    """best[i], the (scores, ids, rows) found so far for query i in order, brought up to date with the tree."""
    peak = max(1, int(np.abs(queries).max(initial=0))) * max(1, int(np.abs(tree["v"]).max(initial=0))) * max(1, queries.shape[1])
    exact = peak < EXACT
    data = tree["v"].astype(np.float64) if exact else tree["v"]
    asked = queries.astype(np.float64) if exact else queries
    reach = _bounds(tree, queries, exact)
    out = []
    for i in range(len(queries)):
        scores, ids, rows = best[i]
        heap = [(-reach[i, 0], 0)]
        while heap:
            negative, node = heapq.heappop(heap)
            if len(scores) == k:
                if -negative < scores[-1]:
                    break
                if -negative == scores[-1] and exact and tree["least"][node] > ids[-1]:
                    continue
            left, right = tree["kids"][node]
            if left:
                heapq.heappush(heap, (-reach[i, left], left))
                heapq.heappush(heap, (-reach[i, right], right))
                continue
            a, b = tree["spans"][node]
            found = (data[a:b] @ asked[i]).astype(np.int64)
            keep = tree["rows"][a:b] != query_rows[i]
            if len(scores) == k:
                keep &= found >= scores[-1]
            if not keep.any():
                continue
            scores = np.concatenate((scores, found[keep]))
            ids = np.concatenate((ids, tree["ids"][a:b][keep]))
            rows = np.concatenate((rows, tree["rows"][a:b][keep]))
            first = np.lexsort((rows, ids, -scores))[:k]
            scores, ids, rows = scores[first], ids[first], rows[first]
        out.append((scores, ids, rows))
    return out


def _packed(rows: DataFrame, by: str, as_tree: bool) -> DataFrame:
    """One row (dim, <by>, blob) per shard or query block."""

    def pack(key, table):
        dim = key[0].as_py()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        v = np.asarray(flat, np.int64).reshape(table.num_rows, dim)
        ids, row = table.column("vec_id").to_numpy(), table.column("row").to_numpy()
        order = np.lexsort((row, ids))
        v, ids, row = v[order], ids[order], row[order]
        nothing = np.zeros(0, np.int64)
        made = build(v, ids, row) if as_tree else {"v": v, "ids": ids, "rows": row, "best": [(nothing,) * 3] * len(ids)}
        return pa.table({"dim": [dim], by: [key[1].as_py()], "blob": [pickle.dumps(made)]}, schema=pa.schema([("dim", pa.int32()), (by, pa.int32()), ("blob", pa.binary())]))

    return rows.groupBy("dim", by).applyInArrow(pack, f"dim int, {by} int, blob binary")


def top_k(vectors: DataFrame, is_query, k: int = 20, shard_rows: int = 4096, block_rows: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows of vectors(row, vec_id, v) for each row that is_query selects.

    A query's own row is no candidate; ties go to the smaller vec_id. Vectors of different length never meet. Scores must
    fit a long. Rows with equal ids are rows of their own. Empty tables give no rows.
    """
    stored = materialise(vectors.withColumn("dim", F.size("v")), "vectors")
    sizes = {r["dim"]: (r["n"], r["q"]) for r in stored.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("int")).alias("q")).collect()}
    spark = vectors.sparkSession
    many = spark.createDataFrame([(d, -(-n // shard_rows), max(1, -(-q // block_rows))) for d, (n, q) in sizes.items()], "dim int, shards int, blocks int")
    dealt = stored.join(many, "dim")  # one row per vector length
    spread = F.xxhash64("row", "vec_id")
    trees = materialise(_packed(dealt.withColumn("shard", F.pmod(spread, "shards").cast("int")).select("dim", "shard", "row", "vec_id", "v"), "shard", True), "trees")
    asked = dealt.filter(is_query).withColumn("block", F.pmod(F.shiftright(spread, 20), "blocks").cast("int"))
    blocks = _packed(asked.select("dim", "block", "row", "vec_id", "v"), "block", False).join(many, "dim")
    blocks = materialise(blocks, "blocks")

    def meet(batches: Iterator[pa.RecordBatch], home: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree, block = (pickle.loads(batch.column(c)[i].as_py()) for c in ("tree", "blob"))
                before = [set(rows.tolist()) for _, _, rows in block["best"]]
                found = search(tree, block["v"], block["rows"], k, block["best"])
                if home:
                    block["best"] = found
                    values = [[batch.column(c)[i].as_py()] for c in ("dim", "block", "shards")] + [[pickle.dumps(block)]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["dim", "block", "shards", "blob"])
                    continue
                columns = [[], [], [], [], []]
                for j, (scores, ids, rows) in enumerate(found):
                    new = np.array([r not in before[j] for r in rows.tolist()], bool)
                    for c, v in zip(columns, (np.full(new.sum(), block["rows"][j]), np.full(new.sum(), block["ids"][j]), ids[new], rows[new], scores[new])):
                        c.append(v)
                if columns[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in columns], ["query_row", "query_id", "vec_id", "row", "score"])

    def homes(batches):
        return meet(batches, True)

    def others(batches):
        return meet(batches, False)

    def listed(batches):
        for batch in batches:
            for blob in batch.column("blob").to_pylist():
                block = pickle.loads(blob)
                for j, (scores, ids, rows) in enumerate(block["best"]):
                    same = np.full(len(ids), 0)
                    yield pa.RecordBatch.from_arrays([pa.array((c + same).astype(np.int64)) for c in (block["rows"][j], block["ids"][j], ids, rows, scores)], ["query_row", "query_id", "vec_id", "row", "score"])

    tree = trees.withColumnRenamed("blob", "tree")
    first = blocks.withColumn("shard", F.col("block") % F.col("shards")).join(tree, ["dim", "shard"])
    known = materialise(first.mapInArrow(homes, "dim int, block int, shards int, blob binary"), "known")
    rest = F.explode(F.filter(F.sequence(F.lit(0), F.col("shards") - 1), lambda s: s != F.col("block") % F.col("shards")))
    pairs = known.withColumn("shard", rest).join(tree, ["dim", "shard"])
    hits = pairs.mapInArrow(others, HITS).unionByName(known.mapInArrow(listed, HITS))
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    ranked = hits.repartition(partitions(vectors), "query_row").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
