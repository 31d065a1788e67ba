"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered in a total order of their own values, so neither files nor partitions matter. Number r of n moves to
p = permute(r), a keyed bijection of 0 .. n-1; its shard is p mod shards and its slot p div shards. Shards therefore
differ by at most one row (law `rows`), and both directions are computable without a table: `places` gives the shard and
slot of a row number, `rows_at` the row number of a shard and slot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import number_rows

ROUNDS = 6
GOLDEN = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> np.ndarray:
    return _mixed(np.array([(seed + (i + 1) * GOLDEN) % 2**64 for i in range(ROUNDS)], np.uint64))


def _network(x: np.ndarray, half: int, keys: np.ndarray, back: bool) -> np.ndarray:
    low = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & low
    for key in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (_mixed(left ^ key) & low), left
        else:
            left, right = right, left ^ (_mixed(right ^ key) & low)
    return (left << np.uint64(half)) | right


def permute(numbers, n: int, seed: int, back: bool = False) -> np.ndarray:
    """Images of numbers under the keyed bijection of 0 .. n-1, or their sources.

    The network acts on the next even number of bits; an image outside 0 .. n-1 is sent through again until it
    falls inside (cycle walking), which takes less than four turns on average.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    keys = _keys(seed)
    out = _network(np.asarray(numbers).astype(np.uint64), half, keys, back)
    while len(outside := np.flatnonzero(out >= np.uint64(n))):
        out[outside] = _network(out[outside], half, keys, back)
    return out.astype(np.int64)


def places(numbers, n: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    at = permute(numbers, n, seed)
    return at % shards, at // shards


def rows_at(shard, slot, n: int, shards: int, seed: int) -> np.ndarray:
    return permute(np.asarray(slot) * shards + np.asarray(shard), n, seed, back=True)


def assign(docs: DataFrame, shards: int = 8, seed: int = 42, order: str = "doc_id") -> DataFrame:
    """All rows and columns of docs with row_no, shard and slot.

    Rows are numbered by `order`, then by a hash of all their columns. Null ids come first, repeated rows take numbers of
    their own, an empty table stays empty. Columns of docs named row_no, shard or slot are replaced.
    """
    kept = [c for c in docs.columns if c not in ("row_no", "shard", "slot")]
    hashed = docs.select(*kept, F.xxhash64(*(F.col(f"`{c}`") for c in kept)).alias("_hash"))
    numbered = number_rows(hashed, [order, "_hash"]).drop("_hash")
    n = numbered.count()

    @F.pandas_udf("bigint")
    def position(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, seed))

    at = numbered.withColumn("_at", position("row_no"))
    shard, slot = (F.col("_at") % shards).cast("int"), F.floor(F.col("_at") / shards).cast("bigint")
    return at.select(*kept, "row_no", shard.alias("shard"), slot.alias("slot"))


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard; each file holds its rows by ascending slot, and the column slot tells the order of all."""
    assigned.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
