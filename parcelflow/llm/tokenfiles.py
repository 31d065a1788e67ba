"""Token ids of whole documents in binary files of independently coded, checksummed blocks.

Documents are range partitioned by id and sorted; each task encodes its documents and fills blocks of about BLOCK_IDS ids,
always with whole documents. A file is a Parquet file of such blocks, so Spark's writers commit it on any store and lost
tasks leave nothing behind: `place` orders the blocks, `docs` and `lengths` say which documents they hold, and `block` is
the coded stream of parcelflow.llm.coder. Reading needs no tokenizer.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm import coder
from parcelflow.llm.common import ROW_BITS, partitions, slices, text_batches
from parcelflow.llm.tokens import Encoder
from parcelflow.session import materialise

BLOCK_IDS = 1 << 22
FILE = "docs array<bigint>, lengths array<bigint>, n_ids bigint, block binary"


def write(docs: DataFrame, path: str, tokenizer: str, vocab: int, cut: str = "white", end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every text (null: none), each followed by end_id, in ascending order of the id (null first).

    Rows of equal ids follow a hash of their texts. vocab bounds the ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.kept(tokenizer, cut)
        names, parts, held = [], [], 0

        def block():
            ids = np.concatenate(parts)
            lengths = [len(p) for p in parts]
            kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary())
            columns = [pa.array([v], k) for v, k in zip((names, lengths, len(ids), coder.encode(ids, vocab)), kinds)]
            return pa.RecordBatch.from_arrays(columns, ["docs", "lengths", "n_ids", "block"])

        for batch in slices(batches, "t", 1 << 22):
            every, offsets = encoder.closed(batch.column("t"), end_id)
            ends = offsets.tolist()
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), ends, ends[1:]):
                names.append(doc)
                parts.append(every[a:b])
                held += b - a
                if held >= BLOCK_IDS:
                    yield block()
                    names, parts, held = [], [], 0
        if names:
            yield block()

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("hash"), F.monotonically_increasing_id().alias("tie"), F.col(text_col).cast("string").alias("t"))
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "hash", "tie")]
    placed = rows.repartitionByRange(partitions(docs), *order).sortWithinPartitions(*order).select("doc_id", "t")
    with text_batches(docs.sparkSession):
        placed.mapInArrow(run, FILE).withColumn("place", F.monotonically_increasing_id()).write.parquet(path)


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document, decoded and checked; start is the number of ids of all documents before it."""
    return _decoded(spark, path, "doc_id bigint, start bigint, ids array<int>", lambda ids: pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))


def checksums(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from its decoded ids as little-endian unsigned 32-bit integers."""
    out = _decoded(spark, path, "doc_id bigint, start bigint, made struct<n_tokens:bigint,ids_crc32:bigint>",
                   lambda ids: pa.array([{"n_tokens": len(x), "ids_crc32": zlib.crc32(x.astype("<u4").tobytes())} for x in ids], pa.struct([("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])))
    return out.select("doc_id", "start", "made.n_tokens", "made.ids_crc32")


def _decoded(spark, path: str, schema: str, made) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, lengths, start, block in zip(*(batch.column(c) for c in ("docs", "lengths", "start", "block"))):
                ids = coder.decode(block.as_py())
                ends = np.cumsum(lengths.values.to_numpy())
                if len(ends) and ends[-1] != len(ids):
                    raise ValueError("a block holds another number of ids than its documents")
                starts = np.concatenate(([0], ends[:-1]))
                for i in range(0, len(ends), 4096):
                    some = [ids[a:b] for a, b in zip(starts[i : i + 4096], ends[i : i + 4096])]
                    yield pa.RecordBatch.from_arrays([docs.values[i : i + 4096], pa.array(starts[i : i + 4096] + start.as_py()), made(some)], names)

    blocks = spark.read.parquet(path)
    task = F.shiftright("place", ROW_BITS)
    sizes = blocks.select("place", task.alias("task"), "n_ids")
    tasks = sizes.groupBy("task").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("task").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    starts = sizes.join(bases, "task").select("place", (F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("start"))
    return blocks.join(materialise(starts, "starts"), "place").mapInArrow(run, schema)
