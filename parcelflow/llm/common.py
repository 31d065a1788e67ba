"""Helpers shared by the operators: row numbers, components of links, batches of bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.session import input_bytes, materialise

RANGE_BYTES = 128 << 20
ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits and the place in it below


def give_back() -> None:
    """Return freed memory to the system: Python workers are reused, and what one stage held counts against the next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not every C library has it
        pass


def releasing(run):
    """A function over Arrow batches that gives memory back when its task ends."""

    def released(batches):
        yield from run(batches)
        give_back()

    return released


@contextmanager
def text_batches(spark, rows: int = 2000) -> Iterator[None]:
    """Smaller Arrow batches for the actions inside: rows that carry texts are wide, and a batch is held on both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(df: DataFrame) -> int:
    """Ranges to deal df into: enough for each to stem from RANGE_BYTES of input at most, and no fewer than shuffle partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // RANGE_BYTES))


def unused(df: DataFrame, name: str) -> str:
    """The name, or it with underscores behind it, that no column of df has in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def every_column(df: DataFrame) -> list:
    """All columns of df by their exact names, which may hold dots."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def number_rows(df: DataFrame, order: list[str], name: str = "row_no") -> DataFrame:
    """df with gapless numbers from 0 in the order of the given columns, nulls first.

    Rows are range partitioned and sorted, so no task holds more than its range; equal rows are split between
    tasks by their place in the input. The result is stored, since a range is only stable once written.
    """
    by = [F.col(c).asc_nulls_first() for c in order]
    tie = F.col("_tie").asc()
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(partitions(df), *by, tie)
    placed = ranged.sortWithinPartitions(*by, tie).drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    stored = materialise(placed, "numbered")
    block, place = F.shiftright("_at", ROW_BITS), F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    joined = stored.withColumn("_block", block).join(materialise(starts, "starts"), "_block")
    return joined.withColumn(name, F.col("_start") + place).drop("_block", "_start", "_at")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links(a, b); root is the smallest node that can be reached.

    Each round hooks neighbours to the smallest node around them (large star, then small star); links are stored after
    each round, and only their number and a checksum reach the driver. A hub's links stay spread: its minimum is an
    aggregate that is joined back, and the join may be split.
    """
    def hooked(edges: DataFrame, least: DataFrame) -> DataFrame:
        return edges.join(least, "u")

    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = hooked(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialise(large.filter("u <> v").distinct(), "large")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = hooked(large, least).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = materialise(small.select("e.u", "e.v").filter("u <> v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def byte_column(array: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary or string column; null counts as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    kind = pa.large_binary()
    array = array.cast(kind).fill_null(b"") if array.null_count else array.cast(kind)
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]] if len(offsets) else whole[:0], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in runs whose column holds about `most` bytes; a longer value is a run of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = byte_column(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end
