"""Drift of columns against a reference: population stability over buckets frozen from the reference's quantiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.operators.quantiles import column_quantiles
from parcelflow.session import materialise

BUCKETS = 10
SMOOTHING = 0.5  # rows added to each bucket of both sides, so that an empty one has a share


def frozen_edges(reference: DataFrame, cols: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(column, edges): the inner quantiles of each column of the reference, in order and once each. Nulls do not count."""
    specs = {f"{c}|{k}": (c, k / buckets) for c in cols for k in range(1, buckets)}
    row = column_quantiles(reference.select(*cols), specs)
    each = [F.struct(F.lit(c).alias("column"), F.array_distinct(F.filter(F.array(*(F.col(f"`{c}|{k}`") for k in range(1, buckets))), lambda e: e.isNotNull())).alias("edges")) for c in cols]
    return row.select(F.explode(F.array(*each)).alias("e")).select("e.*")


def bucket_counts(df: DataFrame, edges: DataFrame, cols: list[str], period: Column) -> DataFrame:
    """(column, period, bucket, n): values up to the first edge are bucket 0, above the last the last; nulls are a bucket of their own (-1)."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols)))
    long = df.select(period.alias("period"), cells.alias("c")).select("period", "c.*").join(F.broadcast(edges), "column")  # one row per column
    bucket = F.when(F.col("value").isNull(), -1).otherwise(F.size(F.filter("edges", lambda e: e < F.col("value"))))
    return long.groupBy("column", "period", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def stability(reference: DataFrame, current: DataFrame, cols: list[str], period: Column, buckets: int = BUCKETS) -> DataFrame:
    """(column, period, rows, psi) of each period of current against the whole reference.

    psi is the sum over buckets of (q - p) ln(q / p) with shares p of the reference and q of the period, SMOOTHING rows added to each bucket
    on both sides. Buckets are those that the frozen edges make, and one for nulls.
    """
    edges = materialise(frozen_edges(reference, cols, buckets), "edges")
    before = bucket_counts(reference, edges, cols, F.lit(0)).drop("period").withColumnRenamed("n", "n_ref")
    now = materialise(bucket_counts(current, edges, cols, period), "buckets")
    every = edges.select("column", F.explode(F.sequence(F.lit(-1), F.size("edges"))).alias("bucket")).join(before, ["column", "bucket"], "left")
    every = materialise(every.select("column", "bucket", F.coalesce("n_ref", F.lit(0)).alias("n_ref")), "reference-buckets")
    full = now.select("column", "period").distinct().join(every, "column").join(now, ["column", "period", "bucket"], "left")
    full = full.withColumn("n", F.coalesce("n", F.lit(0)))
    sums = full.groupBy("column", "period").agg(F.sum("n").alias("rows"), F.sum("n_ref").alias("rows_ref"), F.count("*").alias("k"))
    shares = full.join(materialise(sums, "sums"), ["column", "period"]).select(
        "column", "period", "rows", ((F.col("n") + SMOOTHING) / (F.col("rows") + SMOOTHING * F.col("k"))).alias("q"),
        ((F.col("n_ref") + SMOOTHING) / (F.col("rows_ref") + SMOOTHING * F.col("k"))).alias("p"))
    return shares.groupBy("column", "period").agg(F.max("rows").alias("rows"), F.sum((F.col("q") - F.col("p")) * F.ln(F.col("q") / F.col("p"))).alias("psi"))
