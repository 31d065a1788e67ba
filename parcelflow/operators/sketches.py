"""Mergeable summaries, for callers that choose speed over exactness: quantile and distinct-count sketches that are stored
per period and rolled up for any span without reading the facts again. Exact answers stay the default elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 800  # size of a quantile sketch
LG_K = 12  # logarithm of the size of a distinct-count sketch


def rank_error(k: int = K) -> float:
    """Largest error of a rank, as a share of the rows, that a quantile sketch of size k keeps in 99 of 100 cases."""
    return 2.296 / k**0.9723


def distinct_error(lg_k: int = LG_K) -> float:
    """Relative error of a distinct count that a sketch keeps in 99 of 100 cases (three standard errors)."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def quantile_sketches(df: DataFrame, keys: list[str], value: str, k: int = K) -> DataFrame:
    """(keys, sketch, n): one sketch of the non-null values per key, built by partial aggregation, of bounded size whatever the rows."""
    known = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return known.groupBy(*keys).agg(F.kll_sketch_agg_double("_v", k).alias("sketch"), F.count("*").alias("n"))


def rolled_up_quantiles(sketches: DataFrame, keys: list[str], probabilities: dict[str, float], k: int = K) -> DataFrame:
    """(keys, n, a column per probability) over stored sketches of finer keys. A value is one of those seen, at a rank within rank_error."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", k).alias("_s"), F.sum("n").alias("n"))
    return merged.select(*keys, "n", *(F.kll_sketch_get_quantile_double("_s", F.lit(p)).alias(name) for name, p in probabilities.items()))


def distinct_sketches(df: DataFrame, keys: list[str | Column], cols: list[str], lg_k: int = LG_K) -> DataFrame:
    """(keys, a sketch per column): nulls do not count."""
    return df.groupBy(*keys).agg(*(F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(c) for c in cols))


def rolled_up_distinct(sketches: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """(keys, estimated distinct values per column) over stored sketches of finer keys."""
    return sketches.groupBy(*keys).agg(*(F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in cols))
