"""Categories as ordered target statistics: numbers for trees and regressions without a vocabulary on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.operators import blocks as ranges
from parcelflow.session import materialise

WEIGHT = 1.0  # rows that the prior counts for


def ordered_target(
    df: DataFrame, cols: list[str], target: str, order: list[str], prior: float, weight: float = WEIGHT, blocks: int | None = None, suffix: str = "_ts",
) -> DataFrame:
    """df with, for each column, the mean target of the earlier rows of the same category, drawn towards the prior.

    A row's own target and those of later rows never count, so the statistic leaks nothing. order must be total. Rows are dealt into
    ranges of the order; sums inside a range and the sums that a category brings from earlier ranges make up the prefix,
    so no task holds more than a range, whatever a category holds. Missing categories are one; missing targets do not count.
    """
    kept = df.columns
    blocked = ranges.ordered_blocks(df, [], order, blocks)
    y = F.col(target).cast("double")
    for c in cols:
        total, n = f"_sum_{c}", f"_n_{c}"
        before = Window.partitionBy("_block", c).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        inside = blocked.withColumns({total: F.coalesce(F.sum(y).over(before), F.lit(0.0)), n: F.count(y).over(before)})
        upto = Window.partitionBy("_of").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        sums = blocked.groupBy(F.col("_block").alias("_at"), F.col(c).alias("_of")).agg(F.coalesce(F.sum(y), F.lit(0.0)).alias("_s"), F.count(y).alias("_k"))
        carried = sums.select("_at", "_of", F.coalesce(F.sum("_s").over(upto), F.lit(0.0)).alias("_s"), F.coalesce(F.sum("_k").over(upto), F.lit(0)).alias("_k"))
        carried = materialise(carried, "carried")
        same = (F.col("_block") == F.col("_at")) & F.col(c).eqNullSafe(F.col("_of"))
        value = (F.col(total) + F.col("_s") + prior * weight) / (F.col(n) + F.col("_k") + weight)
        blocked = inside.join(carried, same).withColumn(f"{c}{suffix}", value).drop(total, n, "_at", "_of", "_s", "_k")
    return blocked.select(*kept, *(f"{c}{suffix}" for c in cols))


def target_means(df: DataFrame, cols: list[str], target: str, prior: float, weight: float = WEIGHT) -> DataFrame:
    """(column, category, value): the statistic over all rows, for rows that are scored later; unseen categories take the prior."""
    y = F.col(target).cast("double")
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in cols)))
    long = df.select(y.alias("_y"), cells.alias("c")).select("_y", "c.*")
    value = (F.coalesce(F.sum("_y"), F.lit(0.0)) + prior * weight) / (F.count("_y") + weight)
    return long.groupBy("column", "category").agg(value.alias("value"))


def with_target_means(df: DataFrame, means: DataFrame, cols: list[str], prior: float, suffix: str = "_ts") -> DataFrame:
    """df with the statistic of each column's category; unseen ones take the prior."""
    for c in cols:
        own = materialise(means.where(F.col("column") == c).select(F.col("category").alias("_of"), F.col("value").alias("_v")), "means")
        df = df.join(own, F.col(c).cast("string").eqNullSafe(F.col("_of")), "left").withColumn(f"{c}{suffix}", F.coalesce("_v", F.lit(prior))).drop("_of", "_v")
    return df
