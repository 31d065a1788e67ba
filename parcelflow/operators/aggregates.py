"""Summaries, counts, errors and value domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.functions import dates, numeric, text


def is_missing(c: Column, sentinel: str) -> Column:
    as_text = c.cast("string")
    return c.isNull() | (text.strip(as_text) == "") | (as_text == sentinel)


def missing_counts(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """One row: per column the cells that are null, blank or its sentinel."""
    return df.agg(*(F.count_if(is_missing(F.col(c), f"Missing_{c}")).alias(f"{c}{suffix}") for c in cols))


def error_metrics(pairs: DataFrame, key: str, truth: str, guess: str) -> DataFrame:
    """n, MSE, MAE, MAPE, RMSE and R2 per series; R2 is null for a single row or a constant truth."""
    y, p = F.col(truth), F.col(guess)
    total = F.var_pop(y) * F.count(y)
    agg = pairs.groupBy(key).agg(
        F.count("*").alias("n"), F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"),
        F.avg(numeric.pct_error(y, p)).alias("mape"), F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.sum((y - p) * (y - p)).alias("_res"), total.alias("_tot"),
    )
    return agg.withColumn("r2", F.when((F.col("n") > 1) & (F.col("_tot") > 0), 1 - F.col("_res") / F.col("_tot"))).drop("_res", "_tot")


def top_on_latest_date(df: DataFrame, date: str, area: str, value: str | None, n: int = 5) -> DataFrame:
    """Top areas by summed value (by rows when there is no value column) on the last date of the table."""
    last = df.agg(F.max(date)).scalar()
    amount = F.sum(value) if value else F.count("*")
    sums = df.where(F.col(date) == last).groupBy(area).agg(amount.alias("amount"))
    return sums.orderBy(F.desc("amount"), area).limit(n)


def distinct_counts(df: DataFrame, cols: list[str], approximate: bool = False) -> DataFrame:
    """Row count and distinct values per column. Exact counts are partial aggregates over (column, value)."""
    if approximate:
        return df.agg(F.count("*").alias("rows"), *(F.approx_count_distinct(c).alias(c) for c in cols))
    return df.agg(F.count("*").alias("rows"), *(F.count_distinct(c).alias(c) for c in cols))


def table_profile(df: DataFrame) -> DataFrame:
    """rows, columns and null cells in one pass."""
    nulls = F.lit(0).cast("bigint")
    for c in df.columns:
        nulls = nulls + F.count_if(F.col(f"`{c}`").isNull())
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"), nulls.alias("null_cells"))


def value_domain(df: DataFrame, area: str, features: list[str], first: int = 10) -> DataFrame:
    """Long table (area, feature, place, value): the first sorted distinct values of each feature.

    Numbers sort by value, texts alphabetically. Distinct values are counted before they are ranked and the rank is limited before the shuffle, so no task ever
    holds all values of an area.
    """
    as_text = df.select(area, *(F.col(c).cast("string").alias(c) for c in features))
    seen = as_text.unpivot([area], features, "feature", "value").where(F.col("value").isNotNull()).distinct()
    numbers = [c for c, t in df.select(*features).dtypes if t != "string"]
    size = F.when(F.col("feature").isin(numbers), F.col("value").try_cast("double")) if numbers else F.lit(None)
    place = F.row_number().over(Window.partitionBy(area, "feature").orderBy(size, "value"))
    return seen.withColumn("place", place).where(F.col("place") <= first)


def value_ranges(df: DataFrame, area: str, features: list[str], size: str, first: int = 10) -> DataFrame:
    """One row per area: a short array per feature and the smallest and largest unit."""
    listed = value_domain(df, area, features, first)
    arrays = listed.groupBy(area).agg(
        *(
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("feature") == f, F.struct("place", "value")))), lambda s: s["value"]
            ).alias(f)
            for f in features
        )
    )
    sizes = df.groupBy(area).agg(F.min(size).alias(f"{size}_min"), F.max(size).alias(f"{size}_max"))
    return sizes.join(arrays, area, "left")


def last_month(df: DataFrame, date: str) -> DataFrame:
    return df.agg(dates.month_end(F.max(date)).alias("pivot_month"))


def freshness(tables: dict[str, tuple[DataFrame, str]], pivot: Column) -> DataFrame:
    """Per dependent table: first and last month and how many months it lags behind the pivot."""
    out = None
    for name, (df, date) in tables.items():
        row = df.agg(
            F.lit(name).alias("table_name"), dates.month_end(F.min(date)).alias("first_month"), dates.month_end(F.max(date)).alias("last_month")
        )
        out = row if out is None else out.unionByName(row)
    return out.withColumn("lag_months", dates.month_diff(pivot, F.col("last_month")))


def model_summary(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.count("*").alias("areas"), F.avg("r2").alias("mean_r2"), F.avg("mape").alias("mean_mape"), F.avg("mae").alias("mean_mae"))
