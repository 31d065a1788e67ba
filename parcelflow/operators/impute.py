"""Imputation and the splits of the modelling tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow.functions import dates
from parcelflow.operators import joins, panel


def fill_from_group(df: DataFrame, order: list[str], building: str = "building_name_en", project: str = "project_name_en") -> DataFrame:
    """Missing values take the first one known in the same building or project: one aggregate per group key.

    Both aggregates start from df itself, so neither waits for the other's join.
    """
    base = df
    for key, cols in ((building, fv.BUILDING_FILL), (project, fv.PROJECT_FILL)):
        cols = [c for c in cols if c in base.columns]
        if cols:
            df = joins.fill_from(df, joins.first_known(base, key, cols, order), key, cols)
    return df


def daily_quotes(quotes: DataFrame, key: str = "asset", date: str = "date") -> DataFrame:
    """Quotes on every calendar day between a series' first and last, gaps interpolated."""
    span = quotes.groupBy(key).agg(F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    days = span.select(key, F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 day"))).alias(date))
    full = days.join(quotes, [key, date], "left")
    for c in ("close", "volume"):
        full = panel.interpolate(full, key, date, c)
    return full


def split_last_month(df: DataFrame, segment: str, date: str) -> DataFrame:
    """Rows marked 'test' (latest calendar month of their segment) or 'train' (before the first test row).

    Segments with one month only have nothing to train on and are dropped. Bounds come from one row per segment and month.
    """
    months = df.where(F.col(date).isNotNull()).groupBy(segment, dates.month_start(F.col(date)).alias("_month")).agg(F.min(date).alias("_first"))
    bounds = months.groupBy(segment).agg(F.max_by("_first", "_month").alias("_cut"), F.count("*").alias("_months"))
    from parcelflow.session import materialise

    usable = materialise(bounds.where("_months > 1").select(segment, "_cut"), "split")
    side = F.when(F.col(date) >= F.col("_cut"), "test").otherwise("train")
    return df.join(usable, segment).withColumn("split", side).drop("_cut")


def split_backtest(series: DataFrame, key: str, month: str, periods: int = fv.BACKTEST_MONTHS, last: Column | None = None) -> DataFrame:
    """Rows marked 'train' / 'test' around the global cutoff; series lacking any of the test months are dropped."""
    last = series.agg(F.max(month)).scalar() if last is None else last
    side = F.when(F.col(month) > F.add_months(last, -periods), "test").otherwise("train")
    marked = series.withColumn("split", side)
    tests = F.count_if(F.col("split") == "test").over(Window.partitionBy(key))
    return marked.withColumn("_tests", tests).where(F.col("_tests") == periods).drop("_tests")
