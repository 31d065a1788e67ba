"""Per-series monthly forecasts, backtests and series assembly.

A series is at most a few hundred months, so fits are plain aggregates and steps are one explode per series.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow.functions import dates, numeric
from parcelflow.operators import aggregates, impute, linear, panel
from parcelflow.session import materialise

Forecaster = Callable[[DataFrame, str, str, str, int], DataFrame]

_EPOCH = "2000-01-01"
ROWS_PER_FEATURE = 10


def gridded(series: DataFrame, key: str, month: str, price: str) -> DataFrame:
    """Series on their month grid with interpolated prices; filled months are marked."""
    full = panel.on_grid(series.select(key, month, price), key, month)
    full = full.withColumn("is_imputed", F.col(price).isNull())
    return panel.interpolate(full, key, month, price)


def trend(series: DataFrame, key: str, month: str, price: str, steps: int = fv.HORIZON) -> DataFrame:
    """Log-linear trend per series, continued for the given number of months."""
    t = dates.month_diff(F.col(month), F.lit(_EPOCH).cast("date")).cast("double")
    log_price = numeric.log_price(F.col(price))
    fit = series.where(F.col(price).isNotNull()).groupBy(key).agg(
        F.regr_slope(log_price, t).alias("_b"), F.regr_intercept(log_price, t).alias("_a"), F.max(month).alias("_last")
    )
    ahead = fit.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(steps)))).withColumn(month, F.add_months("_last", F.col("_step")))
    return ahead.select(key, month, F.exp(F.col("_a") + F.col("_b") * t).alias("prediction"))


def seasonal_naive(series: DataFrame, key: str, month: str, price: str, steps: int = fv.HORIZON) -> DataFrame:
    """The latest known price of the same calendar month, else the last known price: every month ahead has a row."""
    known = series.where(F.col(price).isNotNull())
    last = known.groupBy(key).agg(F.max(month).alias("_last"), F.max_by(price, month).alias("_price"))
    ahead = last.withColumn("_step", F.explode(F.sequence(F.lit(1), F.lit(steps)))).withColumn(month, F.add_months("_last", F.col("_step")))
    by_season = known.groupBy(key, F.month(month).alias("_m")).agg(F.max_by(price, month).alias("prediction"))
    both = ahead.withColumn("_m", F.month(month)).join(by_season, [key, "_m"], "left")
    return both.select(key, month, F.coalesce("prediction", "_price").alias("prediction"))


def custom(fn: Callable[[pd.DataFrame], pd.DataFrame], key_type: str = "string") -> Forecaster:
    """Forecaster from a function over one series as a pandas frame (key, month, price) -> (key, month, prediction).

    A series is bounded by its months, so one group is one small frame.
    """

    def run(series: DataFrame, key: str, month: str, price: str, steps: int = fv.HORIZON) -> DataFrame:
        schema = f"{key} {key_type}, {month} date, prediction double"
        return series.select(key, month, price).groupBy(key).applyInPandas(lambda pdf: fn(pdf.sort_values(month)), schema)

    return run


def panel_regression(covariates: list[str] = (), lags: int = 2, ridge: float = 0.01) -> Forecaster:
    """Forecaster from one regression over all series: a month's log return on the returns of the months before it and on
    covariates of the month before, such as shares and market moves.

    The regression is least squares on sums over all rows, so series are read once however many there are, with a light ridge that settles it when
    features are alike; fewer than ROWS_PER_FEATURE rows for each feature tell nothing, and prices stay. Each step ahead uses
    the predicted returns as lags; covariates stay at each series' last known values. Rows that lack any feature are not fitted on; a series
    without a known return or covariate goes on from 0 there. Months of a series are taken in order, gaps do not count.
    """

    def run(series: DataFrame, key: str, month: str, price: str, steps: int = fv.HORIZON) -> DataFrame:
        w = Window.partitionBy(key).orderBy(month)
        known = series.where(F.col(price).isNotNull()).select(
            F.col(key).alias("_key"), F.col(month).alias("_month"), numeric.log_price(F.col(price)).alias("_lp"),
            *(F.last(F.col(c).cast("double"), True).over(w).alias(f"_x{i}") for i, c in enumerate(covariates)))
        own = Window.partitionBy("_key").orderBy("_month")
        rows = known.withColumn("_r", F.col("_lp") - F.lag("_lp").over(own))
        features = [F.lag("_r", k).over(own) for k in range(1, lags + 1)] + [F.lag(f"_x{i}").over(own) for i in range(len(covariates))]
        rows = rows.withColumns({f"_f{i}": f for i, f in enumerate(features)})
        entries = F.array(*(F.struct(F.lit(i).alias("slot"), F.col(f"_f{i}").alias("x")) for i in range(len(features))))
        fitted = rows.dropna(subset=["_r", *(f"_f{i}" for i in range(len(features)))])
        fitted = fitted.select(F.lit(0).alias("_all"), F.lit(0).alias("_fold"), "_r", entries.alias("_entries"))
        sums = materialise(linear.sums_of_products(fitted, "_all", "_fold", "_r"), "panel-sums")
        enough = F.coalesce(sums.where((F.col("i") == linear.ONE) & (F.col("j") == linear.ONE)).agg(F.max("s")).scalar() >= ROWS_PER_FEATURE * len(features), F.lit(False))
        fits = linear.fits(sums, "_all", "_fold", [{"regParam": ridge, "elasticNetParam": 0.0}], 1)
        model = materialise(fits.where(F.col("_fold") == linear.ALL_FOLDS).select(F.struct("intercept", "coefficients").alias("m")), "panel-fit").scalar()

        past = F.array(F.coalesce("_r", F.lit(0.0)), *(F.coalesce(f"_f{i}", F.lit(0.0)) for i in range(lags - 1)))
        state = F.struct("_lp", past.alias("past"), F.array(*(F.coalesce(f"_x{i}", F.lit(0.0)) for i in range(len(covariates))) or [F.lit(0.0)]).alias("x"))
        last = rows.groupBy("_key").agg(F.max("_month").alias("_last"), F.max_by(state, "_month").alias("_s")).withColumn("_m", F.when(enough, model))
        weight = lambda i: F.coalesce(F.col("_m.coefficients")[i], F.lit(0.0))
        fixed = F.coalesce("_m.intercept", F.lit(0.0))
        for i in range(len(covariates)):
            fixed = fixed + weight(lags + i) * F.col("_s.x")[i]

        def step(acc, _):
            r = F.col("_fixed")
            for k in range(lags):
                r = r + weight(k) * acc["past"][k]
            now = acc["lp"] + r
            return F.struct(now.alias("lp"), F.concat(F.array(r), F.slice(acc["past"], 1, lags - 1)).alias("past"), F.concat(acc["path"], F.array(now)).alias("path"))

        start = F.struct(F.col("_s._lp").alias("lp"), F.col("_s.past").alias("past"), F.array().cast("array<double>").alias("path"))
        ahead = last.withColumn("_fixed", fixed).withColumn("_path", F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step, lambda acc: acc["path"]))
        return ahead.select("_key", "_last", F.posexplode("_path").alias("_at", "_now")).select(
            F.col("_key").alias(key), F.add_months("_last", F.col("_at") + 1).alias(month), F.exp("_now").alias("prediction"))

    return run


FORECASTERS: dict[str, Forecaster] = {"trend": trend, "seasonal_naive": seasonal_naive, "panel_regression": panel_regression()}


def _forecaster(method: str | Forecaster) -> Forecaster:
    return FORECASTERS[method] if isinstance(method, str) else method


def forecast(series: DataFrame, key: str, month: str, price: str, steps: int = fv.HORIZON, method: str | Forecaster = "trend") -> DataFrame:
    """(key, month, prediction, growth against the step before). method is a name of FORECASTERS or a forecaster itself."""
    ahead = _forecaster(method)(series, key, month, price, steps)
    return panel.growth_vs_history(ahead, series, key, month, "prediction", price)


def backtest(series: DataFrame, key: str, month: str, price: str, periods: int = fv.BACKTEST_MONTHS, method: str | Forecaster = "trend") -> DataFrame:
    """Errors per series on the held-out last months. Fits see the months up to the cutoff and nothing else."""
    marked = impute.split_backtest(series, key, month, periods)
    guess = _forecaster(method)(marked.where("split = 'train'"), key, month, price, periods)
    truth = marked.where("split = 'test'").select(key, month, F.col(price).alias("truth"))
    return aggregates.error_metrics(truth.join(guess, [key, month]), key, "truth", "prediction")


def select_best(metrics: DataFrame, key: str, score: str = "mape", name: str = "algorithm") -> DataFrame:
    """The full metric row of the best algorithm per key (lowest score, ties by name).

    Only algorithms that were judged on as many rows as any other of the key are compared, if metrics tell that in `n`.
    """
    rest = [c for c in metrics.columns if c != key]
    known = metrics.where(F.col(score).isNotNull())
    if "n" in metrics.columns:
        most = known.groupBy(key).agg(F.max("n").alias("n"))
        known = known.join(most, [key, "n"], "left_semi")
    best = known.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(score, name)).alias("_best"))
    return best.select(key, *(F.col(f"_best.{c}").alias(c) for c in rest))


def splice(history: DataFrame, ahead: DataFrame, base: Column | None = None, price: str = "median_price") -> DataFrame:
    """History and forecast as one series; forecast price is base x growth factor, else the prediction, else the base."""
    options = []
    if "growth_factor" in ahead.columns and base is not None:
        options.append(base * F.col("growth_factor"))
    if "predictions" in ahead.columns:
        options.append(F.col("predictions"))
    if base is not None:
        options.append(base)
    ahead = ahead.withColumn(price, F.coalesce(*options)).select(*history.columns)
    return history.unionByName(ahead)


def series_arrays(
    df: DataFrame, key: str, month: str, values: dict[str, tuple[Column, Column]], extra: list[Column] = ()
) -> DataFrame:
    """One row per key with, for each output, the ordered array of {timestamp, value} over the rows that match.

    values: output -> (value column, row condition); extra: further named aggregates. A series is bounded by its months.
    """
    point = lambda c: F.struct(F.date_format(month, "yyyy-MM-dd").alias("timestamp"), F.round(c, 2).alias("value"))
    return df.groupBy(key).agg(
        *(F.array_sort(F.collect_list(F.when(cond, point(c)))).alias(out) for out, (c, cond) in values.items()),
        *extra,
    )
