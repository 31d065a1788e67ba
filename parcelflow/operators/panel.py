"""Month panels: aggregation of facts, and ordered analytics on the small monthly series that result.

Windows here run over one series at a time, which is bounded by its number of months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from parcelflow.functions import dates, numeric, text
from parcelflow.operators.quantiles import group_quantiles


def month_panel(
    df: DataFrame, area: str = "area_name_en", date: str = "instance_date", price: str = "meter_sale_price",
    flags: list[str] = (), closes: list[str] = (), max_group_rows: int | None = None,
) -> DataFrame:
    """Per (area, month): median price, row count and its log, share of each flag, median of each market close."""
    src = df.select(area, dates.month_start(F.col(date)).alias("month"), price, *flags, *closes)
    specs = {"monthly_price": (price, 0.5), **{c: (c, 0.5) for c in closes}}
    if closes:
        src = src.withColumnsRenamed({c: f"_{c}" for c in closes})
        specs = {"monthly_price": (price, 0.5), **{c: (f"_{c}", 0.5) for c in closes}}
    extra = [
        F.count("*").alias("txn_count"), F.log1p(F.count("*")).alias("log_txn_count"),
        *(F.avg(f).alias(f"pct_{f}") for f in flags),
    ]
    return group_quantiles(src, [area, "month"], specs, extra, max_group_rows)


def smoothed_shares(df: DataFrame, area: str, date: str, categories: list[str]) -> DataFrame:
    """Long table (area, month, feature, category, share) with share = (n + 1) / (rows + distinct categories).

    Rows without a category count in the total; distinct counts the categories seen in that area and month.
    """
    src = df.select(area, dates.month_start(F.col(date)).alias("month"), *(F.col(c).cast("string").alias(c) for c in categories))
    long = src.unpivot([area, "month"], categories, "feature", "category")
    counts = long.groupBy(area, "month", "feature", "category").agg(F.count("*").alias("n"))
    group = Window.partitionBy(area, "month", "feature")
    share = (F.col("n") + 1) / (F.sum("n").over(group) + F.count("category").over(group))
    return counts.withColumn("share", share).where(F.col("category").isNotNull()).drop("n")


def share_columns(shares: DataFrame, area: str, names: list[str]) -> DataFrame:
    """The long shares as one column per named category, 0 where absent."""
    name = F.concat(F.lit("pct_"), F.col("feature"), F.lit("_"), text.share_name(F.col("category")))
    wide = shares.withColumn("_name", name).groupBy(area, "month").pivot("_name", names).agg(F.max("share"))
    return wide.na.fill(0.0, subset=names)


def by_month(area: str = "area_name_en", month: str = "month") -> WindowSpec:
    return Window.partitionBy(area).orderBy(month)


def next_return(panel: DataFrame, area: str = "area_name_en") -> DataFrame:
    """log_price and the log return of the following month."""
    panel = panel.withColumn("log_price", numeric.log_price(F.col("monthly_price")))
    ahead = F.lead("log_price").over(by_month(area)) - F.col("log_price")
    return panel.withColumn("future_log_return_1m", ahead)


def lagged_returns(panel: DataFrame, area: str = "area_name_en") -> DataFrame:
    """The two previous values of the next-month return; rows lacking any of the three are dropped."""
    w = by_month(area)
    panel = panel.withColumns({f"lag_{k}_return": F.lag("future_log_return_1m", k).over(w) for k in (1, 2)})
    return panel.dropna(subset=["future_log_return_1m", "lag_1_return", "lag_2_return"])


def pct_change(c: str, w: WindowSpec) -> Column:
    """Change against the previous row, with gaps bridged by the last known value."""
    known = F.last(c, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    before = F.last(c, True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return known / before - 1


def rolling(df: DataFrame, c: str, w: WindowSpec, mean: str, std: str, rows: int = 3) -> DataFrame:
    """Mean and sample deviation of the last rows; a deviation of one value is null."""
    frame = w.rowsBetween(-(rows - 1), 0)
    return df.withColumns({mean: F.avg(c).over(frame), std: F.stddev_samp(c).over(frame)})


def asset_moves(panel: DataFrame, assets: list[str], area: str = "area_name_en") -> DataFrame:
    """Per asset: change of the monthly close, its 3-month mean and volatility."""
    w = by_month(area)
    for a in assets:
        panel = panel.withColumn(f"{a}_return", pct_change(f"{a}_close", w))
        panel = rolling(panel, f"{a}_return", w, f"{a}_return_3m", f"{a}_vol_3m")
    return panel


def month_grid(df: DataFrame, key: str, month: str = "month", start: str | None = None, end: str | None = None) -> DataFrame:
    """Every month start between the first and last month of each series (or between fixed bounds)."""
    span = df.groupBy(key).agg(F.min(month).alias("_lo"), F.max(month).alias("_hi"))
    lo = F.lit(start).cast("date") if start else F.col("_lo")
    hi = F.lit(end).cast("date") if end else F.col("_hi")
    return span.select(key, F.explode(F.sequence(lo, hi, F.expr("interval 1 month"))).alias(month))


def on_grid(df: DataFrame, key: str, month: str = "month", start: str | None = None, end: str | None = None) -> DataFrame:
    """Series laid on its month grid; inserted months carry nulls."""
    return month_grid(df, key, month, start, end).join(df, [key, month], "left")


def interpolate(df: DataFrame, key: str | list[str], order: str, c: str, out: str | None = None) -> DataFrame:
    """Linear interpolation between known neighbours by position, flat beyond the first and last known value."""
    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(order)
    known = F.when(F.col(c).isNotNull(), F.struct(F.col("_i").alias("i"), F.col(c).alias("v")))
    df = df.withColumn("_i", F.row_number().over(w))
    df = df.withColumns({
        "_prev": F.last(known, True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "_next": F.first(known, True).over(w.rowsBetween(0, Window.unboundedFollowing)),
    })
    p, n = F.col("_prev"), F.col("_next")
    step = (n["v"] - p["v"]) * (F.col("_i") - p["i"]) / (n["i"] - p["i"])
    value = F.when(F.col(c).isNotNull(), F.col(c)).when(p.isNull(), n["v"]).when(n.isNull(), p["v"]).otherwise(p["v"] + step)
    return df.withColumn(out or c, value).drop("_i", "_prev", "_next")


def fill_both_ways(c: str, w: WindowSpec) -> Column:
    """Last known value, else the next known one."""
    back = F.last(c, True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(c, True).over(w.rowsBetween(0, Window.unboundedFollowing))
    return F.coalesce(back, ahead)


def growth_vs_history(forecast: DataFrame, history: DataFrame, key: str, month: str, guess: str, price: str) -> DataFrame:
    """Percent growth per step; the first step is measured against the last known price of the series."""
    last = history.where(F.col(price).isNotNull()).groupBy(key).agg(F.max_by(price, month).alias("_last"))
    base = F.coalesce(F.lag(guess).over(Window.partitionBy(key).orderBy(month)), F.col("_last"))
    grown = forecast.join(last, key, "left").withColumn("_growth", (F.col(guess) / base - 1) * 100)
    return grown.withColumnRenamed("_growth", "predicted_mom_growth_pct").drop("_last")


def rebased(df: DataFrame, key: str, month: str, adj: str, pivot: Column, pivot_price: Column) -> DataFrame:
    """After the pivot month: pivot price times the growth of an outside series (missing values read 0).

    The steps telescope to value / base, where base is the value at the pivot if positive, else the first positive value
    after it. Months before the base keep the pivot price; a value of 0 after the base ends the series at 0.
    """
    df = df.where(F.col(month) >= pivot).withColumn("_v", F.coalesce(F.col(adj), F.lit(0.0)))
    whole = Window.partitionBy(key)
    base_month = F.min(F.when(F.col("_v") > 0, F.col(month))).over(whole)
    base = F.min_by("_v", F.when(F.col("_v") > 0, F.col(month))).over(whole)
    df = df.withColumns({"_base_month": base_month, "_base": base})
    so_far = whole.orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    ended = F.max(((F.col(month) > F.col("_base_month")) & (F.col("_v") <= 0)).cast("int")).over(so_far)
    price = (
        F.when(F.col("_base_month").isNull() | (F.col(month) < F.col("_base_month")), pivot_price)
        .when(ended == 1, F.lit(0.0)).otherwise(pivot_price * F.col("_v") / F.col("_base"))
    )
    return df.withColumn("rebased_price", price).where(F.col(month) > pivot).drop("_v", "_base", "_base_month")


def clamp_last_step(
    df: DataFrame, key: str, month: str, price: str, pivot: Column, max_change: float = 0.05, clamp_to: float = 0.0425
) -> DataFrame:
    """If the last historic step moved more than max_change, rescale that month and all later ones to clamp_to."""
    w = Window.partitionBy(key)
    past = F.when(F.col(month) <= pivot, F.col(month))
    df = df.withColumn("_last_month", F.max(past).over(w))
    earlier = F.when(F.col(month) < F.col("_last_month"), F.col(month))
    df = df.withColumns({
        "_last": F.max(F.when(F.col(month) == F.col("_last_month"), F.col(price))).over(w),
        "_prev": F.max_by(F.when(earlier.isNotNull(), F.struct(F.col(price).alias("v"))), earlier).over(w)["v"],
    })
    change = (F.col("_last") - F.col("_prev")) / F.col("_prev")
    target = F.col("_prev") * (1 + F.signum(change) * clamp_to)
    factor = F.when((F.col("_prev") != 0) & (F.col("_last") != 0) & (F.abs(change) > max_change), target / F.col("_last"))
    later = F.col(month) >= F.col("_last_month")
    scaled = F.col(price) * F.when(later, F.coalesce(factor, F.lit(1.0))).otherwise(F.lit(1.0))
    return df.withColumn(price, scaled).drop("_last_month", "_last", "_prev")


def pivot_chain(df: DataFrame, key: str, month: str, price: str, adj: str, pivot: Column) -> DataFrame:
    """From the pivot month on: macro price is the last known price, news price scales it by the step of adj.

    Growth is relative, so a price of 0 stays 0.
    """
    after = df.where(F.col(month) >= pivot)
    w = Window.partitionBy(key).orderBy(month)
    before = F.lag(adj).over(w)
    step = F.when(F.col(adj).isNotNull() & before.isNotNull() & (before != 0), F.col(adj) / before - 1).otherwise(0.0)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    zero = F.max((F.col(price) == 0).cast("int")).over(so_far) == 1
    macro = F.when(zero, F.lit(0.0)).otherwise(F.last(price, True).over(so_far))
    after = after.withColumns({"macro_forecast": macro, "_step": step})
    return after.withColumn("news_adjusted_forecast", F.col("macro_forecast") * (1 + F.col("_step"))).drop("_step")


def compound_chain(df: DataFrame, key: str, month: str, price: str, growth: str, pivot: Column) -> DataFrame:
    """From the pivot month on: compound the given growth; a month without growth restarts from its raw step.

    A restart month keeps the raw price ratio, so a segment is one anchor price times the running product of growth.
    Growth of -100 % or less, or a price of 0, leaves 0 from there on.
    """
    w = Window.partitionBy(key).orderBy(month)
    df = df.where(F.col(month) >= pivot)
    anchor = (F.row_number().over(w) == 1) | F.col(growth).isNull()
    df = df.withColumn("_anchor", anchor)
    df = df.withColumn("_seg", F.sum(F.col("_anchor").cast("int")).over(w))
    inside = Window.partitionBy(key, "_seg").orderBy(month)
    rate = F.when(F.col("_anchor"), 0.0).otherwise(F.col(growth))
    logs = F.sum(F.when(rate > -1, F.ln(1 + rate)).otherwise(0.0)).over(inside)
    dead = F.max((rate <= -1).cast("int")).over(inside)
    start = F.first(price).over(inside)
    df = df.withColumn("_value", F.when(dead == 1, 0.0).otherwise(start * F.exp(logs)))
    zero = F.max((F.col("_value") == 0).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    value = F.when(zero == 1, F.lit(0.0)).otherwise(F.col("_value"))
    return df.withColumn("macro_forecast", value).drop("_anchor", "_seg", "_value")


def pivot_price(df: DataFrame, key: str, month: str, price: str, pivot: Column, today: Column) -> DataFrame:
    """(key, pivot month, pivot price, reason) by falling back from the pivot month itself to the last known price at
    or before it, then to the current month, then to the last known price at or before the current month."""
    at = lambda cond: F.max_by(price, F.when(cond & F.col(price).isNotNull(), F.col(month)))
    when = lambda cond: F.max(F.when(cond & F.col(price).isNotNull(), F.col(month)))
    m = F.col(month)
    tiers = [("pivot", m == pivot), ("last_before", m <= pivot), ("current", m == today), ("filled", m <= today)]
    best = df.groupBy(key).agg(
        *(at(cond).alias(f"_p_{n}") for n, cond in tiers), *(when(cond).alias(f"_m_{n}") for n, cond in tiers)
    )
    best = best.withColumn("_m_filled", F.when(F.col("_m_filled").isNotNull(), today))
    reason = F.coalesce(*(F.when(F.col(f"_m_{n}").isNotNull(), F.lit(n)) for n, _ in tiers))
    return best.select(
        key, F.coalesce(*(F.col(f"_m_{n}") for n, _ in tiers)).alias("pivot_month"),
        F.coalesce(*(F.col(f"_p_{n}") for n, _ in tiers)).alias("pivot_price"), reason.alias("reason"),
    )


def last_nonzero(df: DataFrame, key: str, month: str, c: str) -> DataFrame:
    """Latest non-zero value per key, 0 when there is none."""
    known = F.when(F.col(c) != 0, F.col(month))
    return df.groupBy(key).agg(F.coalesce(F.max_by(c, known), F.lit(0.0)).alias(c))
