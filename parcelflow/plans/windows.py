"""Queries over ordered analytics."""

from pyspark.sql import functions as F

from parcelflow.functions import dates
from parcelflow.operators import blocks, joins, outliers, panel
from parcelflow.plans.aggregates import TRIM_SQL
from parcelflow.plans.filters import KEYS
from parcelflow.plans.flagship import FLAGSHIP_CTES, area_month_panel, area_return_rows
from parcelflow.plans.joins import ASSETS, CALENDAR_SQL, QUOTES_SQL, quotes
from parcelflow.plans.registry import query
from parcelflow.session import materialise
from parcelflow.sources.bindings import TXN_ORDER, TXN_ORDER_SQL, TXN_SQL, transactions

K = "l_orderkey, l_partkey, l_linenumber"
PIVOT, TODAY = "1999-06-01", "2000-03-01"

# Sparse monthly series: 50 project buckets per area and one of facts without a project, with nullable outside prices and growth.
SERIES_SQL = f"""{TXN_SQL},
ser AS (SELECT concat(area_name_en, '/', coalesce(CAST(project_number % 50 AS string), 'none')) AS series, CAST(date_trunc('month', instance_date) AS DATE) AS month,
  CASE WHEN min(l_linenumber) = 7 THEN NULL ELSE max(meter_sale_price) * 0.7310585786e0 END AS price, CASE WHEN max(l_linenumber) = 7 THEN NULL ELSE min(meter_sale_price) * 0.8807970779e0 END AS adj,
  CASE WHEN min(l_linenumber) < 3 THEN NULL ELSE (max(l_quantity) - 25e0) / 100e0 END AS growth FROM txn GROUP BY 1, 2)"""


def series(spark, sf_dir):
    fields = ["area_name_en", "project_number", "instance_date", "meter_sale_price", "l_linenumber", "l_quantity"]
    facts = transactions(spark, sf_dir, *fields)
    bucket = F.coalesce((F.col("project_number") % 50).cast("string"), F.lit("none"))
    name = F.concat(F.col("area_name_en"), F.lit("/"), bucket).alias("series")
    return facts.groupBy(name, dates.month_start(F.col("instance_date")).alias("month")).agg(
        F.when(F.min("l_linenumber") != 7, F.max("meter_sale_price") * 0.7310585786).alias("price"),
        F.when(F.max("l_linenumber") != 7, F.min("meter_sale_price") * 0.8807970779).alias("adj"),
        F.when(F.min("l_linenumber") >= 3, (F.max("l_quantity") - 25) / 100).alias("growth"),
    )


def day(text):
    return F.lit(text).cast("date")


@query("win_group_bounds_filter", ctes=f"""{TXN_SQL},
b AS (SELECT project_number, count(meter_sale_price) AS n, quantile_cont(meter_sale_price, 0.01) AS lo, quantile_cont(meter_sale_price, 0.99) AS hi FROM txn GROUP BY 1)""", sql=f"""
SELECT {K}, meter_sale_price FROM txn JOIN b ON txn.project_number = b.project_number WHERE n < 25 OR meter_sale_price BETWEEN lo AND hi""")
def win_group_bounds_filter(spark, sf_dir):
    """Many small groups; missing groups go, groups under 25 rows stay whole."""
    facts = transactions(spark, sf_dir, *KEYS, "project_number", "meter_sale_price")
    return outliers.trim_by_group(facts, "project_number", min_rows=25).drop("project_number")


@query("win_hard_min_filter", ctes=TRIM_SQL, sql=f"SELECT {K}, rooms_en, procedure_area FROM roomed")
def win_hard_min_filter(spark, sf_dir):
    return outliers.trim_area_by_rooms(transactions(spark, sf_dir, *KEYS, "rooms_en", "procedure_area"))


@query("win_lead_return", ctes=FLAGSHIP_CTES, sql="SELECT area_name_en, month, round(next_ret, 8) AS future_log_return_1m FROM nexts")
def win_lead_return(spark, sf_dir):
    rows = panel.next_return(area_month_panel(spark, sf_dir))
    return rows.select("area_name_en", "month", F.round("future_log_return_1m", 8).alias("future_log_return_1m"))


@query("win_lag_returns", ctes=FLAGSHIP_CTES, sql="SELECT area_name_en, month, round(lag_1, 8) AS lag_1_return, round(lag_2, 8) AS lag_2_return FROM full_rows")
def win_lag_returns(spark, sf_dir):
    rows = area_return_rows(spark, sf_dir)
    return rows.select("area_name_en", "month", *(F.round(c, 8).alias(c) for c in ("lag_1_return", "lag_2_return")))


@query("win_pct_change", ctes=SERIES_SQL, sql="""
SELECT series, month, round(last_value(price IGNORE NULLS) OVER w / last_value(price IGNORE NULLS) OVER (PARTITION BY series ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1, 8) AS change
FROM ser WINDOW w AS (PARTITION BY series ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def win_pct_change(spark, sf_dir):
    change = panel.pct_change("price", panel.by_month("series"))
    return series(spark, sf_dir).select("series", "month", F.round(change, 8).alias("change"))


@query("win_rolling_mean_std", ctes=SERIES_SQL, sql="""
SELECT series, month, round(avg(price) OVER w, 6) AS mean_3, round(coalesce(stddev_samp(price) OVER w, 0), 6) AS std_3
FROM ser WINDOW w AS (PARTITION BY series ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def win_rolling_mean_std(spark, sf_dir):
    rows = panel.rolling(series(spark, sf_dir), "price", panel.by_month("series"), "mean_3", "std_3").na.fill(0.0, ["std_3"])
    return rows.select("series", "month", F.round("mean_3", 6).alias("mean_3"), F.round("std_3", 6).alias("std_3"))


MOVES_SQL = f"""{TXN_SQL}, {QUOTES_SQL}, {CALENDAR_SQL},
p AS (SELECT area_name_en, CAST(date_trunc('month', instance_date) AS DATE) AS month, median(oil_close) AS oil_close, median(gold_close) AS gold_close
  FROM txn JOIN calendar ON CAST(instance_date AS DATE) = date GROUP BY 1, 2),
r AS (SELECT area_name_en, month, oil_close / lag(oil_close) OVER w - 1 AS oil, gold_close / lag(gold_close) OVER w - 1 AS gold FROM p WINDOW w AS (PARTITION BY area_name_en ORDER BY month))"""


@query("win_asset_moves", ctes=MOVES_SQL, sql="""
SELECT area_name_en, month, round(oil, 8) AS oil_return, round(avg(oil) OVER w, 8) AS oil_return_3m, round(stddev_samp(oil) OVER w, 8) AS oil_vol_3m,
  round(gold, 8) AS gold_return, round(avg(gold) OVER w, 8) AS gold_return_3m, round(stddev_samp(gold) OVER w, 8) AS gold_vol_3m
FROM r WINDOW w AS (PARTITION BY area_name_en ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def win_asset_moves(spark, sf_dir):
    """Market covariates of the panel."""
    facts = transactions(spark, sf_dir, "area_name_en", "instance_date", "meter_sale_price")
    facts = joins.on_calendar(facts, "instance_date", joins.asset_calendar(quotes(spark, sf_dir), ASSETS))
    rows = panel.asset_moves(panel.month_panel(facts, closes=["oil_close", "gold_close"]), ["oil", "gold"])
    cols = [f"{a}_{m}" for a in ("oil", "gold") for m in ("return", "return_3m", "vol_3m")]
    return rows.select("area_name_en", "month", *(F.round(c, 8).alias(c) for c in cols))


FFILL = ["has_parking", "swimming_pools", "unit_balcony_area", "land_type_en"]


@query("win_ffill_global", ctes=TXN_SQL, sql=f"SELECT {K}, l_suppkey, " + ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in FFILL) + f"""
FROM txn WINDOW w AS (PARTITION BY area_name_en ORDER BY {TXN_ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def win_ffill_global(spark, sf_dir):
    """Facts filled forward within their area; areas are cut into ordered blocks, so none has to fit one task."""
    facts = transactions(spark, sf_dir, "area_name_en", *TXN_ORDER, *FFILL)
    return blocks.forward_fill(facts, ["area_name_en"], TXN_ORDER, FFILL).select(*KEYS, "l_suppkey", *FFILL)


@query("win_growth_first_vs_history", ctes=SERIES_SQL + f""",
lastp AS (SELECT series, arg_max(price, month) AS p FROM ser WHERE price IS NOT NULL AND month <= DATE '{PIVOT}' GROUP BY 1),
f AS (SELECT series, month, adj FROM ser WHERE adj IS NOT NULL AND month > DATE '{PIVOT}')""", sql="""
SELECT series, month, round((adj / coalesce(lag(adj) OVER (PARTITION BY series ORDER BY month), p) - 1) * 100, 6) AS predicted_mom_growth_pct FROM f LEFT JOIN lastp USING (series)""")
def win_growth_first_vs_history(spark, sf_dir):
    rows = materialise(series(spark, sf_dir), "series")
    forecast = rows.where(F.col("adj").isNotNull() & (F.col("month") > day(PIVOT)))
    grown = panel.growth_vs_history(forecast.drop("price"), rows.where(F.col("month") <= day(PIVOT)), "series", "month", "adj", "price")
    return grown.select("series", "month", F.round("predicted_mom_growth_pct", 6).alias("predicted_mom_growth_pct"))


@query("win_dedupe_keep", ctes=TXN_SQL, sql=f"""
SELECT {K}, l_suppkey, meter_sale_price FROM txn QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY instance_date DESC, {TXN_ORDER_SQL}) = 1""")
def win_dedupe_keep(spark, sf_dir):
    """The latest transaction per project."""
    facts = transactions(spark, sf_dir, *TXN_ORDER, "meter_sale_price")
    last = joins.keep_one(facts, ["l_partkey"], [F.desc("instance_date"), *(F.col(c) for c in TXN_ORDER)])
    return last.select(*KEYS, "l_suppkey", "meter_sale_price")


@query("win_interpolate_linear", ctes=SERIES_SQL + """,
span AS (SELECT series, min(month) AS lo, max(month) AS hi FROM ser GROUP BY 1),
g AS (SELECT series, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM span),
x AS (SELECT g.series, g.month, price, row_number() OVER (PARTITION BY g.series ORDER BY g.month) AS i FROM g LEFT JOIN ser ON g.series = ser.series AND g.month = ser.month),
y AS (SELECT *, last_value(CASE WHEN price IS NOT NULL THEN i END IGNORE NULLS) OVER b AS pi, last_value(price IGNORE NULLS) OVER b AS pv,
  first_value(CASE WHEN price IS NOT NULL THEN i END IGNORE NULLS) OVER a AS ni, first_value(price IGNORE NULLS) OVER a AS nv FROM x
  WINDOW b AS (PARTITION BY series ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY series ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""", sql="""
SELECT series, month, round(CASE WHEN price IS NOT NULL THEN price WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (i - pi) / (ni - pi) END, 6) AS price FROM y""")
def win_interpolate_linear(spark, sf_dir):
    gridded = panel.on_grid(materialise(series(spark, sf_dir), "series").select("series", "month", "price"), "series")
    return panel.interpolate(gridded, "series", "month", "price").withColumn("price", F.round("price", 6))


@query("win_ffill_bfill", ctes=SERIES_SQL, sql="""
SELECT series, month, coalesce(last_value(price IGNORE NULLS) OVER (PARTITION BY series ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(price IGNORE NULLS) OVER (PARTITION BY series ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS price FROM ser""")
def win_ffill_bfill(spark, sf_dir):
    return series(spark, sf_dir).select("series", "month", panel.fill_both_ways("price", panel.by_month("series")).alias("price"))


@query("win_last_nonzero", ctes=SERIES_SQL, sql="""
SELECT series, coalesce(arg_max(growth, month) FILTER (WHERE growth <> 0), 0) AS growth FROM ser GROUP BY 1""")
def win_last_nonzero(spark, sf_dir):
    return panel.last_nonzero(series(spark, sf_dir), "series", "month", "growth")


@query("win_latest_row", ctes=TXN_SQL, sql=f"""
SELECT area_name_en, reg_type_en, procedure_area, elevators FROM txn QUALIFY row_number() OVER (PARTITION BY area_name_en ORDER BY instance_date DESC, {TXN_ORDER_SQL}) = 1""")
def win_latest_row(spark, sf_dir):
    facts = transactions(spark, sf_dir, *TXN_ORDER, "area_name_en", "reg_type_en", "procedure_area", "elevators")
    last = joins.keep_one(facts, ["area_name_en"], [F.desc("instance_date"), *(F.col(c) for c in TXN_ORDER)])
    return last.select("area_name_en", "reg_type_en", "procedure_area", "elevators")


@query("win_pivot_chain", ctes=SERIES_SQL, sql=f"""
SELECT series, month, macro_forecast, round(macro_forecast * (1 + CASE WHEN adj IS NOT NULL AND prev <> 0 THEN adj / prev - 1 ELSE 0 END), 6) AS news_adjusted_forecast FROM (
  SELECT series, month, adj, lag(adj) OVER w AS prev, last_value(price IGNORE NULLS) OVER (PARTITION BY series ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS macro_forecast
  FROM ser WHERE month >= DATE '{PIVOT}' WINDOW w AS (PARTITION BY series ORDER BY month))""")
def win_pivot_chain(spark, sf_dir):
    rows = panel.pivot_chain(series(spark, sf_dir), "series", "month", "price", "adj", day(PIVOT))
    return rows.select("series", "month", "macro_forecast", F.round("news_adjusted_forecast", 6).alias("news_adjusted_forecast"))


@query("win_compound_chain", ctes=SERIES_SQL + f""",
a AS (SELECT series, month, price, growth, row_number() OVER w = 1 OR growth IS NULL AS anchor FROM ser WHERE month >= DATE '{PIVOT}' WINDOW w AS (PARTITION BY series ORDER BY month)),
s AS (SELECT *, sum(CAST(anchor AS int)) OVER (PARTITION BY series ORDER BY month) AS seg FROM a)""", sql="""
SELECT series, month, round(first_value(price) OVER w * exp(sum(CASE WHEN anchor THEN 0 ELSE ln(1 + growth) END) OVER w), 4) AS macro_forecast
FROM s WINDOW w AS (PARTITION BY series, seg ORDER BY month)""")
def win_compound_chain(spark, sf_dir):
    rows = panel.compound_chain(series(spark, sf_dir), "series", "month", "price", "growth", day(PIVOT))
    return rows.select("series", "month", F.round("macro_forecast", 4).alias("macro_forecast"))


@query("win_rebased_growth", ctes=SERIES_SQL + f""",
v AS (SELECT series, month, coalesce(adj, 0) AS v FROM ser WHERE month >= DATE '{PIVOT}'),
b AS (SELECT series, min(month) FILTER (WHERE v > 0) AS bm, arg_min(v, month) FILTER (WHERE v > 0) AS bv FROM v GROUP BY 1),
e AS (SELECT v.series, v.month, v.v, bm, bv, max(CASE WHEN v.month > bm AND v.v <= 0 THEN 1 ELSE 0 END) OVER (PARTITION BY v.series ORDER BY v.month) AS ended FROM v JOIN b ON v.series = b.series)""", sql=f"""
SELECT series, month, round(CASE WHEN bm IS NULL OR month < bm THEN 1000e0 WHEN ended = 1 THEN 0 ELSE 1000e0 * v / bv END, 6) AS rebased_price FROM e WHERE month > DATE '{PIVOT}'""")
def win_rebased_growth(spark, sf_dir):
    rows = panel.rebased(series(spark, sf_dir), "series", "month", "adj", day(PIVOT), F.lit(1000.0))
    return rows.select("series", "month", F.round("rebased_price", 6).alias("rebased_price"))


@query("win_last_step_clamp", ctes=FLAGSHIP_CTES + f""",
lm AS (SELECT area_name_en, max(month) AS lm FROM panel WHERE month <= DATE '{PIVOT}' GROUP BY 1),
st AS (SELECT p.area_name_en, any_value(lm) AS lm, arg_max(monthly_price, month) AS last_p, arg_max(monthly_price, month) FILTER (WHERE month < lm) AS prev_p
  FROM panel p JOIN lm ON p.area_name_en = lm.area_name_en WHERE month <= lm GROUP BY 1),
f AS (SELECT area_name_en, lm, CASE WHEN abs(last_p / prev_p - 1) > 0.05 THEN prev_p * (1 + sign(last_p - prev_p) * 0.0425e0) / last_p ELSE 1 END AS factor FROM st)""", sql="""
SELECT p.area_name_en, month, round(monthly_price * 0.7310585786e0 * CASE WHEN month >= lm THEN factor ELSE 1 END, 5) AS monthly_price FROM panel p JOIN f ON p.area_name_en = f.area_name_en""")
def win_last_step_clamp(spark, sf_dir):
    rows = panel.clamp_last_step(area_month_panel(spark, sf_dir), "area_name_en", "month", "monthly_price", day(PIVOT))
    return rows.select("area_name_en", "month", F.round(F.col("monthly_price") * 0.7310585786, 5).alias("monthly_price"))


@query("win_dense_series_id", ctes=SERIES_SQL, sql="""
SELECT series, month, (SELECT count(*) FROM (SELECT DISTINCT series FROM ser) o WHERE o.series < ser.series) AS id FROM ser""")
def win_dense_series_id(spark, sf_dir):
    rows = materialise(series(spark, sf_dir).select("series", "month"), "series")
    return rows.join(blocks.dense_ids(rows, "series"), "series")


@query("win_pivot_fallback", ctes=SERIES_SQL + f""",
k AS (SELECT * FROM ser WHERE price IS NOT NULL),
t AS (SELECT s.series, max(CASE WHEN k.month = DATE '{PIVOT}' THEN k.month END) AS m1, max(CASE WHEN k.month <= DATE '{PIVOT}' THEN k.month END) AS m2,
  max(CASE WHEN k.month = DATE '{TODAY}' THEN k.month END) AS m3, max(CASE WHEN k.month <= DATE '{TODAY}' THEN k.month END) AS m4
  FROM (SELECT DISTINCT series FROM ser) s LEFT JOIN k ON s.series = k.series GROUP BY 1)""", sql=f"""
SELECT t.series, CASE WHEN m1 IS NULL AND m2 IS NULL AND m3 IS NULL AND m4 IS NOT NULL THEN DATE '{TODAY}' ELSE coalesce(m1, m2, m3) END AS pivot_month, k.price AS pivot_price,
  CASE WHEN m1 IS NOT NULL THEN 'pivot' WHEN m2 IS NOT NULL THEN 'last_before' WHEN m3 IS NOT NULL THEN 'current' WHEN m4 IS NOT NULL THEN 'filled' END AS reason
FROM t LEFT JOIN k ON k.series = t.series AND k.month = coalesce(m1, m2, m3, m4)""")
def win_pivot_fallback(spark, sf_dir):
    return panel.pivot_price(series(spark, sf_dir), "series", "month", "price", day(PIVOT), day(TODAY))
