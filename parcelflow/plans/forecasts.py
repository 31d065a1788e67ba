"""Queries over forecasts, news-adjusted forecasts and profile requests."""

from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow.operators import aggregates, events as ev
from parcelflow.operators import filters, forecast, impute, joins, panel, profile
from parcelflow.plans.events import month_scores, score_sql
from parcelflow.plans.flagship import FLAGSHIP_CTES, area_month_panel
from parcelflow.plans.joins import ASSETS, CALENDAR_SQL, QUOTES_SQL, quotes
from parcelflow.plans.registry import query
from parcelflow.session import materialise
from parcelflow.sources.bindings import TXN_ORDER, TXN_ORDER_SQL, TXN_SQL, transactions, view, view_sql

CUT = "2001-05-01"
SINGLE = ("trend", "seasonal_naive")  # methods that see one series at a time
MONTH_T = "CAST((year({m}) - 2000) * 12 + month({m}) - 1 AS double)"


def trend_sql(source, steps, name="trend"):
    """Trend forecast of source(area_name_en, month, monthly_price)."""
    return f"""{name}_fit AS (SELECT area_name_en, regr_slope(ln(monthly_price), {MONTH_T.format(m='month')}) AS b, regr_intercept(ln(monthly_price), {MONTH_T.format(m='month')}) AS a, max(month) AS lastm FROM {source} GROUP BY 1),
{name}_ahead AS (SELECT area_name_en, a, b, CAST(lastm + to_months(CAST(s AS int)) AS DATE) AS month FROM {name}_fit, generate_series(1, {steps}) AS g(s)),
{name} AS (SELECT area_name_en, month, exp(a + b * {MONTH_T.format(m='month')}) AS prediction FROM {name}_ahead)"""


def area_panel(spark, sf_dir):
    price = (F.col("monthly_price") * 0.7310585786).alias("monthly_price")
    return materialise(area_month_panel(spark, sf_dir).select("area_name_en", "month", price), "panel")


PANEL_SQL = f"""{FLAGSHIP_CTES},
series AS (SELECT area_name_en, month, monthly_price * 0.7310585786e0 AS monthly_price FROM panel)"""


@query("split_backtest", ctes=PANEL_SQL + """,
lastm AS (SELECT max(month) AS m FROM series),
marked AS (SELECT area_name_en, month, monthly_price, CASE WHEN month > m - INTERVAL 6 MONTH THEN 'test' ELSE 'train' END AS split FROM series, lastm)""", sql="""
SELECT * FROM marked WHERE area_name_en IN (SELECT area_name_en FROM marked WHERE split = 'test' GROUP BY 1 HAVING count(*) = 6)""")
def split_backtest(spark, sf_dir):
    return impute.split_backtest(area_panel(spark, sf_dir), "area_name_en", "month")


GRID_SQL = """span AS (SELECT area_name_en, min(month) AS lo, max(month) AS hi FROM series GROUP BY 1),
g AS (SELECT area_name_en, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM span),
x AS (SELECT g.area_name_en, g.month, monthly_price AS p, row_number() OVER (PARTITION BY g.area_name_en ORDER BY g.month) AS i FROM g LEFT JOIN series q ON g.area_name_en = q.area_name_en AND g.month = q.month),
y AS (SELECT *, last_value(CASE WHEN p IS NOT NULL THEN i END IGNORE NULLS) OVER b AS pi, last_value(p IGNORE NULLS) OVER b AS pv,
  first_value(CASE WHEN p IS NOT NULL THEN i END IGNORE NULLS) OVER a AS ni, first_value(p IGNORE NULLS) OVER a AS nv FROM x
  WINDOW b AS (PARTITION BY area_name_en ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY area_name_en ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT area_name_en, month, CASE WHEN p IS NOT NULL THEN p ELSE pv + (nv - pv) * (i - pi) / (ni - pi) END AS monthly_price FROM y)"""


FORECAST_SQL = f"{PANEL_SQL}, {GRID_SQL}, {trend_sql('filled', 6)}" + """,
lastp AS (SELECT area_name_en, arg_max(monthly_price, month) AS p, max(month) AS m FROM filled GROUP BY 1),
season AS (SELECT area_name_en, month(month) AS mm, arg_max(monthly_price, month) AS prediction FROM filled GROUP BY 1, 2),
both_m AS (SELECT 'trend' AS method, * FROM trend UNION ALL SELECT 'seasonal_naive', t.area_name_en, t.month, coalesce(s.prediction, l.p) FROM trend t JOIN lastp l USING (area_name_en) LEFT JOIN season s ON t.area_name_en = s.area_name_en AND month(t.month) = s.mm)"""


@query("fc_panel_forecast", ctes=FORECAST_SQL, sql="""
SELECT method, area_name_en, month, round(prediction, 4) AS prediction,
  round((prediction / coalesce(lag(prediction) OVER (PARTITION BY method, area_name_en ORDER BY month), p) - 1) * 100, 6) AS predicted_mom_growth_pct
FROM both_m JOIN lastp USING (area_name_en)""")
def fc_panel_forecast(spark, sf_dir):
    series = materialise(forecast.gridded(area_panel(spark, sf_dir), "area_name_en", "month", "monthly_price"), "grid")
    out = None
    for method in SINGLE:
        one = forecast.forecast(series, "area_name_en", "month", "monthly_price", 6, method).withColumn("method", F.lit(method))
        out = one if out is None else out.unionByName(one)
    return out.withColumns({"prediction": F.round("prediction", 4), "predicted_mom_growth_pct": F.round("predicted_mom_growth_pct", 6)})


def regression_sql(source):
    """One regression over all rows of source(area_name_en, month, monthly_price, share, move): log return on the return, share and move of the month before, rolled on for six months."""
    x = ("f1", "f2", "f3")
    cov = {(a, b): f"(sum({a} * {b}) / count(*) - avg({a}) * avg({b}))" + (" * (1 + 0.01e0 / stddev_pop(r))" if a == b else "") for i, a in enumerate(x) for b in (*x[i:], "r")}
    c = lambda a, b: cov[min(a, b), max(a, b)] if b != "r" else cov[a, b]

    def det(m):
        (p, q, r), (s, t, u), (v, w, z) = m
        return f"({p} * ({t} * {z} - {u} * {w}) - {q} * ({s} * {z} - {u} * {v}) + {r} * ({s} * {w} - {t} * {v}))"

    names = {(a, b): f"c_{a}_{b}" for a in x for b in (*x, "r")}
    whole = [[names[a, b] for b in x] for a in x]
    solved = [det([[names[a, "r"] if j == k else whole[i][j] for j in range(3)] for i, a in enumerate(x)]) for k in range(3)]
    return f"""known AS (SELECT area_name_en, month, monthly_price, last_value(share IGNORE NULLS) OVER w AS share, last_value(move IGNORE NULLS) OVER w AS move FROM {source} WHERE monthly_price IS NOT NULL WINDOW w AS (PARTITION BY area_name_en ORDER BY month)),
moves AS (SELECT *, ln(greatest(monthly_price, 1e-9)) AS lp, ln(greatest(monthly_price, 1e-9)) - lag(ln(greatest(monthly_price, 1e-9))) OVER w AS r FROM known WINDOW w AS (PARTITION BY area_name_en ORDER BY month)),
lagged AS (SELECT *, lag(r) OVER w AS f1, lag(share) OVER w AS f2, lag(move) OVER w AS f3 FROM moves WINDOW w AS (PARTITION BY area_name_en ORDER BY month)),
covs AS (SELECT count(*) AS n, avg(r) AS mr, avg(f1) AS m1, avg(f2) AS m2, avg(f3) AS m3, {", ".join(f"{c(a, b)} AS {n}" for (a, b), n in names.items())} FROM lagged WHERE r IS NOT NULL AND f1 IS NOT NULL AND f2 IS NOT NULL AND f3 IS NOT NULL),
slopes AS (SELECT *, {", ".join(f"{s} / {det(whole)} AS b{k + 1}" for k, s in enumerate(solved))} FROM covs),
solved AS (SELECT CASE WHEN n >= 30 THEN b1 ELSE 0 END AS b1, CASE WHEN n >= 30 THEN b2 ELSE 0 END AS b2, CASE WHEN n >= 30 THEN b3 ELSE 0 END AS b3, n, mr, m1, m2, m3 FROM slopes),
coefs AS (SELECT b1, b2, b3, CASE WHEN n >= 30 THEN mr - b1 * m1 - b2 * m2 - b3 * m3 ELSE 0 END AS b0 FROM solved),
ends AS (SELECT area_name_en, max(month) AS lastm, arg_max(lp, month) AS lp, coalesce(arg_max(r, month), 0) AS r, coalesce(arg_max(share, month), 0) AS share, coalesce(arg_max(move, month), 0) AS move FROM moves GROUP BY 1),
roll AS (SELECT area_name_en, lastm, 0 AS step, lp, r, b0 + b2 * share + b3 * move AS fixed, b1 FROM ends, coefs
  UNION ALL SELECT area_name_en, lastm, step + 1, lp + fixed + b1 * r, fixed + b1 * r, fixed, b1 FROM roll WHERE step < 6),
regressed AS (SELECT area_name_en, CAST(lastm + to_months(CAST(step AS int)) AS DATE) AS month, exp(lp) AS prediction FROM roll WHERE step > 0)"""


COVARIATE_SQL = f"""{TXN_SQL}, {QUOTES_SQL}, {CALENDAR_SQL},
monthly AS (SELECT area_name_en, CAST(date_trunc('month', instance_date) AS DATE) AS month, median(meter_sale_price) AS monthly_price, avg(has_parking) AS share, median(oil_close) AS oil_close
  FROM txn JOIN calendar ON CAST(instance_date AS DATE) = date GROUP BY 1, 2),
series AS (SELECT area_name_en, month, monthly_price, share, oil_close / lag(oil_close) OVER (PARTITION BY area_name_en ORDER BY month) - 1 AS move FROM monthly)"""


def covariate_panel(spark, sf_dir):
    """Monthly prices with the share of units with parking and the change of the oil price."""
    facts = transactions(spark, sf_dir, "area_name_en", "instance_date", "meter_sale_price", "has_parking")
    facts = joins.on_calendar(facts, "instance_date", joins.asset_calendar(quotes(spark, sf_dir), ASSETS))
    rows = panel.month_panel(facts, flags=["has_parking"], closes=["oil_close"])
    rows = rows.withColumn("oil_return", panel.pct_change("oil_close", panel.by_month()))
    return materialise(rows.select("area_name_en", "month", "monthly_price", "pct_has_parking", "oil_return"), "panel")


REGRESSION = forecast.panel_regression(["pct_has_parking", "oil_return"], lags=1)


@query("fc_covariate_forecast", ctes="RECURSIVE " + COVARIATE_SQL + ", " + regression_sql("series"), sql="SELECT area_name_en, month, round(prediction, 3) AS prediction FROM regressed")
def fc_covariate_forecast(spark, sf_dir):
    """Six months ahead by one regression over all areas on lagged returns, a share and a market move."""
    ahead = forecast.forecast(covariate_panel(spark, sf_dir), "area_name_en", "month", "monthly_price", 6, REGRESSION)
    return ahead.select("area_name_en", "month", F.round("prediction", 3).alias("prediction"))


@query("fc_covariate_backtest", ctes="RECURSIVE " + COVARIATE_SQL + f""",
lastm AS (SELECT max(month) AS m FROM series),
marked AS (SELECT series.*, month > m - INTERVAL 6 MONTH AS test FROM series, lastm),
usable AS (SELECT * FROM marked WHERE area_name_en IN (SELECT area_name_en FROM marked WHERE test GROUP BY 1 HAVING count(*) = 6)),
train AS (SELECT * FROM usable WHERE NOT test),
{regression_sql("train")}""", sql="""
SELECT u.area_name_en, count(*) AS n, round(avg((monthly_price - prediction) ** 2), 2) AS mse, round(avg(abs(monthly_price - prediction)), 3) AS mae, round(avg(abs(monthly_price - prediction) / abs(monthly_price)), 6) AS mape
FROM usable u JOIN regressed USING (area_name_en, month) WHERE test GROUP BY 1""")
def fc_covariate_backtest(spark, sf_dir):
    """Errors of the last six months by a regression that sees the months before them only."""
    found = forecast.backtest(covariate_panel(spark, sf_dir), "area_name_en", "month", "monthly_price", 6, REGRESSION)
    return found.select("area_name_en", "n", F.round("mse", 2).alias("mse"), F.round("mae", 3).alias("mae"), F.round("mape", 6).alias("mape"))


BACKTEST_SQL = f"""{PANEL_SQL},
lastm AS (SELECT max(month) AS m FROM series),
marked AS (SELECT area_name_en, month, monthly_price, month > m - INTERVAL 6 MONTH AS test FROM series, lastm),
usable AS (SELECT * FROM marked WHERE area_name_en IN (SELECT area_name_en FROM marked WHERE test GROUP BY 1 HAVING count(*) = 6)),
train AS (SELECT * FROM usable WHERE NOT test),
{trend_sql('train', 6)},
season AS (SELECT area_name_en, month(month) AS mm, arg_max(monthly_price, month) AS prediction FROM train GROUP BY 1, 2),
lastp AS (SELECT area_name_en, arg_max(monthly_price, month) AS p FROM train GROUP BY 1),
both_m AS (SELECT 'trend' AS algorithm, * FROM trend UNION ALL SELECT 'seasonal_naive', t.area_name_en, t.month, coalesce(s.prediction, l.p) FROM trend t JOIN lastp l USING (area_name_en) LEFT JOIN season s ON t.area_name_en = s.area_name_en AND month(t.month) = s.mm),
ev AS (SELECT algorithm, u.area_name_en, monthly_price AS y, prediction AS p FROM usable u JOIN both_m b ON u.area_name_en = b.area_name_en AND u.month = b.month WHERE test),
m AS (SELECT algorithm, area_name_en, count(*) AS n, avg((y - p) ** 2) AS mse, avg(abs(y - p)) AS mae, avg(abs(y - p) / abs(y)) AS mape, sqrt(avg((y - p) ** 2)) AS rmse,
  1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS r2 FROM ev GROUP BY 1, 2)"""
METRICS = ["mse", "mae", "mape", "rmse", "r2"]
ROUNDED = ", ".join(f"round({c}, 4) AS {c}" for c in METRICS)


def backtests(spark, sf_dir):
    series = area_panel(spark, sf_dir)
    out = None
    for method in SINGLE:
        one = forecast.backtest(series, "area_name_en", "month", "monthly_price", 6, method).withColumn("algorithm", F.lit(method))
        out = one if out is None else out.unionByName(one)
    return out


@query("fc_backtest", ctes=BACKTEST_SQL, sql=f"SELECT algorithm, area_name_en, n, {ROUNDED} FROM m")
def fc_backtest(spark, sf_dir):
    return backtests(spark, sf_dir).withColumns({c: F.round(c, 4) for c in METRICS})


@query("ml_select_best", ctes=BACKTEST_SQL, sql=f"""
SELECT area_name_en, algorithm, n, {ROUNDED} FROM m QUALIFY row_number() OVER (PARTITION BY area_name_en ORDER BY n DESC, mape, algorithm) = 1""")
def ml_select_best(spark, sf_dir):
    """The algorithm with the lowest held-out error per area."""
    return forecast.select_best(backtests(spark, sf_dir), "area_name_en").withColumns({c: F.round(c, 4) for c in METRICS})


# --- news-adjusted forecasts --------------------------------------------------------------------------------------

NEWS_SQL = f"""{score_sql('month')}, {PANEL_SQL},
past AS (SELECT * FROM series WHERE month <= DATE '{CUT}'),
{trend_sql('past', 12)},
merged AS (SELECT t.area_name_en, regexp_replace(w.area_id, '\\.0$', '') AS area_id, t.month, prediction AS predictions, s.drivers, coalesce(s.macro_news_factor, 0) AS macro_news_factor
  FROM trend t JOIN sensitivity_wide w ON t.area_name_en = w.area LEFT JOIN scores s ON s.area = t.area_name_en AND s.month = t.month),
v0 AS (SELECT area_id, coalesce(arg_max(macro_news_factor, month) FILTER (WHERE macro_news_factor <> 0), 0) AS v0 FROM merged GROUP BY 1),
tt AS (SELECT m.*, v0, (year(month) - year(sm)) * 12 + month(month) - month(sm) AS t FROM merged m JOIN v0 USING (area_id), (SELECT max(month) AS sm FROM scores)),
curves AS (SELECT *, CASE WHEN t < 0 THEN 1 ELSE exp(-ln(2) / 1.5 * t) END AS sent, CASE WHEN t < 0 THEN 0 ELSE pow(CAST(t AS double), 4 * ln(2) / 1.5) * exp(-ln(2) / 1.5 * t)
  / (pow(4e0, 4 * ln(2) / 1.5) * exp(-4 * ln(2) / 1.5) + 1e-9) END AS hump FROM tt),
adjusted AS (SELECT area_id, area_name_en, month, predictions, sent, hump, CASE WHEN t < 0 THEN macro_news_factor ELSE v0 * sent END AS macro_news_factor,
  CASE WHEN t < 0 THEN predictions ELSE predictions * (1 + v0 * sent - CASE WHEN abs(v0) > 0.0001 THEN hump * 0.02 ELSE 0 END) END AS adjusted_pred FROM curves)"""


def area_forecast(spark, sf_dir, steps=12, series=None):
    """Trend forecast from the cut month on, with the area's id as text ('3.0'). series: the area panel, if it is there already."""
    past = filters.up_to_month(area_panel(spark, sf_dir) if series is None else series, "month", CUT)
    ids = view(spark, sf_dir, "sensitivity_wide").select(F.col("area").alias("area_name_en"), "area_id")
    ahead = forecast.trend(past, "area_name_en", "month", "monthly_price", steps)
    return ahead.join(ids, "area_name_en").withColumnRenamed("prediction", "predictions")


def merged_forecast(spark, sf_dir, series=None):
    ids = view(spark, sf_dir, "sensitivity_wide").select("area", "area_id")
    scores = month_scores(spark, sf_dir).join(ids, "area").select("month", "area_id", "macro_news_factor", "drivers")
    scores = materialise(scores, "scores")
    merged = joins.by_month_and_area(area_forecast(spark, sf_dir, series=series), scores)
    return merged.withColumn("macro_news_factor", F.coalesce("macro_news_factor", F.lit(0.0))), scores


def adjusted_forecast(spark, sf_dir, series=None):
    merged, scores = merged_forecast(spark, sf_dir, series)
    merged = materialise(merged, "merged")
    shock = panel.last_nonzero(merged, "area_id", "month", "macro_news_factor")
    event = ev.dominant_event(view(spark, sf_dir, "news"))
    return ev.decay_adjust(merged, shock, event, scores.agg(F.max("month")).scalar())


@query("join_month_area", ctes=NEWS_SQL, sql="SELECT area_id, month, round(predictions, 4) AS predictions, round(macro_news_factor, 8) AS macro_news_factor, drivers FROM merged")
def join_month_area(spark, sf_dir):
    merged, _ = merged_forecast(spark, sf_dir)
    return merged.select("area_id", "month", F.round("predictions", 4).alias("predictions"), F.round("macro_news_factor", 8).alias("macro_news_factor"), "drivers")


@query("fc_decay_adjust", ctes=NEWS_SQL, sql="""
SELECT area_id, month, round(predictions, 4) AS predictions, round(adjusted_pred, 4) AS adjusted_pred, round(macro_news_factor, 8) AS macro_news_factor,
  round(sent, 8) AS sentiment_decay, round(hump, 8) AS price_impact FROM adjusted""")
def fc_decay_adjust(spark, sf_dir):
    rows = adjusted_forecast(spark, sf_dir)
    rounds = {"predictions": 4, "adjusted_pred": 4, "macro_news_factor": 8, "sentiment_decay": 8, "price_impact": 8}
    return rows.select("area_id", "month", *(F.round(c, n).alias(c) for c, n in rounds.items()))


@query("arr_price_path", ctes=NEWS_SQL, sql="""
SELECT area_name_en, string_agg(concat(strftime(month, '%Y-%m'), ' ', CAST(round(predictions, 2) AS string), ' ', CAST(round(adjusted_pred, 2) AS string), ' ',
  CAST(round((adjusted_pred - predictions) / predictions * 100, 2) AS string), ' ', CAST(round(sent, 3) AS string)), '; ' ORDER BY month) AS path
FROM adjusted WHERE month BETWEEN DATE '2001-11-01' AND DATE '2002-05-01' GROUP BY 1""")
def arr_price_path(spark, sf_dir):
    paths = ev.price_path(adjusted_forecast(spark, sf_dir), "area_name_en", F.lit("2001-11-01").cast("date"), F.lit("2002-05-01").cast("date"))
    line = lambda s: F.concat_ws(" ", s["month"], *(s[c].cast("string") for c in ("baseline", "adjusted", "change_pct", "sentiment_decay")))
    return paths.select("area_name_en", F.array_join(F.transform("path", line), "; ").alias("path"))


SPLICE_SQL = f"""{NEWS_SQL},
sp AS (SELECT area_name_en, month, monthly_price AS median_price FROM past UNION ALL SELECT area_name_en, month, predictions FROM merged)"""


def spliced(spark, sf_dir, series=None):
    series = area_panel(spark, sf_dir) if series is None else series
    past = filters.up_to_month(series, "month", CUT).withColumnRenamed("monthly_price", "median_price")
    return forecast.splice(past, area_forecast(spark, sf_dir, series=series))


@query("fc_splice", ctes=SPLICE_SQL, sql="SELECT area_name_en, month, round(median_price, 4) AS median_price FROM sp")
def fc_splice(spark, sf_dir):
    return spliced(spark, sf_dir).withColumn("median_price", F.round("median_price", 4))


@query("join_request_news", ctes=SPLICE_SQL, sql="""
SELECT s.area_name_en, last_day(s.month) AS month, round(median_price, 4) AS median_price, round(adjusted_pred, 4) AS adjusted_pred FROM sp s
LEFT JOIN adjusted a ON a.area_name_en = s.area_name_en AND a.month = s.month""")
def join_request_news(spark, sf_dir):
    """Series with the latest news row of each month."""
    series = area_panel(spark, sf_dir)
    news = materialise(adjusted_forecast(spark, sf_dir, series).select("area_name_en", "month", "adjusted_pred"), "news")
    twice = news.unionByName(news.withColumn("month", F.last_day("month")))
    latest = joins.latest_news(twice, "area_name_en", "month", [F.desc("month"), F.desc("adjusted_pred")])
    rows = spliced(spark, sf_dir, series).withColumn("month", F.last_day("month")).join(latest, ["area_name_en", "month"], "left")
    return rows.withColumns({c: F.round(c, 4) for c in ("median_price", "adjusted_pred")})


@query("arr_series_format", ctes=NEWS_SQL, sql=f"""
SELECT area_name_en, coalesce(string_agg(concat(strftime(month, '%Y-%m-%d'), ' ', CAST(round(monthly_price, 2) AS string)), '; ' ORDER BY month) FILTER (WHERE month < DATE '{CUT}'), '') AS before_prediction,
  coalesce(string_agg(concat(strftime(month, '%Y-%m-%d'), ' ', CAST(round(monthly_price, 2) AS string)), '; ' ORDER BY month) FILTER (WHERE month = DATE '{CUT}'), '') AS prediction_point,
  coalesce(string_agg(concat(strftime(month, '%Y-%m-%d'), ' ', CAST(round(monthly_price, 2) AS string)), '; ' ORDER BY month) FILTER (WHERE month > DATE '{CUT}'), '') AS after_prediction
FROM (SELECT area_name_en, month, monthly_price FROM series) GROUP BY 1""")
def arr_series_format(spark, sf_dir):
    rows = area_panel(spark, sf_dir)
    price, month, cut = F.col("monthly_price"), F.col("month"), F.lit(CUT).cast("date")
    arrays = forecast.series_arrays(rows, "area_name_en", "month", {
        "before_prediction": (price, month < cut), "prediction_point": (price, month == cut), "after_prediction": (price, month > cut),
    })
    line = lambda s: F.concat_ws(" ", s["timestamp"], s["value"].cast("string"))
    return arrays.withColumns({c: F.array_join(F.transform(c, line), "; ") for c in arrays.columns[1:]})


# --- profile requests ---------------------------------------------------------------------------------------------

SERIES_START, SERIES_END = "1996-01-01", CUT
FIELDS = {"rooms_en": "string", "reg_type_en": "string", "trans_group_en": "string", "has_parking": "int"}
RANGE_ROWS = 2500
HISTORY_SQL = f"""{TXN_SQL}, {view_sql('requests')}, {view_sql('centres')},
hist AS (SELECT {TXN_ORDER_SQL}, area_name_en, rooms_en, reg_type_en, trim(trans_group_en) AS trans_group_en, has_parking, procedure_area, meter_sale_price * 0.7310585786e0 AS meter_sale_price FROM txn),
dist AS (SELECT request_id, c.area, 2 * 6371 * atan2(sqrt(a), sqrt(1 - a)) AS km FROM (SELECT request_id, area, pow(sin(radians(c.lat - r.lat) / 2), 2)
  + cos(radians(r.lat)) * cos(radians(c.lat)) * pow(sin(radians(c.lon - r.lon) / 2), 2) AS a FROM requests r, centres c WHERE area_name IS NULL) c),
near AS (SELECT request_id, arg_min(area, ROW(km, area)) AS area FROM dist WHERE km <= 8 GROUP BY 1),
req AS (SELECT r.*, coalesce(r.area_name, near.area) AS area_name_en FROM requests r LEFT JOIN near USING (request_id)),
big AS (SELECT area_name_en FROM hist GROUP BY 1 HAVING count(*) >= {RANGE_ROWS}),
latest AS (SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY area_name_en ORDER BY instance_date DESC, {TXN_ORDER_SQL}) = 1),
""" + ",\n".join(
    f"l_{f} AS (SELECT area_name_en, list(v ORDER BY {'CAST(v AS double)' if k == 'int' else 'v'}) AS vals FROM (SELECT DISTINCT area_name_en, CAST({f} AS string) AS v FROM hist WHERE {f} IS NOT NULL AND area_name_en IN (SELECT area_name_en FROM big)) GROUP BY 1)"
    for f, k in FIELDS.items()
) + """,
resolved AS (SELECT request_id, req.area_name_en, req.procedure_area, """ + ", ".join(
    "coalesce(" + (f"CASE WHEN req.{f} IS NOT NULL AND (l_{f}.vals IS NULL OR list_contains(l_{f}.vals, CAST(req.{f} AS string))) THEN req.{f} END, " if f != "trans_group_en" else "")
    + f"CAST(l_{f}.vals[1] AS {k}), latest.{f}, CAST((SELECT vals[1] FROM l_{f} ORDER BY area_name_en LIMIT 1) AS {k}), CAST('{fv.REQUEST_DEFAULTS[f]}' AS {k})) AS {f}"
    for f, k in FIELDS.items()
) + " FROM req " + " ".join(f"LEFT JOIN l_{f} ON req.area_name_en = l_{f}.area_name_en" for f in FIELDS) + " LEFT JOIN latest ON req.area_name_en = latest.area_name_en)"


def history(spark, sf_dir):
    """The facts that requests need, joined once and stored."""
    facts = transactions(spark, sf_dir, *TXN_ORDER, "area_name_en", *FIELDS, "procedure_area", "meter_sale_price")
    return materialise(facts.withColumns({"trans_group_en": F.trim("trans_group_en"), "meter_sale_price": F.col("meter_sale_price") * 0.7310585786}), "history")


def latest_rows(hist):
    """The first row of each area's last day. Only rows of that day are sorted, not the whole history."""
    last = materialise(hist.groupBy("area_name_en").agg(F.max("instance_date").alias("last")), "last-days")
    same = F.col("h.area_name_en").eqNullSafe(F.col("l.area_name_en")) & F.col("h.instance_date").eqNullSafe(F.col("l.last"))
    rows = hist.alias("h").join(last.alias("l"), same, "left_semi").select("h.*")
    return joins.keep_one(rows, ["area_name_en"], [F.desc("instance_date"), *(F.col(c) for c in TXN_ORDER)])


def request_tables(spark, sf_dir):
    """History, and value ranges of the areas with enough rows; the others fall back to their latest row.

    Rows are reduced to distinct values with the smallest and largest unit of each before values are listed, which takes a row per field.
    """
    hist = history(spark, sf_dir)
    large = filters.min_group_count(hist.select("area_name_en", *FIELDS, "procedure_area"), "area_name_en", RANGE_ROWS)
    sizes = F.array_distinct(F.array(F.min("procedure_area"), F.max("procedure_area")))
    held = large.groupBy("area_name_en", *FIELDS).agg(sizes.alias("_sizes"))
    held = materialise(held.select("area_name_en", *FIELDS, F.explode("_sizes").alias("procedure_area")), "distinct-values")
    return hist, materialise(aggregates.value_ranges(held, "area_name_en", list(FIELDS), "procedure_area"), "ranges")


def resolved_requests(spark, sf_dir):
    """The history and the requests with all fields resolved."""
    hist, ranges = request_tables(spark, sf_dir)
    requests = profile.resolve_area(view(spark, sf_dir, "requests"), view(spark, sf_dir, "centres"))
    return hist, profile.resolve_defaults(requests, ranges, latest_rows(hist), FIELDS, locked=["trans_group_en"])


# All request fields: (type, SQL over the facts, SQL over a request; None for fields that a request never sets).
ALL_FIELDS = {
    "rooms_en": ("string", "rooms_en", "rooms_en"),
    "reg_type_en": ("string", "reg_type_en", "reg_type_en"),
    "floor_bin": ("string", "CASE WHEN l_suppkey % 4 = 0 THEN NULL WHEN l_suppkey % 4 = 1 THEN '1-10' ELSE '11-20' END", "CASE WHEN request_id % 3 = 0 THEN NULL WHEN request_id % 3 = 1 THEN '11-20' ELSE '91-100' END"),
    "Grade": ("string", "CASE WHEN l_partkey % 5 = 0 THEN NULL WHEN l_partkey % 5 = 1 THEN 'A' ELSE 'C' END", "CASE WHEN request_id % 4 = 0 THEN NULL WHEN request_id % 4 = 1 THEN 'C' ELSE 'Z' END"),
    "project_grade": ("string", "CASE WHEN l_partkey % 3 = 0 THEN 'A' ELSE 'B' END", "CASE WHEN request_id % 2 = 0 THEN 'B' END"),
    "Developer_grade": ("string", "CASE WHEN l_suppkey % 6 = 0 THEN NULL ELSE concat('G', CAST(l_suppkey % 3 AS string)) END", "CASE WHEN request_id % 5 = 0 THEN 'G2' END"),
    "Developer Reputation Tier": ("string", "concat('Tier ', CAST(l_suppkey % 2 AS string))", None),
    "trans_group_en": ("string", "trim(trans_group_en)", None),
    "Locality Zone": ("string", "CASE WHEN l_linenumber = 1 THEN NULL ELSE concat('Zone ', CAST(l_suppkey % 4 AS string)) END", None),
    "Price Tier": ("string", "CASE WHEN l_linenumber < 3 THEN 'Low' ELSE 'High' END", None),
    "Developer Tier": ("string", "CAST(NULL AS string)", None),
    "Reputation": ("string", "CASE WHEN l_suppkey % 7 = 0 THEN 'Good' END", None),
    "Score": ("double", "CASE WHEN l_linenumber = 2 THEN NULL ELSE (l_partkey % 9) / 2e0 END", None),
    "has_parking": ("int", "CAST(has_parking AS int)", "has_parking"),
    "swimming_pool": ("int", "CASE WHEN swimming_pools IS NULL THEN NULL WHEN swimming_pools > 0 THEN 1 ELSE 0 END", "CASE WHEN request_id % 3 = 1 THEN 0 WHEN request_id % 3 = 2 THEN 5 END"),
    "balcony": ("int", "CASE WHEN unit_balcony_area > 3 THEN 1 ELSE 0 END", "CASE WHEN request_id % 2 = 1 THEN 1 END"),
    "elevators": ("int", "CAST(elevators AS int)", "CASE WHEN request_id % 6 = 1 THEN 2 END"),
    "metro": ("int", "CASE WHEN l_linenumber = 4 THEN 0 ELSE 1 END", "CAST(NULL AS int)"),
}
assert set(ALL_FIELDS) == set(fv.REQUEST_DEFAULTS) and {f for f, (_, _, asked) in ALL_FIELDS.items() if asked is None} == set(fv.LOCKED_REQUEST_FIELDS)


def _all_fields_sql():
    lists, values = [], []
    for i, (f, (kind, _, asked)) in enumerate(ALL_FIELDS.items()):
        by = "v" if kind == "string" else "CAST(v AS double)"
        lists.append(f"""l{i} AS (SELECT area_name_en, list(v ORDER BY {by}) AS vals FROM (SELECT DISTINCT area_name_en, CAST("{f}" AS string) AS v FROM hist18
  WHERE "{f}" IS NOT NULL AND area_name_en IN (SELECT area_name_en FROM big)) GROUP BY 1)""")
        own = "" if asked is None else f"""CASE WHEN q."{f}" IS NOT NULL AND (l{i}.vals IS NULL OR list_contains(l{i}.vals, CAST(q."{f}" AS string))) THEN CAST(q."{f}" AS {kind}) END, """
        text_default = str(fv.REQUEST_DEFAULTS[f]).replace("'", "''")
        values.append(f"""coalesce({own}CAST(l{i}.vals[1] AS {kind}), latest18."{f}", CAST((SELECT vals[1] FROM l{i} ORDER BY area_name_en LIMIT 1) AS {kind}), CAST('{text_default}' AS {kind})) AS "{f}\"""")
    hist = ", ".join(f'{sql} AS "{f}"' for f, (_, sql, _) in ALL_FIELDS.items())
    asked = ", ".join(f'{sql} AS "{f}"' for f, (_, _, sql) in ALL_FIELDS.items() if sql is not None)
    return f"""{HISTORY_SQL},
hist18 AS (SELECT {TXN_ORDER_SQL}, area_name_en, {hist} FROM txn),
latest18 AS (SELECT * FROM hist18 QUALIFY row_number() OVER (PARTITION BY area_name_en ORDER BY instance_date DESC, {TXN_ORDER_SQL}) = 1),
{", ".join(lists)},
q AS (SELECT request_id, area_name_en, {asked} FROM req),
all_fields AS (SELECT request_id, q.area_name_en, {", ".join(values)} FROM q {" ".join(f"LEFT JOIN l{i} ON q.area_name_en = l{i}.area_name_en" for i in range(len(ALL_FIELDS)))}
  LEFT JOIN latest18 ON q.area_name_en = latest18.area_name_en)"""


@query("req_resolve_defaults", ctes=_all_fields_sql(), sql="SELECT * FROM all_fields")
def req_resolve_defaults(spark, sf_dir):
    """All fields of every request, by tier; locked fields never come from the request."""
    needed = ["area_name_en", "rooms_en", "reg_type_en", "trans_group_en", "has_parking", "swimming_pools", "unit_balcony_area", "elevators", "procedure_area"]
    facts = transactions(spark, sf_dir, *TXN_ORDER, *needed)
    exprs = [F.expr(sql).alias(f) for f, (_, sql, _) in ALL_FIELDS.items()]
    hist = materialise(facts.select(*TXN_ORDER, "area_name_en", "procedure_area", *exprs), "history")
    large = filters.min_group_count(hist.drop(*TXN_ORDER), "area_name_en", RANGE_ROWS)
    ranges = materialise(aggregates.value_ranges(large, "area_name_en", list(ALL_FIELDS), "procedure_area"), "ranges")
    asked = profile.resolve_area(view(spark, sf_dir, "requests"), view(spark, sf_dir, "centres"))
    asked = asked.select("request_id", "area_name_en", *(F.expr(sql).alias(f) for f, (_, _, sql) in ALL_FIELDS.items() if sql is not None))
    kinds = {f: kind for f, (kind, _, _) in ALL_FIELDS.items()}
    resolved = profile.resolve_defaults(asked, ranges, latest_rows(hist), kinds, locked=fv.LOCKED_REQUEST_FIELDS)
    return resolved.select("request_id", "area_name_en", *ALL_FIELDS)


PROFILE_SQL = f"""{HISTORY_SQL},
prof AS (SELECT DISTINCT area_name_en, rooms_en, reg_type_en, trans_group_en, has_parking FROM resolved WHERE area_name_en IS NOT NULL),
histw AS (SELECT * FROM hist WHERE instance_date >= TIMESTAMP '{SERIES_START}' AND instance_date < TIMESTAMP '{CUT}' + INTERVAL 1 MONTH),
combo AS (SELECT DISTINCT area_name_en, rooms_en, reg_type_en, trans_group_en, has_parking FROM histw),
pc AS (SELECT p.area_name_en, p.rooms_en AS r, p.reg_type_en AS g, p.trans_group_en AS t, p.has_parking AS k, c.rooms_en, c.reg_type_en, c.trans_group_en, c.has_parking,
  """ + " + ".join(f"CASE WHEN p.{f} IS NULL OR p.{f} = c.{f} THEN 0 ELSE 1 END" for f in FIELDS) + """ AS mismatch FROM prof p JOIN combo c ON p.area_name_en = c.area_name_en),
bestc AS (SELECT * FROM pc QUALIFY mismatch = min(mismatch) OVER (PARTITION BY area_name_en, r, g, t, k)),
matched AS (SELECT b.area_name_en, r, g, t, k, mismatch, instance_date, meter_sale_price FROM bestc b JOIN histw h ON h.area_name_en = b.area_name_en AND h.rooms_en IS NOT DISTINCT FROM b.rooms_en
  AND h.reg_type_en IS NOT DISTINCT FROM b.reg_type_en AND h.trans_group_en IS NOT DISTINCT FROM b.trans_group_en AND h.has_parking IS NOT DISTINCT FROM b.has_parking),
lims AS (SELECT area_name_en, r, g, t, k, quantile_cont(meter_sale_price, 0.05) AS lo, quantile_cont(meter_sale_price, 0.95) AS hi FROM matched GROUP BY ALL),
kept_rows AS (SELECT m.* FROM matched m JOIN lims l ON m.area_name_en = l.area_name_en AND m.r IS NOT DISTINCT FROM l.r AND m.g IS NOT DISTINCT FROM l.g AND m.t IS NOT DISTINCT FROM l.t AND m.k IS NOT DISTINCT FROM l.k
  WHERE meter_sale_price BETWEEN lo AND hi)"""
AS_FIELDS = "area_name_en, r AS rooms_en, g AS reg_type_en, t AS trans_group_en, k AS has_parking"
COLS = list(FIELDS)


def profiles_and_matches(spark, sf_dir):
    """One row per distinct profile of the resolved requests, and the counted prices that each of them uses."""
    hist, requests = resolved_requests(spark, sf_dir)
    requests = profile.with_profile(requests.where(F.col("area_name_en").isNotNull()), COLS)
    profiles = materialise(requests.select("profile", "area_name_en", *COLS).distinct(), "profiles")
    window = profile.history_window(hist, "instance_date", SERIES_START, SERIES_END)
    counts = materialise(profile.price_counts(window, COLS), "price-counts")
    return profiles, profile.matching_history(profiles, counts, COLS)


def sums():
    return [F.sum("n").alias("n"), F.min("price").alias("lowest"), F.max("price").alias("highest")]


@query("req_nearest_profile", ctes=PROFILE_SQL, sql=f"""
SELECT {AS_FIELDS}, max(mismatch) AS mismatch, count(*) AS n, min(meter_sale_price) AS lowest, max(meter_sale_price) AS highest FROM matched GROUP BY area_name_en, r, g, t, k""")
def req_nearest_profile(spark, sf_dir):
    profiles, matched = profiles_and_matches(spark, sf_dir)
    return profiles.join(matched.groupBy("profile").agg(F.max("mismatch").alias("mismatch"), *sums()), "profile").drop("profile")


@query("req_trim_5_95", ctes=PROFILE_SQL, sql=f"SELECT {AS_FIELDS}, count(*) AS n, min(meter_sale_price) AS lowest, max(meter_sale_price) AS highest FROM kept_rows GROUP BY area_name_en, r, g, t, k")
def req_trim_5_95(spark, sf_dir):
    profiles, matched = profiles_and_matches(spark, sf_dir)
    kept = profile.trim_middle(matched, ["profile"], "price", weight="n")
    return profiles.join(kept.groupBy("profile").agg(*sums()), "profile").drop("profile")


MONTHLY_SQL = f"""{PROFILE_SQL},
med AS (SELECT area_name_en, r, g, t, k, CAST(date_trunc('month', instance_date) AS DATE) AS month, median(meter_sale_price) AS p FROM kept_rows GROUP BY ALL),
gm AS (SELECT DISTINCT area_name_en, r, g, t, k, CAST(unnest(generate_series(DATE '{SERIES_START}', DATE '{SERIES_END}', INTERVAL 1 MONTH)) AS DATE) AS month FROM med),
xm AS (SELECT gm.*, med.p, row_number() OVER (PARTITION BY gm.area_name_en, gm.r, gm.g, gm.t, gm.k ORDER BY gm.month) AS i FROM gm LEFT JOIN med ON gm.area_name_en = med.area_name_en AND gm.r IS NOT DISTINCT FROM med.r
  AND gm.g IS NOT DISTINCT FROM med.g AND gm.t IS NOT DISTINCT FROM med.t AND gm.k IS NOT DISTINCT FROM med.k AND gm.month = med.month),
ym AS (SELECT *, last_value(CASE WHEN p IS NOT NULL THEN i END IGNORE NULLS) OVER b AS pi, last_value(p IGNORE NULLS) OVER b AS pv, first_value(CASE WHEN p IS NOT NULL THEN i END IGNORE NULLS) OVER a AS ni,
  first_value(p IGNORE NULLS) OVER a AS nv FROM xm WINDOW b AS (PARTITION BY area_name_en, r, g, t, k ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  a AS (PARTITION BY area_name_en, r, g, t, k ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
hs AS (SELECT area_name_en, r, g, t, k, last_day(month) AS month, CASE WHEN p IS NOT NULL THEN p WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (i - pi) / (ni - pi) END AS median_price FROM ym)"""


@query("req_monthly_series", ctes=MONTHLY_SQL, sql=f"SELECT {AS_FIELDS}, month, round(median_price, 5) AS median_price FROM hs")
def req_monthly_series(spark, sf_dir):
    profiles, matched = profiles_and_matches(spark, sf_dir)
    series = profile.monthly_series(matched, start=SERIES_START, end=SERIES_END)
    return profiles.join(series, "profile").drop("profile").withColumn("median_price", F.round("median_price", 5))


def _listed(value, cond):
    return f"""coalesce(string_agg(concat(strftime(month, '%Y-%m-%d'), ' ', CAST(round({value}, 2) AS string)), '; ' ORDER BY month) FILTER (WHERE {cond}), '')"""


TODAY_SQL = "DATE '2001-11-30'"
REPORT_SQL = f"""{NEWS_SQL}, {MONTHLY_SQL[len(TXN_SQL) + 2:]},
ahead AS (SELECT area_name_en, r, g, t, k, month, predictions, predictions * (1 + coalesce(adjusted_pred / lag(adjusted_pred) OVER (PARTITION BY area_name_en, r, g, t, k ORDER BY month) - 1, 0)) AS news
  FROM (SELECT p.area_name_en, p.rooms_en AS r, p.reg_type_en AS g, p.trans_group_en AS t, p.has_parking AS k, last_day(a.month) AS month, predictions, adjusted_pred FROM prof p JOIN adjusted a ON p.area_name_en = a.area_name_en)),
h AS (SELECT area_name_en, r, g, t, k, {_listed('median_price', f"month < last_day(DATE '{CUT}')")} AS before_prediction, {_listed('median_price', f"month = last_day(DATE '{CUT}')")} AS prediction_point, true AS known FROM hs GROUP BY ALL),
f AS (SELECT area_name_en, r, g, t, k, {_listed('predictions', 'true')} AS forecast, {_listed('news', 'true')} AS news, {_listed('predictions', f"month = {TODAY_SQL}")} AS point_2,
  {_listed('predictions', f"month > {TODAY_SQL}")} AS forecast_2, {_listed('news', f"month > {TODAY_SQL}")} AS news_2, count(news) > 0 AS has_news FROM ahead GROUP BY ALL)"""


@query("req_forecast_report", ctes=REPORT_SQL, sql=f"""
SELECT request_id, q.area_name_en, coalesce(before_prediction, '') AS before_prediction, CASE WHEN known THEN prediction_point ELSE point_2 END AS prediction_point,
  coalesce(CASE WHEN known THEN forecast ELSE forecast_2 END, '') AS forecast, coalesce(CASE WHEN known THEN news ELSE news_2 END, '') AS news_adjusted_forecast, coalesce(has_news, false) AS news_available,
  CASE WHEN known THEN last_day(DATE '{CUT}') ELSE {TODAY_SQL} END AS pivot_month
FROM resolved q LEFT JOIN h ON q.area_name_en = h.area_name_en AND rooms_en IS NOT DISTINCT FROM h.r AND reg_type_en IS NOT DISTINCT FROM h.g AND trans_group_en IS NOT DISTINCT FROM h.t AND has_parking IS NOT DISTINCT FROM h.k
LEFT JOIN f ON q.area_name_en = f.area_name_en AND rooms_en IS NOT DISTINCT FROM f.r AND reg_type_en IS NOT DISTINCT FROM f.g AND trans_group_en IS NOT DISTINCT FROM f.t AND has_parking IS NOT DISTINCT FROM f.k
WHERE known OR f.area_name_en IS NOT NULL""")
def req_forecast_report(spark, sf_dir):
    """One row per request: history, pivot, forecast and news-adjusted forecast of its profile."""
    hist, ranges = request_tables(spark, sf_dir)
    adjusted = materialise(adjusted_forecast(spark, sf_dir).withColumn("month", F.last_day("month")), "adjusted")
    line = lambda s: F.concat_ws(" ", s["timestamp"], s["value"].cast("string"))
    lists = ["before_prediction", "prediction_point", "forecast", "news_adjusted_forecast"]
    return profile.answer(
        view(spark, sf_dir, "requests"), hist, ranges, latest_rows(hist), view(spark, sf_dir, "centres"), adjusted, FIELDS, COLS,
        SERIES_START, SERIES_END, "2001-11-01", locked=["trans_group_en"],
        shape=lambda reports: reports.withColumns({c: F.array_join(F.transform(c, line), "; ") for c in lists}),
    )


@query("req_area_catalog", ctes=HISTORY_SQL, sql="""
SELECT latest.area_name_en, lat, lon, reg_type_en, procedure_area, (SELECT count(DISTINCT area_name_en) FROM hist) AS area_count FROM latest LEFT JOIN centres ON latest.area_name_en = centres.area""")
def req_area_catalog(spark, sf_dir):
    rows = materialise(latest_rows(history(spark, sf_dir)).select("area_name_en", "reg_type_en", "procedure_area"), "latest")
    catalog = profile.area_catalog(rows, view(spark, sf_dir, "centres"))
    return catalog.withColumn("area_count", rows.agg(F.count("*")).scalar())
