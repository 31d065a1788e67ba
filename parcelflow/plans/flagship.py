"""The flagship query: trimmed monthly median price per area with returns and volatility."""

from pyspark.sql import functions as F

from parcelflow.operators import filters, outliers, panel
from parcelflow.plans.registry import query
from parcelflow.session import materialise
from parcelflow.sources.bindings import TXN_SQL, transactions

START = "1996-01-01"

FLAGSHIP_CTES = f"""{TXN_SQL},
recent AS (SELECT area_name_en, instance_date, meter_sale_price FROM txn WHERE instance_date >= TIMESTAMP '{START}'),
bounds AS (SELECT area_name_en, count(meter_sale_price) AS n, quantile_cont(meter_sale_price, 0.01) AS lo,
  quantile_cont(meter_sale_price, 0.99) AS hi FROM recent GROUP BY 1),
kept AS (SELECT r.* FROM recent r JOIN bounds b ON r.area_name_en = b.area_name_en
  WHERE n < 10 OR meter_sale_price BETWEEN lo AND hi),
panel AS (SELECT area_name_en, CAST(date_trunc('month', instance_date) AS DATE) AS month,
  median(meter_sale_price) AS monthly_price, count(*) AS txn_count, ln(1 + count(*)) AS log_txn_count FROM kept GROUP BY 1, 2),
nexts AS (SELECT *, lead(ln(greatest(monthly_price, 1e-9))) OVER w - ln(greatest(monthly_price, 1e-9)) AS next_ret
  FROM panel WINDOW w AS (PARTITION BY area_name_en ORDER BY month)),
lags AS (SELECT *, lag(next_ret, 1) OVER w AS lag_1, lag(next_ret, 2) OVER w AS lag_2
  FROM nexts WINDOW w AS (PARTITION BY area_name_en ORDER BY month)),
full_rows AS (SELECT * FROM lags WHERE next_ret IS NOT NULL AND lag_1 IS NOT NULL AND lag_2 IS NOT NULL)"""


def area_month_panel(spark, sf_dir):
    """Trimmed panel that several queries start from. Bounds and medians take several passes over the facts, whose join runs once."""
    facts = transactions(spark, sf_dir, "area_name_en", "instance_date", "meter_sale_price")
    recent = materialise(filters.since(facts, "instance_date", START), "recent")
    return panel.month_panel(materialise(outliers.trim_by_group(recent), "trimmed"))


def area_return_rows(spark, sf_dir):
    return panel.lagged_returns(panel.next_return(area_month_panel(spark, sf_dir)))


@query("flagship_area_month_returns", ctes=FLAGSHIP_CTES, sql="""
SELECT area_name_en, month, monthly_price, txn_count, round(log_txn_count, 8) AS log_txn_count,
  round(next_ret, 8) AS future_log_return_1m, round(lag_1, 8) AS lag_1_return, round(lag_2, 8) AS lag_2_return,
  round(avg(lag_1) OVER w3, 8) AS return_3m, round(coalesce(stddev_samp(lag_1) OVER w3, 0), 8) AS vol_3m
FROM full_rows WINDOW w3 AS (PARTITION BY area_name_en ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def area_month_returns(spark, sf_dir):
    rows = area_return_rows(spark, sf_dir)
    rows = panel.rolling(rows, "lag_1_return", panel.by_month(), "return_3m", "vol_3m").na.fill(0.0, ["vol_3m"])
    eight = ["log_txn_count", "future_log_return_1m", "lag_1_return", "lag_2_return", "return_3m", "vol_3m"]
    return rows.withColumns({c: F.round(c, 8) for c in eight}).drop("log_price")
