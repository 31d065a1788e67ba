"""Queries over whole stages."""

from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow.operators import forecast, stages
from parcelflow.plans.aggregates import TRIM_SQL
from parcelflow.plans.filters import KEYS, quoted
from parcelflow.plans.joins import ASSETS, MEMBERS_SQL, QUOTES_SQL, members, quotes
from parcelflow.plans.events import IMPUTED, channels, sensitivity
from parcelflow.plans.forecasts import BACKTEST_SQL, FORECAST_SQL, NEWS_SQL, SINGLE, area_forecast, area_panel
from parcelflow.plans.registry import query
from parcelflow.plans.texts import LINK_KEY_SQL, RULE_SQL
from parcelflow.sources.bindings import TXN_ORDER, TXN_ORDER_SQL, TXN_SQL, transactions, view, view_sql

K = "l_orderkey, l_partkey, l_linenumber"
UNIT_ORDER = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]


@query("stage_clean", ctes=TXN_SQL, sql=f"""
SELECT {K}, trim(coalesce(trans_group_en, '')) AS trans_group_en, strftime(instance_date, '%Y-%m') AS year_month, dayname(instance_date) AS day_of_week, CAST(quarter(instance_date) AS int) AS quarter
FROM txn WHERE instance_date >= TIMESTAMP '1997-01-01' AND trim(coalesce(trans_group_en, '')) NOT IN ({quoted(fv.EXCLUDED_TRANSACTION_GROUPS)})
  AND trim(property_usage_en) = 'Residential' AND trim(property_type_en) = 'Unit'""")
def stage_clean(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "instance_date", "trans_group_en", "property_usage_en", "property_type_en")
    return stages.clean_transactions(facts, start="1997-01-01").select(*KEYS, "trans_group_en", "year_month", "day_of_week", "quarter")


MICRO_KEY_SQL = """concat(CAST(coalesce(property_sub_type_id_u, 0) AS string), '-', CAST(coalesce(area_id_u, 0) AS string), '-', CAST(coalesce(project_number, 0) AS string), '-',
  trim(coalesce(rooms_u, '')), '-', CAST(CAST(trunc(coalesce(actual_area_u, 0)) AS bigint) AS string))"""
ROOMS_SQL = r"""regexp_replace(regexp_replace(regexp_replace({c}, '(\d+)\s*bed\s*rooms?\s*\+\s*hall', '\1 B/R', 'gi'), '^(\d+)\s*(?:B/R)?\s*\+.*$', '\1 B/R', 'i'), '^(\d+)$', '\1 B/R')"""


@query("stage_micro", ctes=f"""{view_sql('projects')}, {view_sql('developers')}, {view_sql('buildings')}, {view_sql('units')},
owned AS (SELECT p.*, coalesce(p.developer_number, d.developer_number) AS dev_num, d.developer_name_en FROM projects p LEFT JOIN developers d ON p.developer_id = d.developer_id),
placed AS (SELECT b.property_id, coalesce(b.area_id, o.area_id) AS area_id, coalesce(b.project_id, o.project_id) AS project_id, b.rooms_en, b.property_sub_type_id, b.actual_area, b.elevators,
  o.project_number, o.developer_name_en, TRY_CAST(o.project_start_date AS DATE) AS project_start_date FROM buildings b FULL JOIN owned o ON b.area_id = o.area_id AND b.project_id = o.project_id),
once AS (SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY property_id ORDER BY project_id NULLS LAST, project_number NULLS LAST, area_id NULLS LAST) = 1),
homes AS (SELECT DISTINCT * FROM units),
linked AS (SELECT coalesce(u.property_sub_type_id, b.property_sub_type_id) AS property_sub_type_id_u, coalesce(u.area_id, b.area_id) AS area_id_u, b.project_number,
  coalesce({ROOMS_SQL.format(c='u.rooms_en')}, b.rooms_en) AS rooms_u, coalesce(u.actual_area, b.actual_area) AS actual_area_u, b.property_id AS property_id_bld, u.property_id AS property_id_u, u.floor_key,
  b.elevators, b.developer_name_en, b.project_start_date, b.project_id AS project_id_bld, l_shipdate, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice
  FROM homes u FULL JOIN once b ON u.parent_property_id = CAST(b.property_id AS string)),
keyed AS (SELECT *, {MICRO_KEY_SQL} AS trans_ubp_key FROM linked),
ranked AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY trans_ubp_key ORDER BY {', '.join(f'{c} NULLS LAST' for c in [*UNIT_ORDER, 'property_id_bld', 'project_id_bld'])}) = 1)""", sql="""
SELECT trans_ubp_key, property_id_u, property_id_bld, CAST(coalesce(area_id_u, 0) AS bigint) AS area_id_u, rooms_u AS rooms_en_u, coalesce(actual_area_u, 0) AS actual_area_u, floor_key, elevators, developer_name_en, project_start_date FROM ranked""")
def stage_micro(spark, sf_dir):
    """Projects, developers, buildings and units in one table keyed for the transactions."""
    micro = stages.micro_table(*(view(spark, sf_dir, v) for v in ("projects", "developers", "buildings", "units")), UNIT_ORDER)
    return micro.select(
        "trans_ubp_key", "property_id_u", "property_id_bld", "area_id_u", "rooms_en_u", "actual_area_u", "floor_key", "elevators",
        "developer_name_en", "project_start_date",
    )


TRAIN_FIELDS = [
    "area_name_en", "area_id", "meter_sale_price", "rooms_en", "procedure_area", "property_sub_type_id", "property_sub_type_en", "project_number", "project_name_en",
    "building_name_en", "property_type_en", "developer_number", "developer_name_en", "elevators", "swimming_pools", "land_type_en", "nearest_mall_en", "nearest_metro_en",
    "nearest_landmark_en", "project_start_date", "built_up_area", "has_parking", "floor_key",
]
TRAIN_IMPUTED = [c for c in IMPUTED if c != "project_start_date"]


def _first(c, key):
    return f"(SELECT {key} AS k, arg_min({c}, ROW({TXN_ORDER_SQL})) FILTER (WHERE {c} IS NOT NULL) AS v FROM named GROUP BY 1)"


TRAIN_CTES = TRIM_SQL.replace(f"{TXN_SQL},", f"{TXN_SQL.replace('txn AS (', 'all_txn AS (', 1)},\ntxn AS (SELECT * FROM all_txn WHERE rooms_en IS NULL OR rooms_en NOT IN ({quoted(fv.NON_HOME_ROOMS)})),", 1) + f""",
{view_sql('projects')}, {view_sql('developers')},
keyed AS (SELECT *, {LINK_KEY_SQL.format(area_id='area_id', project='project_number', area='procedure_area')} AS link_key FROM trimmed),
micro AS (SELECT * FROM (SELECT {LINK_KEY_SQL.format(area_id='area_id', project='project_number', area='procedure_area')} AS link_key, unit_balcony_area AS micro_balcony, {TXN_ORDER_SQL} FROM all_txn)
  QUALIFY row_number() OVER (PARTITION BY link_key ORDER BY {TXN_ORDER_SQL}) = 1),
pn AS (SELECT project_number, min(developer_number) AS num FROM projects GROUP BY 1),
dn AS (SELECT developer_number, min(developer_name_en) AS name FROM developers GROUP BY 1),
e1 AS (SELECT k.*, micro_balcony, coalesce(k.developer_number, pn.num) AS dev_num, nullif(k.developer_name_en, 'Missing_developer_name_en') AS raw_name FROM keyed k LEFT JOIN micro USING (link_key) LEFT JOIN pn ON k.project_number = pn.project_number),
e2 AS (SELECT e1.*, coalesce(raw_name, dn.name) AS dev_name FROM e1 LEFT JOIN dn ON dev_num = dn.developer_number),
bf AS (SELECT dev_num, arg_min(dev_name, ROW({TXN_ORDER_SQL})) AS first_name FROM e2 WHERE dev_name IS NOT NULL AND dev_num IS NOT NULL GROUP BY 1),
e3 AS (SELECT e2.* EXCLUDE (developer_name_en), coalesce(dev_name, first_name, 'Missing_developer_name_en') AS developer_name_en FROM e2 LEFT JOIN bf USING (dev_num)),
named AS (SELECT e3.* EXCLUDE (developer_name_en, project_name_en), {RULE_SQL} AS developer_name_en, trim(project_name_en) AS project_name_en FROM e3),
filled AS (SELECT n.* EXCLUDE ({', '.join(TRAIN_IMPUTED)}), """ + ", ".join(f"coalesce(n.{c}, f_{c}.v) AS {c}" for c in TRAIN_IMPUTED) + " FROM named n " + " ".join(
    f"LEFT JOIN {_first(c, 'building_name_en' if c in fv.BUILDING_FILL else 'project_name_en')} f_{c} ON n.{'building_name_en' if c in fv.BUILDING_FILL else 'project_name_en'} = f_{c}.k" for c in TRAIN_IMPUTED) + """),
zeroed AS (SELECT filled.*, CASE WHEN property_type_en IN ('Building', 'Villa') AND micro_balcony IS NULL THEN 0 ELSE micro_balcony END AS balcony_area FROM filled),
mid AS (SELECT quantile_cont(CAST(has_parking AS double), 0.5) AS hp, quantile_cont(balcony_area, 0.5) AS ba, quantile_cont(built_up_area, 0.5) AS bu, quantile_cont(CAST(swimming_pools AS double), 0.5) AS sp FROM zeroed)"""


@query("stage_training", ctes=TRAIN_CTES, sql=rf"""
SELECT {K}, developer_name_en, project_name_en, CASE WHEN rooms_en IN ({quoted(fv.LARGE_HOME_LABELS)}) THEN 'More than 3B/R' ELSE rooms_en END AS rooms_en, elevators,
  coalesce(land_type_en, 'Missing_land_type_en') AS land_type_en, nearest_mall_en, round(coalesce(CAST(has_parking AS double), hp), 8) AS has_parking, round(coalesce(balcony_area, ba), 8) AS unit_balcony_area,
  round(coalesce(built_up_area, bu), 8) AS built_up_area, round(coalesce(CAST(swimming_pools AS double), sp), 8) AS swimming_pools,
  CAST(coalesce(micro_balcony, 0) <> 0 AS int) AS balcony, coalesce(floor_key, 'Missing_floor_key') AS floor_key,
  CASE WHEN floor_key IS NULL OR trim(floor_key) = '' THEN 0e0 ELSE coalesce(TRY_CAST(regexp_extract(floor_key, '\d+') AS double), 0.5e0) END AS floor FROM zeroed, mid""")
def stage_training(spark, sf_dir):
    """Trimmed, linked, enriched and imputed transactions; unit balconies come through the link key."""
    facts = transactions(spark, sf_dir, *TXN_ORDER, *TRAIN_FIELDS)
    parts = ["property_sub_type_id", "area_id", "project_number", "rooms_en", "procedure_area"]
    units = transactions(spark, sf_dir, *TXN_ORDER, *parts, "unit_balcony_area")
    key = stages.text.link_key(*map(F.col, parts))
    micro = stages.joins.keep_one(units.withColumn("trans_ubp_key", key), ["trans_ubp_key"], [F.col(c) for c in TXN_ORDER])
    micro = stages.materialise(micro.select("trans_ubp_key", "unit_balcony_area"), "micro")  # so its shuffles are gone when the facts are linked
    out = stages.training_table(facts, micro, view(spark, sf_dir, "projects"), view(spark, sf_dir, "developers"), TXN_ORDER)
    nums = ["has_parking", "unit_balcony_area", "built_up_area", "swimming_pools"]
    return out.select(
        *KEYS, "developer_name_en", "project_name_en", "rooms_en", "elevators", "land_type_en", "nearest_mall_en",
        *(F.round(c, 8).alias(c) for c in nums), "balcony", "floor_key", "floor",
    )


@query("stage_panel", ctes=f"""{TXN_SQL}, {QUOTES_SQL}, {MEMBERS_SQL},
span AS (SELECT asset, min(date) AS lo, max(date) AS hi FROM quotes GROUP BY 1),
g AS (SELECT asset, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
x AS (SELECT g.asset, g.date, close, row_number() OVER (PARTITION BY g.asset ORDER BY g.date) AS i FROM g LEFT JOIN quotes q ON g.asset = q.asset AND g.date = q.date),
y AS (SELECT *, last_value(CASE WHEN close IS NOT NULL THEN i END IGNORE NULLS) OVER b AS pi, last_value(close IGNORE NULLS) OVER b AS pv, first_value(CASE WHEN close IS NOT NULL THEN i END IGNORE NULLS) OVER a AS ni,
  first_value(close IGNORE NULLS) OVER a AS nv FROM x WINDOW b AS (PARTITION BY asset ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY asset ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
z AS (SELECT asset, date, CASE WHEN close IS NOT NULL THEN close WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (i - pi) / (ni - pi) END AS close FROM y),
cal AS (SELECT date, max(close) FILTER (WHERE asset = 'oil') AS oil_close, max(close) FILTER (WHERE asset = 'gold') AS gold_close, max(close) FILTER (WHERE asset = 'dfm') AS dfm_close FROM z GROUP BY 1 HAVING count(*) = 3),
ff AS (SELECT area_name_en, instance_date, meter_sale_price, rooms_en, last_value(has_parking IGNORE NULLS) OVER (PARTITION BY area_name_en ORDER BY {TXN_ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS has_parking FROM txn),
fc AS (SELECT ff.*, oil_close, gold_close, dfm_close FROM ff JOIN cal ON CAST(instance_date AS DATE) = date),
st AS (SELECT * FROM fc UNION ALL SELECT "group", fc.* EXCLUDE (area_name_en) FROM fc JOIN members ON area_name_en = member),
kp AS (SELECT * FROM st WHERE area_name_en IN (SELECT area_name_en FROM st GROUP BY 1 HAVING count(*) >= 2000) OR area_name_en IN (SELECT "group" FROM members)),
mp AS (SELECT area_name_en, CAST(date_trunc('month', instance_date) AS DATE) AS month, median(meter_sale_price) AS monthly_price, count(*) AS txn_count, avg(has_parking) AS pct, median(oil_close) AS oil FROM kp GROUP BY 1, 2),
nx AS (SELECT *, lead(ln(monthly_price)) OVER w - ln(monthly_price) AS nr FROM mp WINDOW w AS (PARTITION BY area_name_en ORDER BY month)),
lg AS (SELECT *, lag(nr) OVER w AS l1, lag(nr, 2) OVER w AS l2 FROM nx WINDOW w AS (PARTITION BY area_name_en ORDER BY month)),
sh AS (SELECT area_name_en, CAST(date_trunc('month', instance_date) AS DATE) AS month, count(*) + count(DISTINCT rooms_en) AS total,
  count(*) FILTER (WHERE rooms_en = 'Studio') AS studio, count(*) FILTER (WHERE rooms_en = '2 B/R') AS two FROM kp GROUP BY 1, 2),
dr AS (SELECT *, oil / lag(oil) OVER w - 1 AS oil_ret FROM lg WHERE nr IS NOT NULL AND l1 IS NOT NULL AND l2 IS NOT NULL WINDOW w AS (PARTITION BY area_name_en ORDER BY month)),
pn AS (SELECT area_name_en, month, monthly_price, txn_count, round(pct, 8) AS pct_has_parking, round(nr, 8) AS future_log_return_1m, round(l2, 8) AS lag_2_return, round(coalesce(oil_ret, 0), 8) AS oil_return,
  round(coalesce(avg(oil_ret) OVER w3, 0), 8) AS oil_return_3m, round(coalesce(stddev_samp(oil_ret) OVER w3, 0), 8) AS oil_vol_3m
FROM dr WINDOW w3 AS (PARTITION BY area_name_en ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) QUALIFY count(*) OVER (PARTITION BY area_name_en) >= 50)""", sql="""
SELECT pn.*, round(CASE WHEN studio > 0 THEN (studio + 1e0) / total ELSE 0 END, 8) AS pct_rooms_en_studio, round(CASE WHEN two > 0 THEN (two + 1e0) / total ELSE 0 END, 8) AS pct_rooms_en_2_br,
  dense_rank() OVER (ORDER BY pn.area_name_en) - 1 AS area_number, false AS has_castles FROM pn JOIN sh ON pn.area_name_en = sh.area_name_en AND pn.month = sh.month""")
def stage_panel(spark, sf_dir):
    """The forecasting panel: filled facts, market calendar, group copies, minimum sizes, shares, returns, covariates and area
    numbers. A category that no fact has gives a column of zeros, which is dropped."""
    facts = transactions(spark, sf_dir, *TXN_ORDER, "area_name_en", "meter_sale_price", "has_parking", "rooms_en")
    rows = stages.monthly_training_panel(
        facts, quotes(spark, sf_dir), ASSETS, members(spark), TXN_ORDER, min_rows=2000, categories={"rooms_en": ["Studio", "2 B/R", "Castle"]})
    eight = ["pct_has_parking", "future_log_return_1m", "lag_2_return", "oil_return", "oil_return_3m", "oil_vol_3m", "pct_rooms_en_studio", "pct_rooms_en_2_br"]
    castles = F.lit("pct_rooms_en_castle" in rows.columns).alias("has_castles")
    return rows.select("area_name_en", "month", "monthly_price", "txn_count", *(F.round(c, 8).alias(c) for c in eight), "area_number", castles)


@query("stage_forecast", ctes=f"""best AS (WITH {BACKTEST_SQL} SELECT area_name_en, algorithm, mape FROM m QUALIFY row_number() OVER (PARTITION BY area_name_en ORDER BY n DESC, mape, algorithm) = 1),
ahead AS (WITH {FORECAST_SQL} SELECT method, area_name_en, month, prediction FROM both_m)""", sql="""
SELECT area_name_en, month, method AS algorithm, round(prediction, 4) AS predictions, round(mape, 4) AS mape FROM ahead LEFT JOIN best USING (area_name_en) WHERE method = coalesce(algorithm, 'trend')""")
def stage_forecast(spark, sf_dir):
    """Every area continued by the method that did best on its held-out months."""
    ahead, best = stages.area_forecasts(area_panel(spark, sf_dir), {m: forecast.FORECASTERS[m] for m in SINGLE})
    rows = ahead.join(best.select("area_name_en", "mape"), "area_name_en", "left")
    return rows.select("area_name_en", "month", "algorithm", F.round("predictions", 4).alias("predictions"), F.round("mape", 4).alias("mape"))


@query("stage_news", ctes=NEWS_SQL, sql="""
SELECT area_id, month, round(predictions, 4) AS predictions, round(adjusted_pred, 4) AS adjusted_pred, round(macro_news_factor, 8) AS macro_news_factor FROM adjusted""")
def stage_news(spark, sf_dir):
    """Raw news to adjusted forecasts in one call."""
    news = view(spark, sf_dir, "news")
    weights = news.select("article_id", "entity_tier_weight", "event_scale_weight", "geo_relevance_weight")
    items = news.select("article_id", "published_date", "event_code", "title")
    ids = view(spark, sf_dir, "sensitivity_wide").select("area", "area_id")
    rows = stages.news_adjusted(area_forecast(spark, sf_dir), items, weights, channels(spark), sensitivity(spark, sf_dir), ids)
    return rows.select("area_id", "month", F.round("predictions", 4).alias("predictions"), F.round("adjusted_pred", 4).alias("adjusted_pred"), F.round("macro_news_factor", 8).alias("macro_news_factor"))
