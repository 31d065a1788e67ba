"""Queries over date and math rules."""

from pyspark.sql import functions as F

from parcelflow.functions import dates, numeric
from parcelflow.operators import events as ev
from parcelflow.operators import panel
from parcelflow.plans.filters import KEYS
from parcelflow.plans.registry import query
from parcelflow.sources.bindings import TXN_SQL, table, transactions, view, view_sql

K = "l_orderkey, l_partkey, l_linenumber"


@query("dt_parts", sql=f"""
SELECT {K}, strftime(l_shipdate, '%Y-%m') AS year_month, CAST(year(l_shipdate) AS int) AS year, CAST(month(l_shipdate) AS int) AS month,
  dayname(l_shipdate) AS day_of_week, CAST(dayofyear(l_shipdate) AS int) AS day_of_year, CAST(weekofyear(l_shipdate) AS int) AS week_of_year,
  CAST(quarter(l_shipdate) AS int) AS quarter FROM lineitem""")
def dt_parts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(*KEYS, *(c.alias(n) for n, c in dates.parts(F.col("l_shipdate")).items()))


@query("dt_month_start", sql=f"SELECT {K}, CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem")
def dt_month_start(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*KEYS, dates.month_start(F.col("l_shipdate")).alias("month"))


@query("dt_month_end", sql=f"SELECT {K}, last_day(CAST(l_shipdate AS DATE)) AS month FROM lineitem")
def dt_month_end(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*KEYS, dates.month_end(F.col("l_shipdate")).alias("month"))


@query("dt_month_diff", sql="""
SELECT o_orderkey, CAST((year(o_orderdate) - 1998) * 12 + month(o_orderdate) - 3 AS int) AS months FROM orders""")
def dt_month_diff(spark, sf_dir):
    diff = dates.month_diff(F.col("o_orderdate"), F.lit("1998-03-31").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", diff.alias("months"))


@query("dt_add_months", ctes=TXN_SQL, sql="""
SELECT area_name_en, CAST(max(date_trunc('month', instance_date)) - INTERVAL 6 MONTH AS DATE) AS cutoff FROM txn GROUP BY 1""")
def dt_add_months(spark, sf_dir):
    facts = transactions(spark, sf_dir, "area_name_en", "instance_date")
    last = F.max(dates.month_start(F.col("instance_date")))
    return facts.groupBy("area_name_en").agg(F.add_months(last, -6).alias("cutoff"))


@query("dt_month_grid", ctes=f"""{TXN_SQL},
m AS (SELECT area_name_en, coalesce(project_number % 50, -1) AS bucket, CAST(date_trunc('month', instance_date) AS DATE) AS month FROM txn GROUP BY ALL),
span AS (SELECT concat(area_name_en, '/', CAST(bucket AS string)) AS series, min(month) AS lo, max(month) AS hi, count(*) AS n FROM m GROUP BY 1),
g AS (SELECT series, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM span)""", sql="""
SELECT g.series, g.month, m.month IS NOT NULL AS known FROM g LEFT JOIN m ON g.series = concat(m.area_name_en, '/', CAST(m.bucket AS string)) AND g.month = m.month""")
def dt_month_grid(spark, sf_dir):
    """Series with real holes: 50 buckets of projects per area, and one of facts without a project."""
    facts = transactions(spark, sf_dir, "area_name_en", "project_number", "instance_date")
    series = F.concat(F.col("area_name_en"), F.lit("/"), F.coalesce(F.col("project_number") % 50, F.lit(-1)).cast("string"))
    months = facts.select(series.alias("series"), dates.month_start(F.col("instance_date")).alias("month")).distinct()
    return panel.on_grid(months.withColumn("known", F.lit(True)), "series").na.fill(False, ["known"])


@query("dt_rfc822_utc", sql="""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(ts - INTERVAL 4 HOUR AS DATE) WHEN 1 THEN CAST(ts AS DATE)
  WHEN 2 THEN CAST(ts + INTERVAL 330 MINUTE AS DATE) END AS day FROM events""")
def dt_rfc822_utc(spark, sf_dir):
    kind = F.col("event_id") % 4
    zone = F.when(kind == 0, " +0400").when(kind == 1, " GMT").when(kind == 2, " -0530").otherwise(" nowhere")
    stamp = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), zone)
    return table(spark, sf_dir, "events").select("event_id", dates.rfc822_date(stamp).alias("day"))


@query("math_log_clip", ctes=TXN_SQL, sql=f"""
SELECT {K}, round(ln(greatest(l_quantity - 10, 1e-9)), 8) AS log_price, round(ln(1 + l_quantity), 8) AS log1p_value,
  round(exp(l_quantity / 10) - 1, 8) AS expm1_value FROM txn""")
def math_log_clip(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "l_quantity")
    return facts.select(
        *KEYS, F.round(numeric.log_price(F.col("l_quantity") - 10), 8).alias("log_price"),
        F.round(F.log1p("l_quantity"), 8).alias("log1p_value"), F.round(F.expm1(F.col("l_quantity") / 10), 8).alias("expm1_value"),
    )


@query("math_clip_product", ctes=view_sql("news"), sql="""
SELECT article_id, round(least(greatest(coalesce(entity_tier_weight, 0.5e0) * coalesce(event_scale_weight, 0.5e0)
  * coalesce(geo_relevance_weight, 0.5e0), 0.2e0), 1.5e0), 9) AS strength FROM news""")
def math_clip_product(spark, sf_dir):
    weights = ["entity_tier_weight", "event_scale_weight", "geo_relevance_weight"]
    value = numeric.strength(*map(F.col, weights))
    return view(spark, sf_dir, "news").select("article_id", F.round(value, 9).alias("strength"))


@query("math_haversine", ctes=view_sql("requests"), sql="""
SELECT request_id, round(2 * 6371 * atan2(sqrt(a), sqrt(1 - a)), 6) AS km FROM (SELECT request_id,
  pow(sin(radians(25.1972e0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(25.1972e0)) * pow(sin(radians(55.2744e0 - lon) / 2), 2) AS a FROM requests)""")
def math_haversine(spark, sf_dir):
    km = numeric.haversine_km(F.col("lat"), F.col("lon"), F.lit(25.1972), F.lit(55.2744))
    return view(spark, sf_dir, "requests").select("request_id", F.round(km, 6).alias("km"))


@query("math_decay_curves", ctes=view_sql("news") + """,
params(event_code, h, p) AS (VALUES ('GEO_RISK_ESCALATION', 1.5e0, 4e0), ('REGULATORY_EASING_RE', 3e0, 3e0), ('NEW_SUPPLY_ANNOUNCEMENT', 4e0, 6e0),
  ('OIL_PRICE_SHOCK_UP', 2e0, 3e0), ('unlisted', 3e0, 4e0)),
x AS (SELECT article_id, CAST((year(published_date) - 2001) * 12 + month(published_date) - 7 AS double) AS t, ln(2) / h AS r, p * ln(2) / h AS k
  FROM news JOIN params USING (event_code))""", sql="""
SELECT article_id, round(exp(-r * t), 8) AS sentiment_decay, round(pow(t, k) * exp(-r * t) / (pow(k / r, k) * exp(-k) + 1e-9), 8) AS price_impact FROM x""")
def math_decay_curves(spark, sf_dir):
    """Months since July 2001 per article, with the parameters of its event code."""
    params = ev.decay_table(spark)
    codes = [r[0] for r in ev.fv.EVENT_DECAY]
    code = F.when(F.col("event_code").isin(codes), F.col("event_code")).otherwise("DEFAULT")
    rows = view(spark, sf_dir, "news").withColumn("event_code", code).join(F.broadcast(params), "event_code")
    t = dates.month_diff(F.col("published_date"), F.lit("2001-07-01").cast("date"))
    return rows.select(
        "article_id", F.round(numeric.sentiment_decay(t, F.col("s_halflife")), 8).alias("sentiment_decay"),
        F.round(numeric.price_hump(t, F.col("s_halflife"), F.col("p_peak")), 8).alias("price_impact"),
    )


@query("math_unit_area_clamp", ctes=view_sql("requests") + f""", {TXN_SQL},
lims AS (SELECT area_name_en, min(procedure_area) AS a_min, max(procedure_area) AS a_max FROM txn GROUP BY 1),
b AS (SELECT request_id, coalesce(procedure_area, 55e0) AS v,
  CASE rooms_en WHEN 'Studio' THEN 25e0 WHEN '1 B/R' THEN 45e0 WHEN '2 B/R' THEN 65e0 WHEN '3 B/R' THEN 80e0 ELSE 110e0 END AS r_lo,
  CASE rooms_en WHEN 'Studio' THEN 45e0 WHEN '1 B/R' THEN 70e0 WHEN '2 B/R' THEN 90e0 WHEN '3 B/R' THEN 110e0 ELSE 145e0 END AS r_hi, a_min, a_max
  FROM requests LEFT JOIN lims ON home_area = area_name_en),
c AS (SELECT request_id, v, greatest(r_lo, coalesce(a_min, r_lo)) AS lo, least(r_hi, coalesce(a_max, r_hi)) AS hi FROM b)""", sql="""
SELECT request_id, CASE WHEN v < least(lo, hi) THEN least(lo, hi) WHEN v > hi THEN hi ELSE v END AS procedure_area FROM c""")
def math_unit_area_clamp(spark, sf_dir):
    from parcelflow.operators import profile

    facts = transactions(spark, sf_dir, "area_name_en", "procedure_area")
    limits = facts.groupBy("area_name_en").agg(
        F.min("procedure_area").alias("procedure_area_min"), F.max("procedure_area").alias("procedure_area_max")
    )
    requests = view(spark, sf_dir, "requests").withColumnRenamed("home_area", "area_name_en")
    return profile.clamp_requested_area(requests, limits).select("request_id", "procedure_area")
