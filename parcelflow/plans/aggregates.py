"""Queries over aggregations, sorts, limits and set operations."""

from pyspark.sql import functions as F

from parcelflow.operators import aggregates, drift, joins, outliers, panel, sketches
from parcelflow.plans.filters import KEYS
from parcelflow.plans.flagship import FLAGSHIP_CTES, area_month_panel
from parcelflow.plans.joins import ASSETS, CALENDAR_SQL, ENRICH_SQL, MEMBERS_SQL, QUOTES_SQL, enriched, members, quotes
from parcelflow.plans.registry import query
from parcelflow.session import materialise
from parcelflow.sources.bindings import TXN_ORDER, TXN_ORDER_SQL, TXN_SQL, table, transactions

K = "l_orderkey, l_partkey, l_linenumber"


@query("agg_quantile_bounds", ctes=TXN_SQL, sql="""
SELECT 'area by rooms' AS kind, rooms_en AS grp, round(quantile_cont(procedure_area, 0.05), 8) AS lo, round(quantile_cont(procedure_area, 0.99), 8) AS hi
FROM txn WHERE rooms_en IS NOT NULL GROUP BY 2
UNION ALL SELECT 'price by area', area_name_en, round(quantile_cont(meter_sale_price, 0.01), 8), round(quantile_cont(meter_sale_price, 0.99), 8) FROM txn GROUP BY 2""")
def agg_quantile_bounds(spark, sf_dir):
    facts = transactions(spark, sf_dir, "rooms_en", "procedure_area", "area_name_en", "meter_sale_price")
    out = None
    for kind, key, value, low in (("area by rooms", "rooms_en", "procedure_area", 0.05), ("price by area", "area_name_en", "meter_sale_price", 0.01)):
        bounds = outliers.group_quantiles(facts.select(key, value), [key], {"lo": (value, low), "hi": (value, 0.99)})
        one = bounds.select(F.lit(kind).alias("kind"), F.col(key).alias("grp"), F.round("lo", 8).alias("lo"), F.round("hi", 8).alias("hi"))
        out = one if out is None else out.unionByName(one)
    return out


TRIM_SQL = f"""{TXN_SQL},
rb AS (SELECT rooms_en, CASE rooms_en WHEN 'Studio' THEN 25e0 WHEN '1 B/R' THEN 50e0 WHEN '2 B/R' THEN 80e0 WHEN '3 B/R' THEN 100e0 WHEN '4 B/R' THEN 140e0
  ELSE quantile_cont(procedure_area, 0.05) END AS lo, quantile_cont(procedure_area, 0.99) AS hi FROM txn WHERE rooms_en IS NOT NULL GROUP BY rooms_en),
roomed AS (SELECT txn.* FROM txn JOIN rb ON txn.rooms_en = rb.rooms_en WHERE procedure_area BETWEEN lo AND hi),
pb AS (SELECT area_name_en, count(meter_sale_price) AS n, quantile_cont(meter_sale_price, 0.01) AS lo, quantile_cont(meter_sale_price, 0.99) AS hi FROM roomed GROUP BY 1),
trimmed AS (SELECT roomed.* FROM roomed JOIN pb ON roomed.area_name_en = pb.area_name_en WHERE n < 10 OR meter_sale_price BETWEEN lo AND hi)"""


def _stats_sql(source, suffix):
    return f"""(SELECT area_name_en, count(meter_sale_price) AS count{suffix}, round(avg(meter_sale_price), 6) AS mean{suffix}, round(stddev_samp(meter_sale_price), 6) AS std{suffix},
  min(meter_sale_price) AS min{suffix}, round(quantile_cont(meter_sale_price, 0.25), 8) AS p25{suffix}, round(quantile_cont(meter_sale_price, 0.5), 8) AS p50{suffix},
  round(quantile_cont(meter_sale_price, 0.75), 8) AS p75{suffix}, max(meter_sale_price) AS max{suffix} FROM {source} GROUP BY 1)"""


def _rounded_stats(df):
    rounds = {c: F.round(c, 6 if c.startswith(("mean", "std")) else 8) for c in df.columns if c.startswith(("mean", "std", "p25", "p50", "p75"))}
    return df.withColumns(rounds)


TRIM_FIELDS = ["area_name_en", "meter_sale_price", "rooms_en", "procedure_area"]


@query("agg_describe", ctes=TXN_SQL, sql=f"SELECT * FROM {_stats_sql('txn', '')}")
def agg_describe(spark, sf_dir):
    facts = transactions(spark, sf_dir, "area_name_en", "meter_sale_price")
    return _rounded_stats(outliers.describe(facts, "area_name_en", "meter_sale_price"))


@query("dq_outlier_stages", ctes=TRIM_SQL, sql=f"SELECT * FROM {_stats_sql('txn', '_before')} FULL JOIN {_stats_sql('trimmed', '_after')} USING (area_name_en)")
def dq_outlier_stages(spark, sf_dir):
    """Both outlier treatments with statistics before and after."""
    facts = materialise(transactions(spark, sf_dir, *TRIM_FIELDS), "facts")  # read by every pass; the join behind it runs once
    trimmed = materialise(outliers.trim_all(facts, facts), "trimmed")
    change = outliers.describe_change(facts, trimmed, "area_name_en", "meter_sale_price")
    return _rounded_stats(change)


@query("dq_outlier_pipeline", ctes=TRIM_SQL, sql=f"""
SELECT b.*, a.* EXCLUDE (area_name_en), n.* FROM {_stats_sql('txn', '_before')} b LEFT JOIN {_stats_sql('trimmed', '_after')} a ON a.area_name_en = b.area_name_en,
(SELECT x AS rows_before, y AS rows_after_rooms, z AS rows_after_groups, x - y AS removed_by_rooms, y - z AS removed_by_groups
  FROM (SELECT (SELECT count(*) FROM txn) AS x, (SELECT count(*) FROM roomed) AS y, (SELECT count(*) FROM trimmed) AS z)) n""")
def dq_outlier_pipeline(spark, sf_dir):
    """The whole outlier stage: statistics per area before and after, with the number of rows that each treatment removed."""
    facts = materialise(transactions(spark, sf_dir, *TRIM_FIELDS), "facts")  # read by every pass; the join behind it runs once
    trimmed, counts = outliers.trim_counted(facts)
    counts = materialise(counts, "counts")
    stats = _rounded_stats(outliers.describe_change(facts, trimmed, "area_name_en", "meter_sale_price"))
    return stats.select("*", *(counts.select(c).scalar().alias(c) for c in counts.columns))


DRIFT_COLS = ["meter_sale_price", "procedure_area"]
DRIFT_CUT = "1996-01-01"
_DECILES = "[" + ", ".join(f"{k / 10}" for k in range(1, 10)) + "]"


@query("dq_drift_psi", ctes=TXN_SQL + """,
ref AS (SELECT * FROM txn WHERE instance_date < TIMESTAMP '1996-01-01'), cur AS (SELECT * FROM txn WHERE instance_date >= TIMESTAMP '1996-01-01'),
edges AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS col, list_sort(list_distinct(quantile_cont({c}, {_DECILES}))) AS edges FROM ref" for c in DRIFT_COLS) + """),
long_ref AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS double) AS v FROM ref" for c in DRIFT_COLS) + """),
long_cur AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS col, CAST(date_trunc('month', instance_date) AS DATE) AS period, CAST({c} AS double) AS v FROM cur" for c in DRIFT_COLS) + """),
n_ref AS (SELECT col, CASE WHEN v IS NULL THEN -1 ELSE len(list_filter(edges, lambda e: e < v)) END AS bucket, count(*) AS n FROM long_ref JOIN edges USING (col) GROUP BY 1, 2),
n_cur AS (SELECT col, period, CASE WHEN v IS NULL THEN -1 ELSE len(list_filter(edges, lambda e: e < v)) END AS bucket, count(*) AS n FROM long_cur JOIN edges USING (col) GROUP BY 1, 2, 3),
every AS (SELECT col, unnest(generate_series(-1, len(edges))) AS bucket FROM edges),
cells AS (SELECT p.col, p.period, e.bucket, coalesce(r.n, 0) AS nr, coalesce(c.n, 0) AS nc FROM (SELECT DISTINCT col, period FROM n_cur) p JOIN every e USING (col)
  LEFT JOIN n_ref r ON r.col = p.col AND r.bucket = e.bucket LEFT JOIN n_cur c ON c.col = p.col AND c.period = p.period AND c.bucket = e.bucket),
shares AS (SELECT *, (nr + 0.5e0) / (sum(nr) OVER w + 0.5e0 * count(*) OVER w) AS p, (nc + 0.5e0) / (sum(nc) OVER w + 0.5e0 * count(*) OVER w) AS q FROM cells WINDOW w AS (PARTITION BY col, period))""", sql="""
SELECT col AS "column", period, CAST(sum(nc) AS bigint) AS rows, round(sum((q - p) * ln(q / p)), 8) AS psi FROM shares GROUP BY 1, 2""")
def dq_drift_psi(spark, sf_dir):
    """Population stability of prices and areas per month against the years before; empty buckets count half a row."""
    facts = transactions(spark, sf_dir, "instance_date", *DRIFT_COLS)
    cut = F.lit(DRIFT_CUT).cast("timestamp_ntz")
    month = F.trunc("instance_date", "MM")
    found = drift.stability(facts.where(F.col("instance_date") < cut), facts.where(F.col("instance_date") >= cut), DRIFT_COLS, month)
    return found.select("column", "period", "rows", F.round("psi", 8).alias("psi"))


@query("agg_quantile_sketch", ctes=TXN_SQL, sql="SELECT area_name_en, count(meter_sale_price) AS n, true AS lo_close, true AS mid_close, true AS hi_close FROM txn GROUP BY 1 HAVING count(meter_sale_price) > 0")
def agg_quantile_sketch(spark, sf_dir):
    """Quantiles per area from stored sketches per area and month, and whether their ranks lie within three times the error that 99 of 100 keep."""
    facts = transactions(spark, sf_dir, "area_name_en", "instance_date", "meter_sale_price")
    monthly = sketches.quantile_sketches(facts.withColumn("month", F.trunc("instance_date", "MM")), ["area_name_en", "month"], "meter_sale_price")
    probabilities = {"lo": 0.01, "mid": 0.5, "hi": 0.99}
    found = materialise(sketches.rolled_up_quantiles(materialise(monthly, "sketches"), ["area_name_en"], probabilities), "rolled")
    value = F.col("meter_sale_price")
    placed = facts.join(found, "area_name_en").groupBy("area_name_en", "n").agg(*(
        F.struct(F.count_if(value < F.col(c)).alias("below"), F.count_if(value <= F.col(c)).alias("upto")).alias(c) for c in probabilities))
    slack = 3 * sketches.rank_error() * F.col("n") + 1
    close = [((F.col(f"{c}.below") <= p * F.col("n") + slack) & (F.col(f"{c}.upto") >= p * F.col("n") - slack)).alias(f"{c}_close") for c, p in probabilities.items()]
    return placed.select("area_name_en", "n", *close)


@query("agg_distinct_sketch", ctes=TXN_SQL, sql="SELECT count(DISTINCT project_number) AS project_number, count(DISTINCT project_name_en) AS project_name_en, true AS project_number_close, true AS project_name_en_close FROM txn")
def agg_distinct_sketch(spark, sf_dir):
    """Distinct values over all months from stored sketches per month, beside the exact counts."""
    cols = ["project_number", "project_name_en"]
    facts = transactions(spark, sf_dir, "instance_date", *cols)
    monthly = materialise(sketches.distinct_sketches(facts, [F.trunc("instance_date", "MM").alias("month")], cols), "sketches")
    about = sketches.rolled_up_distinct(monthly, [], cols).select(*(F.col(c).alias(f"_{c}") for c in cols))
    exact = aggregates.distinct_counts(facts, cols).drop("rows")
    both = exact.select(*cols, *(about.select(f"_{c}").scalar().alias(f"_{c}") for c in cols))
    return both.select(*cols, *((F.abs(F.col(f"_{c}") - F.col(c)) <= sketches.distinct_error() * F.col(c) + 1).alias(f"{c}_close") for c in cols))


MISSING_SQL = "count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS string)) = '' OR CAST({c} AS string) = 'Missing_{n}') AS {a}"


@query("agg_missing_count", ctes=TXN_SQL, sql="SELECT " + ", ".join(
    MISSING_SQL.format(c=c, n=c, a=c) for c in ("developer_name_en", "developer_number", "floor_key", "land_type_en")) + " FROM txn")
def agg_missing_count(spark, sf_dir):
    cols = ["developer_name_en", "developer_number", "floor_key", "land_type_en"]
    return aggregates.missing_counts(transactions(spark, sf_dir, *cols), cols)


@query("dq_recovery_report", ctes=ENRICH_SQL, sql="SELECT " + ", ".join([
    MISSING_SQL.format(c="developer_number", n="developer_number", a="developer_number_before"), MISSING_SQL.format(c="developer_name_en", n="developer_name_en", a="developer_name_en_before"),
    MISSING_SQL.format(c="dev_num", n="developer_number", a="developer_number_after"), MISSING_SQL.format(c="dev_name", n="developer_name_en", a="developer_name_en_after")]) + " FROM step2")
def dq_recovery_report(spark, sf_dir):
    """Missing developers before and after enrichment; counted where the rows are, in one pass each."""
    cols = ["developer_number", "developer_name_en"]
    before = aggregates.missing_counts(transactions(spark, sf_dir, *cols), cols, "_before")
    after = aggregates.missing_counts(enriched(spark, sf_dir), cols, "_after")
    return before.select("*", *(after.select(c).scalar().alias(c) for c in after.columns))


MEDIAN_COLS = ["has_parking", "meter_sale_price", "unit_balcony_area", "built_up_area", "swimming_pools"]


@query("agg_global_median", ctes=TXN_SQL, sql="SELECT " + ", ".join(f"round(CAST(median({c}) AS double), 8) AS {c}" for c in MEDIAN_COLS) + " FROM txn")
def agg_global_median(spark, sf_dir):
    mid = outliers.medians(transactions(spark, sf_dir, *MEDIAN_COLS), MEDIAN_COLS)
    return mid.select(*(F.round(c, 8).alias(c) for c in MEDIAN_COLS))


@query("agg_month_panel", ctes=f"{TXN_SQL}, {QUOTES_SQL}, {CALENDAR_SQL}", sql="""
SELECT area_name_en, CAST(date_trunc('month', instance_date) AS DATE) AS month, median(meter_sale_price) AS monthly_price, count(*) AS txn_count,
  round(ln(1 + count(*)), 8) AS log_txn_count, round(avg(has_parking), 8) AS pct_has_parking, round(avg(swimming_pools), 8) AS pct_swimming_pools,
  median(oil_close) AS oil_close, median(gold_close) AS gold_close, median(dfm_close) AS dfm_close
FROM txn JOIN calendar ON CAST(instance_date AS DATE) = date GROUP BY 1, 2""")
def agg_month_panel(spark, sf_dir):
    facts = transactions(spark, sf_dir, "area_name_en", "instance_date", "meter_sale_price", "has_parking", "swimming_pools")
    facts = joins.on_calendar(facts, "instance_date", joins.asset_calendar(quotes(spark, sf_dir), ASSETS))
    flags = ["has_parking", "swimming_pools"]
    out = panel.month_panel(facts, flags=flags, closes=[f"{a}_close" for a in ASSETS])
    return out.withColumns({c: F.round(c, 8) for c in ["log_txn_count", *(f"pct_{f}" for f in flags)]})


@query("agg_smoothed_share", ctes=f"""{TXN_SQL},
l AS (SELECT area_name_en, CAST(date_trunc('month', instance_date) AS DATE) AS month, unnest(['rooms_en', 'nearest_landmark_en', 'nearest_mall_en']) AS feature,
  unnest([rooms_en, nearest_landmark_en, nearest_mall_en]) AS category FROM txn),
g AS (SELECT area_name_en, month, feature, count(*) AS total, count(DISTINCT category) AS k FROM l GROUP BY ALL)""", sql="""
SELECT area_name_en, month, feature, category, round((count(*) + 1e0) / (any_value(total) + any_value(k)), 10) AS share
FROM l JOIN g USING (area_name_en, month, feature) WHERE category IS NOT NULL GROUP BY ALL""")
def agg_smoothed_share(spark, sf_dir):
    cats = ["rooms_en", "nearest_landmark_en", "nearest_mall_en"]
    facts = transactions(spark, sf_dir, "area_name_en", "instance_date", *cats)
    shares = panel.smoothed_shares(facts, "area_name_en", "instance_date", cats)
    return shares.withColumn("share", F.round("share", 10))


@query("agg_share_columns", ctes=f"""{TXN_SQL},
m AS (SELECT area_name_en, CAST(date_trunc('month', instance_date) AS DATE) AS month, rooms_en FROM txn),
g AS (SELECT area_name_en, month, count(*) AS total, count(DISTINCT rooms_en) AS k FROM m GROUP BY 1, 2),
n AS (SELECT area_name_en, month, rooms_en, count(*) AS n FROM m GROUP BY 1, 2, 3)""", sql="""
SELECT area_name_en, month, round(coalesce(max((n + 1e0) / (total + k)) FILTER (WHERE rooms_en = '1 B/R'), 0), 10) AS "pct_rooms_en_1_br",
  round(coalesce(max((n + 1e0) / (total + k)) FILTER (WHERE rooms_en = 'Studio'), 0), 10) AS pct_rooms_en_studio
FROM n JOIN g USING (area_name_en, month) WHERE rooms_en IS NOT NULL GROUP BY 1, 2""")
def agg_share_columns(spark, sf_dir):
    """The shares as panel columns, for named categories."""
    facts = transactions(spark, sf_dir, "area_name_en", "instance_date", "rooms_en")
    shares = panel.smoothed_shares(facts, "area_name_en", "instance_date", ["rooms_en"])
    names = ["pct_rooms_en_1_br", "pct_rooms_en_studio"]
    return panel.share_columns(shares, "area_name_en", names).withColumns({n: F.round(n, 10) for n in names})


# Panel rows with the price of the same month a year earlier as a naive prediction.
NAIVE_SQL = f"""{FLAGSHIP_CTES},
pairs AS (SELECT a.area_name_en, a.month, a.monthly_price AS truth, b.monthly_price AS guess FROM panel a
  JOIN panel b ON a.area_name_en = b.area_name_en AND a.month = CAST(b.month + INTERVAL 12 MONTH AS DATE))"""
METRICS_SQL = """SELECT area_name_en, count(*) AS n, avg((truth - guess) ** 2) AS mse, avg(abs(truth - guess)) AS mae,
  avg(abs(truth - guess) / greatest(abs(truth), 2.220446049250313e-16)) AS mape, sqrt(avg((truth - guess) ** 2)) AS rmse,
  CASE WHEN count(*) > 1 AND var_pop(truth) > 0 THEN 1 - sum((truth - guess) ** 2) / (var_pop(truth) * count(*)) END AS r2 FROM pairs GROUP BY 1"""


def naive_pairs(spark, sf_dir):
    base = materialise(area_month_panel(spark, sf_dir), "panel")
    earlier = base.select("area_name_en", F.add_months("month", 12).alias("month"), F.col("monthly_price").alias("guess"))
    truth = base.select("area_name_en", "month", F.col("monthly_price").alias("truth"))
    return truth.join(earlier, ["area_name_en", "month"])


@query("join_eval", ctes=NAIVE_SQL, sql="SELECT area_name_en, month, truth, guess FROM pairs")
def join_eval(spark, sf_dir):
    return naive_pairs(spark, sf_dir)


@query("agg_error_metrics", ctes=NAIVE_SQL, sql="SELECT area_name_en, n, " + ", ".join(f"round({c}, 6) AS {c}" for c in ("mse", "mae", "mape", "rmse", "r2")) + f" FROM ({METRICS_SQL})")
def agg_error_metrics(spark, sf_dir):
    out = aggregates.error_metrics(naive_pairs(spark, sf_dir), "area_name_en", "truth", "guess")
    return out.withColumns({c: F.round(c, 6) for c in ("mse", "mae", "mape", "rmse", "r2")})


@query("agg_model_summary", ctes=NAIVE_SQL, sql=f"SELECT count(*) AS areas, round(avg(r2), 6) AS mean_r2, round(avg(mape), 6) AS mean_mape, round(avg(mae), 6) AS mean_mae FROM ({METRICS_SQL})")
def agg_model_summary(spark, sf_dir):
    out = aggregates.model_summary(aggregates.error_metrics(naive_pairs(spark, sf_dir), "area_name_en", "truth", "guess"))
    return out.withColumns({c: F.round(c, 6) for c in ("mean_r2", "mean_mape", "mean_mae")})


@query("agg_topn_areas_latest", ctes=TXN_SQL, sql="""
SELECT area_name_en, round(sum(meter_sale_price), 6) AS amount FROM txn WHERE instance_date = (SELECT max(instance_date) FROM txn)
GROUP BY 1 ORDER BY sum(meter_sale_price) DESC, 1 LIMIT 5""")
def agg_topn_areas_latest(spark, sf_dir):
    facts = transactions(spark, sf_dir, "area_name_en", "instance_date", "meter_sale_price")
    return aggregates.top_on_latest_date(facts, "instance_date", "area_name_en", "meter_sale_price").withColumn("amount", F.round("amount", 6))


@query("agg_distinct_counts", ctes=TXN_SQL, sql="""
SELECT count(*) AS rows, count(DISTINCT project_number) AS project_number, count(DISTINCT developer_number) AS developer_number, count(DISTINCT project_name_en) AS project_name_en FROM txn""")
def agg_distinct_counts(spark, sf_dir):
    cols = ["project_number", "developer_number", "project_name_en"]
    return aggregates.distinct_counts(transactions(spark, sf_dir, *cols), cols)


PROFILED = ["rooms_en", "developer_name_en", "floor_key", "has_parking", "unit_balcony_area"]


@query("agg_dataset_profile", ctes=TXN_SQL, sql=f"SELECT count(*) AS rows, {len(PROFILED)} AS columns, " + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in PROFILED) + " AS null_cells FROM txn")
def agg_dataset_profile(spark, sf_dir):
    return aggregates.table_profile(transactions(spark, sf_dir, *PROFILED))


@query("agg_value_domain", ctes=f"""{TXN_SQL},
v AS (SELECT DISTINCT area_name_en, unnest(['rooms_en', 'floor_key', 'project_name_en']) AS feature, unnest([rooms_en, floor_key, project_name_en]) AS value FROM txn),
r AS (SELECT *, row_number() OVER (PARTITION BY area_name_en, feature ORDER BY value) AS place FROM v WHERE value IS NOT NULL),
a AS (SELECT area_name_en, feature, string_agg(value, '|' ORDER BY value) AS vals FROM r WHERE place <= 10 GROUP BY 1, 2),
s AS (SELECT area_name_en, min(procedure_area) AS procedure_area_min, max(procedure_area) AS procedure_area_max FROM txn GROUP BY 1)""", sql="""
SELECT s.*, x.vals AS rooms_en, y.vals AS floor_key, z.vals AS project_name_en FROM s LEFT JOIN a x ON s.area_name_en = x.area_name_en AND x.feature = 'rooms_en'
LEFT JOIN a y ON s.area_name_en = y.area_name_en AND y.feature = 'floor_key' LEFT JOIN a z ON s.area_name_en = z.area_name_en AND z.feature = 'project_name_en'""")
def agg_value_domain(spark, sf_dir):
    features = ["rooms_en", "floor_key", "project_name_en"]
    facts = transactions(spark, sf_dir, "area_name_en", "procedure_area", *features)
    ranges = aggregates.value_ranges(facts, "area_name_en", features, "procedure_area")
    return ranges.withColumns({f: F.array_join(f, "|") for f in features})


FIRST_COLS = ["land_type_en", "nearest_mall_en", "built_up_area"]


@query("agg_group_first", ctes=TXN_SQL, sql="SELECT project_name_en, " + ", ".join(
    f"arg_min({c}, ROW({TXN_ORDER_SQL})) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in FIRST_COLS) + " FROM txn GROUP BY 1")
def agg_group_first(spark, sf_dir):
    facts = transactions(spark, sf_dir, *TXN_ORDER, "project_name_en", *FIRST_COLS)
    return joins.first_known(facts, "project_name_en", FIRST_COLS, TXN_ORDER)


@query("agg_max_month", ctes=TXN_SQL, sql="SELECT last_day(CAST(max(instance_date) AS DATE)) AS pivot_month FROM txn")
def agg_max_month(spark, sf_dir):
    return aggregates.last_month(transactions(spark, sf_dir, "instance_date"), "instance_date")


@query("dq_freshness", sql="""
WITH p AS (SELECT last_day(CAST(max(l_shipdate) AS DATE)) AS pivot_day FROM lineitem),
t AS (SELECT 'orders' AS table_name, last_day(CAST(min(o_orderdate) AS DATE)) AS first_month, last_day(CAST(max(o_orderdate) AS DATE)) AS last_month FROM orders
UNION ALL SELECT 'events', last_day(CAST(min(ts) AS DATE)), last_day(CAST(max(ts) AS DATE)) FROM events)
SELECT table_name, first_month, last_month, CAST((year(pivot_day) - year(last_month)) * 12 + month(pivot_day) - month(last_month) AS int) AS lag_months FROM t, p""")
def dq_freshness(spark, sf_dir):
    pivot = aggregates.last_month(table(spark, sf_dir, "lineitem"), "l_shipdate").scalar()
    tables = {"orders": (table(spark, sf_dir, "orders"), "o_orderdate"), "events": (table(spark, sf_dir, "events"), "ts")}
    return aggregates.freshness(tables, pivot)


# --- sort, limit, sets --------------------------------------------------------------------------------------------


@query("sort_panel", ctes=FLAGSHIP_CTES, sql="SELECT area_name_en, month, monthly_price FROM panel ORDER BY 1, 2")
def sort_panel(spark, sf_dir):
    """Range partitioned and sorted, as a sink would want it."""
    rows = area_month_panel(spark, sf_dir).select("area_name_en", "month", "monthly_price")
    return rows.orderBy("area_name_en", "month")


@query("topk_latest", sql="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10""")
def topk_latest(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").orderBy(F.desc_nulls_last("o_orderdate"), "o_orderkey").limit(10)
    return orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_custkey")


@query("topk_groups", ctes=TXN_SQL, sql="""
SELECT area_name_en, sum(l_quantity) AS amount FROM txn GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def topk_groups(spark, sf_dir):
    sums = transactions(spark, sf_dir, "area_name_en", "l_quantity").groupBy("area_name_en").agg(F.sum("l_quantity").alias("amount"))
    return sums.orderBy(F.desc("amount"), "area_name_en").limit(5)


@query("union_all_stack", ctes=f"{TXN_SQL}, {MEMBERS_SQL}", sql="""
SELECT area_name_en, count(*) AS n, sum(l_quantity) AS quantity FROM (SELECT area_name_en, l_quantity FROM txn
  UNION ALL SELECT "group", l_quantity FROM txn JOIN members ON area_name_en = member) GROUP BY 1""")
def union_all_stack(spark, sf_dir):
    """Rows with their group copies; a row may be copied into several groups."""
    facts = transactions(spark, sf_dir, "area_name_en", "l_quantity")
    stacked = joins.with_group_copies(facts, "area_name_en", members(spark))
    return stacked.groupBy("area_name_en").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("set_distinct", ctes=TXN_SQL, sql="SELECT DISTINCT project_number, developer_number FROM txn")
def set_distinct(spark, sf_dir):
    return transactions(spark, sf_dir, "project_number", "developer_number").distinct()


@query("set_assign_multi", ctes=f"{TXN_SQL}, {MEMBERS_SQL}", sql=f"""
SELECT {K}, "group" AS area_name_en FROM txn JOIN members ON area_name_en = member""")
def set_assign_multi(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "area_name_en")
    return joins.assign_groups(facts, "area_name_en", members(spark))
