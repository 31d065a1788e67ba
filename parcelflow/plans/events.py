"""Queries over news events, and imputation."""

from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow.operators import events as ev
from parcelflow.operators import impute, joins, outliers
from parcelflow.plans.filters import KEYS
from parcelflow.plans.joins import QUOTES_SQL, quotes
from parcelflow.plans.registry import query
from parcelflow.session import materialise
from parcelflow.sources.bindings import TXN_ORDER, TXN_ORDER_SQL, TXN_SQL, transactions, view, view_sql

K = "l_orderkey, l_partkey, l_linenumber"

# Configuration of the runs below: how event codes act on channels.
CHANNELS = [
    ("GEO_RISK_ESCALATION", "sentiment", -0.8), ("GEO_RISK_ESCALATION", "tourism", -0.5), ("REGULATORY_EASING_RE", "policy", 0.7),
    ("REGULATORY_EASING_RE", "sentiment", 0.2), ("NEW_SUPPLY_ANNOUNCEMENT", "supply", -0.6), ("OIL_PRICE_SHOCK_UP", "liquidity", 0.5),
    ("OIL_PRICE_SHOCK_UP", "sentiment", 0.1),
]
CHANNEL_NAMES = sorted({c for _, c, _ in CHANNELS})

EVENT_SQL = view_sql("news") + ", " + view_sql("sensitivity_wide") + """,
channels(event_code, channel, weight) AS (VALUES """ + ", ".join(f"('{e}', '{c}', {w}e0)" for e, c, w in CHANNELS) + """),
sens AS (UNPIVOT sensitivity_wide ON sentiment, tourism, policy, supply, liquidity INTO NAME channel VALUE weight),
scored AS (SELECT *, least(greatest(coalesce(entity_tier_weight, 0.5e0) * coalesce(event_scale_weight, 0.5e0) * coalesce(geo_relevance_weight, 0.5e0), 0.2e0), 1.5e0) AS strength FROM news),
crows AS (SELECT published_date, article_id, title, channel, strength * weight AS contribution FROM scored JOIN channels USING (event_code)
  QUALIFY row_number() OVER (PARTITION BY title, channel ORDER BY published_date, article_id) = 1)"""


def score_sql(period):
    """Scores per period and area from crows(period, channel, contribution)."""
    return f"""{EVENT_SQL},
timed AS (SELECT *, CAST(date_trunc('month', published_date) AS DATE) AS month FROM crows),
sums AS (SELECT {period}, channel, sum(contribution) AS contribution FROM timed GROUP BY 1, 2),
grid AS (SELECT p.{period}, c.channel, coalesce(s.contribution, 0) AS contribution FROM (SELECT DISTINCT {period} FROM sums) p CROSS JOIN (SELECT DISTINCT channel FROM sums) c
  LEFT JOIN sums s ON s.{period} = p.{period} AND s.channel = c.channel),
signals AS (SELECT {period}, channel, tanh((contribution - median(contribution) OVER w) / greatest(max(contribution) OVER w - min(contribution) OVER w, 1e-6)) AS signal
  FROM grid WINDOW w AS (PARTITION BY channel)),
parts AS (SELECT {period}, area, channel, signal * weight AS part FROM signals JOIN sens USING (channel)),
scores AS (SELECT {period}, area, sum(part) AS macro_news_factor,
  concat('{{', coalesce(string_agg(concat('"', channel, '":', CAST(round(part, 4) AS string)), ',' ORDER BY channel) FILTER (WHERE abs(part) > 0.01), ''), '}}') AS drivers FROM parts GROUP BY 1, 2)"""


def channels(spark):
    return joins.literal_table(spark, CHANNELS, "event_code string, channel string, weight double")


def sensitivity(spark, sf_dir):
    wide = view(spark, sf_dir, "sensitivity_wide")
    return wide.unpivot(["area"], ["sentiment", "tourism", "policy", "supply", "liquidity"], "channel", "weight")


def scored(spark, sf_dir):
    """Events and their weights as two tables that meet by article id."""
    news = view(spark, sf_dir, "news")
    weights = news.select("article_id", "entity_tier_weight", "event_scale_weight", "geo_relevance_weight")
    return ev.score(news.select("article_id", "published_date", "event_code", "title"), weights)


def channel_rows(spark, sf_dir):
    return ev.channel_rows(scored(spark, sf_dir), channels(spark))


def month_scores(spark, sf_dir):
    return ev.month_scores(channel_rows(spark, sf_dir), sensitivity(spark, sf_dir))


@query("map_explode_channels", ctes=EVENT_SQL, sql="SELECT published_date, article_id, title, channel, round(contribution, 9) AS contribution FROM crows")
def map_explode_channels(spark, sf_dir):
    return channel_rows(spark, sf_dir).withColumn("contribution", F.round("contribution", 9))


@query("agg_pivot_channels", ctes=score_sql("published_date"), sql="SELECT published_date, " + ", ".join(
    f"round(coalesce(sum(contribution) FILTER (WHERE channel = '{c}'), 0), 8) AS {c}" for c in CHANNEL_NAMES) + " FROM sums GROUP BY 1")
def agg_pivot_channels(spark, sf_dir):
    wide = ev.pivot_channels(ev.channel_sums(channel_rows(spark, sf_dir)), CHANNEL_NAMES)
    return wide.select("published_date", *(F.round(c, 8).alias(c) for c in CHANNEL_NAMES))


@query("agg_collect_titles", ctes=EVENT_SQL, sql="SELECT DISTINCT published_date, title FROM crows")
def agg_collect_titles(spark, sf_dir):
    return ev.titles_per_date(channel_rows(spark, sf_dir))


@query("math_robust_tanh", ctes=score_sql("published_date"), sql="SELECT published_date, channel, round(signal, 8) AS signal FROM signals")
def math_robust_tanh(spark, sf_dir):
    signals = ev.squash(materialise(ev.channel_sums(channel_rows(spark, sf_dir)), "sums"))
    return signals.withColumn("signal", F.round("signal", 8))


@query("map_dot_drivers", ctes=score_sql("published_date"), sql="SELECT published_date, area, round(macro_news_factor, 8) AS macro_news_factor, drivers FROM scores")
def map_dot_drivers(spark, sf_dir):
    signals = ev.squash(materialise(ev.channel_sums(channel_rows(spark, sf_dir)), "sums"))
    return ev.area_scores(signals, sensitivity(spark, sf_dir)).withColumn("macro_news_factor", F.round("macro_news_factor", 8))


@query("join_cross_dates_areas", ctes=score_sql("month"), sql="SELECT month, area, round(macro_news_factor, 8) AS macro_news_factor, drivers FROM scores")
def join_cross_dates_areas(spark, sf_dir):
    """Every month with every area, reached through the channels both sides share."""
    return month_scores(spark, sf_dir).withColumn("macro_news_factor", F.round("macro_news_factor", 8))


@query("agg_mode_event", ctes=view_sql("news"), sql="""
SELECT published_date, arg_max(event_code, ROW(n, event_code)) AS event_code, max(n) AS n FROM (SELECT published_date, event_code, count(*) AS n FROM news GROUP BY 1, 2) GROUP BY 1""")
def agg_mode_event(spark, sf_dir):
    return ev.most_frequent_event(view(spark, sf_dir, "news"), ["published_date"])


RANKS_SQL = "ranks(event_code, rank) AS (VALUES " + ", ".join(f"('{e}', {r})" for e, r in fv.EVENT_SEVERITY) + ")"


@query("agg_max_severity", ctes=f"{view_sql('news')}, {RANKS_SQL}", sql="""
SELECT published_date, arg_max(news.event_code, ROW(coalesce(rank, 0), news.event_code)) AS event_code, max(coalesce(rank, 0)) AS rank
FROM news LEFT JOIN ranks ON news.event_code = ranks.event_code GROUP BY 1""")
def agg_max_severity(spark, sf_dir):
    return ev.dominant_event(view(spark, sf_dir, "news"), by=["published_date"])


@query("json_event_parse", ctes=view_sql("news"), sql="""
SELECT CASE WHEN article_id % 4 = 1 THEN concat('A', CAST(article_id AS string)) ELSE CAST(article_id AS string) END AS article_id,
  CASE WHEN article_id % 6 = 1 THEN DATE '2024-02-03' ELSE published_date END AS published_date, title,
  CASE WHEN article_id % 9 = 4 THEN 'unknown' ELSE event_code END AS event_code, CASE article_id % 9 WHEN 4 THEN 0 WHEN 5 THEN 2 ELSE 1 END AS n_events
FROM news WHERE article_id % 7 <> 3 AND article_id % 10 <> 7 AND article_id % 11 <> 5""")
def json_event_parse(spark, sf_dir):
    """Documents with missing keys, empty event lists, irrelevant ones and broken ones."""
    return ev.parse_documents(_documents(spark, sf_dir), "doc", "article_id", "published_date", "title").select(
        "article_id", "published_date", "title", "event_code", F.size("events").alias("n_events")
    )


def _documents(spark, sf_dir):
    i = F.col("article_id")
    event = F.concat(F.lit('{"event_code": "'), "event_code", F.lit('", "confidence": 0.5, "countries": ["AE"]}'))
    listed = F.when(i % 9 == 4, "[]").when(i % 9 == 5, F.concat(F.lit("["), event, F.lit(', {"event_code": "second"}]'))).otherwise(F.concat(F.lit("["), event, F.lit("]")))
    doc = F.concat(
        F.lit("{"), F.when(i % 4 == 1, F.concat(F.lit('"article_id": "A'), i.cast("string"), F.lit('", '))).otherwise(""),
        F.when(i % 6 == 1, '"published_date": "2024-02-03", ').otherwise(""),
        F.when(i % 7 == 3, '"has_relevant_event": false, ').when(i % 10 == 7, "").otherwise('"has_relevant_event": true, '),
        F.lit('"events": '), listed, F.when(i % 11 == 5, "").otherwise("}"),
    )
    return view(spark, sf_dir, "news").withColumn("doc", doc)


@query("json_event_rejects", ctes=view_sql("news"), sql="""
SELECT CAST(article_id AS string) AS article_id, 'malformed' AS reason FROM news WHERE article_id % 11 = 5""")
def json_event_rejects(spark, sf_dir):
    """Event documents that cannot be read, for the reject table."""
    return ev.document_rejects(_documents(spark, sf_dir), "doc", "article_id").select("article_id", "reason")


@query("arr_driver_snapshot", ctes=score_sql("month"), sql="""
SELECT area, month, drivers FROM scores WHERE month = (SELECT max(month) FROM timed WHERE month < DATE '2001-11-15' AND title IS NOT NULL)""")
def arr_driver_snapshot(spark, sf_dir):
    rows = materialise(channel_rows(spark, sf_dir), "channel-rows")
    monthly = rows.withColumn("month", F.trunc("published_date", "MM"))
    signals = ev.squash(ev.channel_sums(monthly, "month"), "month")
    return ev.driver_snapshot(rows, signals, sensitivity(spark, sf_dir), F.lit("2001-11-15").cast("date"))


# --- imputation ---------------------------------------------------------------------------------------------------

IMPUTED = [*fv.BUILDING_FILL, *(c for c in fv.PROJECT_FILL if c not in ("project_end_date", "completion_date"))]


@query("imp_group_first", ctes=TXN_SQL + ", " + ", ".join(
    f"{name} AS (SELECT {key}, " + ", ".join(f"arg_min({c}, ROW({TXN_ORDER_SQL})) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in IMPUTED if (c in fv.BUILDING_FILL) == (name == "b")) + " FROM txn GROUP BY 1)"
    for name, key in (("b", "building_name_en"), ("p", "project_name_en"))), sql=f"SELECT {K}, " + ", ".join(
        f"coalesce(t.{c}, {'b' if c in fv.BUILDING_FILL else 'p'}.{c}) AS {c}" for c in IMPUTED) + """
FROM txn t LEFT JOIN b ON t.building_name_en = b.building_name_en LEFT JOIN p ON t.project_name_en = p.project_name_en""")
def imp_group_first(spark, sf_dir):
    facts = transactions(spark, sf_dir, *TXN_ORDER, "building_name_en", "project_name_en", *IMPUTED)
    return impute.fill_from_group(facts, TXN_ORDER).select(*KEYS, *IMPUTED)


@query("imp_median", ctes=TXN_SQL + ", m AS (SELECT " + ", ".join(f"quantile_cont(CAST({c} AS double), 0.5) AS {c}" for c in fv.MEDIAN_FILL) + " FROM txn)",
       sql=f"SELECT {K}, " + ", ".join(f"round(coalesce(CAST(t.{c} AS double), m.{c}), 8) AS {c}" for c in fv.MEDIAN_FILL) + " FROM txn t, m")
def imp_median(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, *fv.MEDIAN_FILL)
    return outliers.fill_medians(facts, fv.MEDIAN_FILL).select(*KEYS, *(F.round(c, 8).alias(c) for c in fv.MEDIAN_FILL))


def _interp_sql(c):
    return f"""CASE WHEN {c} IS NOT NULL THEN {c} WHEN p_{c} IS NULL THEN n_{c} WHEN n_{c} IS NULL THEN p_{c}
      ELSE p_{c} + (n_{c} - p_{c}) * (i - pi) / (ni - pi) END"""


@query("imp_market_daily", ctes=QUOTES_SQL + """,
span AS (SELECT asset, min(date) AS lo, max(date) AS hi FROM quotes GROUP BY 1),
g AS (SELECT asset, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
x AS (SELECT g.asset, g.date, close, volume, row_number() OVER (PARTITION BY g.asset ORDER BY g.date) AS i FROM g LEFT JOIN quotes q ON g.asset = q.asset AND g.date = q.date),
y AS (SELECT *, last_value(CASE WHEN close IS NOT NULL THEN i END IGNORE NULLS) OVER b AS pi, last_value(close IGNORE NULLS) OVER b AS p_close, last_value(volume IGNORE NULLS) OVER b AS p_volume,
  first_value(CASE WHEN close IS NOT NULL THEN i END IGNORE NULLS) OVER a AS ni, first_value(close IGNORE NULLS) OVER a AS n_close, first_value(volume IGNORE NULLS) OVER a AS n_volume FROM x
  WINDOW b AS (PARTITION BY asset ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY asset ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))""",
       sql=f"SELECT asset, date, round({_interp_sql('close')}, 5) AS close, round({_interp_sql('volume')}, 5) AS volume FROM y")
def imp_market_daily(spark, sf_dir):
    daily = impute.daily_quotes(materialise(quotes(spark, sf_dir), "quotes"))
    return daily.withColumns({c: F.round(c, 5) for c in ("close", "volume")})


@query("split_last_month", ctes=TXN_SQL + """,
seg AS (SELECT * REPLACE (coalesce(project_number, -1) AS project_number) FROM txn),
lm AS (SELECT project_number, max(date_trunc('month', instance_date)) AS lm, count(DISTINCT date_trunc('month', instance_date)) AS k FROM seg GROUP BY 1),
cut AS (SELECT t.project_number, min(instance_date) AS cut FROM seg t JOIN lm ON t.project_number = lm.project_number WHERE k > 1 AND date_trunc('month', instance_date) = lm GROUP BY 1)""", sql=f"""
SELECT {K}, t.project_number, CASE WHEN instance_date >= cut THEN 'test' ELSE 'train' END AS split FROM seg t JOIN cut ON t.project_number = cut.project_number""")
def split_last_month(spark, sf_dir):
    """Facts without a project are a segment of their own."""
    facts = transactions(spark, sf_dir, *KEYS, "project_number", "instance_date").na.fill(-1, ["project_number"])
    return impute.split_last_month(facts, "project_number", "instance_date").drop("instance_date")
