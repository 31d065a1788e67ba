"""The stages a user runs on their own tables: DataFrames in, DataFrames out. Only the work folder is written to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow import schemas
from parcelflow.functions import dates, text
from parcelflow.operators import blocks, events, filters, forecast, impute, joins, outliers, panel
from parcelflow.session import drop, materialise, release

def micro_table(projects: DataFrame, developers: DataFrame, buildings: DataFrame, units: DataFrame, order: list[str]) -> DataFrame:
    """Projects, developers, buildings and units linked into one row per link key. order ranks units within a key."""
    schemas.require(units, ["property_id", "parent_property_id", *order])
    owned = filters.coerce_dates(joins.merge(projects, developers, ["developer_id"], "left"), fv.PROJECT_DATES)
    placed = joins.merge(buildings, owned.drop("property_id"), ["area_id", "project_id"], "full")
    placed = filters.coerce_dates(filters.drop_listed(placed, fv.UNUSED), ["creation_date"])
    placed = filters.add_suffix(placed, fv.UNIT_FILL, "_bld").withColumnRenamed("property_id", "property_id_bld")
    rank = [F.col(c).asc_nulls_last() for c in ("project_id_bld", "project_number", "area_id_bld")]
    placed = joins.keep_one(placed, ["property_id_bld"], rank)
    placed = placed.withColumn("parent_property_id", F.col("property_id_bld").cast("string"))

    homes = filters.add_suffix(filters.drop_listed(units, fv.UNUSED).distinct(), fv.UNIT_FILL, "_u")
    homes = homes.withColumnRenamed("property_id", "property_id_u").withColumn("parent_property_id", F.col("parent_property_id").cast("string"))
    linked = joins.merge(homes, placed, ["parent_property_id"], "full")
    if "rooms_en_u" in linked.columns:
        linked = linked.withColumn("rooms_en_u", text.rooms_normalised(F.col("rooms_en_u")))
    linked = filters.fill_pairs(linked, fv.UNIT_FILL)
    key = text.link_key(*map(F.col, ["property_sub_type_id_u", "area_id_u", "project_number", "rooms_en_u", "actual_area_u"]))
    linked = linked.withColumns({
        "trans_ubp_key": key, "area_id_u": text.whole(F.col("area_id_u")), "project_number": text.whole(F.col("project_number")),
        "actual_area_u": F.coalesce(F.col("actual_area_u").cast("double"), F.lit(0.0)), "floor_bin": text.floor_bin(F.col("floor_key")),
    })
    rank = [F.col(c).asc_nulls_last() for c in (*order, "property_id_bld", "project_id_bld")]
    return filters.keep_listed(joins.keep_one(linked, ["trans_ubp_key"], rank), fv.MICRO_COLUMNS)


def clean_transactions(
    raw: DataFrame, start: str = "2010-01-01", excluded: list[str] = fv.EXCLUDED_TRANSACTION_GROUPS,
    usage: str = fv.HOME_USAGE, kind: str = fv.HOME_TYPE,
) -> DataFrame:
    """Valid home transactions since the start day, with calendar fields."""
    df = schemas.require(raw, ["instance_date"])
    if df.schema["instance_date"].dataType.typeName() == "string":
        df = filters.coerce_dates(df, ["instance_date"])
    df = filters.drop_suffix(filters.since(df, "instance_date", start), "_ar")
    df = df.withColumns(dates.parts(F.col("instance_date")))
    if "trans_group_en" in df.columns:
        df = filters.exclude_set(df, "trans_group_en", excluded)
    if {"property_usage_en", "property_type_en"} <= set(df.columns):
        df = filters.equals_pair(df, "property_usage_en", usage, "property_type_en", kind)
    return df


def training_table(
    cleaned: DataFrame, micro: DataFrame, projects: DataFrame, developers: DataFrame, order: list[str],
    building_card: DataFrame | None = None, developer_card: DataFrame | None = None, project_card: DataFrame | None = None,
) -> DataFrame:
    """Cleaned transactions trimmed, linked, enriched and imputed. One output row per transaction that survives trimming.

    order is a total order of the transactions; it decides every "first known" value.
    """
    spark, trimmed, matched = cleaned.sparkSession, [], []
    df = materialise(outliers.trim_all(filters.exclude_rooms(cleaned)), "trimmed", trimmed)
    release(spark)
    parts = ["property_sub_type_id", "area_id", "project_number", "rooms_en", "procedure_area"]
    df = df.withColumn("trans_ubp_key", text.link_key(*map(F.col, parts)))
    micro = micro.drop("area_id_u", "project_number") if "project_number" in df.columns else micro
    df = materialise(joins.merge(df, micro, ["trans_ubp_key"], "left").drop(*fv.MICRO_ONLY), "matched", matched)
    drop(spark, trimmed)
    release(spark)
    # Up to three joins shuffle all rows. Five statistics and the result need them, so they are done once; stored columns are a fraction of
    # shuffled rows, so each join is stored, and its shuffle freed, before the next one writes its own.
    df = materialise(joins.enrich_developers(df, projects, developers), "linked")
    drop(spark, matched)
    release(spark)
    df = joins.backfill_developer_names(df, order)
    df = df.withColumn("developer_name_en", text.developer_from_project(F.col("developer_name_en"), F.col("project_name_en")))
    df = df.withColumns({c: text.strip(F.col(c)) for c in ("building_name_en", "developer_name_en", "project_name_en")})
    if building_card is not None:
        df = joins.attach_scorecard(
            df, building_card, "building_name_en", "Building Name", ["Grade", "Price Tier", "Reputation"], ["Score"]
        )
    if developer_card is not None:
        df = joins.attach_scorecard(
            df, developer_card, "developer_name_en", "Developer Name", ["Developer_grade", "Developer Tier"],
            ["Developer Score (0-100)"], {"Grade": "Developer_grade"},
        )
    if project_card is not None:
        df = joins.attach_scorecard(
            df, project_card, "project_name_en", "Project Name",
            ["project_grade", "Developer Reputation Tier", "Location / Positioning Tier"],
            ["Est. Gross Rental Yield (%)", "Composite Score (0-100)"], {"Grade": "project_grade"},
        )
    flags = {"swimming_pool": "swimming_pools", "balcony": "unit_balcony_area", "elevator": "elevators"}
    df = filters.amenity_flags(df, {f: c for f, c in flags.items() if c in df.columns})
    if "nearest_metro_en" in df.columns:
        df = filters.sentinel_flag(df, "metro", "nearest_metro_en", fv.NO_METRO)
    rooms = "rooms_en_u" if "rooms_en_u" in df.columns else "rooms_en"
    df = df.withColumn(rooms, text.room_group(F.col(rooms)))
    df = impute.fill_from_group(df, order)
    if "unit_balcony_area" in df.columns:
        df = filters.zero_where(df, "unit_balcony_area", "property_type_en", ["Building", "Villa"])
    df = outliers.fill_medians(df, [c for c in fv.MEDIAN_FILL if c in df.columns])
    df = df.withColumn("floor", text.floor_value(F.col("floor_key")))
    return filters.label_missing(df, fv.LABELLED)


def monthly_training_panel(
    cleaned: DataFrame, quotes: DataFrame, assets: list[str], members: DataFrame, order: list[str], min_rows: int = fv.MIN_AREA_ROWS,
    min_months: int = fv.MIN_SERIES_MONTHS, categories: dict[str, list[str]] = {}, max_zero_share: float = fv.MAX_ZERO_SHARE,
) -> DataFrame:
    """Month panel with market covariates, category shares and area numbers for large areas and all area groups.

    Gaps in the facts are filled forward within their area, then facts on days off the calendar go. quotes: (date, asset,
    close, volume). categories: column -> the values whose smoothed shares become columns. Numeric columns that are zero in
    more than max_zero_share of the rows are dropped, except prices, counts and returns.
    """
    calendar = joins.asset_calendar(impute.daily_quotes(quotes), assets)
    flags = [c for c in ("has_parking", "swimming_pool", "balcony", "elevator", "metro") if c in cleaned.columns]
    keep = dict.fromkeys(["area_name_en", "instance_date", "meter_sale_price", *flags, *categories, *order])
    facts = blocks.forward_fill(cleaned.select(*keep), ["area_name_en"], order, [*flags, "meter_sale_price"])
    closes = [f"{a}_close" for a in assets]
    facts = joins.on_calendar(facts, "instance_date", calendar).select("area_name_en", "instance_date", "meter_sale_price", *flags, *closes, *categories)
    facts = joins.with_group_copies(materialise(facts, "filled"), "area_name_en", members)
    groups = [r[0] for r in members.select("group").distinct().collect()]
    facts = filters.min_group_count(facts, "area_name_en", min_rows, groups)
    rows = panel.month_panel(facts, flags=flags, closes=closes)
    if categories:
        shares = panel.smoothed_shares(facts, "area_name_en", "instance_date", list(categories))
        names = [text.share_label(feature, value) for feature, values in categories.items() for value in values]
        rows = rows.join(materialise(panel.share_columns(shares, "area_name_en", names), "shares"), ["area_name_en", "month"], "left")
    rows = panel.asset_moves(panel.lagged_returns(panel.next_return(rows)), assets)
    rows = rows.na.fill(0.0, subset=filters.numeric_columns(rows))
    rows = materialise(filters.min_group_count(rows, "area_name_en", min_months), "panel")
    kept = ["monthly_price", "txn_count", "log_txn_count", "log_price", "future_log_return_1m", "lag_1_return", "lag_2_return"]
    rows = filters.drop_sparse(rows, kept, max_zero_share)
    return rows.join(blocks.dense_ids(rows, "area_name_en").withColumnRenamed("id", "area_number"), "area_name_en")


def area_forecasts(
    prices: DataFrame, methods: dict[str, forecast.Forecaster] = forecast.FORECASTERS, steps: int = fv.HORIZON, periods: int = fv.BACKTEST_MONTHS,
) -> tuple[DataFrame, DataFrame]:
    """(forecast rows, backtest metrics of the method chosen per area) from prices(area_name_en, month, monthly_price).

    The method with the lowest held-out error continues an area's gridded series; areas without a backtest take the first
    method. methods are forecasters by name, so a function of one's own (forecast.custom) competes with the rest.
    """
    keys = ("area_name_en", "month", "monthly_price")
    series = materialise(forecast.gridded(prices, *keys), "grid")
    name = lambda df, n: df.withColumn("algorithm", F.lit(n))
    judged = reduce(DataFrame.unionByName, (name(forecast.backtest(prices, *keys, periods, m), n) for n, m in methods.items()))
    best = materialise(forecast.select_best(judged, "area_name_en"), "best")
    ahead = reduce(DataFrame.unionByName, (name(forecast.forecast(series, *keys, steps, m), n) for n, m in methods.items()))
    ahead = ahead.join(best.select("area_name_en", F.col("algorithm").alias("_best")), "area_name_en", "left")
    chosen = ahead.where(F.col("algorithm") == F.coalesce("_best", F.lit(next(iter(methods))))).drop("_best")
    return chosen.withColumnRenamed("prediction", "predictions"), best


def news_adjusted(
    ahead: DataFrame, news: DataFrame, weights: DataFrame, channels: DataFrame, sensitivity: DataFrame, ids: DataFrame, signed: bool = False,
) -> DataFrame:
    """Forecast rows shifted by the news: scored events, monthly channel signals, area scores and their decay.

    ahead: (area_name_en, area_id, month, predictions). news: (article_id, published_date, event_code, title) with weights by
    article. channels: (event_code, channel, weight). sensitivity: (area, channel, weight). ids: (area, area_id).
    """
    rows = events.channel_rows(events.score(news, weights), channels)
    scores = events.month_scores(rows, sensitivity).join(ids, "area").select("month", "area_id", "macro_news_factor", "drivers")
    scores = materialise(scores, "scores")
    merged = joins.by_month_and_area(ahead, scores).withColumn("macro_news_factor", F.coalesce("macro_news_factor", F.lit(0.0)))
    merged = materialise(merged, "merged")
    shock = panel.last_nonzero(merged, "area_id", "month", "macro_news_factor")
    return events.decay_adjust(merged, shock, events.dominant_event(news), scores.agg(F.max("month")).scalar(), signed=signed)
