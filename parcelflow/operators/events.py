"""News events: parsing, scoring, channels, area scores and decay of their price effect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow import schemas
from parcelflow.functions import dates, numeric
from parcelflow.operators.joins import keep_one, literal_table
from parcelflow.operators.quantiles import bounded_quantile
from parcelflow.session import materialise


_CORRUPT = "_corrupt_record"


def read_documents(docs: DataFrame, doc: str) -> DataFrame:
    """docs with the parsed document `_d` and `_reason`: why it cannot be read (missing, empty, malformed) or is not wanted (irrelevant), else null."""
    schema = f"{schemas.EVENT_DOCUMENT}, {_CORRUPT} string"
    parsed = docs.withColumn("_d", F.from_json(F.col(doc), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    reason = (
        F.when(F.col(doc).isNull(), "missing").when(F.trim(F.col(doc)) == "", "empty").when(F.col(f"_d.{_CORRUPT}").isNotNull(), "malformed")
        .when(~F.coalesce(F.col("_d.has_relevant_event"), F.lit(False)), "irrelevant")
    )
    return parsed.withColumn("_reason", reason)


def document_rejects(docs: DataFrame, doc: str, article: str) -> DataFrame:
    """(article_id, doc, reason) of event documents that cannot be read; those without a relevant event are no rejects."""
    broken = read_documents(docs, doc).where(F.col("_reason").isNotNull() & (F.col("_reason") != "irrelevant"))
    return broken.select(F.col(article).cast("string").alias("article_id"), F.col(doc).alias("doc"), F.col("_reason").alias("reason"))


def parse_documents(docs: DataFrame, doc: str, article: str, date: str, title: str) -> DataFrame:
    """Event documents (JSON) with absent fields taken from the row; only those with a relevant event.

    Unreadable documents drop out here; document_rejects has them. The event code is the first event's.
    """
    parsed = read_documents(docs, doc)
    events = F.coalesce(F.col("_d.events"), F.array().cast(parsed.schema["_d"].dataType["events"].dataType))
    out = parsed.where(F.col("_reason").isNull()).select(
        F.coalesce(F.col("_d.article_id"), F.col(article).cast("string")).alias("article_id"),
        F.coalesce(F.col("_d.published_date"), F.col(date).cast("string")).try_cast("date").alias("published_date"),
        F.coalesce(F.col("_d.title"), F.col(title)).alias("title"),
        events.alias("events"),
    )
    first = F.try_element_at(F.col("events"), F.lit(1))["event_code"]
    return out.withColumn("event_code", F.coalesce(first, F.lit("unknown")))


def score(events: DataFrame, weights: DataFrame, key: str = "article_id") -> DataFrame:
    """Strength of each event by its own article's weights; an article without weights counts 0.5 each."""
    names = ["entity_tier_weight", "event_scale_weight", "geo_relevance_weight"]
    return events.join(weights.select(key, *names), key, "left").withColumn("strength", numeric.strength(*map(F.col, names)))


def channel_rows(scored: DataFrame, channels: DataFrame) -> DataFrame:
    """One row per event and channel with its contribution, each (title, channel) once: the earliest."""
    rows = scored.where(F.col("published_date").isNotNull()).join(channels, "event_code").select(
        "published_date", "article_id", "title", "channel", (F.col("strength") * F.col("weight")).alias("contribution")
    )
    return keep_one(rows, ["title", "channel"], [F.col("published_date"), F.col("article_id")])


def channel_sums(rows: DataFrame, period: str = "published_date") -> DataFrame:
    """(period, channel, contribution)."""
    return rows.groupBy(period, "channel").agg(F.sum("contribution").alias("contribution"))


def titles_per_date(rows: DataFrame) -> DataFrame:
    """The set of titles per date, one row per title, so that a busy day is no single value."""
    return rows.select("published_date", "title").distinct()


def complete_channels(sums: DataFrame, period: str = "published_date") -> DataFrame:
    """Every period with every channel, 0 where it had no contribution. Periods and channels are few."""
    wide = sums.groupBy(period).agg(F.map_from_entries(F.collect_list(F.struct("channel", "contribution"))).alias("_m"))
    names = sums.agg(F.collect_set("channel")).scalar()
    long = wide.withColumn("channel", F.explode(names))
    return long.select(period, "channel", F.coalesce(F.try_element_at("_m", F.col("channel")), F.lit(0.0)).alias("contribution"))


def pivot_channels(sums: DataFrame, channels: list[str], period: str = "published_date") -> DataFrame:
    return sums.groupBy(period).pivot("channel", channels).agg(F.sum("contribution")).na.fill(0.0, channels)


def squash(sums: DataFrame, period: str = "published_date") -> DataFrame:
    """Per channel over all periods: tanh((x - median) / range), absent periods counting 0. Stays in long form."""
    full = complete_channels(sums, period)
    # One value per period and channel: the group is the calendar, not the news.
    spread = full.groupBy("channel").agg(
        bounded_quantile("contribution", 0.5).alias("_mid"), F.min("contribution").alias("_lo"), F.max("contribution").alias("_hi")
    )
    value = numeric.robust_tanh(F.col("contribution"), F.col("_mid"), F.col("_lo"), F.col("_hi"))
    return full.join(materialise(spread, "spread"), "channel").select(period, "channel", value.alias("signal"))


def area_scores(signals: DataFrame, sensitivity: DataFrame, period: str = "published_date", least: float = 0.01) -> DataFrame:
    """(period, area, score, drivers): sum of signal times sensitivity, and the parts that matter as a JSON map.

    Channels without a sensitivity count 0, so each area still gets a row per period.
    """
    parts = signals.join(sensitivity, "channel").withColumn("part", F.col("signal") * F.col("weight"))
    entry = F.when(F.abs("part") > least, F.struct(F.col("channel"), F.round("part", 4).alias("part")))
    return parts.groupBy(period, "area").agg(
        F.sum("part").alias("macro_news_factor"),
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("drivers"),
    )


def month_scores(rows: DataFrame, sensitivity: DataFrame) -> DataFrame:
    """Scores per (month, area): contributions are summed per month before squashing, so months are unique."""
    monthly = rows.withColumn("month", dates.month_start(F.col("published_date")))
    sums = materialise(channel_sums(monthly, "month"), "sums")  # a row per month and channel, read four times; the events behind it once
    return area_scores(squash(sums, "month"), sensitivity, "month")


def dominant_event(events: DataFrame, code: str = "event_code", by: list[str] = ()) -> DataFrame:
    """The present code of highest severity (ties by name), DEFAULT when there is none."""
    ranks = literal_table(events.sparkSession, fv.EVENT_SEVERITY, "event_code string, rank int")
    present = events.select(*by, F.col(code).alias("event_code")).dropna(subset=["event_code"]).distinct()
    ranked = present.join(F.broadcast(ranks), "event_code", "left").withColumn("rank", F.coalesce("rank", F.lit(0)))
    best = F.max(F.struct(F.col("rank"), F.col("event_code")))
    return ranked.groupBy(*by).agg(
        F.coalesce(best["event_code"], F.lit("DEFAULT")).alias("event_code"), F.coalesce(best["rank"], F.lit(0)).alias("rank")
    )


def most_frequent_event(events: DataFrame, by: list[str], code: str = "event_code") -> DataFrame:
    counts = events.groupBy(*by, code).agg(F.count("*").alias("n"))
    best = F.max(F.struct(F.col("n"), F.col(code)))
    return counts.groupBy(*by).agg(best[code].alias(code), best["n"].alias("n"))


def decay_table(spark) -> DataFrame:
    return literal_table(
        spark, fv.EVENT_DECAY, "event_code string, s_halflife double, p_peak double, p_sensitivity double, direction int"
    )


def decay_adjust(
    forecast: DataFrame, base_shock: DataFrame, event: DataFrame, shock_month: Column, signed: bool = False
) -> DataFrame:
    """Forecast (area_id, month, predictions) adjusted by a decaying news shock and a delayed price reaction.

    base_shock has one row per area with its last non-zero factor; event is the one-row dominant event. Months before
    the shock stay as predicted. signed=True lets positive events raise prices; the default lowers them as well.
    """
    params = decay_table(forecast.sparkSession)
    names = params.columns[1:]
    own = event.join(F.broadcast(params), "event_code").agg(F.first(F.struct(*names))).scalar()
    default = params.where("event_code = 'DEFAULT'").select(F.struct(*names)).scalar()
    shock = base_shock.select("area_id", F.col("macro_news_factor").alias("_v0"))
    df = forecast.join(shock, "area_id", "left").withColumn("_params", F.coalesce(own, default)).withColumns({
        "_v0": F.coalesce("_v0", F.lit(0.0)), "_t": dates.month_diff(F.col("month"), shock_month),
    })
    halflife, peak, sens, way = (F.col("_params")[c] for c in names)
    after = F.col("_t") >= 0
    sentiment = numeric.sentiment_decay(F.col("_t"), halflife)
    hump = numeric.price_hump(F.greatest("_t", F.lit(0)), halflife, peak)
    push = -way if signed else F.abs(way)
    df = df.withColumns({
        "sentiment_decay": F.when(after, sentiment).otherwise(1.0),
        "price_impact": F.when(after, hump).otherwise(0.0),
    })
    structural = F.when(F.abs("_v0") > 0.0001, F.col("price_impact") * sens * push).otherwise(0.0)
    factor = F.when(after, 1 + F.col("_v0") * F.col("sentiment_decay") - structural).otherwise(1.0)
    out = {"adjusted_pred": F.col("predictions") * factor}
    if "macro_news_factor" in forecast.columns:
        out["macro_news_factor"] = F.when(after, F.col("_v0") * F.col("sentiment_decay")).otherwise(F.col("macro_news_factor"))
    return df.withColumns(out).drop("_v0", "_t", "_params")


def price_path(adjusted: DataFrame, area: str, start: Column, end: Column) -> DataFrame:
    """Per area, the ordered months of the window with baseline, adjusted price, change and sentiment."""
    base, adj = F.col("predictions"), F.col("adjusted_pred")
    step = F.struct(
        F.date_format("month", "yyyy-MM").alias("month"), F.round(base, 2).alias("baseline"), F.round(adj, 2).alias("adjusted"),
        F.round((adj - base) / base * 100, 2).alias("change_pct"), F.round("sentiment_decay", 3).alias("sentiment_decay"),
    )
    window = adjusted.where(F.col("month").between(start, end) & (base != 0))
    return window.groupBy(area).agg(F.array_sort(F.collect_list(step)).alias("path"))


def driver_snapshot(rows: DataFrame, signals: DataFrame, sensitivity: DataFrame, before: Column, least: float = 0.01) -> DataFrame:
    """Latest month before the window that had titles, and each area's drivers in that month."""
    months = rows.where(F.col("title").isNotNull()).select(dates.month_start(F.col("published_date")).alias("month"))
    last = materialise(months.where(F.col("month") < before).agg(F.max("month").alias("month")), "news-month")
    scores = area_scores(signals.where(F.col("month") == last.scalar()), sensitivity, "month", least)
    return scores.select("area", "month", "drivers")
