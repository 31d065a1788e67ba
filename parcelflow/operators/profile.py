"""Unit-profile requests answered in batch: defaults, matching history, monthly series and the report.

Many requests share a profile, so work is done once per distinct profile. Matching never pairs requests with history
rows: profiles and the distinct history combinations meet on subsets of equal columns (see nearest_combinations).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow.functions import numeric, text
from parcelflow.operators import forecast, joins, panel
from parcelflow.operators.outliers import trim_middle
from parcelflow.operators.quantiles import group_quantiles
from parcelflow.session import materialise

_ANY, _NONE, _SEP = "\x02", "\x03", "\x01"


# --- requests -----------------------------------------------------------------------------------------------------


def resolve_area(requests: DataFrame, centres: DataFrame, max_km: float = fv.MAX_MATCH_KM) -> DataFrame:
    """area_name_en of a request: the named area, else the nearest centre within max_km, then its stand-in if any."""
    near = joins.nearest_of_many(requests.where(F.col("area_name").isNull()), ["request_id"], "lat", "lon", centres, max_km)
    named = requests.where(F.col("area_name").isNotNull()).withColumns(
        {"nearest_area": F.lit(None).cast("string"), "distance_km": F.lit(None).cast("double")}
    )
    both = named.unionByName(near).withColumn("_area", F.coalesce("area_name", "nearest_area"))
    return joins.resolve_alias(both, "_area", "area_name_en").drop("_area")


def resolve_defaults(
    requests: DataFrame, ranges: DataFrame, latest: DataFrame, fields: dict[str, str], locked: list[str] = (),
    area: str = "area_name_en", literals: dict = fv.REQUEST_DEFAULTS,
) -> DataFrame:
    """Each field by tier: allowed request value, the area's first value, its latest row, any area's first, a constant.

    ranges: one row per area with an array of allowed texts per field. latest: one row per area. fields: name -> type.
    An area is found in any letter case and takes the spelling of ranges, else of latest.
    """
    firsts = ranges.agg(
        *(F.min_by(F.try_element_at(F.col(f), F.lit(1)), F.when(F.size(f) > 0, F.col(area))).alias(f) for f in fields)
    )
    any_first = firsts.select(F.struct(*fields)).scalar()
    allowed = _by_name(ranges, area, "_ranges_area", [F.col(f).alias(f"_allowed_{f}") for f in fields])
    rows = _by_name(latest, area, "_latest_area", [F.col(f).cast("string").alias(f"_row_{f}") for f in fields])
    df = requests.withColumn("_name", text.name_key(F.col(area)))
    df = df.join(materialise(allowed, "ranges"), "_name", "left").join(materialise(rows, "latest"), "_name", "left")
    df = df.withColumn("_any_first", any_first).withColumn(area, F.coalesce("_ranges_area", "_latest_area", area))
    out = {}
    for f, kind in fields.items():
        wanted = F.lit(None).cast("string") if f in locked or f not in requests.columns else F.col(f).try_cast(kind).cast("string")
        listed = F.col(f"_allowed_{f}")
        no_range = listed.isNull() | (F.size(listed) == 0)
        tiers = [
            F.when(wanted.isNotNull() & (no_range | F.array_contains(listed, wanted)), wanted),
            F.try_element_at(listed, F.lit(1)),
            F.col(f"_row_{f}"),
            F.col("_any_first")[f],
        ]
        out[f] = F.coalesce(*(t.try_cast(kind) for t in tiers), F.lit(literals[f]).cast(kind))
    return df.withColumns(out).drop(*(f"_allowed_{f}" for f in fields), *(f"_row_{f}" for f in fields), "_any_first", "_name", "_ranges_area", "_latest_area")


def _by_name(rows: DataFrame, area: str, out: str, cols: list[Column]) -> DataFrame:
    """One row per area name, whatever its letter case: the first spelling in sorted order."""
    named = rows.where(F.col(area).isNotNull()).select(text.name_key(F.col(area)).alias("_name"), F.col(area).alias(out), *cols)
    return joins.keep_one(named, ["_name"], [F.col(out)])


def clamp_requested_area(requests: DataFrame, limits: DataFrame, rooms: str = "rooms_en", area: str = "procedure_area") -> DataFrame:
    """Requested unit area within its room range, tightened by what the area has seen.

    limits: (area_name_en, procedure_area_min, procedure_area_max), one row per area.
    """
    low, high = (F.lit(x) for x in fv.REQUEST_AREA_RANGE_OTHER)
    for label, a, b in fv.REQUEST_AREA_RANGES:
        low = F.when(F.col(rooms) == label, F.lit(a)).otherwise(low)
        high = F.when(F.col(rooms) == label, F.lit(b)).otherwise(high)
    df = requests.join(materialise(limits, "limits"), "area_name_en", "left")
    low = F.greatest(low, F.col("procedure_area_min"))
    high = F.least(high, F.col("procedure_area_max"))
    value = numeric.clamp(F.coalesce(F.col(area), F.lit(fv.REQUEST_AREA_DEFAULT)), low, high)
    return df.withColumn(area, value).drop("procedure_area_min", "procedure_area_max")


# --- matching history ---------------------------------------------------------------------------------------------


def combination(area: str, cols: list[str]) -> Column:
    """Exact key of an area and its column values, missing values included."""
    return F.concat_ws(_SEP, F.col(area), *(F.coalesce(_text(c), F.lit(_NONE)) for c in cols))


def _text(c: str) -> Column:
    return text.strip(F.col(c).cast("string"))


def _subsets(cols: list[str]) -> Column:
    """All subsets of columns with known values, as (size, which columns, their values)."""
    out = []
    for mask in range(2 ** len(cols)):
        chosen = [c for i, c in enumerate(cols) if mask >> i & 1]
        known = reduce(lambda a, b: a & b, (_text(c).isNotNull() for c in chosen), F.lit(True))
        values = F.concat_ws(_SEP, *(_text(c) if c in chosen else F.lit(_ANY) for c in cols))
        entry = F.struct(F.lit(len(chosen)).alias("size"), F.lit(mask).alias("mask"), values.alias("values"))
        out.append(F.when(known, entry))
    return F.filter(F.array(*out), lambda s: s.isNotNull())


def nearest_combinations(profiles: DataFrame, history: DataFrame, cols: list[str], area: str = "area_name_en") -> DataFrame:
    """(profile, combination, mismatch): the history combinations of the profile's area with the fewest differing columns.

    A column the profile leaves open counts as equal; a missing history value equals nothing. Fewest mismatches means the
    largest subset of equal columns, so both sides list their subsets and meet by equality. Both tables are distinct
    combinations of category values: their size follows the vocabulary, not the rows.
    """
    combos = history.select(area, *(_text(c).alias(c) for c in cols)).distinct().withColumn("combination", combination(area, cols))
    right = combos.select(area, "combination", F.explode(_subsets(cols)).alias("_s")).select(area, "combination", "_s.size", "_s.mask", "_s.values")
    wanted = reduce(lambda a, b: a + b, (_text(c).isNotNull().cast("int") for c in cols))
    left = profiles.withColumn("_wanted", wanted).select(area, "profile", "_wanted", F.explode(_subsets(cols)).alias("_s"))
    left = left.select(area, "profile", "_wanted", "_s.size", "_s.mask", "_s.values")
    right = materialise(right, "combinations")
    meet = [area, "size", "mask", "values"]
    shared = left.join(right.select(*meet).distinct(), meet, "left_semi")
    best = shared.groupBy("profile").agg(F.max("size").alias("_best"))
    top = left.join(best, "profile").where(F.col("size") == F.col("_best"))
    return top.join(right, meet).select("profile", "combination", (F.col("_wanted") - F.col("_best")).alias("mismatch"))


def with_profile(requests: DataFrame, cols: list[str], area: str = "area_name_en") -> DataFrame:
    return requests.withColumn("profile", combination(area, cols))


def history_window(history: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """Rows from the start day to the end of the end month; applied before matching, so profiles match what is used."""
    kind = history.schema[date].dataType
    after = F.add_months(F.trunc(F.lit(end).cast("date"), "MM"), 1).cast(kind)
    return history.where((F.col(date) >= F.lit(start).cast(kind)) & (F.col(date) < after))


def group_history(history: DataFrame, area: str = "area_name_en") -> DataFrame:
    """History plus, under each stand-in's name, the rows of its member areas (group names match in any letter case)."""
    names = sorted({name for _, name in fv.AREA_STAND_INS})
    pairs = [(name, member) for name in names for group, member in fv.AREA_GROUPS if group.lower() == name.lower()]
    members = joins.literal_table(history.sparkSession, pairs, "group string, member string")
    return joins.with_group_copies(history, area, members)


def price_counts(history: DataFrame, cols: list[str] = fv.PROFILE_COLUMNS, area: str = "area_name_en", date: str = "instance_date", price: str = "meter_sale_price") -> DataFrame:
    """(area, cols, combination, month, price, n): how often each price occurs per combination and month."""
    rows = history.select(area, *(_text(c).alias(c) for c in cols), F.trunc(date, "MM").alias("month"), F.col(price).alias("price"))
    return rows.groupBy(area, *cols, "month", "price").agg(F.count("*").alias("n")).withColumn("combination", combination(area, cols))


def group_counts(counts: DataFrame, cols: list[str] = fv.PROFILE_COLUMNS, area: str = "area_name_en") -> DataFrame:
    """price_counts of group_history, from the price_counts of the history: facts are read once and only counts are copied."""
    both = group_history(counts.drop("combination"), area)
    return both.groupBy(area, *cols, "month", "price").agg(F.sum("n").alias("n")).withColumn("combination", combination(area, cols))


def matching_history(profiles: DataFrame, counts: DataFrame, cols: list[str] = fv.PROFILE_COLUMNS, area: str = "area_name_en") -> DataFrame:
    """(profile, mismatch, month, price, n) from price_counts. profiles has one row per profile.

    Profiles meet counts, not rows: a combination that many profiles use brings each of its prices of a month once.
    """
    pairs = materialise(nearest_combinations(profiles, counts, cols, area), "pairs")
    return counts.join(pairs, "combination").select("profile", "mismatch", "month", "price", "n")


def monthly_series(matched: DataFrame, start: str = fv.HISTORY_START, end: str | None = None) -> DataFrame:
    """Per profile: trimmed monthly median on every month end from start to end, gaps interpolated."""
    matched = materialise(matched.select("profile", "month", "price", "n"), "matched")
    kept = trim_middle(matched, ["profile"], "price", weight="n")
    medians = group_quantiles(kept, ["profile", "month"], {"median_price": ("price", 0.5)}, weight="n")
    medians = materialise(medians, "medians")
    full = panel.on_grid(medians, "profile", "month", start, end)
    return panel.interpolate(full, "profile", "month", "median_price").withColumn("month", F.last_day("month"))


# --- report -------------------------------------------------------------------------------------------------------


def report(history: DataFrame, ahead: DataFrame, news: DataFrame, pivot: Column, today: Column) -> DataFrame:
    """One row per profile: series before, at and after the pivot month, and the news-adjusted forecast.

    history: (profile, month, median_price) up to the pivot; ahead: (profile, month, predictions); news: (profile, month,
    adjusted_pred), at most one row per month. All months are month ends. A month in both keeps its forecast.
    """
    past = history.select("profile", "month", "median_price", F.lit(True).alias("is_history"))
    rows = forecast.splice(past, ahead.select("profile", "month", "predictions", F.lit(False).alias("is_history")))
    rows = joins.keep_one(rows, ["profile", "month"], [F.col("is_history"), F.col("median_price").desc_nulls_last()])
    rows = materialise(rows, "spliced")
    at = panel.pivot_price(rows, "profile", "month", "median_price", pivot, today)
    rows = rows.join(news.select("profile", "month", "adjusted_pred"), ["profile", "month"], "left")
    rows = rows.join(at, "profile")
    chain = panel.pivot_chain(rows, "profile", "month", "median_price", "adjusted_pred", F.col("pivot_month"))
    chain = chain.select("profile", "month", "macro_forecast", "news_adjusted_forecast")
    month, at_pivot = F.col("month"), F.col("pivot_month")
    values = {
        "before_prediction": (F.col("median_price"), F.col("is_history") & (month < at_pivot)),
        "prediction_point": (F.col("median_price"), month == at_pivot),
        "forecast": (F.col("macro_forecast"), month > at_pivot),
        "news_adjusted_forecast": (F.col("news_adjusted_forecast"), month > at_pivot),
    }
    facts = [(F.count("adjusted_pred") > 0).alias("news_available"), F.first("pivot_month").alias("pivot_month")]
    return forecast.series_arrays(rows.join(chain, ["profile", "month"], "left"), "profile", "month", values, facts)


def answer(
    requests: DataFrame, history: DataFrame, ranges: DataFrame, latest: DataFrame, centres: DataFrame, adjusted: DataFrame,
    fields: dict[str, str], cols: list[str], start: str, end: str, today: str, locked: list[str] = (),
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Reports of a batch of requests. Requests whose area cannot be found get no row.

    history: transactions with area_name_en, the match columns, instance_date and meter_sale_price. adjusted:
    (area_name_en, month end, predictions, adjusted_pred). fields: request fields with their types; cols: the fields
    history is matched on. start, end (the pivot month) and today bound the series. shape formats the reports, which have one row per
    profile; they are stored before the requests meet them, so nothing of a report is computed again for each request.
    """
    resolved = resolve_defaults(resolve_area(requests, centres), ranges, latest, fields, locked)
    keyed = with_profile(resolved.where(F.col("area_name_en").isNotNull()), cols).select("request_id", "profile", "area_name_en", *cols)
    keyed = materialise(keyed, "requests")
    profiles = materialise(keyed.select("profile", "area_name_en", *cols).distinct(), "profiles")
    window = history_window(history.select("area_name_en", *cols, "instance_date", "meter_sale_price"), "instance_date", start, end)
    counts = materialise(group_counts(materialise(price_counts(window, cols), "area-counts"), cols), "price-counts")
    past = monthly_series(matching_history(profiles, counts, cols), start, end)
    ahead = profiles.select("profile", "area_name_en").join(adjusted, "area_name_en")
    pivot, now = (F.last_day(F.lit(d).cast("date")) for d in (end, today))
    answers = report(past, ahead.select("profile", "month", "predictions"), ahead.select("profile", "month", "adjusted_pred"), pivot, now)
    answers = materialise(shape(answers) if shape else answers, "answers")
    return keyed.select("request_id", "profile", "area_name_en").join(answers, "profile").drop("profile")


def area_catalog(latest: DataFrame, centres: DataFrame, area: str = "area_name_en") -> DataFrame:
    """Known areas with their centre and default unit."""
    places = centres.select(F.col("area").alias(area), "lat", "lon")
    return latest.join(places, area, "left")
