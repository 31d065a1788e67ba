"""Joins: linkage, enrichment, lookup and nearest-point matching.

Sides are broadcast only by the planner's size check (see session.materialise); above it they shuffle, where adaptive
execution splits skewed partitions. Full joins are written as a left join plus the unmatched right rows, because a
plain full join cannot be split by skew handling.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow import fixed_values as fv
from parcelflow.functions import numeric, text
from parcelflow.session import materialise


_VARIABLE = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def _key_match(on: list[str], null_safe: bool, left: str = "l", right: str = "r") -> Column:
    def one(c):
        a, b = F.col(f"{left}.{c}"), F.col(f"{right}.{c}")
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(lambda x, y: x & y, (one(c) for c in on))


def merge(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", null_safe: bool = False) -> DataFrame:
    """Join in which a column both sides carry becomes coalesce(left, right). how is 'left', 'inner' or 'full'."""
    if how == "full":
        matched = merge(left, right, on, "left", null_safe)
        keys = left.select(*on).distinct()
        rest = right.alias("l").join(keys.alias("r"), _key_match(on, null_safe), "left_anti").select("l.*")
        return matched.unionByName(rest, allowMissingColumns=True)
    both = left.alias("l").join(right.alias("r"), _key_match(on, null_safe), how)
    shared = set(left.columns) & set(right.columns) - set(on)
    cols = [F.coalesce(F.col(f"l.`{c}`"), F.col(f"r.`{c}`")).alias(c) if c in shared else F.col(f"l.`{c}`") for c in left.columns]
    return both.select(*cols, *(F.col(f"r.`{c}`") for c in right.columns if c not in left.columns))


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given total order. Spark limits each group before the shuffle, so hot keys stay cheap."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_known(df: DataFrame, key: str, cols: list[str], order: list[str]) -> DataFrame:
    """(key, cols): the first known value of each column per key, missing order values first.

    The first order column decides nearly everywhere, and its least value per key is a hash aggregate. Only rows that
    share it are compared by the rest of the order. Order columns of variable width are compared at once.
    """
    at = F.struct(*order)
    rows = df.where(F.col(key).isNotNull()).select(*dict.fromkeys([key, *order, *cols]))
    if len(order) > 1 and not isinstance(df.schema[order[0]].dataType, _VARIABLE):
        lead = F.col(order[0])
        found = [F.min(F.when(F.col(c).isNotNull(), lead)).alias(f"_at_{i}") for i, c in enumerate(cols)]
        open_ = [F.max(F.col(c).isNotNull() & lead.isNull()).alias(f"_open_{i}") for i, c in enumerate(cols)]
        firsts = materialise(rows.groupBy(key).agg(*found, *open_), "firsts")
        is_first = [F.col(c).isNotNull() & lead.eqNullSafe(F.when(~F.col(f"_open_{i}"), F.col(f"_at_{i}"))) for i, c in enumerate(cols)]
        rows = rows.join(firsts, key).where(reduce(lambda x, y: x | y, is_first))
        known = is_first
    else:
        known = [F.col(c).isNotNull() for c in cols]
    return rows.groupBy(key).agg(*(F.min_by(F.col(c), F.when(k, at)).alias(c) for c, k in zip(cols, known)))


def fill_from(df: DataFrame, known: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Missing cols take the value known for the key. known has one row per key, so rows never multiply."""
    names = {c: f"_known_{c}" for c in cols}
    side = materialise(known.select(key, *cols).withColumnsRenamed(names), "known")
    filled = {c: F.coalesce(F.col(c), F.col(n)) for c, n in names.items()}
    return df.join(side, key, "left").withColumns(filled).select(*df.columns)


def enrich_developers(facts: DataFrame, projects: DataFrame, developers: DataFrame) -> DataFrame:
    """Developer number from the project, then developer name from the number, only where missing."""
    numbers = first_known(projects, "project_number", ["developer_number"], ["developer_number"])
    facts = fill_from(facts, numbers, "project_number", ["developer_number"])
    facts = facts.withColumn("developer_name_en", F.nullif(F.col("developer_name_en"), F.lit(fv.MISSING_DEVELOPER)))
    names = first_known(developers, "developer_number", ["developer_name_en"], ["developer_name_en"])
    return fill_from(facts, names, "developer_number", ["developer_name_en"])


def backfill_developer_names(facts: DataFrame, order: list[str]) -> DataFrame:
    """A missing name takes the first name known for the same number inside the facts, else the sentinel."""
    names = first_known(facts, "developer_number", ["developer_name_en"], order)
    filled = fill_from(facts, names, "developer_number", ["developer_name_en"])
    return filled.withColumn("developer_name_en", F.coalesce("developer_name_en", F.lit(fv.MISSING_DEVELOPER)))


def attach_scorecard(
    facts: DataFrame, card: DataFrame, on: str, key: str, texts: list[str], numbers: list[str], renames: dict[str, str] = {}
) -> DataFrame:
    """Scorecard columns by stripped name, one card row per name, with defaults for unmatched rows."""
    card = card.withColumn(key, text.strip(F.col(key))).dropna(subset=[key])
    card = keep_one(card, [key], [F.col(c).asc_nulls_last() for c in card.columns])
    card = card.withColumnRenamed(key, "_card_key").withColumnsRenamed(renames)
    joined = facts.join(card, text.strip(F.col(on)) == F.col("_card_key"), "left").drop("_card_key")
    filled = {c: F.coalesce(F.col(c), F.lit("Unknown")) for c in texts}
    filled |= {c: F.coalesce(numeric.number(F.col(c)), F.lit(0.0)) for c in numbers}
    return joined.withColumns(filled)


def asset_calendar(daily: DataFrame, assets: list[str]) -> DataFrame:
    """Long quotes (date, asset, close, volume) to one row per date on which every asset has a quote."""
    wide = daily.where(F.col("asset").isin(assets)).groupBy("date").agg(
        F.count_distinct("asset").alias("_n"),
        *(F.max(F.when(F.col("asset") == a, F.col(v))).alias(f"{a}_{v}") for a in assets for v in ("close", "volume")),
    )
    return wide.where(F.col("_n") == len(assets)).drop("_n")


def on_calendar(facts: DataFrame, date: str, calendar: DataFrame) -> DataFrame:
    """Facts with the market columns of their day; facts on days without quotes are dropped."""
    side = materialise(calendar.withColumnRenamed("date", "_day"), "calendar")
    return facts.join(side, F.col(date).cast("date") == F.col("_day")).drop("_day")


def by_month_and_area(forecast: DataFrame, scores: DataFrame) -> DataFrame:
    """Forecast rows with the score of their month and (normalised) area id; scores has one row per month and area."""
    left = forecast.withColumns({"area_id": text.norm_id(F.col("area_id")), "month": F.trunc("month", "MM")})
    right = scores.withColumns({"area_id": text.norm_id(F.col("area_id")), "month": F.trunc("month", "MM")})
    return left.join(right, ["month", "area_id"], "left")


def map_values(df: DataFrame, col: str, out: str, pairs: DataFrame) -> DataFrame:
    """out = the value that pairs(key, value) holds for col; pairs has one row per key."""
    side = pairs.select(F.col("key").alias("_key"), F.col("value").alias(out))
    return df.join(side, F.col(col) == F.col("_key"), "left").drop("_key")


def members_of(df: DataFrame, col: str, members: DataFrame) -> DataFrame:
    """Rows whose col is a member of any group."""
    return df.join(members.select(F.col("member").alias(col)).distinct(), col, "left_semi")


def assign_groups(df: DataFrame, col: str, members: DataFrame) -> DataFrame:
    """Every row once per group that lists its col, with col replaced by the group's name."""
    side = members.select(F.col("member").alias(col), F.col("group").alias("_group"))
    return df.join(side, col).withColumn(col, F.col("_group")).select(*df.columns)


def with_group_copies(df: DataFrame, col: str, members: DataFrame) -> DataFrame:
    """The rows themselves plus their group copies."""
    return df.unionByName(assign_groups(df, col, members))


def literal_table(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed lookup table as a DataFrame."""
    return spark.createDataFrame(rows, schema)


def nearest_centre(
    points: DataFrame, lat: str, lon: str, centres: list[tuple[str, float, float]] = fv.AREA_CENTRES,
    max_km: float | None = fv.MAX_MATCH_KM,
) -> DataFrame:
    """Nearest of the fixed centres (ties by name) within max_km, else null, and the distance.

    The centres are a short fixed list, so the search is one expression per row: no join and no shuffle.
    """
    tried = [
        F.struct(
            numeric.haversine_km(F.col(lat), F.col(lon), F.lit(a), F.lit(b)).alias("km"), F.lit(name).alias("area")
        )
        for name, a, b in centres
    ]
    df = points.withColumn("_near", F.when(F.col(lat).isNotNull() & F.col(lon).isNotNull(), F.array_min(F.array(*tried))))
    close = F.lit(True) if max_km is None else F.col("_near.km") <= max_km
    return df.withColumns({"nearest_area": F.when(close, F.col("_near.area")), "distance_km": F.col("_near.km")}).drop("_near")


def nearest_of_many(
    points: DataFrame, key: list[str], lat: str, lon: str, centres: DataFrame, max_km: float = fv.MAX_MATCH_KM, levels: int = 3
) -> DataFrame:
    """The same for a table of centres (area, lat, lon) of any size, through equality on grid cells.

    The search widens level by level: a point that has a centre within the small radius is settled there, and only the
    rest look further. So dense neighbourhoods are searched at a scale that holds few centres, and the result is exact.
    Centres at the same spot are one (the first by name, which is how ties are settled anyway).
    """
    spots = centres.groupBy("lat", "lon").agg(F.min("area").alias("area"))
    spots = materialise(spots.select("area", F.col("lat").alias("_lat"), F.col("lon").alias("_lon")), "centres")
    waiting = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(*key, lat, lon)
    found = None
    for level in reversed(range(levels)):
        best = materialise(_nearest_within(waiting, key, lat, lon, spots, max_km / 8**level), "nearest")
        found = best if found is None else found.unionByName(best)
        waiting = waiting.join(best.select(*key), key, "left_anti")
    return points.join(found, key, "left")


def _grid(lat: Column, radius: float) -> tuple[Column, Column]:
    """(band of latitude, number of cells around the globe in that band).

    A band is no lower than the radius, and its cells are no narrower than the radius anywhere in it, so a circle
    around a point stays within the point's cell and its neighbours; near the poles one cell is the whole band.
    """
    step = radius / 111.0
    band = F.floor(lat / step)
    return band, _cells(band, radius)


def _cells(band: Column, radius: float) -> Column:
    step = radius / 111.0
    furthest = F.least(F.lit(90.0), F.greatest(F.abs(band * step), F.abs((band + 1) * step)))
    shrink = F.cos(F.radians(furthest))
    reach = math.sin(radius * 1.001 / fv.EARTH_RADIUS_KM)
    width = F.degrees(F.asin(F.lit(reach) / F.greatest(shrink, F.lit(reach))))
    return F.when(shrink <= reach, F.lit(1)).otherwise(F.greatest(F.lit(1), F.floor(360.0 / width))).cast("bigint")


def _nearest_within(points: DataFrame, key: list[str], lat: str, lon: str, spots: DataFrame, radius: float) -> DataFrame:
    """Nearest spot of the points that have one within radius. A spot is entered in the cells around it, over the date line
    as well, so it meets every point that may match."""
    cell = lambda lon, n: F.least(F.floor((lon + 180) / 360 * n), n - 1)
    around = F.array(*(F.lit(i) for i in (-1, 0, 1)))
    bands = F.transform(around, lambda d: F.floor(F.col("_lat") / (radius / 111.0)) + d)
    near = spots.withColumn("_cy", F.explode(bands))
    near = near.withColumn("_nx", _cells(F.col("_cy"), radius))
    beside = F.transform(around, lambda d: F.pmod(cell(F.col("_lon"), F.col("_nx")) + d, F.col("_nx")))
    near = near.withColumn("_cx", F.explode(F.array_distinct(beside))).drop("_nx")
    band, cells = _grid(F.col(lat), radius)
    placed = points.withColumn("_cy", band).withColumn("_cx", F.pmod(cell(F.col(lon), cells), cells))
    km = numeric.haversine_km(F.col(lat), F.col(lon), F.col("_lat"), F.col("_lon"))
    met = placed.join(near, ["_cy", "_cx"]).withColumn("_km", km).where(F.col("_km") <= radius)
    best = met.groupBy(*key).agg(F.min(F.struct(F.col("_km").alias("km"), F.col("area"))).alias("_best"))
    return best.select(*key, F.col("_best.area").alias("nearest_area"), F.col("_best.km").alias("distance_km"))


def resolve_alias(df: DataFrame, area: str, out: str, stand_ins: list[tuple[str, str]] = fv.AREA_STAND_INS) -> DataFrame:
    """The stand-in of an area that has one (in any letter case), else the area itself."""
    value = text.name_key(F.col(area))
    found = F.lit(None).cast("string")
    for name, group in stand_ins:
        found = F.when(value == name.strip().lower(), F.lit(group)).otherwise(found)
    return df.withColumn(out, F.coalesce(found, F.col(area)))


def latest_news(news: DataFrame, key: str, month: str, order: list[Column]) -> DataFrame:
    """One news row per key and calendar month (the last in the given order), dated to the month end."""
    monthly = news.withColumn(month, F.last_day(month))
    return keep_one(monthly, [key, month], order)
