"""Quantile trimming and the statistics around it."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow.operators.quantiles import column_quantiles, group_quantiles
from parcelflow.session import drop, materialise


def trim_by_group(
    df: DataFrame, group: str = "area_name_en", value: str = "meter_sale_price", low: float = 0.01, high: float = 0.99,
    min_rows: int = fv.MIN_TRIM_ROWS, max_group_rows: int | None = None,
) -> DataFrame:
    """Rows whose value lies within the group's quantiles; groups with few known values stay whole.

    Rows without a group are dropped; rows without a value survive only in the small groups.
    """
    return _within_group(df, _group_bounds(df, group, value, low, high, max_group_rows), group, value, min_rows)


def _group_bounds(df: DataFrame, group: str, value: str, low: float, high: float, max_group_rows: int | None) -> DataFrame:
    specs = {"_lo": (value, low), "_hi": (value, high)}
    return materialise(group_quantiles(df, [group], specs, (), max_group_rows, {"_n": value}), "bounds")


def _within_group(df: DataFrame, bounds: DataFrame, group: str, value: str, min_rows: int) -> DataFrame:
    inside = (F.col("_n") < min_rows) | F.col(value).between(F.col("_lo"), F.col("_hi"))
    return df.join(bounds, group).where(inside).select(*df.columns)


def trim_area_by_rooms(
    df: DataFrame, room: str = "rooms_en", area: str = "procedure_area", max_group_rows: int | None = None
) -> DataFrame:
    """Unit areas between the room type's fixed minimum (else its p5) and its p99. Rows without a room type go."""
    return _within_rooms(df, _room_bounds(df, room, area, max_group_rows), room, area)


def _room_bounds(df: DataFrame, room: str, area: str, max_group_rows: int | None) -> DataFrame:
    bounds = group_quantiles(df, [room], {"_lo": (area, 0.05), "_hi": (area, 0.99)}, (), max_group_rows)
    fixed = F.lit(None).cast("double")
    for label, room_id in fv.ROOM_IDS.items():
        fixed = F.when(F.col(room) == label, F.lit(float(fv.MIN_AREA_BY_ROOM_ID[room_id]))).otherwise(fixed)
    return materialise(bounds.select(room, F.coalesce(fixed, F.col("_lo")).alias("_lo"), "_hi"), "bounds")


def _within_rooms(df: DataFrame, bounds: DataFrame, room: str, area: str) -> DataFrame:
    return df.join(bounds, room).where(F.col(area).between(F.col("_lo"), F.col("_hi"))).select(*df.columns)


TRIM_COLUMNS = ["rooms_en", "procedure_area", "area_name_en", "meter_sale_price"]


def trim_all(df: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Both treatments in order.

    All bounds are taken from the four columns they need, which are stored once: df may be a join that each pass would run again. stored has
    these columns of df if the caller has them already.
    """
    made: list[str] = []
    slim = materialise(df.select(*TRIM_COLUMNS), "trim-columns", made) if stored is None else stored
    room, area, group, value = TRIM_COLUMNS
    by_room = _room_bounds(slim, room, area, None)
    by_group = _group_bounds(_within_rooms(slim, by_room, room, area), group, value, 0.01, 0.99, None)
    drop(df.sparkSession, made)
    return _within_group(_within_rooms(df, by_room, room, area), by_group, group, value, fv.MIN_TRIM_ROWS)


def _seen(observed: Observation, rows: DataFrame) -> int:
    """The observed count; where the planner left the observation out of a plan that holds no rows, rows are counted."""
    try:
        return int(observed.get["n"])
    except Py4JJavaError:
        return rows.count()


def trim_counted(
    df: DataFrame, room: str = "rooms_en", area: str = "procedure_area", group: str = "area_name_en", value: str = "meter_sale_price",
    low: float = 0.01, high: float = 0.99, min_rows: int = fv.MIN_TRIM_ROWS, max_group_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Both treatments, and one row with the rows before and after each and what each removed.

    Rows are counted inside the one write of the trimmed table, where they pass; no table is stored or read for it. Bounds
    are small and joined without a shuffle below the broadcast threshold, so a repeated task counts once; above it, rows of a map stage that is
    run again after a lost executor may be counted again in rows_before and rows_after_rooms.
    """
    seen = {name: Observation(name) for name in ("rows_before", "rows_after_rooms", "rows_after_groups")}

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.observe(seen[name], F.count(F.lit(1)).alias("n"))

    by_room = _room_bounds(df, room, area, max_group_rows)
    by_group = _group_bounds(_within_rooms(df, by_room, room, area), group, value, low, high, max_group_rows)
    roomed = counted(_within_rooms(counted(df, "rows_before"), by_room, room, area), "rows_after_rooms")
    trimmed = materialise(counted(_within_group(roomed, by_group, group, value, min_rows), "rows_after_groups"), "trimmed")
    plain = _within_rooms(df, by_room, room, area)
    n = [_seen(seen[name], rows) for name, rows in zip(seen, (df, plain, trimmed))]
    names = [*seen, "removed_by_rooms", "removed_by_groups"]
    return trimmed, df.sparkSession.createDataFrame([(*n, n[0] - n[1], n[1] - n[2])], ", ".join(f"{c} bigint" for c in names))


def describe(df: DataFrame, group: str, value: str, suffix: str = "", max_group_rows: int | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max of value per group."""
    specs = {f"{q}{suffix}": (value, p) for q, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))}
    extra = [
        F.count(value).alias(f"count{suffix}"), F.avg(value).alias(f"mean{suffix}"),
        F.stddev_samp(value).alias(f"std{suffix}"), F.min(value).alias(f"min{suffix}"), F.max(value).alias(f"max{suffix}"),
    ]
    return group_quantiles(df, [group], specs, extra, max_group_rows)


def describe_change(before: DataFrame, after: DataFrame, group: str, value: str) -> DataFrame:
    """Statistics of both tables side by side; a group missing on one side keeps its row."""
    left = materialise(describe(before, group, value, "_before"), "before")
    right = materialise(describe(after, group, value, "_after"), "after")
    return left.join(right, group, "full")


def trim_middle(
    df: DataFrame, keys: list[str], value: str, low: float = 0.05, high: float = 0.95, max_group_rows: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Rows between the two quantiles of their group, with no exception for small groups."""
    bounds = group_quantiles(df, keys, {"_lo": (value, low), "_hi": (value, high)}, (), max_group_rows, weight=weight)
    return df.join(materialise(bounds, "bounds"), keys).where(F.col(value).between(F.col("_lo"), F.col("_hi"))).select(*df.columns)


def medians(df: DataFrame, cols: list[str], max_group_rows: int | None = None) -> DataFrame:
    """One row with the median of each column over the whole table."""
    return column_quantiles(df, {c: (c, 0.5) for c in cols}, (), max_group_rows)


def fill_medians(df: DataFrame, cols: list[str], max_group_rows: int | None = None) -> DataFrame:
    """Missing numbers take the column's median."""
    mid = materialise(medians(df, cols, max_group_rows), "medians")
    df = df.withColumn("_mid", mid.select(F.struct(*cols)).scalar())
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col("_mid")[c]) for c in cols}).drop("_mid")
