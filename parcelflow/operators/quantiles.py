"""Exact, linearly interpolated quantiles per group, safe for groups of any size.

A first pass over the keys alone finds groups of more than `max_group_rows` rows. All others are one aggregate with partial
sums: Spark's percentile, which keeps one counter per distinct value in memory, beside any further aggregates of the caller. Rows of
larger groups are counted by value and range partitioned into blocks of bounded size: the sums of the blocks tell which
block holds a wanted rank, and only those blocks are ranked. The limit decides where a group is worked on, never its result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.session import input_bytes, materialise

Specs = dict[str, tuple[str, float]]

MAX_GROUP_ROWS = 1_000_000
BLOCK_BYTES = 64 << 20
_ALL = "_all_rows"


def group_quantiles(
    df: DataFrame, keys: list[str], specs: Specs, extra: list[Column] = (), max_group_rows: int | None = None,
    counts: dict[str, str] = {}, weight: str | None = None,
) -> DataFrame:
    """One row per key with each output `name -> (column, probability)`. Null keys and null values are left out.

    counts holds `name -> column` for numbers of known values; extra holds further named
    aggregates over all rows of the group. Both come from the same pass. With weight, a row stands for as many rows as that column says.
    """
    limit = MAX_GROUP_ROWS if max_group_rows is None else max_group_rows
    src = df.dropna(subset=keys) if keys else df.withColumn(_ALL, F.lit(1))
    by = keys or [_ALL]
    hot = _hot_groups(src, by, limit)
    if hot is None:
        return _in_memory(src, keys, specs, counts, extra, weight)
    large = src.join(hot, by, "left_semi")
    cols = sorted({c for c, _ in specs.values()} | set(counts.values()))
    entry = F.explode(F.array(*(F.struct(F.lit(i).alias("_c"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(cols))))
    stacked = large.select(*by, _times(weight).alias("_n"), entry.alias("_e")).select(*by, "_n", "_e._c", "_e._v")
    values = materialise(stacked.groupBy(*by, "_c", "_v").agg(F.sum("_n").alias("_n")), "values")
    out = _by_blocks(values, by, cols, specs, counts)
    if extra:
        out = out.join(materialise(large.groupBy(*by).agg(*extra), "extra"), by)
    if keys:
        out = _in_memory(src.join(hot, by, "left_anti"), keys, specs, counts, extra, weight).unionByName(out)
    return out.drop(_ALL)


def _times(weight: str | None) -> Column:
    return (F.col(weight) if weight else F.lit(1)).cast("bigint")


def column_quantiles(df: DataFrame, specs: Specs, extra: list[Column] = (), max_group_rows: int | None = None) -> DataFrame:
    """The same over the whole table: one row."""
    return group_quantiles(df, [], specs, extra, max_group_rows)


def bounded_quantile(c: Column | str, p: float) -> Column:
    """Quantile aggregate for groups whose size is bounded by construction, such as the months of a series."""
    return F.percentile(c, F.lit(p))


def _hot_groups(rows: DataFrame, keys: list[str], limit: int) -> DataFrame | None:
    over = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit).select(*keys)
    return None if over.isEmpty() else materialise(over, "hot-groups")


def _number_known(cols: list[str], counts: dict[str, str]) -> list[Column]:
    known = F.col("_v").isNotNull()
    return [F.sum(F.when(known & (F.col("_c") == cols.index(c)), F.col("_n")).otherwise(0)).alias(name) for name, c in counts.items()]


def _in_memory(rows: DataFrame, keys: list[str], specs: Specs, counts: dict[str, str], extra: list[Column], weight: str | None) -> DataFrame:
    """Everything in one aggregate; without keys also an empty table has its one row."""
    probs: dict[str, list[float]] = {}
    for c, p in specs.values():
        if p not in probs.setdefault(c, []):
            probs[c].append(p)
    times = _times(weight)
    repeated = [times] if weight else []
    found = [F.percentile(F.col(c).cast("double"), F.array(*(F.lit(p) for p in ps)), *repeated).alias(f"_q_{c}") for c, ps in probs.items()]
    known = [F.coalesce(F.sum(F.when(F.col(c).cast("double").isNotNull(), times)), F.lit(0)).alias(name) for name, c in counts.items()]
    agg = rows.groupBy(*keys).agg(*found, *known, *extra)
    picked = {name: F.col(f"_q_{c}")[probs[c].index(p)] for name, (c, p) in specs.items()}
    rest = [c for c in agg.columns if c not in keys and not c.startswith("_q_") and c not in counts]
    return agg.select(*keys, *(v.alias(n) for n, v in picked.items()), *counts, *rest)


def _by_blocks(values: DataFrame, keys: list[str], cols: list[str], specs: Specs, counts: dict[str, str]) -> DataFrame:
    """Quantiles of large groups from the ranks of their distinct values."""
    group = [*keys, "_c"]
    known = values.where(F.col("_v").isNotNull())
    n = max(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(values) // BLOCK_BYTES))
    blocked = known.repartitionByRange(n, *group, "_v").withColumn("_block", F.spark_partition_id())
    blocked = materialise(blocked, "blocks")
    sums = blocked.groupBy(*group, "_block").agg(F.sum("_n").alias("_rows"))
    upto = F.sum("_rows").over(Window.partitionBy(*group).orderBy("_block"))
    sums = materialise(sums.withColumn("_end", upto).withColumn("_begin", upto - F.col("_rows")), "sums")

    wanted = F.array(*(F.struct(F.lit(name).alias("_name"), F.lit(cols.index(c)).alias("_c"), F.lit(p).alias("_p")) for name, (c, p) in specs.items()))
    places = sums.groupBy(*group).agg(F.max("_end").alias("_all")).withColumn("_w", F.explode(wanted)).where("_c = _w._c")
    places = places.select(*group, "_w._name", (F.col("_w._p") * (F.col("_all") - 1)).alias("_pos"))
    places = materialise(places.withColumns({"_lo": F.floor("_pos"), "_hi": F.ceil("_pos")}), "places")
    ranks = places.select(*group, F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("_rank")).distinct()
    held = ranks.join(sums, group).where((F.col("_rank") >= F.col("_begin")) & (F.col("_rank") < F.col("_end")))
    held = materialise(held.select(*group, "_block", "_begin", "_rank"), "ranks")

    cell = [*group, "_block"]
    to_here = F.sum("_n").over(Window.partitionBy(*cell).orderBy("_v"))
    spans = blocked.join(held.select(*cell).distinct(), cell, "left_semi").withColumn("_to", to_here)
    inside = (F.col("_rank") - F.col("_begin") < F.col("_to")) & (F.col("_rank") - F.col("_begin") >= F.col("_to") - F.col("_n"))
    found = materialise(spans.join(held, cell).where(inside).select(*group, "_rank", "_v"), "found")

    low = found.select(*group, F.col("_rank").alias("_lo"), F.col("_v").alias("_lo_v"))
    high = found.select(*group, F.col("_rank").alias("_hi"), F.col("_v").alias("_hi_v"))
    placed = places.join(low, [*group, "_lo"]).join(high, [*group, "_hi"])
    between = (F.col("_hi") - F.col("_pos")) * F.col("_lo_v") + (F.col("_pos") - F.col("_lo")) * F.col("_hi_v")
    value = F.when(F.col("_lo_v") == F.col("_hi_v"), F.col("_lo_v")).otherwise(between)
    solved = placed.groupBy(*keys).agg(*(F.max(F.when(F.col("_name") == name, value)).alias(name) for name in specs))
    numbers = values.groupBy(*keys).agg(F.count("*").alias("_rows"), *_number_known(cols, counts)).drop("_rows")
    return numbers.join(solved, keys, "left").select(*keys, *specs, *counts)
