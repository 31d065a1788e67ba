"""Row filters and column projections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow.functions import dates, numeric, text
from parcelflow.session import materialise

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in _NUMERIC or t.startswith("decimal")]


# --- rows -------------------------------------------------------------------------------------------------------


def since(df: DataFrame, col: str, start: str) -> DataFrame:
    """Rows with a known date on or after start. The comparison is on the raw column, so it reaches the scan."""
    return df.where(F.col(col).isNotNull() & (F.col(col) >= F.lit(start).cast(df.schema[col].dataType)))


def up_to_month(df: DataFrame, col: str, month: str | None) -> DataFrame:
    return df if month is None else df.where(F.col(col) <= F.lit(month).cast("date"))


def exclude_set(df: DataFrame, col: str, values: str | Iterable[str]) -> DataFrame:
    """Strip the column, read missing as '' and drop rows whose value is listed."""
    listed = [values] if isinstance(values, str) else list(values)
    listed = [v.strip() for v in listed if v.strip()]
    df = df.withColumn(col, F.coalesce(text.strip(F.col(col)), F.lit("")))
    return df.where(~F.col(col).isin(listed)) if listed else df


def equals_pair(df: DataFrame, a: str, a_value: str, b: str, b_value: str) -> DataFrame:
    df = df.withColumns({a: text.strip(F.col(a)), b: text.strip(F.col(b))})
    return df.where((F.col(a) == a_value) & (F.col(b) == b_value))


def exclude_rooms(df: DataFrame, col: str = "rooms_en") -> DataFrame:
    """Drop labels that are not homes; rows without a label stay."""
    return df.where(F.col(col).isNull() | ~F.col(col).isin(fv.NON_HOME_ROOMS))


def include_set(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    return df.where(F.col(col).isin(values))


def target_known(df: DataFrame, candidates: Iterable[str] = ("meter_sale_price", "actual_price", "transaction_value")) -> tuple[DataFrame, str]:
    """First candidate the table has, and the rows where it is known."""
    target = next(c for c in candidates if c in df.columns)
    return df.dropna(subset=[target]), target


def min_group_count(df: DataFrame, key: str, least: int, always: Iterable[str] = ()) -> DataFrame:
    """Rows of groups with at least `least` rows, and of the always-kept groups."""
    return _by_count(df, key, (F.col("_n") >= least) | F.col(key).isin(list(always)))


def exact_group_count(df: DataFrame, key: str, count: int) -> DataFrame:
    return _by_count(df, key, F.col("_n") == count)


def _by_count(df: DataFrame, key: str, keep: Column) -> DataFrame:
    kept = df.groupBy(key).agg(F.count("*").alias("_n")).where(keep).select(key)
    return df.join(materialise(kept, "kept-groups"), key, "left_semi")


def required_known(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols).distinct()


# --- columns ----------------------------------------------------------------------------------------------------


def drop_suffix(df: DataFrame, suffix: str = "_ar") -> DataFrame:
    return df.drop(*(c for c in df.columns if c.endswith(suffix)))


def drop_listed(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def add_suffix(df: DataFrame, cols: Iterable[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in cols if c in df.columns})


def fill_pairs(df: DataFrame, cols: Iterable[str], target: str = "_u", source: str = "_bld") -> DataFrame:
    """c_u takes c_bld where it is missing."""
    pairs = [c for c in cols if f"{c}{target}" in df.columns and f"{c}{source}" in df.columns]
    return df.withColumns({f"{c}{target}": F.coalesce(f"{c}{target}", f"{c}{source}") for c in pairs})


def keep_listed(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*(c for c in names if c in df.columns))


def assert_unique_columns(df: DataFrame) -> DataFrame:
    twice = sorted({c for c in df.columns if df.columns.count(c) > 1})
    if twice:
        raise ValueError(f"duplicate columns: {twice}")
    return df


def strip_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip() for c in df.columns))


def coerce_dates(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: dates.to_date_or_null(F.col(c)) for c in cols if c in df.columns})


def coerce_numbers(df: DataFrame, cols: Iterable[str], default: float | None = None) -> DataFrame:
    out = {}
    for c in cols:
        value = numeric.number(F.col(c))
        out[c] = value if default is None else F.coalesce(value, F.lit(default))
    return df.withColumns(out)


def default_fill(df: DataFrame, text_cols: Iterable[str], number_cols: Iterable[str]) -> DataFrame:
    """Defaults after a left join: 'Unknown' for text, 0 for numbers (read from text where needed)."""
    filled = {c: F.coalesce(F.col(c), F.lit("Unknown")) for c in text_cols}
    return coerce_numbers(df.withColumns(filled), number_cols, 0.0)


def label_missing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(f"Missing_{c}")) for c in cols if c in df.columns})


def fill_by_type(df: DataFrame) -> DataFrame:
    """Missing text becomes 'missing_<column>', missing numbers 0."""
    texts = {c: f"missing_{c}" for c, t in df.dtypes if t == "string"}
    return df.na.fill(texts).na.fill(0, subset=numeric_columns(df))


def sentinel_to_null(df: DataFrame, col: str, sentinel: str) -> DataFrame:
    return df.withColumn(col, F.nullif(F.col(col), F.lit(sentinel)))


def amenity_flags(df: DataFrame, flags: dict[str, str]) -> DataFrame:
    """flag -> source column: 1 when the source is known and not zero."""
    return df.withColumns({f: (F.coalesce(F.col(c), F.lit(0)) != 0).cast("int") for f, c in flags.items()})


def sentinel_flag(df: DataFrame, flag: str, col: str, sentinels: list[str]) -> DataFrame:
    """1 when the text is known and not one of the sentinels in any letter case."""
    known = F.col(col).isNotNull() & ~F.lower(F.col(col)).isin(sentinels)
    return df.withColumn(flag, known.cast("int"))


def zero_where(df: DataFrame, col: str, type_col: str, types: list[str]) -> DataFrame:
    """Missing col becomes 0 for the given types."""
    return df.withColumn(col, F.when(F.col(type_col).isin(types) & F.col(col).isNull(), F.lit(0)).otherwise(F.col(col)))


def drop_sparse(df: DataFrame, protected: Iterable[str], max_zero_share: float = fv.MAX_ZERO_SHARE) -> DataFrame:
    """Drop numeric columns that are zero in more than the given share of rows. One aggregate over all columns."""
    protected = set(protected)
    cols = [c for c in numeric_columns(df) if c not in protected]
    if not cols:
        return df
    zero = [(F.sum(F.when(F.col(c) == 0, 1).otherwise(0)) / F.count("*")).alias(c) for c in cols]
    shares = df.agg(*zero).first()
    return df.drop(*(c for c in cols if (shares[c] or 0.0) > max_zero_share))
