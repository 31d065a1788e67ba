"""Numeric rules as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow import fixed_values as fv

EPS = 2.220446049250313e-16


def null_if_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def number(c: Column) -> Column:
    """Text to a double; unreadable text and NaN become null."""
    return null_if_nan(c.try_cast("double"))


def log_price(c: Column) -> Column:
    return F.ln(F.greatest(c, F.lit(1e-9)))


def strength(*weights: Column) -> Column:
    """Product of the weights, kept within the strength bounds; a missing weight counts 0.5."""
    product = F.lit(1.0)
    for w in weights:
        product = product * F.coalesce(w, F.lit(fv.DEFAULT_WEIGHT))
    return F.least(F.greatest(product, F.lit(fv.STRENGTH_MIN)), F.lit(fv.STRENGTH_MAX))


def robust_tanh(x: Column, median: Column, low: Column, high: Column) -> Column:
    return F.tanh((x - median) / F.greatest(high - low, F.lit(1e-6)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    return F.lit(2 * fv.EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def sentiment_decay(t: Column, halflife: Column) -> Column:
    """Half-life decay of sentiment, t months after the event."""
    return F.exp(-F.lit(math.log(2)) / halflife * t)


def price_hump(t: Column, halflife: Column, peak: Column) -> Column:
    """Delayed price reaction t^k * exp(-rate t), scaled to 1 at its peak month."""
    rate = F.lit(math.log(2)) / halflife
    k = peak * rate
    top = F.pow(k / rate, k) * F.exp(-k)
    return F.pow(t.cast("double"), k) * F.exp(-rate * t) / (top + F.lit(1e-9))


def clamp(c: Column, low: Column, high: Column) -> Column:
    """c within [low, high]; an empty interval collapses to its upper end."""
    low = F.least(low, high)
    return F.when(c < low, low).when(c > high, high).otherwise(c)


def pct_error(truth: Column, guess: Column) -> Column:
    """Absolute error relative to the truth, guarded against a zero truth."""
    return F.abs(truth - guess) / F.greatest(F.abs(truth), F.lit(EPS))
