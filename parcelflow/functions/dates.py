"""Calendar rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_date_or_null(c: Column) -> Column:
    """Text to a date; anything unreadable becomes null."""
    return c.try_cast("date")


def parts(c: Column) -> dict[str, Column]:
    """Calendar fields of a transaction date."""
    return {
        "year_month": F.date_format(c, "yyyy-MM"),
        "year": F.year(c),
        "month": F.month(c),
        "day_of_week": F.date_format(c, "EEEE"),
        "day_of_year": F.dayofyear(c),
        "week_of_year": F.weekofyear(c),
        "quarter": F.quarter(c),
    }


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_end(c: Column) -> Column:
    return F.last_day(c)


def month_diff(later: Column, earlier: Column) -> Column:
    """Whole calendar months from earlier to later."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def rfc822_date(c: Column) -> Column:
    """Feed date ('Mon, 01 Jan 2024 10:00:00 +0400') to the UTC date; unreadable becomes null."""
    bare = F.regexp_replace(F.trim(c), "^[A-Za-z]{3}, *", "")
    offset = F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z"))
    zone = F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z"))
    return F.to_utc_timestamp(F.coalesce(offset, zone), F.current_timezone()).cast("date")
