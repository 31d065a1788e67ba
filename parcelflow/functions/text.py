"""Text rules as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelflow import fixed_values as fv

_SPACE = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACE))


def name_key(c: Column) -> Column:
    """Names are the same in any letter case and with blanks around them."""
    return F.lower(strip(c))


def first_number(c: Column, kind: str = "bigint") -> Column:
    """First run of digits in c, null when there is none."""
    return F.nullif(F.regexp_extract(c, r"([0-9]+)", 1), F.lit("")).try_cast(kind)


def rooms_normalised(c: Column) -> Column:
    """'2 bed rooms + hall', '3 B/R + maid' and '4' become '2 B/R', '3 B/R' and '4 B/R'."""
    c = F.regexp_replace(c, r"(?i)([0-9]+)\s*bed\s*rooms?\s*\+\s*hall", "$1 B/R")
    c = F.regexp_replace(c, r"(?i)^([0-9]+)\s*(?:B/R)?\s*\+.*$", "$1 B/R")
    return F.regexp_replace(c, r"^([0-9]+)$", "$1 B/R")


def floor_bin(c: Column) -> Column:
    """Floor label to 'Unknown', 'Below 1st Floor' or a ten-floor bin."""
    label = F.upper(strip(c))
    n = first_number(label)
    low = F.expr("0").cast("bigint") + F.floor((n - 1) / 10) * 10 + 1
    return (
        F.when(label.isNull() | label.isin("-", "", "NA"), "Unknown")
        .when(label.rlike("^[GBMP]") | (n == 0), "Below 1st Floor")
        .when(n.isNotNull(), F.concat(low.cast("string"), F.lit("-"), (low + 9).cast("string")))
        .otherwise("Unknown")
    )


def floor_value(c: Column) -> Column:
    """First number in a floor label; 0.5 for a label without digits, 0 for a missing one."""
    blank = c.isNull() | (strip(c) == "")
    return F.when(blank, F.lit(0.0)).otherwise(F.coalesce(first_number(c, "double"), F.lit(0.5)))


def rooms_number(c: Column) -> Column:
    """Room label to its number. A label matches as a whole word, so '11 B/R' is 11, not 1."""
    label = strip(c)
    out = None
    for text, number in fv.ROOM_NUMBERS:
        hit = label.rlike(f"(^|[^0-9A-Za-z]){text}($|[^0-9A-Za-z])")
        out = F.when(hit, F.lit(float(number))) if out is None else out.when(hit, F.lit(float(number)))
    return out.otherwise(first_number(label, "double"))


def room_group(c: Column) -> Column:
    return F.when(c.isin(fv.LARGE_HOME_LABELS), F.lit(fv.LARGE_HOME_GROUP)).otherwise(c)


def whole(c: Column) -> Column:
    """Text or number to an integer, cut toward zero; 0 when missing or unreadable."""
    return F.coalesce(c.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def link_key(sub_type: Column, area_id: Column, project: Column, rooms: Column, area: Column) -> Column:
    """Key shared by unit records and transactions. Missing numbers read 0 and missing rooms ''."""
    return F.concat_ws(
        "-",
        *(whole(c).cast("string") for c in (sub_type, area_id, project)),
        F.coalesce(strip(rooms), F.lit("")),
        whole(area).cast("string"),
    )


def developer_missing(name: Column) -> Column:
    return name.isNull() | (name == "") | (name == fv.MISSING_DEVELOPER)


def developer_from_project(name: Column, project: Column) -> Column:
    """Developer by keyword in the project name, only where the name is missing; the last matching keyword wins."""
    text = F.lower(F.coalesce(project, F.lit("")))
    found = F.lit(None).cast("string")
    for keyword, developer in fv.DEVELOPER_KEYWORDS:
        found = F.when(text.contains(keyword), F.lit(developer)).otherwise(found)
    return F.when(developer_missing(name), F.coalesce(found, name)).otherwise(name)


def _has_word(text: Column, words: list[str]) -> Column:
    """Whole-word match; the plain substring test comes first because almost every text fails it."""
    anywhere = reduce(lambda a, b: a | b, (text.contains(w) for w in words))
    return anywhere & text.rlike(f"(^|[^a-z0-9_])({'|'.join(words)})($|[^a-z0-9_])")


def geo_tag(title: Column, snippet: Column, source: Column) -> Column:
    """(region, country) of a news item by whole-word place names, then by source."""
    return geo_tag_of(geo_text(title, snippet), source)


def geo_text(title: Column, snippet: Column) -> Column:
    return F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(snippet, F.lit(""))))


def geo_tag_of(text: Column, source: Column) -> Column:
    """The same from the item's text in lower case; a column of its own spares building it for every place."""
    tag = F.when(F.lit(False), F.struct(F.lit("").alias("region"), F.lit("").alias("country")))
    for words, region, country in fv.GEO_KEYWORDS:
        tag = tag.when(_has_word(text, words), F.struct(F.lit(region).alias("region"), F.lit(country).alias("country")))
    tag = tag.when(
        source.isin(fv.LOCAL_SOURCES), F.struct(F.lit("GCC").alias("region"), F.lit("UAE").alias("country"))
    )
    return tag.otherwise(F.struct(F.lit("Global").alias("region"), F.lit("Global").alias("country")))


def model_slug(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9A-Za-z_]+", "_")


def file_slug(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit(" "), F.lit("_")), F.lit("'"), F.lit(""))


def share_name(c: Column) -> Column:
    """Category as used in a share column name."""
    return F.lower(F.replace(F.replace(c, F.lit(" "), F.lit("_")), F.lit("/"), F.lit("")))


def share_label(feature: str, value: str) -> str:
    """Name of the share column of one category value."""
    return f"pct_{feature}_{value.replace(' ', '_').replace('/', '').lower()}"


def norm_id(c: Column) -> Column:
    return F.regexp_replace(strip(c.cast("string")), r"\.0$", "")


def title_area(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def list_cell(c: Column) -> Column:
    """Text cell holding a list literal to an array; other text to one element; null to an empty array."""
    empty = F.array().cast("array<string>")
    looks_like_list = strip(c).startswith("[")
    parsed = F.when(looks_like_list, F.from_json(strip(c), "array<string>"))
    return F.coalesce(parsed, F.when(c.isNotNull(), F.array(c)), empty)
