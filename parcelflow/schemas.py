"""Declared table schemas (as DDL text) and the one step that makes a table conform to them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelflow.functions.numeric import null_if_nan


SCORECARD_DEVELOPER = "`Developer Name` string, `Developer Score (0-100)` string, Grade string, `Developer Tier` string"
FEED = (
    "channel struct<item: array<struct<title: string, link: string, description: string, pubDate: string, category: string>>>"
)
EVENT_DOCUMENT = (
    "article_id string, source string, title string, published_date string, has_relevant_event boolean, "
    "events array<struct<event_id: string, event_code: string, event_subtype: string, "
    "primary_entity: struct<name: string, type: string>, secondary_entities: array<struct<name: string, type: string>>, "
    "countries: array<string>, regions: array<string>, "
    "event_nature: struct<is_policy: boolean, is_conflict: boolean, is_economic: boolean, is_regulatory: boolean, "
    "is_infrastructure: boolean>, time_horizon: string, "
    "raw_facts: struct<announced_numbers: array<string>, keywords: array<string>, quoted_phrases: array<string>>, "
    "confidence: double>>"
)


def require(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Fail at plan time when a mandatory column is absent."""
    absent = sorted(set(cols) - set(df.columns))
    if absent:
        raise ValueError(f"missing columns: {absent}")
    return df


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Exactly the declared columns: cast where possible (else null), added as null where absent, NaN read as null."""
    out = []
    for field in StructType.fromDDL(schema).fields:
        if field.name not in df.columns:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        c = F.col(f"`{field.name}`")
        if df.schema[field.name].dataType != field.dataType:
            c = c.try_cast(field.dataType)
        if field.dataType.typeName() in ("double", "float"):
            c = null_if_nan(c)
        out.append(c.alias(field.name))
    return df.select(*out)


def added_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Columns a step added. Reads schemas only."""
    return [c for c in after.columns if c not in set(before.columns)]


ROLES = {
    "date": ("instance_date", "month", "date", "published_date"),
    "area": ("area_name_en", "area", "area_name"),
    "value": ("meter_sale_price", "monthly_price", "predicted_monthly_price"),
}


def role(df: DataFrame, name: str) -> str | None:
    """The declared column that plays a role in this table, if any."""
    return next((c for c in ROLES[name] if c in df.columns), None)
