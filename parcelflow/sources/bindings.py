"""Domain views over the given tables.

Every field is plain SQL text valid in both dialects, so a query and the SQL it is checked against start from the same
rows. A view joins only the tables its requested fields need; joins are on unique keys and never multiply facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# field -> (tables needed besides lineitem, SQL)
TXN_FIELDS: dict[str, tuple[str, str]] = {
    "l_orderkey": ("", "l_orderkey"),
    "l_partkey": ("", "l_partkey"),
    "l_suppkey": ("", "l_suppkey"),
    "l_linenumber": ("", "l_linenumber"),
    "l_quantity": ("", "l_quantity"),
    "l_extendedprice": ("", "l_extendedprice"),
    "instance_date": ("", "l_shipdate"),
    "trans_group_en": ("", """CASE WHEN l_returnflag = 'R' THEN 'Sales' WHEN l_returnflag = 'N' THEN 'Sales '
        WHEN l_linenumber <= 4 THEN ' Gifts' WHEN l_linenumber <= 6 THEN 'Mortgages' ELSE NULL END"""),
    "property_usage_en": ("", "CASE WHEN l_linestatus = 'O' THEN 'Residential ' ELSE 'Commercial' END"),
    "property_type_en": ("part", """CASE WHEN p_type IN ('STANDARD', 'ECONOMY', 'LARGE') THEN ' Unit'
        WHEN p_type = 'SMALL' THEN 'Villa' WHEN p_type = 'PROMO' THEN 'Building' ELSE 'Land' END"""),
    "property_sub_type_id": ("part", "CASE WHEN p_size = 13 THEN NULL ELSE p_size % 12 END"),
    "property_sub_type_en": ("part", "CASE WHEN p_size = 13 THEN NULL ELSE p_type END"),
    "area_id": ("supplier", "s_nationkey"),
    "area_name_en": ("nation", "n_name"),
    "project_number": ("", "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_partkey END"),
    "project_name_en": ("part", """concat(CASE p_size % 7 WHEN 0 THEN 'Emaar ' WHEN 1 THEN 'Damac Springs '
        WHEN 2 THEN 'The Magnolia ' WHEN 3 THEN 'DUBAI PROPERTIES ' WHEN 4 THEN ' ' ELSE '' END, p_name)"""),
    "building_name_en": ("part", "p_brand"),
    "rooms_en": ("part", """CASE p_size % 9 WHEN 0 THEN 'Studio' WHEN 1 THEN '1 B/R' WHEN 2 THEN '2 B/R'
        WHEN 3 THEN '3 B/R' WHEN 4 THEN '4 B/R' WHEN 5 THEN 'Office' WHEN 6 THEN 'PENTHOUSE'
        WHEN 7 THEN '11 B/R' ELSE NULL END"""),
    "reg_type_en": ("", "CASE WHEN l_discount > 0.05 THEN 'Off-Plan Properties' ELSE 'Existing Properties' END"),
    "procedure_area": ("", "l_quantity * 4.7e0"),
    "meter_sale_price": ("", "l_extendedprice / l_quantity"),
    "has_parking": ("", "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_linenumber % 2 END"),
    "swimming_pools": ("", "CASE WHEN l_linenumber IN (2, 5) THEN NULL ELSE l_linenumber % 3 END"),
    "elevators": ("", "CASE WHEN l_linenumber IN (4, 7) THEN NULL ELSE l_linenumber % 4 END"),
    "unit_balcony_area": ("", "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax * 100e0 END"),
    "built_up_area": ("part", "CASE WHEN l_linenumber = 5 THEN NULL ELSE p_retailprice END"),
    "land_type_en": ("part", "CASE WHEN l_linenumber IN (1, 2) THEN NULL ELSE p_type END"),
    "nearest_metro_en": ("", """CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'No_nearest_metro_en' WHEN 3 THEN 'None'
        ELSE concat('Metro ', CAST(l_suppkey % 7 AS string)) END"""),
    "nearest_mall_en": ("", "CASE WHEN l_linenumber IN (1, 4) THEN NULL ELSE concat('Mall ', CAST(l_suppkey % 5 AS string)) END"),
    "nearest_landmark_en": ("", "CASE WHEN l_linenumber = 2 THEN NULL ELSE concat('Landmark/', CAST(l_suppkey % 3 AS string)) END"),
    "project_start_date": ("part", "CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('2010-01-', CAST(p_size AS string)) END"),
    "floor_key": ("part", """CASE p_size % 10 WHEN 0 THEN '-' WHEN 1 THEN 'PODIUM' WHEN 2 THEN concat('G+', CAST(p_size AS string))
        WHEN 3 THEN NULL WHEN 4 THEN 'xyz' WHEN 5 THEN concat('Floor ', CAST(p_size AS string)) WHEN 6 THEN '0'
        WHEN 7 THEN ' ' ELSE CAST(p_size AS string) END"""),
    "developer_number": ("", "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_suppkey END"),
    "developer_name_en": ("supplier", """CASE WHEN l_linenumber IN (2, 4) THEN NULL
        WHEN l_linenumber = 5 THEN 'Missing_developer_name_en' ELSE s_name END"""),
}

# A total order of the facts: no two lines agree on all of these.
TXN_ORDER = [
    "instance_date", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
]

TXN_SQL = (
    "txn AS (SELECT " + ", ".join(f"{sql} AS {name}" for name, (_, sql) in TXN_FIELDS.items())
    + " FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"
    + " JOIN nation ON s_nationkey = n_nationkey)"
)
TXN_ORDER_SQL = ", ".join(TXN_ORDER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """Transaction facts with the requested fields (all of them when none is named)."""
    names = list(dict.fromkeys(fields)) or list(TXN_FIELDS)
    needs = {TXN_FIELDS[f][0] for f in names}
    df = table(spark, sf_dir, "lineitem")
    if "part" in needs:
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if needs & {"supplier", "nation"}:
        df = df.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    if "nation" in needs:
        df = df.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return df.select(*(F.expr(TXN_FIELDS[f][1]).alias(f) for f in names))


# view -> (SELECT list shared by both dialects, FROM)
VIEWS: dict[str, tuple[dict[str, str], str]] = {
    "projects": ({
        "project_id": "p_partkey",
        "project_number": "p_partkey",
        "developer_id": "CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_partkey % 137 END",
        "developer_number": "CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_partkey % 137 END",
        "project_start_date": "concat('2010-01-', CAST(p_size AS string))",
        "project_end_date": "concat('2012-02-', CAST(p_size AS string))",
        "completion_date": "CASE WHEN p_size < 5 THEN 'unknown' ELSE '2013-05-06' END",
        "area_id": "CAST(p_partkey % 25 AS int)",
        "master_project_en": "p_brand",
        "master_project_ar": "p_type",
        "no_of_units": "p_size",
    }, "part"),
    "developers": ({
        "developer_id": "s_suppkey",
        "developer_number": "s_suppkey",
        "developer_name_en": "s_name",
        "registration_date": "concat('20', CAST(10 + s_nationkey AS string), '-07-01')",
    }, "supplier"),
    "buildings": ({
        "property_id": "p_partkey",
        "area_id": "CASE WHEN p_size = 17 THEN NULL ELSE CAST(p_partkey % 25 AS int) END",
        "project_id": "CASE WHEN p_size % 10 = 0 THEN p_partkey + 1000000 ELSE p_partkey END",
        "zone_id": "p_size % 4",
        "land_number": "p_brand",
        "rooms_en": "CASE WHEN p_size % 3 = 0 THEN '2 bed rooms + hall' ELSE NULL END",
        "property_sub_type_id": "p_size % 12",
        "actual_area": "p_retailprice / 10e0",
        "project_name_en": "p_name",
        "land_type_en": "p_type",
        "swimming_pools": "CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size % 4 END",
        "elevators": "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size % 5 END",
        "floors": "p_size",
        "creation_date": "concat('2011-03-', CAST(p_size AS string))",
    }, "part"),
    "units": ({
        "property_id": "l_orderkey * 10 + l_linenumber",
        "parent_property_id": """CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN concat('x', CAST(l_partkey AS string))
            ELSE CAST(l_partkey AS string) END""",
        "area_id": "CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(l_partkey % 25 AS int) END",
        "land_number": "CASE WHEN l_linenumber = 3 THEN NULL ELSE concat('L', CAST(l_suppkey % 9 AS string)) END",
        "rooms_en": """CASE l_linenumber WHEN 3 THEN '1 bed room + hall' WHEN 4 THEN '3 B/R + maid' WHEN 5 THEN '4'
            WHEN 6 THEN NULL ELSE 'Studio' END""",
        "property_sub_type_id": "CASE WHEN l_linenumber = 4 THEN NULL ELSE CAST(l_suppkey % 12 AS int) END",
        "actual_area": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity * 4.7e0 END",
        "project_id": "CASE WHEN l_linenumber >= 5 THEN NULL ELSE l_partkey END",
        "floor_key": "CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(CAST(l_suppkey % 40 AS int) AS string) END",
        "unit_balcony_area": "CASE WHEN l_tax = 0e0 THEN NULL ELSE l_tax * 100e0 END",
        "l_orderkey": "l_orderkey", "l_partkey": "l_partkey", "l_suppkey": "l_suppkey", "l_linenumber": "l_linenumber",
        "l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_shipdate": "l_shipdate",
    }, "lineitem"),
    "news": ({
        "article_id": "event_id",
        "published_date": "CAST(ts AS date) + CAST((user_id % 6) * 31 - 8219 AS int)",
        "event_code": """CASE event_type WHEN 'error' THEN 'GEO_RISK_ESCALATION' WHEN 'signup' THEN 'REGULATORY_EASING_RE'
            WHEN 'click' THEN 'NEW_SUPPLY_ANNOUNCEMENT' WHEN 'purchase' THEN 'OIL_PRICE_SHOCK_UP' ELSE 'unlisted' END""",
        "title": "concat(event_type, ' ', props, ' ', CAST(user_id % 40 AS string))",
        "entity_tier_weight": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE (event_id % 13) / 6e0 END",
        "event_scale_weight": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE (user_id % 10) / 5e0 END",
        "geo_relevance_weight": "CASE WHEN value > 100e0 THEN 1.5e0 ELSE 0.9e0 END",
    }, "events"),
    "sensitivity_wide": ({
        "area": "n_name",
        "area_id": "concat(CAST(n_nationkey AS string), '.0')",
        "sentiment": "(n_nationkey % 5) / 10e0",
        "tourism": "(n_nationkey % 3) / 5e0",
        "policy": "(n_nationkey % 4) / 8e0 - 0.2e0",
        "supply": "(n_nationkey % 7) / 9e0",
        "liquidity": "0.15e0 - (n_nationkey % 2) / 4e0",
    }, "nation"),
    "centres": ({
        "area": "n_name",
        "lat": "24.9e0 + (n_nationkey % 5) * 0.12e0",
        "lon": "55.05e0 + CAST((n_nationkey - n_nationkey % 5) / 5 AS int) * 0.13e0",
    }, "nation"),
    "requests": ({
        "request_id": "c_custkey",
        "area_name": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE n_name END",
        "lat": "24.85e0 + (c_custkey % 97) * 0.006e0",
        "lon": "55.00e0 + (c_custkey % 89) * 0.007e0",
        "rooms_en": "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Studio' WHEN 'MACHINERY' THEN '1 B/R' WHEN 'BUILDING' THEN '9 B/R' WHEN 'AUTOMOBILE' THEN NULL ELSE '3 B/R' END",
        "reg_type_en": "CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN 'Off-Plan Properties' ELSE 'Existing Properties' END",
        "trans_group_en": "CASE WHEN c_custkey % 6 = 0 THEN 'Gifts' ELSE 'Sales' END",
        "has_parking": "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 3 AS int) END",
        "procedure_area": "CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE 20e0 + c_custkey % 150 END",
        "home_area": "n_name",
    }, "customer JOIN nation ON c_nationkey = n_nationkey"),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    fields, source = VIEWS[name]
    left, _, rest = source.partition(" JOIN ")
    df = table(spark, sf_dir, left)
    if rest:
        right, _, on = rest.partition(" ON ")
        df = df.join(table(spark, sf_dir, right), F.expr(on))
    return df.select(*(F.expr(sql).alias(f) for f, sql in fields.items()))


def view_sql(name: str) -> str:
    fields, source = VIEWS[name]
    return f"{name} AS (SELECT " + ", ".join(f"{sql} AS {f}" for f, sql in fields.items()) + f" FROM {source})"
