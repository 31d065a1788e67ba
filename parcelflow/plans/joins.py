"""Queries over joins."""

from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow.functions import text
from parcelflow.operators import joins, layout
from parcelflow.plans.filters import KEYS
from parcelflow.plans.registry import query
from parcelflow.plans.texts import TXN_KEY_SQL
from parcelflow.sources.bindings import TXN_ORDER, TXN_ORDER_SQL, TXN_SQL, table, transactions, view, view_sql

K = "l_orderkey, l_partkey, l_linenumber"

# Area groups over the areas of the given tables; one area may belong to several.
MEMBERS = [
    ("grouped1", "NATION_1"), ("grouped1", "NATION_2"), ("proxy1", "NATION_1"), ("proxy1", "NATION_3"), ("proxy1", "NATION_12"),
]
MEMBERS_SQL = 'members("group", member) AS (VALUES ' + ", ".join(f"('{g}', '{m}')" for g, m in MEMBERS) + ")"


def members(spark):
    return joins.literal_table(spark, MEMBERS, "group string, member string")


@query("join_left_dim", ctes=f'{view_sql("projects")}, {view_sql("developers")}', sql="""
SELECT p.project_id, p.developer_id, d.developer_name_en, d.registration_date
FROM projects p LEFT JOIN developers d ON p.developer_id = d.developer_id""")
def join_left_dim(spark, sf_dir):
    projects = view(spark, sf_dir, "projects").select("project_id", "developer_id")
    devs = view(spark, sf_dir, "developers").select("developer_id", "developer_name_en", "registration_date")
    return joins.merge(projects, devs, ["developer_id"], "left")


@query("join_full_composite", ctes=f'{view_sql("projects")}, {view_sql("buildings")}', sql="""
SELECT coalesce(b.area_id, p.area_id) AS area_id, coalesce(b.project_id, p.project_id) AS project_id, b.property_id, p.project_number, p.no_of_units
FROM buildings b FULL JOIN projects p ON b.area_id = p.area_id AND b.project_id = p.project_id""")
def join_full_composite(spark, sf_dir):
    blds = view(spark, sf_dir, "buildings").select("area_id", "project_id", "property_id")
    projects = view(spark, sf_dir, "projects").select("area_id", "project_id", "project_number", "no_of_units")
    return joins.merge(blds, projects, ["area_id", "project_id"], "full")


@query("join_full_null_safe", ctes=f'{view_sql("projects")}, {view_sql("buildings")}', sql="""
SELECT coalesce(b.area_id, p.no_of_units) AS area_id, b.n, p.m
FROM (SELECT area_id, count(*) AS n FROM buildings GROUP BY 1) b
FULL JOIN (SELECT nullif(no_of_units, 3) AS no_of_units, count(*) AS m FROM projects GROUP BY 1) p ON b.area_id IS NOT DISTINCT FROM p.no_of_units""")
def join_full_null_safe(spark, sf_dir):
    """The variant in which missing keys meet."""
    left = view(spark, sf_dir, "buildings").groupBy("area_id").agg(F.count("*").alias("n"))
    units = F.nullif(F.col("no_of_units"), F.lit(3)).alias("area_id")
    right = view(spark, sf_dir, "projects").groupBy(units).agg(F.count("*").alias("m"))
    return joins.merge(left, right, ["area_id"], "full", null_safe=True)


@query("join_full_parent", ctes=f'{view_sql("units")}, {view_sql("buildings")}', sql="""
SELECT u.l_orderkey, u.l_linenumber, coalesce(u.parent_property_id, CAST(b.property_id AS string)) AS parent_property_id, u.floor_key, b.project_id AS project_id_bld, b.elevators
FROM units u FULL JOIN buildings b ON u.parent_property_id = CAST(b.property_id AS string)""")
def join_full_parent(spark, sf_dir):
    """Units and buildings by the building's id as text; buildings once per id."""
    units = view(spark, sf_dir, "units").select("parent_property_id", "l_orderkey", "l_linenumber", "floor_key")
    blds = view(spark, sf_dir, "buildings")
    once = joins.keep_one(blds, ["property_id"], [F.col("creation_date").asc_nulls_last(), F.col("project_id")])
    right = once.select(
        F.col("property_id").cast("string").alias("parent_property_id"), F.col("project_id").alias("project_id_bld"), "elevators"
    )
    return joins.merge(units, right, ["parent_property_id"], "full")


LINK_CTES = f"""{TXN_SQL},
keyed AS (SELECT *, {TXN_KEY_SQL} AS link_key FROM txn),
marked AS (SELECT *, CASE WHEN l_linenumber IN (2, 4) THEN concat(link_key, '/maid') ELSE link_key END AS unit_key FROM keyed),
micro AS (SELECT unit_key, floor_key, unit_balcony_area, row_number() OVER (PARTITION BY unit_key ORDER BY {TXN_ORDER_SQL}) AS rn FROM marked)"""
LINK_SQL = f"""
SELECT {K}, link_key, m.floor_key, m.unit_balcony_area FROM keyed k LEFT JOIN micro m ON k.link_key = m.unit_key AND m.rn = 1"""


@query("join_left_linkkey", ctes=LINK_CTES, sql=LINK_SQL)
def join_left_linkkey(spark, sf_dir):
    return joins.merge(*_linked_sides(spark, sf_dir), ["link_key"], "left")


@query("join_left_linkkey_stored", ctes=LINK_CTES, sql=LINK_SQL)
def join_left_linkkey_stored(spark, sf_dir):
    """The same join from a layout that both sides are stored in, with frequent keys spread."""
    facts, dim = layout.store_sides(*_linked_sides(spark, sf_dir), "link_key", buckets=8, most_rows=1000, salts=4)
    return layout.merge_stored(spark, facts, dim)


def _linked_sides(spark, sf_dir):
    """Transactions with their unit record. Unit records are deduplicated, so transactions never multiply."""
    parts = ["property_sub_type_id", "area_id", "project_number", "rooms_en", "procedure_area"]
    txn = transactions(spark, sf_dir, *TXN_ORDER, *parts, "floor_key", "unit_balcony_area")
    keyed = txn.withColumn("link_key", text.link_key(*map(F.col, parts)))
    maid = F.when(F.col("l_linenumber").isin(2, 4), F.concat("link_key", F.lit("/maid"))).otherwise(F.col("link_key"))
    units = keyed.withColumn("link_key", maid).select("link_key", "floor_key", "unit_balcony_area", *TXN_ORDER)
    micro = joins.keep_one(units, ["link_key"], [F.col(c) for c in TXN_ORDER])
    return keyed.select(*KEYS, "link_key"), micro.select("link_key", "floor_key", "unit_balcony_area")


ENRICH_SQL = f"""{TXN_SQL}, {view_sql("projects")}, {view_sql("developers")},
pn AS (SELECT project_number, min(developer_number) AS num FROM projects GROUP BY 1),
dn AS (SELECT developer_number, min(developer_name_en) AS name FROM developers GROUP BY 1),
step1 AS (SELECT t.*, coalesce(t.developer_number, pn.num) AS dev_num, nullif(t.developer_name_en, 'Missing_developer_name_en') AS raw_name
  FROM txn t LEFT JOIN pn ON t.project_number = pn.project_number),
step2 AS (SELECT step1.*, coalesce(raw_name, dn.name) AS dev_name FROM step1 LEFT JOIN dn ON dev_num = dn.developer_number)"""


def enriched(spark, sf_dir):
    facts = transactions(spark, sf_dir, *TXN_ORDER, "project_number", "developer_number", "developer_name_en")
    return joins.enrich_developers(facts, view(spark, sf_dir, "projects"), view(spark, sf_dir, "developers"))


@query("join_enrich_coalesce", ctes=ENRICH_SQL, sql=f"SELECT {K}, dev_num AS developer_number, dev_name AS developer_name_en FROM step2")
def join_enrich_coalesce(spark, sf_dir):
    return enriched(spark, sf_dir).select(*KEYS, "developer_number", "developer_name_en")


@query("join_self_backfill", ctes=f"""{TXN_SQL},
t AS (SELECT *, nullif(developer_name_en, 'Missing_developer_name_en') AS name FROM txn),
known AS (SELECT developer_number, arg_min(name, ROW({TXN_ORDER_SQL})) AS first_name FROM t WHERE name IS NOT NULL AND developer_number IS NOT NULL GROUP BY 1)""", sql=f"""
SELECT {K}, coalesce(name, first_name, 'Missing_developer_name_en') AS developer_name_en FROM t LEFT JOIN known USING (developer_number)""")
def join_self_backfill(spark, sf_dir):
    facts = transactions(spark, sf_dir, *TXN_ORDER, "developer_number", "developer_name_en")
    facts = facts.withColumn("developer_name_en", F.nullif(F.col("developer_name_en"), F.lit(fv.MISSING_DEVELOPER)))
    return joins.backfill_developer_names(facts, TXN_ORDER).select(*KEYS, "developer_name_en")


@query("join_scorecards", ctes=f"""{TXN_SQL},
b AS (SELECT p_brand AS k, p_type AS grade, p_retailprice AS score, row_number() OVER (PARTITION BY p_brand ORDER BY CAST(p_retailprice AS string), p_type) AS rn FROM part WHERE p_brand NOT LIKE '%1'),
d AS (SELECT s_name AS k, CASE WHEN s_acctbal > 5000 THEN 'A' END AS grade, TRY_CAST(CASE WHEN s_nationkey % 4 = 0 THEN 'n/a' ELSE CAST(s_acctbal AS string) END AS double) AS score FROM supplier WHERE s_suppkey % 9 <> 7),
p AS (SELECT p_name AS k, p_type AS grade, row_number() OVER (PARTITION BY p_name ORDER BY p_type) AS rn FROM part)""", sql=f"""
SELECT {K}, coalesce(b.grade, 'Unknown') AS "Grade", coalesce(b.score, 0) AS "Score", coalesce(d.grade, 'Unknown') AS "Developer_grade",
  coalesce(d.score, 0) AS "Developer Score (0-100)", coalesce(p.grade, 'Unknown') AS project_grade
FROM txn LEFT JOIN b ON building_name_en = b.k AND b.rn = 1 LEFT JOIN d ON developer_name_en = d.k LEFT JOIN p ON trim(project_name_en) = p.k AND p.rn = 1""")
def join_scorecards(spark, sf_dir):
    """Three cards by stripped name. Cards repeat names; facts must not multiply. Some cards carry names that no fact has."""
    facts = transactions(spark, sf_dir, *KEYS, "building_name_en", "developer_name_en", "project_name_en")
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    bld = part.select(F.concat("p_brand", F.when(F.col("p_brand").endswith("1"), "/x").otherwise(" ")).alias("Building Name"), F.col("p_retailprice").cast("string").alias("Score"), F.col("p_type").alias("Grade"))
    dev = supplier.select(
        F.concat("s_name", F.when(F.col("s_suppkey") % 9 == 7, "/x").otherwise("")).alias("Developer Name"), F.when(F.col("s_acctbal") > 5000, "A").alias("Grade"),
        F.when(F.col("s_nationkey") % 4 == 0, "n/a").otherwise(F.col("s_acctbal").cast("string")).alias("Developer Score (0-100)"),
    )
    proj = part.select(F.concat(F.lit("  "), "p_name").alias("Project Name"), F.col("p_type").alias("Grade"))
    facts = joins.attach_scorecard(facts, bld, "building_name_en", "Building Name", ["Grade"], ["Score"])
    facts = joins.attach_scorecard(facts, dev, "developer_name_en", "Developer Name", ["Developer_grade"], ["Developer Score (0-100)"], {"Grade": "Developer_grade"})
    facts = joins.attach_scorecard(facts, proj, "project_name_en", "Project Name", ["project_grade"], [], {"Grade": "project_grade"})
    return facts.select(*KEYS, "Grade", "Score", "Developer_grade", "Developer Score (0-100)", "project_grade")


QUOTES_SQL = """quotes AS (SELECT CAST(o_orderdate AS DATE) AS date, CASE o_orderpriority WHEN '1-URGENT' THEN 'oil' WHEN '2-HIGH' THEN 'gold' ELSE 'dfm' END AS asset,
  max(o_totalprice) * 0.7310585786e0 AS close, CAST(count(*) AS double) * 0.8807970779e0 AS volume FROM orders
  WHERE isodow(o_orderdate) <= 5 GROUP BY 1, 2)"""
ASSETS = ["oil", "gold", "dfm"]
CALENDAR_SQL = """calendar AS (SELECT date, o.close AS oil_close, o.volume AS oil_volume, g.close AS gold_close, g.volume AS gold_volume, d.close AS dfm_close, d.volume AS dfm_volume
  FROM (SELECT * FROM quotes WHERE asset = 'oil') o JOIN (SELECT * FROM quotes WHERE asset = 'gold') g USING (date) JOIN (SELECT * FROM quotes WHERE asset = 'dfm') d USING (date))"""


def quotes(spark, sf_dir):
    """Daily market quotes: weekdays only, so the series has gaps."""
    asset = F.when(F.col("o_orderpriority") == "1-URGENT", "oil").when(F.col("o_orderpriority") == "2-HIGH", "gold").otherwise("dfm")
    orders = table(spark, sf_dir, "orders").where(F.weekday("o_orderdate") < 5)
    return orders.groupBy(F.col("o_orderdate").cast("date").alias("date"), asset.alias("asset")).agg(
        (F.max("o_totalprice") * 0.7310585786).alias("close"), (F.count("*").cast("double") * 0.8807970779).alias("volume")
    )


@query("join_asset_calendar", ctes=f"{TXN_SQL}, {QUOTES_SQL}, {CALENDAR_SQL}", sql=f"""
SELECT {K}, CAST(instance_date AS DATE) AS day, oil_close, gold_close, dfm_close, dfm_volume FROM txn JOIN calendar ON CAST(instance_date AS DATE) = date""")
def join_asset_calendar(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "instance_date")
    both = joins.on_calendar(facts, "instance_date", joins.asset_calendar(quotes(spark, sf_dir), ASSETS))
    return both.select(*KEYS, F.col("instance_date").cast("date").alias("day"), "oil_close", "gold_close", "dfm_close", "dfm_volume")


@query("join_lookup_map", sql="SELECT c_custkey, n_name AS area_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def join_lookup_map(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("value"))
    return joins.map_values(table(spark, sf_dir, "customer"), "c_nationkey", "area_name", names).select("c_custkey", "area_name")


@query("join_semi_members", ctes=f"{TXN_SQL}, {MEMBERS_SQL}", sql=f"SELECT {K}, area_name_en FROM txn WHERE area_name_en IN (SELECT member FROM members)")
def join_semi_members(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "area_name_en")
    return joins.members_of(facts, "area_name_en", members(spark)).select(*KEYS, "area_name_en")


CENTRES_SQL = "centres(area, alat, alon) AS (VALUES " + ", ".join(
    f"('{a.replace(chr(39), chr(39) * 2)}', {lat!r}e0, {lon!r}e0)" for a, lat, lon in fv.AREA_CENTRES
) + ")"


@query("join_nearest_point", ctes=f"""{view_sql("requests")}, {CENTRES_SQL},
d AS (SELECT request_id, area, pow(sin(radians(alat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(alat)) * pow(sin(radians(alon - lon) / 2), 2) AS a FROM requests, centres),
best AS (SELECT request_id, min(2 * 6371 * atan2(sqrt(a), sqrt(1 - a))) AS km, arg_min(area, ROW(2 * 6371 * atan2(sqrt(a), sqrt(1 - a)), area)) AS area FROM d GROUP BY 1)""", sql="""
SELECT request_id, CASE WHEN km <= 8 THEN area END AS nearest_area, round(km, 6) AS distance_km FROM best""")
def join_nearest_point(spark, sf_dir):
    found = joins.nearest_centre(view(spark, sf_dir, "requests"), "lat", "lon")
    return found.select("request_id", "nearest_area", F.round("distance_km", 6).alias("distance_km"))


@query("join_nearest_of_many", ctes=f"""{view_sql("requests")},
centres AS (SELECT s_name AS area, 24.85e0 + (s_suppkey % 61) * 0.0091e0 AS alat, 55.00e0 + (s_suppkey % 53) * 0.0117e0 AS alon FROM supplier),
d AS (SELECT request_id, area, 2 * 6371 * atan2(sqrt(a), sqrt(1 - a)) AS km FROM (SELECT request_id, area, pow(sin(radians(alat - lat) / 2), 2)
  + cos(radians(lat)) * cos(radians(alat)) * pow(sin(radians(alon - lon) / 2), 2) AS a FROM requests, centres)),
best AS (SELECT request_id, min(km) AS km, arg_min(area, ROW(km, area)) AS area FROM d WHERE km <= 2 GROUP BY 1)""", sql="""
SELECT request_id, area AS nearest_area, round(km, 6) AS distance_km FROM requests LEFT JOIN best USING (request_id)""")
def join_nearest_of_many(spark, sf_dir):
    """Centres that grow with the data: matched through grid cells, here within 2 km."""
    centres = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("area"), F.expr("24.85e0 + (s_suppkey % 61) * 0.0091e0").alias("lat"), F.expr("55.00e0 + (s_suppkey % 53) * 0.0117e0").alias("lon")
    )
    points = view(spark, sf_dir, "requests").select("request_id", "lat", "lon")
    found = joins.nearest_of_many(points, ["request_id"], "lat", "lon", centres, 2.0)
    return found.select("request_id", "nearest_area", F.round("distance_km", 6).alias("distance_km"))


@query("join_alias_resolve", ctes=view_sql("requests") + ", stand_ins(name, grp) AS (VALUES " + ", ".join(f"('{a}', '{g}')" for a, g in fv.AREA_STAND_INS) + f"""), {CENTRES_SQL}""", sql="""
SELECT request_id, c.area, coalesce(grp, c.area) AS effective_area FROM requests
JOIN (SELECT area, row_number() OVER (ORDER BY area) AS i FROM centres) c ON c.i = request_id % 40 + 1 LEFT JOIN stand_ins ON c.area = name""")
def join_alias_resolve(spark, sf_dir):
    names = F.array(*(F.lit(n) for n in sorted(a for a, _, _ in fv.AREA_CENTRES)))
    area = F.element_at(names, (F.col("request_id") % 40 + 1).cast("int"))
    requests = view(spark, sf_dir, "requests").select("request_id", area.alias("area"))
    return joins.resolve_alias(requests, "area", "effective_area")
