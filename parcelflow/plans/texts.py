"""Queries over text rules."""

from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow.functions import text
from parcelflow.plans.filters import KEYS, quoted
from parcelflow.plans.registry import query
from parcelflow.sources.bindings import TXN_SQL, table, transactions, view, view_sql

K = "l_orderkey, l_partkey, l_linenumber"


@query("str_rooms_normalise", ctes=view_sql("units"), sql=rf"""
SELECT {K}, regexp_replace(regexp_replace(regexp_replace(rooms_en, '(\d+)\s*bed\s*rooms?\s*\+\s*hall', '\1 B/R', 'gi'),
  '^(\d+)\s*(?:B/R)?\s*\+.*$', '\1 B/R', 'i'), '^(\d+)$', '\1 B/R') AS rooms_en FROM units""")
def str_rooms_normalise(spark, sf_dir):
    units = view(spark, sf_dir, "units")
    return units.select(*KEYS, text.rooms_normalised(F.col("rooms_en")).alias("rooms_en"))


@query("str_floor_bin", ctes=TXN_SQL, sql=rf"""
SELECT {K}, CASE WHEN floor_key IS NULL OR upper(trim(floor_key)) IN ('-', '', 'NA') THEN 'Unknown'
  WHEN regexp_matches(upper(trim(floor_key)), '^[GBMP]') OR TRY_CAST(regexp_extract(floor_key, '\d+') AS bigint) = 0 THEN 'Below 1st Floor'
  WHEN TRY_CAST(regexp_extract(floor_key, '\d+') AS bigint) IS NULL THEN 'Unknown'
  ELSE concat(CAST((TRY_CAST(regexp_extract(floor_key, '\d+') AS bigint) - 1) // 10 * 10 + 1 AS string), '-',
    CAST((TRY_CAST(regexp_extract(floor_key, '\d+') AS bigint) - 1) // 10 * 10 + 10 AS string)) END AS floor_bin FROM txn""")
def str_floor_bin(spark, sf_dir):
    return transactions(spark, sf_dir, *KEYS, "floor_key").select(*KEYS, text.floor_bin(F.col("floor_key")).alias("floor_bin"))


@query("str_floor_value", ctes=TXN_SQL, sql=rf"""
SELECT {K}, CASE WHEN floor_key IS NULL OR trim(floor_key) = '' THEN 0e0
  ELSE coalesce(TRY_CAST(regexp_extract(floor_key, '\d+') AS double), 0.5e0) END AS floor FROM txn""")
def str_floor_value(spark, sf_dir):
    return transactions(spark, sf_dir, *KEYS, "floor_key").select(*KEYS, text.floor_value(F.col("floor_key")).alias("floor"))


@query("str_rooms_number", ctes=TXN_SQL, sql=f"""
SELECT {K}, CAST(CASE rooms_en WHEN '1 B/R' THEN 1 WHEN '2 B/R' THEN 2 WHEN '3 B/R' THEN 3 WHEN '4 B/R' THEN 4 WHEN '11 B/R' THEN 11
  WHEN 'Studio' THEN 11 WHEN 'PENTHOUSE' THEN 621 END AS double) AS rooms_num FROM txn""")
def str_rooms_number(spark, sf_dir):
    return transactions(spark, sf_dir, *KEYS, "rooms_en").select(*KEYS, text.rooms_number(F.col("rooms_en")).alias("rooms_num"))


@query("str_room_group", ctes=TXN_SQL, sql=f"""
SELECT {K}, CASE WHEN rooms_en IN ({quoted(fv.LARGE_HOME_LABELS)}) THEN 'More than 3B/R' ELSE rooms_en END AS rooms_en FROM txn""")
def str_room_group(spark, sf_dir):
    return transactions(spark, sf_dir, *KEYS, "rooms_en").select(*KEYS, text.room_group(F.col("rooms_en")).alias("rooms_en"))


LINK_KEY_SQL = """concat(CAST(coalesce(property_sub_type_id, 0) AS string), '-', CAST(coalesce({area_id}, 0) AS string), '-',
  CAST(coalesce({project}, 0) AS string), '-', trim(coalesce(rooms_en, '')), '-', CAST(CAST(trunc(coalesce({area}, 0)) AS bigint) AS string))"""
TXN_KEY_SQL = LINK_KEY_SQL.format(area_id="area_id", project="project_number", area="procedure_area")
UNIT_KEY_SQL = LINK_KEY_SQL.format(area_id="area_id", project="project_id", area="actual_area")


@query("str_link_key", ctes=f'{TXN_SQL}, {view_sql("units")}', sql=f"""
SELECT 'transactions' AS side, {TXN_KEY_SQL} AS link_key, count(*) AS n FROM txn GROUP BY 1, 2
UNION ALL SELECT 'units', {UNIT_KEY_SQL}, count(*) FROM units GROUP BY 1, 2""")
def str_link_key(spark, sf_dir):
    """One key function for both sides."""
    txn = transactions(spark, sf_dir, "property_sub_type_id", "area_id", "project_number", "rooms_en", "procedure_area")
    units = view(spark, sf_dir, "units")
    left = txn.select(F.lit("transactions").alias("side"), text.link_key(*map(F.col, txn.columns)).alias("link_key"))
    cols = ["property_sub_type_id", "area_id", "project_id", "rooms_en", "actual_area"]
    right = units.select(F.lit("units").alias("side"), text.link_key(*map(F.col, cols)).alias("link_key"))
    return left.unionAll(right).groupBy("side", "link_key").agg(F.count("*").alias("n"))


RULE_SQL = "CASE WHEN developer_name_en IS NOT NULL AND developer_name_en NOT IN ('', 'Missing_developer_name_en') THEN developer_name_en " + "".join(
    f"WHEN contains(lower(project_name_en), '{k}') THEN '{d}' " for k, d in reversed(fv.DEVELOPER_KEYWORDS)
) + "ELSE developer_name_en END"


@query("str_rule_label", ctes=TXN_SQL, sql=f"SELECT {K}, {RULE_SQL} AS developer_name_en FROM txn")
def str_rule_label(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "developer_name_en", "project_name_en")
    name = text.developer_from_project(F.col("developer_name_en"), F.col("project_name_en"))
    return facts.select(*KEYS, name.alias("developer_name_en"))


@query("str_trim_keys", ctes=TXN_SQL, sql=f"SELECT {K}, trim(project_name_en) AS project_name_en, trim(property_usage_en) AS property_usage_en FROM txn")
def str_trim_keys(spark, sf_dir):
    cols = ["project_name_en", "property_usage_en"]
    return transactions(spark, sf_dir, *KEYS, *cols).withColumns({c: text.strip(F.col(c)) for c in cols})


GEO_SQL = {
    part: "CASE " + "".join(
        f"WHEN regexp_matches(t, '(^|[^a-z0-9_])({'|'.join(words)})($|[^a-z0-9_])') THEN '{(region, country)[part]}' "
        for words, region, country in fv.GEO_KEYWORDS
    ) + f"WHEN source IN ({quoted(fv.LOCAL_SOURCES)}) THEN '{('GCC', 'UAE')[part]}' ELSE 'Global' END"
    for part in (0, 1)
}
LEAD_SQL = """CASE doc_id % 12 WHEN 0 THEN 'Dubai: ' WHEN 1 THEN 'In Oman, ' WHEN 2 THEN 'Woman ' WHEN 3 THEN 'saudi-' WHEN 4 THEN 'Nigeria ' ELSE '' END"""
SOURCE_SQL = "CASE doc_id % 13 WHEN 0 THEN 'Khaleej Times' WHEN 5 THEN 'Dubai Confidential' ELSE source END"


@query("str_geo_tag", ctes=f"""
d AS (SELECT doc_id, concat({LEAD_SQL}, text) AS title, lang, {SOURCE_SQL} AS source FROM documents),
lowered AS (SELECT doc_id, source, lower(concat(title, ' ', lang)) AS t FROM d)""",
       sql=f"SELECT doc_id, {GEO_SQL[0]} AS region, {GEO_SQL[1]} AS country FROM lowered")
def str_geo_tag(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    titled = docs.select("doc_id", F.concat(F.expr(LEAD_SQL), "text").alias("title"), "lang", F.expr(SOURCE_SQL).alias("source"))
    tag = text.geo_tag(F.col("title"), F.col("lang"), F.col("source"))
    return titled.select("doc_id", tag["region"].alias("region"), tag["country"].alias("country"))


@query("str_slug", sql=r"""
SELECT doc_id, regexp_replace(concat(source, ' ', lang, '''s/x'), '[^0-9A-Za-z_]+', '_', 'g') AS model_slug,
  replace(replace(concat(source, ' ', lang, '''s/x'), ' ', '_'), '''', '') AS file_slug,
  lower(replace(replace(concat(source, ' ', lang, '''s/x'), ' ', '_'), '/', '')) AS share_name FROM documents""")
def str_slug(spark, sf_dir):
    name = F.concat(F.col("source"), F.lit(" "), F.col("lang"), F.lit("'s/x"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.model_slug(name).alias("model_slug"), text.file_slug(name).alias("file_slug"),
        text.share_name(name).alias("share_name"),
    )


@query("str_norm_id", sql="SELECT s_suppkey, CAST(s_nationkey AS string) AS area_id, s_name AS name_id FROM supplier")
def str_norm_id(spark, sf_dir):
    padded = F.concat(F.lit(" "), F.col("s_nationkey").cast("double").cast("string"), F.lit(" "))
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", text.norm_id(padded).alias("area_id"), text.norm_id(F.col("s_name")).alias("name_id")
    )


@query("str_title_area", sql="""
SELECT p_partkey, array_to_string(list_transform(string_split(lower(replace(concat(p_name, '_', p_type), '_', ' ')), ' '),
  lambda s: concat(upper(s[1:1]), s[2:])), ' ') AS area FROM part""")
def str_title_area(spark, sf_dir):
    name = F.concat(F.col("p_name"), F.lit("_"), F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", text.title_area(name).alias("area"))
