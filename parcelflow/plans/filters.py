"""Queries over filters and projections."""

from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow import schemas
from parcelflow.operators import filters, joins
from parcelflow.plans.registry import query
from parcelflow.sources.bindings import TXN_SQL, table, transactions, view, view_sql

KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]


def quoted(values):
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


@query("proj_date_coerce", ctes=view_sql("projects"), sql="""
SELECT project_id, TRY_CAST(project_start_date AS DATE) AS project_start_date, TRY_CAST(project_end_date AS DATE) AS project_end_date,
  TRY_CAST(completion_date AS DATE) AS completion_date FROM projects""")
def proj_date_coerce(spark, sf_dir):
    cols = ["project_start_date", "project_end_date", "completion_date", "cancellation_date"]
    return filters.keep_listed(filters.coerce_dates(view(spark, sf_dir, "projects"), cols), ["project_id", *cols])


@query("filt_valid_date_since", sql="""
SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'""")
def filt_valid_date_since(spark, sf_dir):
    recent = filters.since(table(spark, sf_dir, "lineitem"), "l_shipdate", "1998-01-01")
    return recent.select(*KEYS, F.col("l_shipdate").cast("date").alias("day"))


@query("proj_drop_by_suffix", ctes=view_sql("projects"), sql="SELECT project_id, master_project_en FROM projects")
def proj_drop_by_suffix(spark, sf_dir):
    cut = view(spark, sf_dir, "projects").select("project_id", "master_project_en", "master_project_ar")
    return filters.drop_suffix(cut, "_ar")


@query("proj_drop_config", ctes=view_sql("buildings"), sql="SELECT property_id, area_id, project_id FROM buildings")
def proj_drop_config(spark, sf_dir):
    cut = view(spark, sf_dir, "buildings").select("property_id", "area_id", "project_id", "zone_id", "floors")
    return filters.drop_listed(cut, ["zone_id", "floors", "land_sub_number"])


@query("proj_rename_provenance", ctes=view_sql("buildings"), sql="""
SELECT property_id, area_id AS area_id_bld, land_number AS land_number_bld, actual_area AS actual_area_bld, floors FROM buildings""")
def proj_rename_provenance(spark, sf_dir):
    cut = view(spark, sf_dir, "buildings").select("property_id", "area_id", "land_number", "actual_area", "floors")
    return filters.add_suffix(cut, fv.UNIT_FILL, "_bld")


@query("proj_coalesce_collisions", ctes=f'{view_sql("projects")}, {view_sql("developers")}', sql="""
SELECT project_id, p.developer_id, coalesce(p.developer_number, d.developer_number) AS developer_number, developer_name_en
FROM projects p LEFT JOIN developers d ON p.developer_id = d.developer_id""")
def proj_coalesce_collisions(spark, sf_dir):
    projects = view(spark, sf_dir, "projects").select("project_id", "developer_id", "developer_number")
    devs = view(spark, sf_dir, "developers").select("developer_id", "developer_number", "developer_name_en")
    return joins.merge(projects, devs, ["developer_id"], "left")


@query("proj_fill_pairs", ctes=f'{view_sql("units")}, {view_sql("buildings")}', sql="""
SELECT u.l_orderkey, u.l_partkey, u.l_linenumber, coalesce(u.area_id, b.area_id) AS area_id_u, coalesce(u.land_number, b.land_number) AS land_number_u,
  coalesce(u.rooms_en, b.rooms_en) AS rooms_en_u, coalesce(u.actual_area, b.actual_area) AS actual_area_u
FROM units u LEFT JOIN buildings b ON u.parent_property_id = CAST(b.property_id AS string)""")
def proj_fill_pairs(spark, sf_dir):
    cols = ["area_id", "land_number", "rooms_en", "actual_area"]
    units = filters.add_suffix(view(spark, sf_dir, "units"), cols, "_u")
    blds = view(spark, sf_dir, "buildings").select(F.col("property_id").cast("string").alias("parent_property_id"), *cols)
    both = units.join(filters.add_suffix(blds, cols, "_bld"), "parent_property_id", "left")
    return filters.fill_pairs(both, cols).select(*KEYS, *(f"{c}_u" for c in cols))


@query("proj_final_columns", sql="SELECT s_suppkey, s_name FROM supplier")
def proj_final_columns(spark, sf_dir):
    return filters.keep_listed(table(spark, sf_dir, "supplier"), ["s_suppkey", "s_name", "floor_key"])


@query("proj_dedupe_columns", sql="SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def proj_dedupe_columns(spark, sf_dir):
    """Joined on a shared name, so no column appears twice; the check fails the plan otherwise."""
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    both = table(spark, sf_dir, "orders").join(names, "o_custkey")
    return filters.assert_unique_columns(both).select("o_orderkey", "o_custkey", "c_name")


@query("filt_exclude_set", ctes=TXN_SQL, sql=f"""
SELECT l_orderkey, l_partkey, l_linenumber, trim(coalesce(trans_group_en, '')) AS trans_group_en FROM txn
WHERE trim(coalesce(trans_group_en, '')) NOT IN ({quoted(fv.EXCLUDED_TRANSACTION_GROUPS)})""")
def filt_exclude_set(spark, sf_dir):
    return filters.exclude_set(transactions(spark, sf_dir, *KEYS, "trans_group_en"), "trans_group_en", fv.EXCLUDED_TRANSACTION_GROUPS)


@query("filt_equals_pair", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, trim(property_usage_en) AS property_usage_en, trim(property_type_en) AS property_type_en
FROM txn WHERE trim(property_usage_en) = 'Residential' AND trim(property_type_en) = 'Unit'""")
def filt_equals_pair(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "property_usage_en", "property_type_en")
    return filters.equals_pair(facts, "property_usage_en", fv.HOME_USAGE, "property_type_en", fv.HOME_TYPE)


@query("filt_exclude_rooms", ctes=TXN_SQL, sql=f"""
SELECT l_orderkey, l_partkey, l_linenumber, rooms_en FROM txn WHERE rooms_en IS NULL OR rooms_en NOT IN ({quoted(fv.NON_HOME_ROOMS)})""")
def filt_exclude_rooms(spark, sf_dir):
    return filters.exclude_rooms(transactions(spark, sf_dir, *KEYS, "rooms_en"))


@query("filt_include_set", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, trans_group_en FROM txn WHERE trans_group_en IN ('Sales')""")
def filt_include_set(spark, sf_dir):
    return filters.include_set(transactions(spark, sf_dir, *KEYS, "trans_group_en"), "trans_group_en", ["Sales"])


@query("filt_target_not_null", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, built_up_area AS actual_price FROM txn WHERE built_up_area IS NOT NULL""")
def filt_target_not_null(spark, sf_dir):
    """No meter_sale_price here, so the next candidate is the target."""
    facts = transactions(spark, sf_dir, *KEYS, "built_up_area").withColumnRenamed("built_up_area", "actual_price")
    known, _ = filters.target_known(facts)
    return known


@query("filt_min_group_count", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, area_name_en FROM txn WHERE area_name_en IN ('NATION_12', 'NATION_20')
  OR area_name_en IN (SELECT area_name_en FROM txn GROUP BY 1 HAVING count(*) >= 2000)""")
def filt_min_group_count(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "area_name_en")
    return filters.min_group_count(facts, "area_name_en", 2000, ["NATION_12", "NATION_20"]).select(*KEYS, "area_name_en")


@query("filt_exact_count", sql="""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) = 6)""")
def filt_exact_count(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*KEYS)
    return filters.exact_group_count(lines, "l_orderkey", 6).select("l_orderkey", "l_linenumber", "l_partkey")


@query("filt_drop_sparse_cols", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN rooms_en IN ('Studio', '1 B/R', '2 B/R') THEN 1 ELSE 0 END AS small_home,
  CASE WHEN l_quantity = 7 THEN 1 ELSE 0 END AS kept_anyway FROM txn""")
def filt_drop_sparse_cols(spark, sf_dir):
    """The share of zeros decides the columns: one is far above 90 %, one is protected."""
    facts = transactions(spark, sf_dir, *KEYS, "rooms_en", "l_quantity")
    flags = facts.select(
        *KEYS, F.coalesce(F.col("rooms_en").isin("Studio", "1 B/R", "2 B/R"), F.lit(False)).cast("int").alias("small_home"),
        (F.col("l_quantity") == 5).cast("int").alias("mostly_zero"), (F.col("l_quantity") == 7).cast("int").alias("kept_anyway"),
    )
    return filters.drop_sparse(flags, protected=[*KEYS, "kept_anyway"])


@query("filt_upto_month", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, CAST(date_trunc('month', instance_date) AS DATE) AS month FROM txn
WHERE date_trunc('month', instance_date) <= DATE '1997-06-01'""")
def filt_upto_month(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "instance_date")
    months = facts.select(*KEYS, F.trunc("instance_date", "MM").alias("month"))
    return filters.up_to_month(months, "month", "1997-06-01")


@query("proj_one_flag", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, CAST(coalesce(swimming_pools, 0) <> 0 AS int) AS swimming_pool,
  CAST(coalesce(unit_balcony_area, 0) <> 0 AS int) AS balcony, CAST(coalesce(elevators, 0) <> 0 AS int) AS elevator FROM txn""")
def proj_one_flag(spark, sf_dir):
    flags = {"swimming_pool": "swimming_pools", "balcony": "unit_balcony_area", "elevator": "elevators"}
    return filters.amenity_flags(transactions(spark, sf_dir, *KEYS, *flags.values()), flags).select(*KEYS, *flags)


@query("proj_sentinel_flag", ctes=TXN_SQL, sql=f"""
SELECT l_orderkey, l_partkey, l_linenumber,
  CAST(nearest_metro_en IS NOT NULL AND lower(nearest_metro_en) NOT IN ({quoted(fv.NO_METRO)}) AS int) AS metro FROM txn""")
def proj_sentinel_flag(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "nearest_metro_en")
    return filters.sentinel_flag(facts, "metro", "nearest_metro_en", fv.NO_METRO).drop("nearest_metro_en")


@query("proj_conditional_zero", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN property_type_en IN ('Building', 'Villa') AND unit_balcony_area IS NULL THEN 0
  ELSE unit_balcony_area END AS unit_balcony_area FROM txn""")
def proj_conditional_zero(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "property_type_en", "unit_balcony_area")
    return filters.zero_where(facts, "unit_balcony_area", "property_type_en", ["Building", "Villa"]).drop("property_type_en")


@query("proj_default_fill", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, coalesce(land_type_en, 'Unknown') AS land_type_en,
  coalesce(TRY_CAST(floor_key AS double), 0) AS floor_key FROM txn""")
def proj_default_fill(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "land_type_en", "floor_key")
    return filters.default_fill(facts, ["land_type_en"], ["floor_key"])


@query("proj_missing_label", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, """ + ", ".join(f"coalesce({c}, 'Missing_{c}') AS {c}" for c in fv.LABELLED) + " FROM txn")
def proj_missing_label(spark, sf_dir):
    return filters.label_missing(transactions(spark, sf_dir, *KEYS, *fv.LABELLED), fv.LABELLED)


@query("proj_numeric_coerce", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, TRY_CAST(floor_key AS double) AS floor_key FROM txn""")
def proj_numeric_coerce(spark, sf_dir):
    return filters.coerce_numbers(transactions(spark, sf_dir, *KEYS, "floor_key"), ["floor_key"])


@query("proj_sentinel_to_null", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, nullif(developer_name_en, 'Missing_developer_name_en') AS developer_name_en FROM txn""")
def proj_sentinel_to_null(spark, sf_dir):
    facts = transactions(spark, sf_dir, *KEYS, "developer_name_en")
    return filters.sentinel_to_null(facts, "developer_name_en", fv.MISSING_DEVELOPER)


@query("filt_required_not_null", ctes=TXN_SQL, sql="""
SELECT DISTINCT project_number, developer_number, floor_key FROM txn
WHERE project_number IS NOT NULL AND developer_number IS NOT NULL AND floor_key IS NOT NULL""")
def filt_required_not_null(spark, sf_dir):
    cols = ["project_number", "developer_number", "floor_key"]
    return filters.required_known(transactions(spark, sf_dir, *cols), cols)


@query("proj_trim_headers", sql="SELECT c_custkey, c_name FROM customer")
def proj_trim_headers(spark, sf_dir):
    padded = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias(" c_custkey"), F.col("c_name").alias("c_name  "))
    return filters.strip_headers(padded)


@query("proj_fill_by_type", ctes=TXN_SQL, sql="""
SELECT l_orderkey, l_partkey, l_linenumber, coalesce(land_type_en, 'missing_land_type_en') AS land_type_en,
  coalesce(has_parking, 0) AS has_parking, coalesce(unit_balcony_area, 0) AS unit_balcony_area FROM txn""")
def proj_fill_by_type(spark, sf_dir):
    return filters.fill_by_type(transactions(spark, sf_dir, *KEYS, "land_type_en", "has_parking", "unit_balcony_area"))


@query("dq_required_columns", sql="SELECT n_nationkey, n_name, CAST(NULL AS double) AS lat FROM nation")
def dq_required_columns(spark, sf_dir):
    """The schema check passes, then the table is made to conform: an absent column arrives as null."""
    nations = schemas.require(table(spark, sf_dir, "nation"), ["n_nationkey", "n_name"])
    return schemas.conform(nations, "n_nationkey int, n_name string, lat double")


@query("dq_guess_columns", ctes=TXN_SQL, sql="""
SELECT area_name_en AS area, max(CAST(instance_date AS DATE)) AS last_date, max(meter_sale_price) AS top_value FROM txn GROUP BY 1""")
def dq_guess_columns(spark, sf_dir):
    """Date, area and value columns come from declared roles, not from name matching."""
    facts = transactions(spark, sf_dir, "area_name_en", "instance_date", "meter_sale_price")
    date, area, value = (schemas.role(facts, r) for r in ("date", "area", "value"))
    return facts.groupBy(F.col(area).alias("area")).agg(
        F.max(F.col(date).cast("date")).alias("last_date"), F.max(value).alias("top_value")
    )


@query("dq_merge_added_columns", sql="""SELECT unnest(['c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS added_column, count(*) AS matched_rows
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def dq_merge_added_columns(spark, sf_dir):
    """Columns a merge adds (from schemas) with the number of rows in which each is known."""
    orders = table(spark, sf_dir, "orders")
    both = orders.join(table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "left")
    new = schemas.added_columns(orders, both)
    known = both.agg(*(F.count(c).alias(c) for c in new))
    return known.unpivot([], new, "added_column", "matched_rows")
