"""Queries over readers and sinks. Written copies live in the session's shared work folder."""

from pyspark.sql import functions as F

from parcelflow import schemas
from parcelflow.functions import text
from parcelflow.operators import filters
from parcelflow.plans.registry import query
from parcelflow.session import fresh_path, materialise
from parcelflow.sources import readers, sinks
from parcelflow.sources.bindings import table, view, view_sql

LINE = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string"
LINE_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag"


@query("scan_parquet", sql="SELECT n_nationkey, n_name, n_regionkey FROM nation")
def scan_parquet(spark, sf_dir):
    schema = "n_nationkey int, n_name string, n_regionkey int"
    return readers.read_parquet(spark, f"{sf_dir}/nation.parquet", schema)


@query("scan_projected", sql="SELECT l_orderkey, l_shipdate, l_extendedprice FROM lineitem")
def scan_projected(spark, sf_dir):
    return readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet", columns=["l_orderkey", "l_shipdate", "l_extendedprice"])


@query("scan_csv", sql="SELECT doc_id, text, lang, n_chars FROM documents")
def scan_csv(spark, sf_dir):
    path = fresh_path(spark, "csv")
    sinks.write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars"), path)
    return readers.read_csv(spark, path, "doc_id bigint, text string, lang string, n_chars bigint", multi_line=True)


@query("scan_scorecard", sql="""SELECT s_name AS "Developer Name", CAST(s_acctbal AS string) AS "Developer Score (0-100)",
  CASE WHEN s_acctbal > 5000 THEN 'A' ELSE 'B' END AS "Grade", CAST(s_nationkey AS string) AS "Developer Tier" FROM supplier""")
def scan_scorecard(spark, sf_dir):
    card = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("  "), "s_name", F.lit("\t ")).alias("Developer Name"),
        F.col("s_acctbal").cast("string").alias("Developer Score (0-100)"),
        F.when(F.col("s_acctbal") > 5000, "A").otherwise("B").alias("Grade"),
        F.col("s_nationkey").cast("string").alias("Developer Tier"),
    )
    path = fresh_path(spark, "scorecard")
    sinks.write_csv(card, path)
    return readers.read_scorecard(spark, path, schemas.SCORECARD_DEVELOPER)


@query("scan_json_map", sql="""
SELECT event_type AS key, concat('c', CAST(user_id % 20 AS string)) AS channel, max(value) AS weight FROM events GROUP BY 1, 2""")
def scan_json_map(spark, sf_dir):
    """One JSON document per event type, as the configuration files are laid out."""
    channel = F.concat(F.lit("c"), (F.col("user_id") % 20).cast("string")).alias("channel")
    pairs = table(spark, sf_dir, "events").groupBy("event_type", channel).agg(F.max("value").alias("weight"))
    entry = F.struct(F.col("channel").alias("k"), F.col("weight").alias("v"))
    maps = pairs.groupBy("event_type").agg(F.map_from_entries(F.collect_list(entry)).alias("channels"))
    doc = F.to_json(F.create_map(F.col("event_type"), F.col("channels")))
    path = fresh_path(spark, "json-map")
    maps.select(doc.alias("value")).write.text(path)
    return readers.read_channel_map(spark, path)


@query("scan_list_literal", sql="""
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey,
  CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN 'plain text' WHEN 3 THEN concat('S', CAST(l_suppkey AS string))
    ELSE concat('S', CAST(l_suppkey AS string), '|it ', l_returnflag) END AS items,
  CASE l_linenumber WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE 2 END AS n FROM lineitem""")
def scan_list_literal(spark, sf_dir):
    s = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    n = F.col("l_linenumber")
    cell = (
        F.when(n == 1, F.lit(None)).when(n == 2, "plain text").when(n == 3, F.concat(F.lit("['"), s, F.lit("']")))
        .otherwise(F.concat(F.lit(" ['"), s, F.lit("', 'it "), F.col("l_returnflag"), F.lit("']")))
    )
    parsed = table(spark, sf_dir, "lineitem").withColumn("list", text.list_cell(cell))
    keys = ["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"]
    return parsed.select(*keys, F.array_join("list", "|").alias("items"), F.size("list").alias("n"))


FEED_SQL = """bodies AS (SELECT doc_id, lang, CASE doc_id % 9 WHEN 0 THEN 'Khaleej Times' ELSE source END AS source,
  trim(regexp_replace(regexp_replace(text, '[^ -~]+', ' ', 'g'), ' +', ' ', 'g')) AS body FROM documents),
tagged AS (SELECT *, concat(' ', lower(concat(CASE doc_id % 4 WHEN 0 THEN 'Doha notes ' WHEN 1 THEN 'Romania ' ELSE '' END, lang, ' ',
  CAST(doc_id AS string), ' ', body)), ' ') AS t FROM bodies)"""


def _feed_bodies(spark, sf_dir, *more):
    """One feed document per text, with markup characters escaped as a feed would carry them."""
    docs = table(spark, sf_dir, "documents")
    plain = F.regexp_replace(F.regexp_replace("text", "[^ -~]+", " "), " +", " ")
    safe = F.replace(F.replace(F.replace(plain, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    lead = F.when(F.col("doc_id") % 4 == 0, "Doha notes ").when(F.col("doc_id") % 4 == 1, "Romania ").otherwise("")
    title = F.concat(lead, "lang", F.lit(" "), F.col("doc_id").cast("string"))
    date = F.concat(F.lit("Mon, 0"), (F.col("doc_id") % 9 + 1).cast("string"), F.lit(" Jan 2024 22:30:00 -0400"))
    body = F.concat(
        F.lit("<rss><channel><title>feed</title><item><title>\n "), title, F.lit(" </title><description>"), safe,
        F.lit("</description><pubDate>"), date, F.lit("</pubDate></item></channel></rss>"),
    )
    source = F.when(F.col("doc_id") % 9 == 0, "Khaleej Times").otherwise(F.col("source"))
    return docs.select(source.alias("source"), body.alias("body"), *more)


@query("scan_feed_items", ctes=FEED_SQL, sql=r"""
SELECT source, concat(CASE doc_id % 4 WHEN 0 THEN 'Doha notes ' WHEN 1 THEN 'Romania ' ELSE '' END, lang, ' ', CAST(doc_id AS string)) AS title,
  '' AS link, body AS snippet, concat('Mon, 0', CAST(doc_id % 9 + 1 AS string), ' Jan 2024 22:30:00 -0400') AS published_date,
  '' AS category, CAST('2024-01-02' AS DATE) + CAST(doc_id % 9 AS int) AS published_day,
  CASE WHEN regexp_matches(t, '[^a-z0-9_](dubai|abu dhabi|sharjah|ajman|rak|fujairah|saudi|riyadh|kuwait|bahrain|oman|muscat|qatar|doha)[^a-z0-9_]') THEN 'GCC'
    WHEN regexp_matches(t, '[^a-z0-9_]iran[^a-z0-9_]') THEN 'MENA' WHEN regexp_matches(t, '[^a-z0-9_]nigeria[^a-z0-9_]') THEN 'Africa'
    WHEN regexp_matches(t, '[^a-z0-9_]philippines[^a-z0-9_]') THEN 'Asia' WHEN source = 'Khaleej Times' THEN 'GCC' ELSE 'Global' END AS region
FROM tagged""")
def scan_feed_items(spark, sf_dir):
    items = materialise(readers.feed_items(_feed_bodies(spark, sf_dir), "body", "source"), "items")
    day = readers.news_items(items.select("title", "published_date")).withColumnRenamed("published_date", "published_day")
    return items.drop("country").join(day, "title")


def _some_broken(bodies):
    """Feed documents of which some are cut off, empty, missing, or no feed at all."""
    kind = F.col("doc_id") % 13
    cut = F.substr("body", F.lit(1), F.length("body") - 8)
    body = F.when(kind == 1, cut).when(kind == 2, F.lit(None)).when(kind == 3, "  ").when(kind == 4, "<rss><other/></rss>")
    return bodies.select("source", body.when(kind == 5, "<rss><channel><title>no items</title></channel></rss>").otherwise(F.col("body")).alias("body"))


@query("scan_feed_rejects", ctes=FEED_SQL, sql="""
SELECT source, CASE doc_id % 13 WHEN 1 THEN 'malformed' WHEN 2 THEN 'missing' WHEN 3 THEN 'empty' WHEN 4 THEN 'no channel' END AS reason,
  count(*) AS documents, CAST(count(*) FILTER (WHERE doc_id % 13 NOT IN (1, 2, 3, 4, 5)) AS bigint) AS items FROM bodies GROUP BY 1, 2""")
def scan_feed_rejects(spark, sf_dir):
    """What came in by source and fate: items of readable documents, and documents that went to the reject table."""
    documents = readers.feed_documents(_some_broken(_feed_bodies(spark, sf_dir, "doc_id")), "body", "source")
    return readers.feed_counts(documents)


@query("scan_with_fallback", sql="SELECT s_suppkey AS developer_id, s_name AS developer_name_en FROM supplier")
def scan_with_fallback(spark, sf_dir):
    """The first root was never written, so its archive is read."""
    schema = "developer_id bigint, developer_name_en string"
    archive = fresh_path(spark, "archive")
    sinks.write_run(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("developer_id"), F.col("s_name").alias("developer_name_en")), archive, "1")
    return readers.with_fallback(spark, [fresh_path(spark, "never-written"), archive], schema)


@query("sink_parquet", sql=f"SELECT {LINE_COLS}, CAST(year(l_shipdate) AS int) AS year FROM lineitem WHERE year(l_shipdate) = 1997")
def sink_parquet(spark, sf_dir):
    """Laid out by year; the read prunes to one partition."""
    path = fresh_path(spark, "by-year")
    lines = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    sinks.write_parquet(lines.select(*LINE_COLS.split(", "), "year"), path, ["year"])
    return readers.read_parquet(spark, path, f"{LINE}, year int").where("year = 1997")


@query("sink_csv", sql=f"SELECT {LINE_COLS} FROM lineitem")
def sink_csv(spark, sf_dir):
    path = fresh_path(spark, "csv")
    sinks.write_csv(table(spark, sf_dir, "lineitem").select(*LINE_COLS.split(", ")), path)
    return readers.read_csv(spark, path, LINE)


@query("sink_versioned", sql="SELECT c_custkey, c_acctbal * 2 AS c_acctbal FROM customer")
def sink_versioned(spark, sf_dir):
    """Two runs are kept; readers get the newer one."""
    root = fresh_path(spark, "runs")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    sinks.write_run(customers, root, "2024-01-01")
    sinks.write_run(customers.withColumn("c_acctbal", F.col("c_acctbal") * 2), root, "2024-02-01")
    return readers.latest_run(spark, root, "c_custkey bigint, c_acctbal double")


@query("sink_json_records", ctes=view_sql("developers"), sql="""
SELECT concat('{"developer_id":', CAST(developer_id AS string), ',"developer_name_en":"', developer_name_en,
  '","registration_date":"', strftime(CAST(registration_date AS DATE), '%Y-%m-%d'), '"}') AS record
FROM developers ORDER BY CAST(registration_date AS DATE) DESC, developer_id LIMIT 10""")
def sink_json_records(spark, sf_dir):
    """The newest records written as JSON, and read back as they lie in the files."""
    devs = filters.coerce_dates(view(spark, sf_dir, "developers"), ["registration_date"])
    path = fresh_path(spark, "records")
    newest = [F.desc_nulls_last("registration_date"), F.col("developer_id")]
    sinks.write_json_records(devs.select("developer_id", "developer_name_en", "registration_date"), path, newest, 10)
    return spark.read.text(path).withColumnRenamed("value", "record")
