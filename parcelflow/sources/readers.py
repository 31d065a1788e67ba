"""Readers. Every one takes a declared schema; nothing is inferred from data."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow import schemas
from parcelflow.functions import dates, text
from parcelflow.operators import joins


def read_parquet(spark: SparkSession, path: str, schema: str | None = None, columns: list[str] | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """Headed CSV; unreadable cells become null.

    Files are split between tasks by lines. Only texts with quoted line breaks need multi_line, which reads a file whole.
    """
    options = {"header": True, "mode": "PERMISSIVE", "escape": '"', "multiLine": multi_line}
    return spark.read.schema(schema).options(**options).csv(path)


def read_scorecard(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Scorecard with its key (the first column) stripped."""
    df = read_csv(spark, path, schema)
    key = df.columns[0]
    return df.withColumn(key, text.strip(F.col(key)))


def read_channel_map(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents {key: {channel: weight}}, one per line, to rows (key, channel, weight)."""
    raw = spark.read.text(path)
    outer = raw.select(F.explode(F.from_json("value", "map<string, map<string, double>>")).alias("key", "channels"))
    return outer.select("key", F.explode("channels").alias("channel", "weight"))


_CORRUPT = "_corrupt_record"


def feed_documents(bodies: DataFrame, body: str, source: str) -> DataFrame:
    """(source, body, items, reason) of raw feed documents, each read once.

    reason tells why a document cannot be read (missing, empty, malformed, no channel) and is null for all others; a readable feed may hold no items.
    """
    schema = f"{schemas.FEED}, {_CORRUPT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = bodies.select(F.col(source).alias("source"), F.col(body).alias("body"), F.from_xml(F.col(body), schema, options).alias("_feed"))
    reason = (
        F.when(F.col("body").isNull(), "missing").when(F.trim("body") == "", "empty").when(F.col(f"_feed.{_CORRUPT}").isNotNull(), "malformed")
        .when(F.col("_feed.channel").isNull(), "no channel")
    )
    return parsed.select("source", "body", F.col("_feed.channel.item").alias("items"), reason.alias("reason"))


def feed_rejects(documents: DataFrame) -> DataFrame:
    """(source, body, reason) of the documents that could not be read, whole, for a reject table."""
    return documents.where(F.col("reason").isNotNull()).select("source", "body", "reason")


def feed_counts(documents: DataFrame) -> DataFrame:
    """Per source and reason (null: read) the documents and their items, so that what came in can be held against what went on."""
    size = F.when(F.col("reason").isNull(), F.coalesce(F.size("items"), F.lit(0))).otherwise(0)
    return documents.groupBy("source", "reason").agg(F.count("*").alias("documents"), F.sum(size).alias("items"))


def feed_items(bodies: DataFrame, body: str, source: str) -> DataFrame:
    """Raw feed documents to one row per item, texts stripped, absent texts ''. Unreadable documents have none; see feed_rejects."""
    return items_of(feed_documents(bodies, body, source))


def items_of(documents: DataFrame) -> DataFrame:
    """The items of readable documents as feed_items returns them.

    Each document is parsed once: a filter on the reason, or an explode that leaves out empty lists, would be pushed below the parser and parse
    it again for each of its terms. Places are looked up in one lower-case text per item.
    """
    readable = F.when(F.col("reason").isNull(), F.col("items"))
    parsed = documents.select("source", F.posexplode_outer(readable).alias("_pos", "item")).where(F.col("_pos").isNotNull())
    fields = {"title": "title", "link": "link", "snippet": "description", "published_date": "pubDate", "category": "category"}
    clean = [F.coalesce(text.strip(F.col(f"item.{tag}")), F.lit("")).alias(name) for name, tag in fields.items()]
    items = parsed.select("source", *clean).withColumn("_text", text.geo_text(F.col("title"), F.col("snippet")))
    return items.withColumn("_tag", text.geo_tag_of(F.col("_text"), F.col("source"))).select("*", "_tag.region", "_tag.country").drop("_tag", "_text")


def news_items(items: DataFrame) -> DataFrame:
    """Items once per (title, published date), the first by all their values, with the date as a UTC day."""
    once = joins.keep_one(items, ["title", "published_date"], [F.col(c).asc_nulls_last() for c in items.columns])
    return once.withColumn("published_date", dates.rfc822_date(F.col("published_date")))


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def latest_run(spark: SparkSession, root: str, schema: str) -> DataFrame | None:
    """The newest run whose write was recorded as finished; None when there is none."""
    try:
        run = spark.read.schema("run_id string, finished boolean").parquet(f"{root}/runs").where("finished")
        newest = run.agg(F.max("run_id").alias("r")).first()["r"]
        return None if newest is None else read_parquet(spark, f"{root}/data/run_id={newest}", schema)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def with_fallback(spark: SparkSession, roots: list[str], schema: str) -> DataFrame:
    """The newest finished run of the first root that has one, else an empty table."""
    for root in roots:
        df = latest_run(spark, root, schema)
        if df is not None:
            return df
    return empty(spark, schema)
