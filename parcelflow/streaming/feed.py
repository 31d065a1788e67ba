"""Polling of news feeds: each run takes in the feed documents that arrived since the last one, then stops."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.functions import dates
from parcelflow.operators import joins
from parcelflow.session import materialise
from parcelflow.sources import readers

BODIES = "source string, body string"
KEY = ["title", "published_date"]


def stored_items(spark: SparkSession, store: str) -> DataFrame | None:
    """All items taken in so far, with the batch that brought them; None before the first."""
    try:
        return spark.read.parquet(store)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _append(bodies: DataFrame, batch: int, store: str) -> None:
    """Store the batch's new items. A replayed batch overwrites its own files only, so nothing is stored twice."""
    found = readers.feed_items(bodies, "body", "source")
    items = joins.keep_one(found, KEY, [F.col(c).asc_nulls_last() for c in found.columns])
    month = F.date_format(dates.rfc822_date(F.col("published_date")), "yyyy-MM")
    items = items.withColumn("month", F.coalesce(month, F.lit("none")))
    known = stored_items(bodies.sparkSession, store)
    if known is not None:  # an item's month follows from its key, so only the batch's months of the store are read
        months = materialise(items.select("month").distinct(), "months")
        known = known.join(months, "month", "left_semi").where(F.col("batch") != batch)
        items = items.join(known.select(*KEY), KEY, "left_anti")
    items.write.mode("overwrite").partitionBy("month").parquet(f"{store}/batch={batch}")


def poll(spark: SparkSession, incoming: str, store: str, state: str) -> None:
    """One polling run over a folder of feed documents (source, body)."""
    stream = spark.readStream.schema(BODIES).parquet(incoming)
    run = stream.writeStream.foreachBatch(lambda df, i: _append(df, i, store)).option("checkpointLocation", state)
    run.trigger(availableNow=True).start().awaitTermination()
