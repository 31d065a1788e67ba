"""Tables stored by a join key, so that a join that is run again and again shuffles neither side.

Both sides are written once in the same number of buckets of (key, salt). Keys that hold too many of the facts' rows are
spread over several salts there, and the other side carries a copy for each. A later join reads bucket by bucket.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.operators import joins
from parcelflow.session import fresh_path, input_bytes, materialise

BUCKET_BYTES = 128 << 20
HOT_ROWS = 5_000_000  # rows of a key above which it is spread
SALTS = 32
SALT = "_salt"


@dataclass(frozen=True)
class Keyed:
    """A stored table: its name in the session's catalog, where it lies, and how it is dealt."""

    name: str
    path: str
    schema: str
    key: str
    buckets: int


def hot_keys(facts: DataFrame, key: str, most_rows: int = HOT_ROWS) -> DataFrame:
    """(key) of the values that more than most_rows rows hold, stored. There are rows / most_rows of them at most."""
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return materialise(counts.where(F.col("_n") > most_rows).select(key), "hot-keys")


def _write(df: DataFrame, key: str, buckets: int) -> Keyed:
    spark, path, name = df.sparkSession, fresh_path(df.sparkSession, "keyed"), f"keyed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key, SALT)  # as the buckets are dealt, so each is one file
    dealt.write.format("parquet").bucketBy(buckets, key, SALT).sortBy(key, SALT).option("path", path).saveAsTable(name)
    return Keyed(name, path, df.schema.simpleString(), key, buckets)


def store_sides(
    facts: DataFrame, dim: DataFrame, key: str, buckets: int | None = None, most_rows: int = HOT_ROWS, salts: int = SALTS,
) -> tuple[Keyed, Keyed]:
    """Both sides of a left join on key, stored to be joined without a shuffle. Rows of hot keys and of none are spread over the salts."""
    hot = hot_keys(facts, key, most_rows).withColumn("_hot", F.lit(True))
    n = buckets or max(1, -(-input_bytes(facts) // BUCKET_BYTES))
    marked = facts.join(hot, key, "left")
    spread = F.floor(F.rand(7) * salts).cast("int")  # any salt will do, since the other side has them all
    left = marked.withColumn(SALT, F.when(F.col("_hot") | F.col(key).isNull(), spread).otherwise(0)).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = dim.where(F.col(key).isNotNull()).join(hot, key, "left").withColumn(SALT, F.explode(copies)).drop("_hot")
    return _write(left, key, n), _write(right, key, n)


def register(spark: SparkSession, stored: Keyed) -> Keyed:
    """Make a table of an earlier application known to this one under a name of its own."""
    name = f"keyed_{uuid.uuid4().hex}"
    columns = stored.schema.removeprefix("struct<").removesuffix(">")
    ddl = spark.createDataFrame([], columns).schema.toDDL()
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet CLUSTERED BY (`{stored.key}`, {SALT}) SORTED BY (`{stored.key}`, {SALT}) INTO {stored.buckets} BUCKETS LOCATION '{stored.path}'")
    return Keyed(name, stored.path, stored.schema, stored.key, stored.buckets)


def merge_stored(spark: SparkSession, facts: Keyed, dim: Keyed) -> DataFrame:
    """Left join of the stored sides as joins.merge does it; neither side is shuffled."""
    return joins.merge(spark.table(facts.name), spark.table(dim.name), [facts.key, SALT], "left").drop(SALT)
