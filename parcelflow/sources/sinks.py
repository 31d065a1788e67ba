"""Writers. Nothing is moved or renamed by the driver: earlier outputs stay as runs of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    """One table, optionally laid out by partition columns so that readers prune on them."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, escape='"', timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").csv(path)


def write_run(df: DataFrame, root: str, run_id: str) -> None:
    """Store a run next to the earlier ones, then record it as finished; readers see only recorded runs."""
    df.write.mode("errorifexists").parquet(f"{root}/data/run_id={run_id}")
    done = df.sparkSession.range(1).select(F.lit(run_id).alias("run_id"), F.lit(True).alias("finished"))
    done.write.mode("append").parquet(f"{root}/runs")


def write_json_records(df: DataFrame, path: str, order: list[Column], n: int) -> None:
    """The first n rows as JSON records with ISO dates, for a report."""
    df.orderBy(*order).limit(n).write.mode("overwrite").json(path)
