"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_work_dirs: dict[str, str] = {}


def local_session(app: str = "parcelflow", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks. A cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the session names in spark.checkpoint.dir.

    Only a local master may do without it, since driver and tasks share one machine there: it gets one temporary folder
    per application, removed when Python ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/parcelflow"
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _work_dirs:
        _work_dirs[app] = tempfile.mkdtemp(prefix="parcelflow-")
        atexit.register(shutil.rmtree, _work_dirs[app], ignore_errors=True)
    return f"{_work_dirs[app]}/parcelflow"


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for made in _open_scopes:
        made.append(path)
    return path


_open_scopes: list[list[str]] = []
observers: list[Callable[[DataFrame, str], None]] = []  # called with every table before it is stored


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end, also after a failure. What is still needed must be written elsewhere before."""
    made: list[str] = []
    _open_scopes.append(made)
    try:
        yield
    finally:
        _open_scopes.remove(made)
        drop(spark, made)


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables through Hadoop's file system, whatever store they lie in."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Have the driver collect its garbage now, so that the shuffle files of finished jobs are freed before the next stage writes its own.

    For jobs of several stages that each move about as much as the input; nothing that is still in use is touched.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that df reads, by the planner's statistics of its leaves."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 62)  # leaves without statistics carry a placeholder above this


def materialise(df: DataFrame, label: str = "table", made: list[str] | None = None) -> DataFrame:
    """Write df to the work folder and read it back. made gets the path, for whoever drops the table when nothing reads it any more.

    Used for tables that are reused or joined back to facts: the lineage is cut, lost executors cost nothing but the
    task at hand, and the planner sees the true size on disk, so it broadcasts the table only below
    spark.sql.autoBroadcastJoinThreshold and shuffles (with skew splitting) above it.
    """
    path = fresh_path(df.sparkSession, label)
    if made is not None:
        made.append(path)
    for seen in observers:
        seen(df, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
