"""Named queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]

RUNNERS: dict[str, Runner] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register the decorated (spark, sf_dir) -> DataFrame function under name.

    ctes holds comma-separated common table expressions that sql may use.
    """

    def wrap(fn: Runner) -> Runner:
        if name in RUNNERS:
            raise ValueError(f"query {name} is registered twice")
        RUNNERS[name] = fn
        if sql is not None:
            ORACLES[name] = f"WITH {ctes.strip().rstrip(',')}\n{sql.strip()}" if ctes else sql.strip()
        return fn

    return wrap
