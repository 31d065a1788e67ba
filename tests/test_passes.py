"""Queries read a join or a panel that several steps need once, and rank no more rows than they must."""

import os

import pytest
from pyspark.sql import functions as F

from parcelflow import fixed_values as fv
from parcelflow import session
from parcelflow.operators import events, joins, outliers, profile
from parcelflow.plans import RUNNERS, forecasts
from parcelflow.sources import bindings

SF = "/root/testdata/sf0.001"


@pytest.fixture
def stored(monkeypatch):
    """(label, number of joins in the plan) of every table that is stored."""
    seen = []
    monkeypatch.setattr(session, "observers", [lambda df, label: seen.append((label, df._jdf.queryExecution().optimizedPlan().toString().count("Join ")))])
    return seen


@pytest.mark.parametrize("name", ["dq_outlier_stages", "dq_outlier_pipeline"])
def test_outlier_queries_join_the_facts_once(spark, stored, name):
    """part, supplier and nation went to the driver, to be broadcast, with each of a dozen passes."""
    scans = []

    def scanned(df, label):
        scans.append((label, df._jdf.queryExecution().optimizedPlan().toString().count("n_nationkey")))

    session.observers.append(scanned)
    RUNNERS[name](spark, SF).collect()
    assert [label for label, n in scans if n] == ["facts"]


def test_request_news_builds_the_panel_once(spark, stored):
    RUNNERS["join_request_news"](spark, SF).collect()
    assert [label for label, _ in stored].count("panel") == 1


def test_month_scores_read_the_events_once(spark, stored):
    rows = spark.createDataFrame([("2024-01-03", "c", 1.0), ("2024-02-03", "d", -2.0), ("2024-02-09", "c", 0.5)], "published_date string, channel string, contribution double")
    rows = rows.withColumn("published_date", F.col("published_date").cast("date")).join(spark.range(1))
    sensitivity = spark.createDataFrame([("A", "c", 1.0), ("A", "d", 0.5)], "area string, channel string, weight double")
    got = events.month_scores(rows, sensitivity)
    assert [n for label, n in stored if label == "sums"] == [1] and [n for label, n in stored if label == "spread"] == [0]
    assert got.count() == 2


def test_trim_all_takes_its_bounds_from_stored_columns(spark, stored):
    """The source is read for its four columns and for the result, and for nothing between."""
    rows = spark.range(600).select(
        F.when(F.col("id") % 2 == 0, "Studio").alias("rooms_en"), (F.col("id") % 97).cast("double").alias("procedure_area"),
        F.concat(F.lit("A"), (F.col("id") % 3).cast("string")).alias("area_name_en"), (F.col("id") * 7 % 101).cast("double").alias("meter_sale_price"), "id")
    rows = rows.join(spark.range(600).withColumn("wide", F.lit("x")), "id")
    want = outliers.trim_by_group(outliers.trim_area_by_rooms(rows)).collect()
    stored.clear()
    got = outliers.trim_all(rows).collect()
    assert sorted(got) == sorted(want) and 0 < len(got) < 300
    assert [label for label, _ in stored] == ["trim-columns", "bounds", "bounds"] and max(n for label, n in stored if label == "bounds") < 2


def test_training_stores_each_join_of_the_facts_and_drops_what_was_read(spark, stored):
    """The joins with projects, link keys and parts were one job, so the shuffles of all of them lay on the disks at once."""
    folder = session.work_dir(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    assert RUNNERS["stage_training"](spark, SF).count() > 0
    joins_of = dict(stored)
    assert joins_of["matched"] == 1 and joins_of["linked"] == 2 and [label for label, _ in stored].index("micro") < [label for label, _ in stored].index("matched")
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert "linked" in left and not left & {"trim-columns", "trimmed", "matched"}


def test_latest_rows_rank_only_the_last_day(spark, stored):
    order = {c: F.lit(0) for c in bindings.TXN_ORDER if c not in ("instance_date", "l_orderkey")}
    data = [("A", "2024-01-01", 1), ("A", "2024-03-01", 5), ("A", "2024-03-01", 4), ("A", None, 0), ("B", None, 3), ("B", None, 2), (None, "2023-01-01", 9), (None, "2024-01-01", 8)]
    hist = spark.createDataFrame(data, "area_name_en string, d string, l_orderkey int").withColumns({"instance_date": F.col("d").cast("date"), **order})
    plain = joins.keep_one(hist, ["area_name_en"], [F.desc("instance_date"), *(F.col(c) for c in bindings.TXN_ORDER)])
    key = lambda r: (r["area_name_en"] or "", r["l_orderkey"])
    got = sorted(map(key, forecasts.latest_rows(hist).collect()))
    assert got == sorted(map(key, plain.collect())) == [("", 8), ("A", 4), ("B", 2)]
    assert [label for label, _ in stored] == ["last-days"]


def test_reports_are_formatted_once_per_profile(spark, monkeypatch):
    """Lists of months were put together for every request, though many requests share a profile; values were listed from a row per fact and field."""
    seen = {}

    def plan(df, label):
        seen[label] = df._jdf.queryExecution().optimizedPlan().toString()

    monkeypatch.setattr(session, "observers", [plan])
    out = RUNNERS["req_forecast_report"](spark, SF)
    assert "array_join" in seen["answers"] and "array_join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert "distinct-values-" in seen["ranges"] or "Expand" not in seen["distinct-values"]


def test_groups_copy_counts_not_facts(spark, stored):
    """Counts of areas and of groups are those of the history with its group copies; the facts were joined with the group names."""
    group, members = next((g, [m for n, m in fv.AREA_GROUPS if n.lower() == g.lower()]) for _, g in fv.AREA_STAND_INS if any(n.lower() == g.lower() for n, _ in fv.AREA_GROUPS))
    data = [(a, " x " if i % 2 else "x", f"2024-0{1 + i % 3}-09", float(i % 4) if i % 5 else None) for i in range(60) for a in (members[i % len(members)], "Z", None)] + [(group, None, "2024-01-02", 1.0)]
    hist = spark.createDataFrame(data, "area_name_en string, c string, d string, p double").withColumn("d", F.col("d").cast("date"))
    want = profile.price_counts(profile.group_history(hist), ["c"], date="d", price="p")
    got = profile.group_counts(profile.price_counts(hist, ["c"], date="d", price="p"), ["c"])
    key = lambda r: tuple(map(str, (r[c] for c in want.columns)))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect())) and group in {r["area_name_en"] for r in got.collect()}
    RUNNERS["req_forecast_report"](spark, SF)
    labels = dict(stored)
    assert labels["area-counts"] == 0 and "price-counts" in labels
