"""Readers, sinks, stored runs and feed polling."""

import os

import pytest

from parcelflow.session import fresh_path, materialise, scratch, work_dir
from parcelflow.sources import readers, sinks
from parcelflow.streaming import feed


def body(*items):
    inner = "".join(f"<item><title> {t} </title><pubDate>{d}</pubDate></item>" for t, d in items)
    return f"<rss><channel>{inner}</channel></rss>"


def test_feed_polling_takes_each_item_once(spark):
    incoming, store, state = (fresh_path(spark, n) for n in ("incoming", "store", "state"))
    day = "Mon, 01 Jan 2024 10:00:00 GMT"

    def arrive(*docs):
        spark.createDataFrame([("s", d) for d in docs], feed.BODIES).write.mode("append").parquet(incoming)
        feed.poll(spark, incoming, store, state)
        return sorted(r["title"] for r in feed.stored_items(spark, store).collect())

    assert arrive(body(("a", day), ("b", day)), body(("a", day))) == ["a", "b"]
    assert arrive(body(("b", day), ("c", day))) == ["a", "b", "c"]


def test_csv_round_trip(spark):
    path = fresh_path(spark, "csv")
    rows = [(1, 'says "x", y', 1.5), (2, "two\nlines", None), (3, None, -2.0)]
    df = spark.createDataFrame(rows, "i int, t string, v double")
    sinks.write_csv(df, path)
    assert sorted(tuple(r) for r in readers.read_csv(spark, path, "i int, t string, v double", multi_line=True).collect()) == rows


def test_unfinished_runs_are_not_read(spark):
    root = fresh_path(spark, "runs")
    df = spark.createDataFrame([(1,)], "i int")
    assert readers.latest_run(spark, root, "i int") is None
    sinks.write_run(df, root, "1")
    df.selectExpr("i + 1 AS i").write.parquet(f"{root}/data/run_id=2")
    assert [r["i"] for r in readers.latest_run(spark, root, "i int").collect()] == [1]
    assert readers.with_fallback(spark, [fresh_path(spark, "none")], "i int").count() == 0


def test_earlier_runs_are_never_overwritten(spark):
    root = fresh_path(spark, "runs")
    df = spark.createDataFrame([(1,)], "i int")
    sinks.write_run(df, root, "1")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        sinks.write_run(df, root, "1")


def test_channel_map(spark):
    path = fresh_path(spark, "map")
    spark.createDataFrame([('{"E": {"c": 0.5, "d": -1}}',), ('{"F": {}}',)], "value string").write.text(path)
    assert sorted(tuple(r) for r in readers.read_channel_map(spark, path).collect()) == [("E", "c", 0.5), ("E", "d", -1.0)]


def test_work_folder_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert work_dir(spark).startswith(named.rstrip("/"))
    df = materialise(spark.range(3).toDF("i"))
    assert df.count() == 3 and df.inputFiles()[0].startswith("file:" if work_dir(spark).startswith("/") else "")


def test_news_items_do_not_depend_on_arrival(spark):
    data = [("t", "d1", f"link{i}") for i in range(30)] + [("u", "d2", None)]
    df = spark.createDataFrame(data, "title string, published_date string, link string")
    kept = {tuple(r) for n in (1, 7) for r in readers.news_items(df.repartition(n)).select("title", "link").collect()}
    assert kept == {("t", "link0"), ("u", None)}


def test_one_temporary_folder_per_application(spark, monkeypatch):
    if not spark.conf.get("spark.checkpoint.dir", None):
        assert work_dir(spark) == work_dir(spark) and os.path.isdir(os.path.dirname(work_dir(spark)))


def test_scratch_tables_are_deleted(spark):
    with scratch(spark):
        path = materialise(spark.range(5).toDF("i")).inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)
    with pytest.raises(ValueError), scratch(spark):
        path = materialise(spark.range(5).toDF("i")).inputFiles()[0].removeprefix("file://")
        raise ValueError
    assert not os.path.exists(path)


def test_a_cluster_must_name_a_shared_folder():
    class Context:
        master, applicationId = "local-cluster[2,1,1024]", "x"

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        work_dir(Session())
