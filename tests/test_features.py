"""Stored layouts, ordered target statistics, drift, sketches, rejects, observed counts and the panel regression on small tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.operators import drift, encode, events, forecast, layout, outliers, quantiles, sketches
from parcelflow.sources import readers

FEED = "<rss><channel><title>f</title>{}</channel></rss>"
ITEM = "<item><title>{}</title><description>d</description></item>"


# --- stored layout ------------------------------------------------------------------------------------------------


def sides(spark):
    facts = [(i, "hot" if i % 3 else ("k%d" % (i % 50) if i % 7 else None)) for i in range(3000)]
    dim = [("hot", "H", 1)] + [("k%d" % i, "D%d" % i, i) for i in range(40)] + [("alone", "A", 0), (None, "N", 0)]
    return spark.createDataFrame(facts, "i int, key string"), spark.createDataFrame(dim, "key string, d string, x int")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip() for line in plan.split("\n") if "Exchange" in line and "Broadcast" not in line]


def test_stored_sides_join_without_a_shuffle(spark):
    facts, dim = sides(spark)
    left, right = layout.store_sides(facts, dim, "key", buckets=4, most_rows=100, salts=5)
    want = sorted(map(str, facts.join(dim, "key", "left").select("i", "key", "d", "x").collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = layout.merge_stored(spark, left, right)
        assert exchanges(joined) == []
        assert sorted(map(str, joined.select("i", "key", "d", "x").collect())) == want
        assert exchanges(joined) == []
        assert exchanges(spark.table(left.name).drop("_salt").join(dim, "key", "left")) != []
        again = layout.merge_stored(spark, layout.register(spark, left), layout.register(spark, right))
        assert exchanges(again) == [] and sorted(map(str, again.select("i", "key", "d", "x").collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_keys_are_spread_over_the_salts(spark):
    facts, dim = sides(spark)
    left, right = layout.store_sides(facts, dim, "key", buckets=4, most_rows=100, salts=5)
    held = {(r["key"], r["_salt"]): r["count"] for r in spark.table(left.name).groupBy("key", "_salt").count().collect()}
    for key in ("hot", None):
        sizes = [n for (k, _), n in held.items() if k == key]
        assert len(sizes) == 5 and max(sizes) < 1.5 * sum(sizes) / 5
    assert all(salt == 0 for key, salt in held if key not in ("hot", None))
    assert spark.table(right.name).where("key = 'hot'").count() == 5 and spark.table(right.name).where("key = 'k1'").count() == 1
    assert [r["key"] for r in layout.hot_keys(facts, "key", 100).collect()] == ["hot"]


def test_empty_sides(spark):
    facts, dim = sides(spark)
    left, right = layout.store_sides(facts.limit(0), dim.limit(0), "key", buckets=2)
    assert layout.merge_stored(spark, left, right).collect() == []


# --- ordered target statistics ------------------------------------------------------------------------------------


@pytest.mark.parametrize("n_blocks", [1, 3, 16])
def test_ordered_target_equals_a_plain_pass(spark, n_blocks):
    draw = random.Random(1)
    rows = [(i, draw.choice(["a", "b", "c", None]), draw.choice(["x", "y"]), draw.choice([None, draw.uniform(0, 9)])) for i in range(300)]
    shuffled = rows[:]
    draw.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "i int, p string, q string, y double")
    got = {r["i"]: r for r in encode.ordered_target(df, ["p", "q"], "y", ["i"], prior=4.0, weight=2.0, blocks=n_blocks).collect()}
    seen = {}
    for i, p, q, y in rows:
        for name, value in (("p", p), ("q", q)):
            s, k = seen.get((name, value), (0.0, 0))
            assert math.isclose(got[i][f"{name}_ts"], (s + 8.0) / (k + 2.0), rel_tol=1e-12)
            if y is not None:
                seen[name, value] = (s + y, k + 1)
    means = encode.target_means(df, ["p", "q"], "y", prior=4.0, weight=2.0)
    assert {(r["column"], r["category"]): round(r["value"], 9) for r in means.collect()} == {k: round((s + 8.0) / (n + 2.0), 9) for k, (s, n) in seen.items()}
    new = encode.with_target_means(spark.createDataFrame([("a", "never"), (None, "x")], "p string, q string"), means, ["p", "q"], 4.0).collect()
    assert new[0]["q_ts"] in (4.0, new[1]["q_ts"]) and len(new) == 2


def test_own_and_later_targets_do_not_count(spark):
    rows = [(i, "ab"[i % 2], float(i)) for i in range(40)]
    plain = encode.ordered_target(spark.createDataFrame(rows, "i int, c string, y double"), ["c"], "y", ["i"], 0.0)
    spoiled = encode.ordered_target(spark.createDataFrame([(i, c, y if i < 20 else 1e9) for i, c, y in rows], "i int, c string, y double"), ["c"], "y", ["i"], 0.0)
    first = lambda df: [r["c_ts"] for r in df.where("i <= 20").orderBy("i").collect()]
    assert first(plain) == first(spoiled)


# --- drift --------------------------------------------------------------------------------------------------------


def test_stability_equals_numpy(spark):
    draw = np.random.default_rng(4)
    before, same, moved = draw.normal(0, 1, 2000), draw.normal(0, 1, 500), draw.normal(1.5, 1, 500)
    ref = spark.createDataFrame([(float(v),) for v in before], "v double")
    rows = [("same", float(v)) for v in same] + [("moved", float(v)) for v in moved] + [("moved", None)] * 20 + [("gone", None)]
    got = {r["period"]: r for r in drift.stability(ref, spark.createDataFrame(rows, "month string, v double"), ["v"], F.col("month")).collect()}
    edges = np.quantile(before, [k / 10 for k in range(1, 10)])

    def psi(values, nulls):
        counts = lambda x, k: np.append(np.bincount(np.searchsorted(edges, x, "left"), minlength=10), k)
        p, q = counts(before, 0) + 0.5, counts(values, nulls) + 0.5
        p, q = p / p.sum(), q / q.sum()
        return float(((q - p) * np.log(q / p)).sum())

    assert math.isclose(got["same"]["psi"], psi(same, 0), rel_tol=1e-9) and got["same"]["psi"] < 0.1
    assert math.isclose(got["moved"]["psi"], psi(moved, 20), rel_tol=1e-9) and got["moved"]["psi"] > 0.25
    assert math.isclose(got["gone"]["psi"], psi(np.array([]), 1), rel_tol=1e-9) and got["gone"]["rows"] == 1


def test_stability_of_constant_and_empty_columns(spark):
    ref = spark.createDataFrame([(1.0, None)] * 50, "v double, w double")
    cur = spark.createDataFrame([("m", 1.0, 3.0)] * 50, "month string, v double, w double")
    got = {r["column"]: r["psi"] for r in drift.stability(ref, cur, ["v", "w"], F.col("month")).collect()}
    assert abs(got["v"]) < 1e-12 and got["w"] > 1
    assert drift.stability(ref, cur.limit(0), ["v"], F.col("month")).collect() == []


# --- sketches -----------------------------------------------------------------------------------------------------


def test_sketch_ranks_lie_within_the_bound_after_rolling_up(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("month"), (F.col("id") % 2).alias("area"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("v"))
    stored = sketches.quantile_sketches(df.unionByName(df.limit(5).withColumn("v", F.lit(None).cast("double"))), ["area", "month"], "v", 200)
    assert stored.count() == 30
    for r in sketches.rolled_up_quantiles(stored, ["area"], {"a": 0.05, "b": 0.5, "c": 0.95}, 200).collect():
        own = np.sort([x["v"] for x in df.where(F.col("area") == r["area"]).collect()])
        assert r["n"] == len(own) == 30_000
        for name, p in (("a", 0.05), ("b", 0.5), ("c", 0.95)):
            assert abs(np.searchsorted(own, r[name], "right") / len(own) - p) <= 3 * sketches.rank_error(200)
    assert 0.013 < sketches.rank_error(200) < 0.0135


def test_distinct_sketches_merge(spark):
    df = spark.range(40_000).select((F.col("id") % 12).alias("month"), (F.col("id") % 9000).alias("p"), F.when(F.col("id") % 2 == 0, F.col("id") % 7).alias("q"))
    stored = sketches.distinct_sketches(df, ["month"], ["p", "q"])
    whole = sketches.rolled_up_distinct(stored, [], ["p", "q"]).first()
    assert abs(whole["p"] - 9000) <= sketches.distinct_error() * 9000 and whole["q"] == 7
    half = sketches.rolled_up_distinct(stored.where("month < 6"), [], ["p"]).first()["p"]
    true = df.where("month < 6").select("p").distinct().count()
    assert abs(half - true) <= sketches.distinct_error() * true


# --- rejects ------------------------------------------------------------------------------------------------------


def test_every_feed_document_is_read_or_rejected(spark):
    good = FEED.format(ITEM.format("a") + ITEM.format("b"))
    bodies = [("s", good), ("s", good[:-20]), ("s", None), ("s", " "), ("s", "hello"), ("t", FEED.format("")), ("t", "<rss></rss>"), ("t", FEED.format(ITEM.format("x & y")))]
    documents = readers.feed_documents(spark.createDataFrame(bodies, "source string, body string"), "body", "source")
    rejects = [(r["source"], r["reason"]) for r in readers.feed_rejects(documents).collect()]
    assert sorted(rejects) == [("s", "empty"), ("s", "malformed"), ("s", "malformed"), ("s", "missing"), ("t", "malformed"), ("t", "no channel")]
    assert {r["body"] for r in readers.feed_rejects(documents).collect()} < {b for _, b in bodies}
    counts = readers.feed_counts(documents).collect()
    assert sum(r["documents"] for r in counts) == len(bodies)
    assert sum(r["items"] for r in counts) == readers.items_of(documents).count() == 2


def test_a_feed_document_is_parsed_once(spark, tmp_path):
    """The parser stood in the plan five times: for the items and for each term of the filters pushed below it."""
    many = "<rss><channel><item><title>Oman</title></item><item/><item><title>b</title><description>x</description></item></channel></rss>"
    bodies = [("s", many), ("s", "<rss><channel/></rss>"), ("s", "<rss"), ("s", None), (None, "<rss><channel><item><title>c</title></item></channel></rss>")]
    spark.createDataFrame(bodies, "source string, body string").write.parquet(str(tmp_path / "b"))
    items = readers.feed_items(spark.read.parquet(str(tmp_path / "b")), "body", "source")
    assert sorted((r["source"] or "", r["title"], r["snippet"], r["region"]) for r in items.collect()) == [
        ("", "c", "", "Global"), ("s", "", "", "Global"), ("s", "Oman", "", "GCC"), ("s", "b", "x", "Global")]
    assert items._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 1


def test_every_event_document_is_read_or_rejected(spark):
    docs = [(1, '{"has_relevant_event": true, "events": []}'), (2, '{"has_relevant_event": true, "events": ['), (3, None), (4, " "), (5, '{"has_relevant_event": false}'), (6, "text")]
    df = spark.createDataFrame(docs, "article_id int, doc string").withColumns({"d": F.lit("2024-01-01"), "t": F.lit("title")})
    parsed = {r["article_id"] for r in events.parse_documents(df, "doc", "article_id", "d", "t").collect()}
    rejects = {(r["article_id"], r["reason"]) for r in events.document_rejects(df, "doc", "article_id").collect()}
    assert parsed == {"1"} and rejects == {("2", "malformed"), ("3", "missing"), ("4", "empty"), ("6", "malformed")}


# --- counts inside the write --------------------------------------------------------------------------------------


def facts(spark, n=900):
    draw = random.Random(2)
    rows = [(draw.choice(["Studio", "1 B/R", None]), draw.uniform(10, 300), draw.choice(["A", "B"]), draw.choice([None, draw.uniform(1, 1000)])) for _ in range(n)]
    return spark.createDataFrame(rows, "rooms_en string, procedure_area double, area_name_en string, meter_sale_price double")


def test_observed_counts_equal_counts(spark):
    df = facts(spark)
    trimmed, counts = outliers.trim_counted(df)
    roomed = outliers.trim_area_by_rooms(df)
    n = counts.first()
    assert (n["rows_before"], n["rows_after_rooms"], n["rows_after_groups"]) == (900, roomed.count(), outliers.trim_by_group(roomed).count())
    assert n["removed_by_rooms"] == 900 - roomed.count() and trimmed.count() == n["rows_after_groups"]
    assert sorted(map(str, trimmed.collect())) == sorted(map(str, outliers.trim_all(df).collect()))
    none = outliers.trim_counted(df.limit(0))[1].first()
    assert none["rows_before"] == none["removed_by_groups"] == 0
    roomless = outliers.trim_counted(df.withColumn("rooms_en", F.lit(None).cast("string")))[1].first()
    assert (roomless["rows_before"], roomless["rows_after_rooms"], roomless["removed_by_rooms"]) == (900, 0, 900)


def test_one_table_is_stored_for_the_counts(spark):
    from parcelflow import session

    made = []
    session.observers.append(lambda df, label: made.append(label))
    try:
        outliers.trim_counted(facts(spark))
    finally:
        session.observers.pop()
    assert made == ["bounds", "bounds", "trimmed"]


# --- quantiles ----------------------------------------------------------------------------------------------------


def test_small_groups_store_nothing_and_take_one_pass(spark):
    from parcelflow import session

    made = []
    session.observers.append(lambda df, label: made.append(label))
    try:
        out = quantiles.group_quantiles(facts(spark), ["area_name_en"], {"m": ("meter_sale_price", 0.5), "p": ("procedure_area", 0.1)}, [F.count("*").alias("rows")], None, {"k": "meter_sale_price"})
        rows = out.collect()
    finally:
        session.observers.pop()
    assert made == [] and out.columns == ["area_name_en", "m", "p", "k", "rows"] and sum(r["rows"] for r in rows) == 900
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Generate" not in plan and plan.count("Scan") == 1


@pytest.mark.parametrize("limit", [None, 0, 450])
def test_both_paths_give_the_same(spark, limit):
    df = facts(spark).unionByName(facts(spark, 5).withColumn("area_name_en", F.lit(None).cast("string"))).unionByName(facts(spark, 3).withColumns({"area_name_en": F.lit("C"), "meter_sale_price": F.lit(None).cast("double")}))
    specs = {"m": ("meter_sale_price", 0.5), "lo": ("meter_sale_price", 0.013), "p": ("procedure_area", 0.9)}
    got = {r["area_name_en"]: r for r in quantiles.group_quantiles(df, ["area_name_en"], specs, [F.max("procedure_area").alias("top")], limit, {"k": "meter_sale_price"}).collect()}
    data = df.where("area_name_en is not null").toPandas()
    for area, own in data.groupby("area_name_en"):
        y = own["meter_sale_price"].dropna()
        assert got[area]["k"] == len(y) and got[area]["top"] == own["procedure_area"].max()
        assert math.isclose(got[area]["p"], np.quantile(own["procedure_area"], 0.9), rel_tol=1e-12)
        for name, p in (("m", 0.5), ("lo", 0.013)):
            assert got[area][name] is None if not len(y) else math.isclose(got[area][name], np.quantile(y, p), rel_tol=1e-12)
    assert set(got) == {"A", "B", "C"}


# --- regression over all series -----------------------------------------------------------------------------------


def series(spark, n=40, extra=0.0):
    draw, rows = random.Random(3), []
    for a in range(4):
        price, share, r = 1000.0 + a, 0.5, 0.0
        for m in range(n):
            rows.append((f"S{a}", f"{2018 + m // 12}-{1 + m % 12:02d}-01", price * math.exp(extra * (m >= n - 6)), share))
            r = 0.4 * r + 0.2 * (share - 0.5) + draw.gauss(0, 1e-4)
            price, share = price * math.exp(r), draw.uniform(0, 1)
    return spark.createDataFrame(rows, "area string, month string, price double, share double").withColumn("month", F.col("month").cast("date"))


def test_panel_regression_finds_lags_and_covariates(spark):
    method = forecast.panel_regression(["share"], lags=1, ridge=0.0)
    got = {(r["area"], str(r["month"])): r["prediction"] for r in method(series(spark), "area", "month", "price", 3).collect()}
    assert len(got) == 12
    data = series(spark).orderBy("area", "month").toPandas()
    data["r"] = np.log(data["price"]).groupby(data["area"]).diff()
    data["f1"], data["f2"] = data.groupby("area")["r"].shift(), data.groupby("area")["share"].shift()
    fit = data.dropna()
    b = np.linalg.lstsq(np.column_stack([np.ones(len(fit)), fit["f1"], fit["f2"]]), fit["r"], rcond=None)[0]
    assert abs(b[1] - 0.4) < 0.05 and abs(b[2] - 0.2) < 0.01
    for area, own in data.groupby("area"):
        lp, r, x = math.log(own["price"].iloc[-1]), own["r"].iloc[-1], own["share"].iloc[-1]
        for month in ("2021-05-01", "2021-06-01", "2021-07-01"):
            r = b[0] + b[1] * r + b[2] * x
            lp += r
            assert math.isclose(got[area, month], math.exp(lp), rel_tol=1e-9)


def test_backtest_sees_nothing_beyond_the_cutoff(spark):
    method = forecast.panel_regression(["share"], lags=2)
    cut = lambda df: method(df.where("month <= date'2020-10-01'"), "area", "month", "price", 6)
    assert sorted(map(str, cut(series(spark)).collect())) == sorted(map(str, cut(series(spark, extra=5.0)).collect()))
    errors = forecast.backtest(series(spark), "area", "month", "price", 6, method).collect()
    assert len(errors) == 4 and all(r["n"] == 6 and r["mape"] < 0.5 for r in errors)
    moved = forecast.backtest(series(spark, extra=5.0), "area", "month", "price", 6, method).collect()
    assert all(r["mape"] > 0.9 for r in moved)


def test_short_series_keep_their_price(spark):
    few = spark.createDataFrame([("A", "2024-01-01", 7.0), ("B", "2024-01-01", 5.0), ("B", "2024-02-01", None)], "area string, month string, price double").withColumn("month", F.col("month").cast("date"))
    got = forecast.FORECASTERS["panel_regression"](few, "area", "month", "price", 2).collect()
    assert sorted((r["area"], str(r["month"]), round(r["prediction"], 9)) for r in got) == [("A", "2024-02-01", 7.0), ("A", "2024-03-01", 7.0), ("B", "2024-02-01", 5.0), ("B", "2024-03-01", 5.0)]
