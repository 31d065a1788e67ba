"""Operators on small tables: edges, invariants and agreement of the large-group paths with the plain ones."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from parcelflow.operators import blocks, events, filters, forecast, impute, joins, outliers, panel, profile, stages
from parcelflow.operators.quantiles import column_quantiles, group_quantiles


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def skewed(spark, n=4000, seed=1):
    """A third of the rows in one group, many ties, one group of equal values, one tiny group."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if i % 3 == 0 else f"g{r.randint(0, 4)}"
        v = None if r.random() < 0.02 else round(r.lognormvariate(3, 2), r.choice([0, 2, 6]))
        out.append((k, float(v) if v is not None else None, r.random()))
    out += [("same", 5.0, 0.1)] * 500 + [("one", 9.0, 0.2), ("empty", None, 0.3)] + [("two", float(i % 2), 0.5) for i in range(700)]
    return spark.createDataFrame(out, "k string, v double, w double").repartition(5)


SPECS = {"lo": ("v", 0.01), "mid": ("v", 0.5), "hi": ("v", 0.99), "wmid": ("w", 0.25)}


def test_selection_equals_percentile(spark):
    df = skewed(spark)
    plain = rows(group_quantiles(df, ["k"], SPECS, [F.count("*").alias("n")]), "k")
    small = rows(group_quantiles(df, ["k"], SPECS, [F.count("*").alias("n")], max_group_rows=40).select("k", "n", *SPECS), "k")
    names = group_quantiles(df, ["k"], SPECS, [F.count("*").alias("n")]).columns
    plain = [tuple(r[names.index(c)] for c in ("k", "n", *SPECS)) for r in plain]
    for a, b in zip(plain, small, strict=True):
        assert a[:2] == b[:2]
        for x, y in zip(a[2:], b[2:], strict=True):
            assert x == (None if y is None else pytest.approx(y, rel=1e-12))


def test_one_value_that_fills_a_group_takes_no_more_steps(spark):
    """90 % zeros and 10,000 distinct others: the number of stored tables does not depend on the data."""
    r = random.Random(5)
    data = [("a", 0.0)] * 90_000 + [("a", r.random() * 1e6) for _ in range(10_000)] + [("b", float(i)) for i in range(3_000)]
    df = spark.createDataFrame(data, "k string, v double").repartition(7)
    specs = {"lo": ("v", 0.01), "mid": ("v", 0.5), "p95": ("v", 0.95), "hi": ("v", 0.9999)}
    want = rows(group_quantiles(df, ["k"], specs), "k")
    stored = []
    from parcelflow.operators import quantiles

    plain = quantiles.materialise
    quantiles.materialise = lambda d, label="table": stored.append(label) or plain(d, label)
    try:
        got = rows(group_quantiles(df, ["k"], specs, max_group_rows=100), "k")
    finally:
        quantiles.materialise = plain
    assert [g[0] for g in got] == [w[0] for w in want] and len(stored) <= 7
    assert [g[1:] for g in got] == [pytest.approx(w[1:], rel=1e-12) for w in want]


def test_selection_over_whole_table(spark):
    df = skewed(spark)
    specs = {"a": ("v", 0.5), "b": ("w", 0.9)}
    assert tuple(column_quantiles(df, specs).first()) == pytest.approx(tuple(column_quantiles(df, specs, max_group_rows=30).first()), rel=1e-12)


def test_trim_small_groups_stay_whole(spark):
    df = spark.createDataFrame([("a", float(x)) for x in [*range(8), 1000]] + [("b", float(x)) for x in [*range(9), 1000]] + [(None, 1.0)] + [("a", None)], "g string, v double")
    kept = outliers.trim_by_group(df, "g", "v")
    counts = dict(rows(kept.groupBy("g").count()))
    assert counts == {"a": 10, "b": 8}


def test_room_minimum(spark):
    data = [("Studio", 24.0), ("Studio", 25.0), ("Studio", 30.0), (None, 50.0)] + [("9 B/R", float(x)) for x in range(100)]
    df = spark.createDataFrame(data, "rooms_en string, procedure_area double")
    kept = rows(outliers.trim_area_by_rooms(df))
    assert ("Studio", 24.0) not in kept and ("Studio", 25.0) in kept and not any(r[0] is None for r in kept)
    assert ("9 B/R", 4.0) not in kept and ("9 B/R", 5.0) in kept and ("9 B/R", 99.0) not in kept


def test_forward_fill_matches_window(spark):
    r = random.Random(3)
    data = [("hot" if r.random() < 0.5 else f"g{i % 3}", i, r.choice([None, float(i)]), r.choice([None, f"t{i}"])) for i in range(600)]
    df = spark.createDataFrame(data, "k string, o int, x double, y string").repartition(7)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", "o", F.last("x", True).over(w), F.last("y", True).over(w))
    for n in (1, 4, 13):
        assert rows(blocks.forward_fill(df, ["k"], ["o"], ["x", "y"], n), "k", "o") == rows(want, "k", "o")


def test_forward_fill_of_rows_without_a_key(spark):
    r = random.Random(4)
    data = [(r.choice([None, "a"]), i, float(i) if i % 9 == 0 else None) for i in range(200)]
    df = spark.createDataFrame(data, "k string, o int, x double").repartition(5)
    one = rows(blocks.forward_fill(df, ["k"], ["o"], ["x"], 1), "o")
    assert rows(blocks.forward_fill(df, ["k"], ["o"], ["x"], 6), "o") == one
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    assert one == rows(df.select("k", "o", F.last("x", True).over(w)), "o")


def test_blocks_follow_the_size_of_the_input(spark, monkeypatch, tmp_path):
    spark.range(100_000).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 20_000)
    assert blocks.ordered_blocks(df, [], ["id"]).select("_block").distinct().count() > 15


def test_seasonal_forecast_has_every_month_ahead(spark):
    known = [("s", date(2020, m, 1), 10.0 * m) for m in (1, 2, 3, 4)]
    df = spark.createDataFrame(known, "k string, m date, p double")
    got = rows(forecast.seasonal_naive(df, "k", "m", "p", 10), "m")
    assert [r[2] for r in got] == [40.0] * 8 + [10.0, 20.0] and got[0][1] == date(2020, 5, 1)
    assert [r[2] for r in rows(forecast.forecast(df, "k", "m", "p", 3, forecast.seasonal_naive), "m")] == [40.0] * 3


def test_only_equally_judged_algorithms_compete(spark):
    metrics = spark.createDataFrame([("s", "a", 6, 0.5), ("s", "b", 2, 0.1), ("t", "a", 6, 0.3), ("t", "b", 6, 0.2)], "k string, algorithm string, n bigint, mape double")
    assert rows(forecast.select_best(metrics, "k").select("k", "algorithm"), "k") == [("s", "a"), ("t", "b")]


def test_grid_search_at_high_latitudes_and_over_the_date_line(spark):
    r = random.Random(8)
    lats, lons = [-89.99, -75.0, -61.0, 0.0, 60.5, 64.9, 78.0, 89.95], [-180.0, -179.98, -0.01, 0.02, 55.0, 179.97, 180.0]
    near = lambda x, s: max(-90.0, min(90.0, x + r.uniform(-s, s)))
    cs = [(f"c{i}{j}", near(a, 0.03), b) for i, a in enumerate(lats) for j, b in enumerate(lons)]
    pts = [(k, near(r.choice(lats), 0.05), ((r.choice(lons) + r.uniform(-0.1, 0.1) + 180) % 360) - 180) for k in range(400)]
    points = spark.createDataFrame(pts, "i int, lat double, lon double")
    for radius in (8.0, 2.0):
        found = joins.nearest_of_many(points, ["i"], "lat", "lon", spark.createDataFrame(cs, "area string, lat double, lon double"), radius)
        got = rows(found.select("i", F.round("distance_km", 6)), "i")
        plain = joins.nearest_centre(points, "lat", "lon", cs, radius)
        assert got == rows(plain.select("i", F.when(F.col("distance_km") <= radius, F.round("distance_km", 6))), "i")
        assert sum(d is not None for _, d in got) > 50


def test_first_known_keeps_the_total_order(spark):
    r = random.Random(6)
    data = [(r.choice(["a", "b", None]), r.choice([None, date(2020, 1, r.randint(1, 4))]), i, r.choice([None, f"v{i}"]), r.choice([None, i])) for i in range(300)]
    df = spark.createDataFrame(data, "k string, d date, i int, t string, n int").repartition(4)
    got = rows(joins.first_known(df, "k", ["t", "n"], ["d", "i"]), "k")
    at = lambda x: (x[1] is not None, x[1] or date.min, x[2])
    want = [(k, *(min((x for x in data if x[0] == k and x[c] is not None), key=at)[c] for c in (3, 4))) for k in ("a", "b")]
    assert got == want


def test_spelling_with_blanks_does_not_double_history(spark):
    hist = spark.createDataFrame([("A", "Studio", 1.0), ("A", "Studio ", 2.0)], "area string, c string, price double").withColumn("d", F.lit("2020-01-05").cast("date"))
    asked = profile.with_profile(spark.createDataFrame([("A", "Studio")], "area string, c string"), ["c"], "area")
    matched = profile.matching_history(asked, profile.price_counts(hist, ["c"], "area", "d", "price"), ["c"], "area")
    assert rows(matched.select("price", "n"), "price") == [(1.0, 1), (2.0, 1)]


def test_counted_prices_give_the_quantiles_of_rows(spark):
    r = random.Random(2)
    data = [(r.choice("ab"), float(r.randint(1, 9))) for _ in range(500)]
    df = spark.createDataFrame(data, "k string, v double")
    counted = df.groupBy("k", "v").count()
    specs = {"lo": ("v", 0.05), "mid": ("v", 0.5)}
    assert rows(group_quantiles(counted, ["k"], specs, weight="count"), "k") == rows(group_quantiles(df, ["k"], specs), "k")


def test_areas_are_found_in_any_letter_case(spark):
    ranges = spark.createDataFrame([("Business Bay", ["x"]), ("Aaa", ["y"])], "area_name_en string, f array<string>")
    latest = spark.createDataFrame([("Business Bay", "z"), ("Other Place", "w")], "area_name_en string, f string")
    asked = spark.createDataFrame([(1, "business bay "), (2, "OTHER place"), (3, "nowhere"), (4, None)], "request_id int, area_name_en string")
    got = rows(profile.resolve_defaults(asked, ranges, latest, {"f": "string"}, literals={"f": "d"}).select("request_id", "area_name_en", "f"), "request_id")
    assert got == [(1, "Business Bay", "x"), (2, "Other Place", "w"), (3, "nowhere", "y"), (4, None, "y")]
    named = spark.createDataFrame([("JABAL ali",)], "a string")
    assert joins.resolve_alias(named, "a", "b").first()["b"] == "G3"


def test_dense_ids(spark):
    df = spark.createDataFrame([(f"n{i % 37:02d}",) for i in range(200)] + [(None,)], "name string")
    assert rows(blocks.dense_ids(df, "name", 6), "id") == [(f"n{i:02d}", i) for i in range(37)]


def test_full_merge_keeps_every_row_once(spark):
    a = spark.createDataFrame([(1, "x", "l"), (2, None, "l"), (None, "n", "l"), (2, "z", "l")], "k int, c string, a string")
    b = spark.createDataFrame([(2, "r", 10), (3, "s", 20), (None, "t", 30)], "k int, c string, b int")
    got = sorted(rows(joins.merge(a, b, ["k"], "full")), key=str)
    assert got == sorted([(1, "x", "l", None), (2, "r", "l", 10), (2, "z", "l", 10), (None, "n", "l", None), (3, "s", None, 20), (None, "t", None, 30)], key=str)
    safe = sorted(rows(joins.merge(a, b, ["k"], "full", null_safe=True)), key=str)
    assert (None, "n", "l", 30) in safe and len(safe) == 5


def test_scorecards_never_multiply_facts(spark):
    facts = spark.createDataFrame([(1, " A "), (2, "B"), (3, None)], "i int, name string")
    card = spark.createDataFrame([("A", "x", "7"), ("A ", "y", "bad"), ("C", "z", "1")], "Name string, Grade string, Score string")
    got = rows(joins.attach_scorecard(facts, card, "name", "Name", ["Grade"], ["Score"]), "i")
    assert got == [(1, " A ", "x", 7.0), (2, "B", "Unknown", 0.0), (3, None, "Unknown", 0.0)]


def test_nearest_centre(spark):
    pts = spark.createDataFrame([(1, 25.1970, 55.2740), (2, 26.5, 56.5), (3, None, 55.0)], "i int, lat double, lon double")
    got = rows(joins.nearest_centre(pts, "lat", "lon").select("i", "nearest_area"), "i")
    assert got == [(1, "Burj Khalifa"), (2, None), (3, None)]


def test_grid_search_equals_all_pairs(spark):
    r = random.Random(5)
    pts = spark.createDataFrame([(i, 24.8 + r.random() * 0.4, 55 + r.random() * 0.5) for i in range(60)], "i int, lat double, lon double")
    cs = [(f"c{i}", 24.8 + r.random() * 0.4, 55 + r.random() * 0.5) for i in range(40)]
    far = joins.nearest_of_many(pts, ["i"], "lat", "lon", spark.createDataFrame(cs, "area string, lat double, lon double"), 5.0)
    plain = joins.nearest_centre(pts, "lat", "lon", cs, 5.0)
    assert rows(far.select("i", "nearest_area"), "i") == rows(plain.select("i", "nearest_area"), "i")


def test_smoothed_share(spark):
    d = date(2024, 1, 5)
    df = spark.createDataFrame([("x", d, "A"), ("x", d, "A"), ("x", d, "B")], "area string, d date, c string")
    got = rows(panel.smoothed_shares(df, "area", "d", ["c"]).select("category", "share"), "category")
    assert got == [("A", pytest.approx(3 / 5)), ("B", pytest.approx(2 / 5))]
    with_null = df.union(spark.createDataFrame([("x", d, None)], df.schema))
    assert rows(panel.smoothed_shares(with_null, "area", "d", ["c"]).select("share"), "category")[0][0] == pytest.approx(3 / 6)


def test_interpolation(spark):
    df = spark.createDataFrame([("s", date(2020, 1, 1), 10.0), ("s", date(2020, 4, 1), 16.0)], "k string, month date, p double")
    full = panel.on_grid(df, "k", "month", "2019-12-01", "2020-06-01")
    assert [r[2] for r in rows(panel.interpolate(full, "k", "month", "p"), "month")] == [10, 10, 12, 14, 16, 16, 16]


def test_rolling_of_one_value(spark):
    df = spark.createDataFrame([("s", 1, 5.0)], "k string, i int, v double")
    got = rows(panel.rolling(df, "v", Window.partitionBy("k").orderBy("i"), "m", "s"))[0]
    assert got[3] == 5.0 and got[4] is None


def series(spark, values, **extra):
    data = [("s", date(2020, i + 1, 1), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "k string, m date, v double")


def test_clamp_last_step(spark):
    df = series(spark, [100.0, 112.0, 120.0, 130.0])
    got = [r[2] for r in rows(panel.clamp_last_step(df, "k", "m", "v", F.lit("2020-02-01").cast("date")), "m")]
    f = 104.25 / 112
    assert got == pytest.approx([100.0, 104.25, 120 * f, 130 * f])
    calm = [r[2] for r in rows(panel.clamp_last_step(series(spark, [100.0, 104.0, 120.0]), "k", "m", "v", F.lit("2020-02-01").cast("date")), "m")]
    assert calm == [100.0, 104.0, 120.0]


def chain(prices, growth):
    """Reference loop for the compound chain."""
    out = [prices[0]]
    for p, g in zip(prices[1:], growth[1:]):
        prev = out[-1]
        out.append(p if g is None and prev != 0 else prev * (1 + (g or 0.0)))
    return out


def test_compound_chain(spark):
    prices, growth = [100.0, 110.0, 90.0, 95.0, 97.0], [None, 0.1, None, -0.05, 0.02]
    data = [("s", date(2020, i + 1, 1), p, g) for i, (p, g) in enumerate(zip(prices, growth))]
    df = spark.createDataFrame(data, "k string, m date, p double, g double")
    got = [r[-1] for r in rows(panel.compound_chain(df, "k", "m", "p", "g", F.lit("2020-01-01").cast("date")), "m")]
    assert got == pytest.approx(chain(prices, growth))


def test_compound_chain_stays_zero(spark):
    data = [("s", date(2020, i + 1, 1), p, g) for i, (p, g) in enumerate([(100.0, None), (90.0, -1.0), (80.0, 0.5), (70.0, None)])]
    df = spark.createDataFrame(data, "k string, m date, p double, g double")
    assert [r[-1] for r in rows(panel.compound_chain(df, "k", "m", "p", "g", F.lit("2020-01-01").cast("date")), "m")] == [100.0, 0.0, 0.0, 0.0]


def test_rebased_growth(spark):
    pivot = F.lit("2020-01-01").cast("date")
    got = rows(panel.rebased(series(spark, [50.0, 60.0, 45.0]), "k", "m", "v", pivot, F.lit(1000.0)), "m")
    assert [r[-1] for r in got] == pytest.approx([1200.0, 900.0])
    late = rows(panel.rebased(series(spark, [None, 60.0, 45.0, None, 50.0]), "k", "m", "v", pivot, F.lit(1000.0)), "m")
    assert [r[-1] for r in late] == pytest.approx([1000.0, 750.0, 0.0, 0.0])


def test_pivot_price_tiers(spark):
    data = [("at", date(2020, 3, 1), 5.0), ("before", date(2020, 1, 1), 4.0), ("before", date(2020, 3, 1), None), ("now", date(2020, 5, 1), 7.0),
            ("fill", date(2020, 4, 1), 8.0), ("none", date(2020, 3, 1), None)]
    df = spark.createDataFrame(data, "k string, m date, p double")
    got = {r[0]: r[1:] for r in rows(panel.pivot_price(df, "k", "m", "p", F.lit("2020-03-01").cast("date"), F.lit("2020-05-01").cast("date")))}
    assert got == {
        "at": (date(2020, 3, 1), 5.0, "pivot"), "before": (date(2020, 1, 1), 4.0, "last_before"), "now": (date(2020, 5, 1), 7.0, "current"),
        "fill": (date(2020, 5, 1), 8.0, "filled"), "none": (None, None, None),
    }


def test_decay_leaves_earlier_months(spark):
    fc = spark.createDataFrame([("1", date(2020, 1, 1), 100.0), ("1", date(2020, 3, 1), 100.0), ("2", date(2020, 3, 1), 100.0)], "area_id string, month date, predictions double")
    shock = spark.createDataFrame([("1", 0.1), ("2", 0.0)], "area_id string, macro_news_factor double")
    event = spark.createDataFrame([("no such code", 0)], "event_code string, rank int")
    got = rows(events.decay_adjust(fc, shock, event, F.lit("2020-02-01").cast("date")), "area_id", "month")
    names = events.decay_adjust(fc, shock, event, F.lit("2020-02-01").cast("date")).columns
    first = dict(zip(names, got[0]))
    assert (first["adjusted_pred"], first["sentiment_decay"], first["price_impact"]) == (100.0, 1.0, 0.0)
    assert dict(zip(names, got[2]))["adjusted_pred"] == 100.0
    assert dict(zip(names, got[1]))["adjusted_pred"] != 100.0


def test_signed_decay_lets_good_news_raise_prices(spark):
    fc = spark.createDataFrame([("1", date(2020, 6, 1), 100.0)], "area_id string, month date, predictions double")
    shock = spark.createDataFrame([("1", 0.001)], "area_id string, macro_news_factor double")
    event = spark.createDataFrame([("REGULATORY_EASING_RE", 6)], "event_code string, rank int")
    at = F.lit("2020-03-01").cast("date")
    down = events.decay_adjust(fc, shock, event, at).first()["adjusted_pred"]
    up = events.decay_adjust(fc, shock, event, at, signed=True).first()["adjusted_pred"]
    assert down < 100.0 < up


def test_dominant_event(spark):
    empty = spark.createDataFrame([], "event_code string")
    assert events.dominant_event(empty).first()["event_code"] == "DEFAULT"
    some = spark.createDataFrame([("SUPPLY_DELAY",), ("unlisted",), ("GEO_RISK_ESCALATION",)], "event_code string")
    assert events.dominant_event(some).first()["event_code"] == "GEO_RISK_ESCALATION"


def test_splits(spark):
    df = spark.createDataFrame([("a", date(2020, 1, 3)), ("a", date(2020, 2, 1)), ("a", date(2020, 2, 9)), ("b", date(2020, 2, 1)), ("b", date(2020, 2, 5))], "k string, d date")
    got = rows(impute.split_last_month(df, "k", "d"), "k", "d")
    assert got == [("a", date(2020, 1, 3), "train"), ("a", date(2020, 2, 1), "test"), ("a", date(2020, 2, 9), "test")]


def test_backtest_sees_only_the_past(spark):
    data = [("s", date(2019 + i // 12, i % 12 + 1, 1), 100.0 * 1.01**i) for i in range(24)] + [("short", date(2020, 12, 1), 1.0)]
    df = spark.createDataFrame(data, "k string, m date, p double")
    got = rows(forecast.backtest(df, "k", "m", "p", 6))
    assert len(got) == 1 and got[0][0] == "s" and got[0][1] == 6
    changed = df.withColumn("p", F.when((F.col("k") == "s") & (F.col("m") > F.lit("2020-06-01").cast("date")), F.col("p") * 3).otherwise(F.col("p")))
    fit = lambda d: rows(forecast.trend(impute.split_backtest(d, "k", "m", 6).where("split = 'train'"), "k", "m", "p", 6), "m")
    assert fit(df) == fit(changed)


def test_custom_forecaster(spark):
    def last_value(pdf):
        return pdf.tail(1).assign(prediction=pdf["p"].iloc[-1])[["k", "m", "prediction"]]

    df = spark.createDataFrame([("s", date(2020, 1, 1), 1.0), ("s", date(2020, 2, 1), 2.0)], "k string, m date, p double")
    assert rows(forecast.custom(last_value)(df, "k", "m", "p")) == [("s", date(2020, 2, 1), 2.0)]


def test_nearest_profile_equals_all_pairs(spark):
    r = random.Random(9)
    vals = [None, "x", "y", "z"]
    cols = ["c1", "c2", "c3", "c4"]
    hist = [("A" if r.random() < 0.7 else "B", *(r.choice(vals) for _ in cols), float(i)) for i in range(60)]
    prof = list({("A" if r.random() < 0.5 else "B", *(r.choice(vals) for _ in cols)) for _ in range(40)})
    h = spark.createDataFrame(hist, "area string, c1 string, c2 string, c3 string, c4 string, price double")
    p = profile.with_profile(spark.createDataFrame(prof, "area string, c1 string, c2 string, c3 string, c4 string"), cols, "area")
    got = {}
    counts = profile.price_counts(h.withColumn("d", F.lit("2020-01-05").cast("date")), cols, "area", "d", "price")
    for row in profile.matching_history(p, counts, cols, "area").select("profile", "price").collect():
        got.setdefault(row["profile"], set()).add(row["price"])
    keys = {tuple(x)[:5]: x["profile"] for x in p.collect()}
    for q in prof:
        score = {x[-1]: sum(w is not None and w != c for w, c in zip(q[1:], x[1:5])) for x in hist if x[0] == q[0]}
        best = min(score.values())
        assert got[keys[q]] == {price for price, s in score.items() if s == best}


def test_min_group_count_keeps_named_groups(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("p",)], "k string")
    assert dict(rows(filters.min_group_count(df, "k", 3, ["p"]).groupBy("k").count())) == {"a": 3, "p": 1}


def test_group_copies_keep_the_originals(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    members = spark.createDataFrame([("g", "a"), ("h", "a")], "group string, member string")
    assert sorted(rows(joins.with_group_copies(df, "k", members))) == [("a", 1), ("b", 2), ("g", 1), ("h", 1)]


def test_string_dates_are_coerced(spark):
    df = spark.createDataFrame([("2020-01-05", " Sales "), ("bad", "Sales"), ("2009-12-31", "Sales"), ("2020-01-06", "Gifts")], "instance_date string, trans_group_en string")
    got = stages.clean_transactions(df)
    assert rows(got.select("instance_date", "trans_group_en", "quarter")) == [(date(2020, 1, 5), "Sales", 1)]


def test_stand_ins_use_their_members_history(spark):
    hist = spark.createDataFrame([("Jabal Ali", 1), ("Warsan Fourth", 2), ("Burj Khalifa", 3)], "area_name_en string, v int")
    got = rows(profile.group_history(hist))
    assert sorted(got) == sorted([("Jabal Ali", 1), ("Warsan Fourth", 2), ("Burj Khalifa", 3), ("G3", 1), ("G3", 2)])
    requests = spark.createDataFrame([(1, "Jabal Ali", None, None), (2, None, 25.1971, 55.2745), (3, None, 10.0, 10.0)], "request_id int, area_name string, lat double, lon double")
    centres = spark.createDataFrame([("Burj Khalifa", 25.1972, 55.2744)], "area string, lat double, lon double")
    assert rows(profile.resolve_area(requests, centres).select("request_id", "area_name_en"), "request_id") == [(1, "G3"), (2, "Burj Khalifa"), (3, None)]
