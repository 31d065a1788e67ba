"""Registered queries against SQL on the smallest tables, and independence from how the input is partitioned."""

import pytest
from pyspark.sql import functions as F

from oracle import compare, duck
from parcelflow.operators import learn
from parcelflow.plans import ORACLES, RUNNERS
from parcelflow.session import fresh_path
from parcelflow.sources import bindings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(set(RUNNERS) & set(ORACLES)))
def test_query_equals_sql(spark, con, name):
    assert compare(RUNNERS[name](spark, SF), con, ORACLES[name]) == []


QUANTILES = ["flagship_area_month_returns", "agg_quantile_bounds", "agg_describe", "agg_global_median", "agg_month_panel", "win_group_bounds_filter", "win_hard_min_filter",
             "imp_median", "req_trim_5_95", "req_monthly_series", "dq_outlier_stages", "stage_training", "stage_panel"]


@pytest.mark.parametrize("name", QUANTILES)
def test_large_group_path_gives_the_same_rows(spark, con, monkeypatch, name):
    from parcelflow.operators import quantiles

    used = []
    plain = quantiles._by_blocks
    monkeypatch.setattr(quantiles, "MAX_GROUP_ROWS", 0)
    monkeypatch.setattr(quantiles, "_by_blocks", lambda *a: used.append(1) or plain(*a))
    assert compare(RUNNERS[name](spark, SF), con, ORACLES[name]) == []
    assert used


def test_every_query_has_sql():
    """All but the whole output of the model search, which tests/test_models.py holds against plain fits."""
    assert set(RUNNERS) - set(ORACLES) == {"ml_trial_log", "ml_segment_metrics", "ml_request_prices"} and set(ORACLES) <= set(RUNNERS)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["win_ffill_global", "win_dedupe_keep", "imp_group_first", "join_self_backfill", "stage_training", "agg_group_first"])
def test_partitioning_does_not_change_results(spark, monkeypatch, name):
    want = sorted(map(str, RUNNERS[name](spark, SF).collect()))
    plain = bindings.table

    def shuffled(spark, sf_dir, table):
        df = plain(spark, sf_dir, table)
        return df.repartition(11, *df.columns[-2:]) if table == "lineitem" else df

    monkeypatch.setattr(bindings, "table", shuffled)
    assert sorted(map(str, RUNNERS[name](spark, SF).collect())) == want


def _training(spark, n=400, days=90):
    data = [("A" if i % 2 else "B", f"2024-{1 + i % days // 30:02d}-{1 + i % 28:02d}", float(100 + (i * 37) % 50 + 30 * (i % 3)), "xyz"[i % 3], i) for i in range(n)]
    return spark.createDataFrame(data, "area_name_en string, d string, price double, t string, i int").withColumn("d", F.col("d").cast("date"))


def test_search_survives_days_that_hold_everything(spark):
    """All training rows on one day, fewer rows than folds, and a metric that cannot be judged."""
    one_day = _training(spark, 30).withColumn("d", F.lit("2024-01-05").cast("date"))
    ready = learn.encode(one_day, ["t"], []).transform(one_day)
    folded = learn.with_folds(ready, ["d", "i"], 3)
    assert sorted(r["count"] for r in folded.groupBy("fold").count().collect()) == [10, 10, 10]
    log = learn.random_search(folded, "linear", "price", 2, 3)
    assert [t["cv_rank"] for t in log] == [1, 2] and all(t["fold_sizes"] == [10, 10, 10] for t in log)
    few = learn.with_folds(ready.limit(2), ["d", "i"], 3)
    assert learn.random_search(few, "linear", "price", 1, 3)[0]["cv_mean_mape"] is not None
    alone = learn.with_folds(ready.limit(1), ["d", "i"], 3)
    assert learn.random_search(alone, "linear", "price", 1, 3)[0]["cv_mean_mape"] is None


def test_a_group_may_be_called_like_an_area(spark):
    members = spark.createDataFrame([("A", "B"), ("a/b c", "A"), ("a_b c", "B")], "group string, member string")
    root = fresh_path(spark, "models")
    trials, metrics, models = learn.train_segments(
        _training(spark), members, ["t"], [], "price", "d", order=["i"], min_rows=100, root=root, algorithms=["linear"], n_settings=1, folds=2)
    want = {"area:A", "area:B", "group:A", "group:a/b c", "group:a_b c"}
    assert {r["segment"] for r in models.collect()} == want == {r["segment"] for r in metrics.collect()}
    rows = _training(spark, 40).withColumn("key", F.when(F.col("i") % 2 == 0, "group:A").otherwise("area:A"))
    a = learn.batch_score(rows, "key", models, ["t"], []).collect()
    b = learn.batch_score(rows, "key", learn.load_models(spark, root), ["t"], []).collect()
    assert sorted((r["i"], r["prediction"]) for r in a) == sorted((r["i"], r["prediction"]) for r in b) and len(a) == 40
    assert learn.batch_score(rows, "key", models.limit(0), ["t"], []).collect() == []
