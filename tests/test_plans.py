"""Plans of fact-sized queries: pushdown, pruning, no Python in the row path, no single-task exchange of facts."""

import pytest

from parcelflow import session
from parcelflow.plans import RUNNERS
from parcelflow.sources.bindings import TXN_ORDER, transactions

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def every_plan(monkeypatch):
    """Plans of all jobs of a query: the tables it stores on the way, and its result."""
    seen = []
    monkeypatch.setattr(session, "observers", [lambda df, label: seen.append((label, plan(df)))])

    def run(spark, name):
        seen.clear()
        result = plan(RUNNERS[name](spark, SF))
        return [*seen, ("result", result)]

    return run


def test_flagship_plan(spark, every_plan):
    plans = every_plan(spark, "flagship_area_month_returns")
    for label, text in plans:
        assert "Python" not in text and "CartesianProduct" not in text, label
        assert "SinglePartition" not in text or "lineitem" not in text, label
    facts = [text for _, text in plans if "l_extendedprice" in text]
    assert facts and all("GreaterThanOrEqual(l_shipdate" in text and "BroadcastHashJoin" in text for text in facts)


@pytest.mark.parametrize("name", ["imp_group_first", "join_self_backfill", "agg_group_first", "stage_training"])
def test_first_known_values_do_not_sort_the_facts(spark, every_plan, name):
    for label, text in every_plan(spark, name):
        # only rows that share the first date are sorted, and the projects
        assert "SortAggregate" not in text or "_at_0" in text or "l_orderkey" not in text, label


@pytest.mark.parametrize("name", ["req_forecast_report", "stage_training", "stage_panel", "win_ffill_global", "fc_decay_adjust"])
def test_all_jobs_of_a_query_stay_native(spark, every_plan, name):
    plans = every_plan(spark, name)
    assert len(plans) > 2
    for label, text in plans:
        assert "Python" not in text and "CartesianProduct" not in text, label


def test_requests_read_the_facts_once(spark, every_plan):
    plans = every_plan(spark, "req_nearest_profile")
    assert sum(text.count("l_extendedprice") > 0 and "lineitem" in text for _, text in plans) == 1


@pytest.mark.parametrize("name", [
    "filt_exclude_set", "win_ffill_global", "win_dedupe_keep", "win_group_bounds_filter", "imp_group_first", "join_scorecards",
    "join_left_linkkey", "str_rule_label", "agg_smoothed_share", "stage_micro", "stage_training", "req_nearest_profile",
])
def test_no_python_and_no_single_task(spark, name):
    text = plan(RUNNERS[name](spark, SF))
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_only_requested_columns(spark):
    text = plan(transactions(spark, SF, "instance_date", "procedure_area"))
    assert "ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>" in text and "Join" not in text


def test_keep_first_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(RUNNERS["win_dedupe_keep"](spark, SF))


def test_order_columns_identify_a_line(spark):
    df = transactions(spark, SF, *TXN_ORDER)
    assert df.count() == df.distinct().count()
