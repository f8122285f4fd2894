"""Plan shape of the registered queries: no cross products, no Python on the row path outside the forest."""

import re

import pytest

import __spark_entry__ as entry

# the forest scores in numpy; the exact two-sample law is computed on one row per feature
FOREST = {"fit_forest", "forest_score", "permutation_importance", "ks_pvalue_exact"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cross_products(spark, folder, name):
    text = plan(entry.queries()[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in FOREST:
        assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", text)


def test_scan_reads_only_what_it_needs(spark, folder):
    text = plan(entry.queries()["gas_summary"](spark, folder))
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_time_filter_is_pushed_down(spark, folder):
    text = plan(entry.queries()["union_by_name"](spark, folder))
    assert "LessThan(ts" in text and "GreaterThanOrEqual(ts" in text


@pytest.mark.parametrize("name", ["psi", "kl_divergence", "feature_histogram"])
def test_histograms_shuffle_no_values(spark, folder, name):
    text = plan(entry.queries()[name](spark, folder))
    assert not re.search(r"hashpartitioning\(feature#\d+, x#\d+", text) and "hashpartitioning(feature" in text
