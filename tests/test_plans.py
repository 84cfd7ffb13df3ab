"""The plans are the ones the jobs were written for."""

import re

import pytest

from daymark.functions.criteria import JAAM
from daymark.operators import evaluate, labels
from daymark.plans.queries import QUERIES
from daymark.sources.tables import read_table, write_table
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def stored(spark, small_days, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("days") / "days")
    write_table(small_days, place)
    return read_table(spark, place)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_pass_chain_has_one_exchange_and_one_sort(stored):
    plan = plan_of(labels.label_progression(stored, unique_days=True))
    assert plan.count("Exchange hashpartitioning(subject_id") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("- Window [") + plan.count("+- Window [") >= 2
    assert plan.count("lead(") == 3  # one per label
    assert "Join" not in plan


def test_rows_are_read_once_without_unique_days(spark, stored):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan then shows reuse
    try:
        plan = plan_of(labels.sic_labels(stored))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("ReusedExchange") >= 1
    assert "windowspecdefinition(subject_id" not in plan


def test_columns_and_filters_reach_the_scan(stored):
    table = labels.sic_labels(stored.filter("subject_id = 3"), unique_days=True)
    plan = plan_of(table)
    assert "EqualTo(subject_id,3)" in plan
    assert "wbc_avg" not in plan
    later = plan_of(labels.sic_labels(stored, unique_days=True).filter("subject_id = 3"))
    assert "EqualTo(subject_id,3)" in later


def without_adaptive_execution(spark, df):
    """The plan as it is before stages run, which shows what is reused."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return plan_of(df())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_ranking_exchanges_distinct_scores_by_level_once(spark):
    from daymark.plans.queries import scored_days

    plan = without_adaptive_execution(spark, lambda: evaluate.auprc(scored_days(spark, SMALL)))
    assert plan.count("- Exchange hashpartitioning(_middle") == 1
    assert len(re.findall(r"ReusedExchange .* Exchange hashpartitioning\(_middle", plan)) == 1


def test_auroc_hands_its_totals_up_without_a_join(spark):
    from daymark.plans.queries import scored_days

    plan = without_adaptive_execution(spark, lambda: evaluate.auroc(scored_days(spark, SMALL)))
    assert "Join" not in plan and "ReusedExchange" not in plan
    for level in ("hashpartitioning(_middle", "hashpartitioning(_top", "SinglePartition"):
        assert plan.count(f"- Exchange {level}") == 1


def test_merge_join_becomes_inner(stored):
    joined = labels.merge_by_join(stored, labels.sic_labels(stored, unique_days=True))
    optimized = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in optimized and "LeftOuter" not in optimized


def test_sic_day_filter_stays_above_the_dic_window(stored):
    chosen = labels.on_sic_days(labels.label_progression(stored, JAAM, unique_days=True), JAAM)
    optimized = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("(sic_today") < optimized.index("Window [")


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in (
    "logistic", "gbt", "gbt_dic_progression", "model_rows", "model_evaluation",
    "model_calibration", "model_fairness", "model_group_counts", "logistic_one_flag",
    "trees_one_flag", "importance_one_flag", "tree_importance", "permutation_importance",
)])
def test_no_python_on_the_way(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
