"""The plans that decide whether a query scales."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from holdfast.plans.catalog import QUERIES
from holdfast.plans.churn import Study
from holdfast.sources import order_tables

FITTED = ("smote_balance", "smote_balanced", "lr_scores", "rf_scores", "gbt_scores", "random_search_results",
          "booster_facts", "booster_first_split", "forest_facts", "served_by_model",
          "cox_hazards", "cox_null_scores", "fitted_model_comparison", "tree_shap", "batch_scores", "live_scores")
LAZY = [n for n in QUERIES if n not in FITTED]


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python_rows(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Join Cross", plan)
    assert not re.search(r"PythonUDF|MapInPandas|FlatMapGroups|ArrowEvalPython", plan)


def test_cutoff_filter_and_columns_reach_the_scan(spark, sf_dir, capsys):
    Study(order_tables(spark, sf_dir)).observed_orders.select("order_id").explain("formatted")
    plan = capsys.readouterr().out
    assert re.search(r"PushedFilters: .*LessThanOrEqual\(o_orderdate", plan)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan


def test_feature_table_shuffles_each_grain_once(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        study = Study(order_tables(spark, sf_dir))
        plan = plan_of(study.features()).split("== Physical Plan ==")[1]
        # Items are read once and go to their order once; people are added up once.
        assert len(re.findall(r"FileScan parquet .*lineitem\.parquet", plan)) == 1
        after_items = plan[: plan.index("lineitem.parquet")].splitlines()
        depth = len(after_items[-1]) - len(after_items[-1].lstrip(" :+-*()0123456789"))
        by_order, at = 0, depth
        for line in reversed(after_items):
            indent = len(line) - len(line.lstrip(" :+-*()0123456789"))
            if indent < at:
                at = indent
                by_order += bool(re.search(r"Exchange hashpartitioning\(order_id#\d+L?, \d+\)", line))
                if "customer_unique_id" in line and "Exchange" in line:
                    break
        assert by_order == 1
        by_person = re.findall(r"Exchange hashpartitioning\(customer_unique_id#\d+L?, (?:category#\d+, )?\d+\)", plan)
        assert len(by_person) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_split_does_not_shuffle_the_table(spark, sf_dir):
    from holdfast.operators.prep import stratified_split

    df = spark.range(100).select(F.col("id").alias("customer_unique_id"), (F.col("id") % 2).alias("label"), F.lit("wide").alias("payload"))
    plan = plan_of(stratified_split(df)).split("== Physical Plan ==")[1]
    for exchange in re.findall(r"Exchange .*?\n.*", plan):
        assert "payload" not in exchange
