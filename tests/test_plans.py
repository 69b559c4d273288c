"""What the plans of the registered queries must and must not contain."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions.ordering import with_position
from tidemark.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairing_of_everything_with_everything(spark, sf_dir, plan_of, name):
    plan = plan_of(QUERIES[name](spark, sf_dir), "simple")
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir, plan_of):
    plan = plan_of(QUERIES["scan_filter_project"](spark, sf_dir))
    assert "EqualTo(o_orderstatus,F)" in plan and "GreaterThan(o_totalprice,100000.0)" in plan
    assert "o_orderpriority" not in plan
    plan = plan_of(QUERIES["distinct_pairs"](spark, sf_dir))
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string>" in plan


def test_counting_decodes_no_column(spark, sf_dir, plan_of):
    assert "ReadSchema: struct<>" in plan_of(QUERIES["row_counts"](spark, sf_dir))


def test_latest_record_is_a_top_n(spark, sf_dir, plan_of):
    plan = plan_of(QUERIES["latest_record"](spark, sf_dir), "simple")
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_key_copies_are_folded_before_the_shuffle(spark, sf_dir, plan_of):
    plan = plan_of(QUERIES["key_profile"](spark, sf_dir), "simple")
    assert "partial_count(1)" in plan.split("Exchange hashpartitioning")[1]


@pytest.mark.parametrize("computed", [False, True])
@pytest.mark.parametrize("after", ["nothing", "filter", "aggregate"])
def test_no_row_carries_the_bounds(spark, sf_dir, plan_of, after, computed):
    """The list of bounds is read where rows search it; no projection puts it out."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    if computed:
        orders = orders.withColumn("o_orderstatus", F.sha2("o_orderstatus", 256))
    bounds = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderstatus", "o_orderkey")
    found = with_position(orders, ["o_orderstatus", "o_orderkey"], bounds, 1500, "p")
    if after == "filter":
        found = found.where("p % 3 = 1")
    if after == "aggregate":
        found = found.groupBy("p").count()
    assert "__bounds" not in plan_of(found)


@pytest.mark.parametrize("name", ["page_rows", "text_key_pages", "composite_key_pages", "tied_key_pages"])
def test_pages_take_no_python(spark, sf_dir, plan_of, name):
    plan = plan_of(QUERIES[name](spark, sf_dir), "simple")
    assert "Python" not in plan and "__bounds" not in plan
