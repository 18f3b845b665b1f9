"""Plans and results under skew: what must hold when one key owns a third of the rows."""

import re

import pytest
from pyspark.sql import functions as F

from starmill import queries
from starmill.operators.dedup import keep_one
from starmill.operators.matching import lookup
from starmill.plans import clean as cleaning
from starmill.plans import measures
from starmill.plans.model import Warehouse
from starmill.session import tune
from starmill.sources import adapter

FOLDER = "/root/testdata/sf0.01"
FIRST = {"payments": ["arrival"], "reviews": ["arrival"]}


@pytest.fixture
def shuffled_joins(spark, settings):
    """Small data made to look large: no broadcasts, and a low bar for skew."""
    tune(spark)
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__forceOptimizeSkewedJoin="true",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="64",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )


def executed_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, one_item_in, one_review_in):
    """Clean tables in which one order owns the given shares of all items and reviews."""
    clean = cleaning.clean(adapter.raw_tables(spark, FOLDER), FIRST)
    located = clean["customers"].where("customer_state = 'ASIA'")
    orders = clean["orders"].join(located, "customer_id", "left_semi")
    sold = orders.join(clean["order_items"], "order_id", "left_semi")
    hot = sold.agg(F.min("order_id")).first()[0]

    def heat(df, one_in):
        chosen = F.pmod(F.xxhash64(*df.columns), F.lit(one_in)) == 0
        return df.withColumn("order_id", F.when(chosen, hot).otherwise(F.col("order_id")))

    return clean.replacing(
        {
            "order_items": lambda: heat(clean["order_items"], one_item_in),
            "reviews": lambda: heat(clean["reviews"], one_review_in),
        }
    )


@pytest.mark.parametrize("one_item_in, one_review_in", [(3, 1000), (20000, 3)])
def test_order_fact_splits_a_hot_order(spark, shuffled_joins, one_item_in, one_review_in):
    tables = skewed(spark, one_item_in, one_review_in)
    built = Warehouse(tables, closed="right")
    plan = executed_plan(built.lifecycle_rows)
    assert "skew=true" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = Warehouse(tables, closed="right", key_method="global")
        items = plain.tables["order_items"].join(plain.dim_products, "product_id")
        items = items.join(plain.dim_sellers, "seller_id").join(plain.orders, "order_id")
        expected = items.join(plain.reviews, "order_id", "left")
        columns = ["order_id", "order_item_id", "review_id", "review_sk", "product_sk"]
        left = built.lifecycle_rows.withColumn("order_item_id", F.col("item_text")).select(*columns)
        right = expected.select(*columns)
        assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def single_partition_inputs(plan):
    """What feeds each exchange into one task."""
    return re.findall(r"Exchange SinglePartition.*\n(.*)", plan)


def test_no_table_goes_through_one_task(spark):
    tune(spark, FOLDER)
    built = Warehouse(cleaning.clean(adapter.raw_tables(spark, FOLDER), FIRST), closed="right")
    for name in ("dim_customers", "dim_products", "dim_reviews", "fact_orderlifecycle"):
        plan = built.table(name)._jdf.queryExecution().executedPlan().toString()
        inputs = single_partition_inputs(plan)
        # Row counts per partition or range, and date bounds that were taken per partition before.
        small = (
            "HashAggregate(keys=[_part",
            "HashAggregate(keys=[], functions=[partial_min(",
            "ReadSchema: struct<_range:int,_rows:bigint>",
        )
        assert inputs and all(any(s in i for s in small) for i in inputs), name
        assert "Python" not in plan


def test_scan_reads_only_what_a_measure_needs(spark):
    tune(spark, FOLDER)
    built = Warehouse(
        cleaning.clean(adapter.raw_tables(spark, FOLDER), FIRST), key_method="natural"
    )
    plan = measures.payment_mix(built.payment_rows)._jdf.queryExecution().executedPlan().toString()
    events = [line for line in plan.splitlines() if "events.parquet" in line]
    assert events and all("ts:" not in line for line in events)


def scanned(df, table):
    """The columns that a plan reads of a table; empty if it does not read it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(rf"{table}\.parquet\].*ReadSchema: struct<(.*?)>", plan)
    return {c.split(":")[0] for s in schemas for c in s.split(",") if c}


def test_unread_columns_and_tables_are_not_read(spark):
    x = queries.Inputs(spark, FOLDER)
    assert "props" not in scanned(queries.payments_mom(x), "events")
    assert scanned(queries.purchase_date_bounds(x), "orders")
    assert not scanned(queries.purchase_date_bounds(x), "lineitem")
    assert not scanned(queries.payment_mix(x), "lineitem")
    # A survivor is a whole row; only a key that is declared unique lets columns drop out.
    unique = ("customers", "orders", "categories", "products", "sellers")
    declared = cleaning.clean(x.raw, queries.ARRIVAL, unique=unique, total=tuple(queries.ARRIVAL))
    orders = measures.order_count(Warehouse(declared, key_method="natural").sales_rows)
    assert scanned(orders, "part") <= {"p_partkey", "p_type"}


def test_date_keys_cost_no_join(spark):
    tune(spark, FOLDER)
    built = Warehouse(cleaning.clean(adapter.raw_tables(spark, FOLDER), FIRST), closed="right")
    keys = [c for c in built.lifecycle_rows.columns if c.endswith("_date_sk")]
    without = built.lifecycle_rows.drop(*keys)

    def joins(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Join ")

    assert joins(built.lifecycle_rows) == joins(without)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_lookup_in_a_grouped_table_splits_a_hot_key(spark, shuffled_joins, how):
    facts = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("n"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    names = facts.where("n % 2 = 0").select("k", (F.length("k") + 1).alias("size"))
    names = keep_one(names, ["k"])
    joined = lookup(facts, "k", names, how=how)
    assert "skew=true" in executed_plan(joined)
    expected = facts.join(names, "k", how)
    assert joined.exceptAll(expected).count() == 0 and expected.exceptAll(joined).count() == 0


def test_unread_item_numbers_are_not_computed(spark):
    items = cleaning.clean(adapter.raw_tables(spark, FOLDER))["order_items"].select("seller_id")
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "IsNotNull(l_orderkey)" in plan
