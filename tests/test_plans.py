"""What the physical plans must look like, whatever the data."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from sparkmart.operators import cdc, checks, scd2
from sparkmart.operators.merge import KeyedTable, number_range_bucket
from sparkmart.plans import analytics, facts

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shop(spark):
    from sparkmart.catalog.derive import shop as of

    return of(spark, SF)


def test_cursor_reaches_the_scan(shop):
    text = plan(cdc.read_since(shop.staged_log, "0" * 20).select("order_number"))
    assert "GreaterThan(_start_lsn" in text
    assert re.search(r"ReadSchema: struct<order_number:string,_start_lsn:string>", text)


def test_latest_state_thins_out_keys_before_its_only_shuffle(shop):
    text = plan(cdc.latest_state(shop.staged_log, facts.SALES_KEYS))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Partial" in text and text.count("WindowGroupLimit") == 2


def test_versions_are_found_without_shuffling_small_dimensions(shop):
    text = plan(shop.sales_base())
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_full_history_shuffles_once(shop):
    text = plan(scd2.from_history(shop.observed, "product_key", ["product_price"], "observed_on"))
    assert text.count("Exchange hashpartitioning") == 1


def test_upsert_reads_touched_buckets_only(spark, shop, table):
    t = facts.sales_table(table(), orders_per_bucket=100)
    t.replace(shop.sales_base())
    text = plan(t.read(spark).where(F.col("bucket").isin([1, 2])))
    assert re.search(r"PartitionFilters: \[bucket#\d+L? IN \(1,2\)\]", text)


def test_key_repair_splits_the_scan_by_the_unknown_key(spark, table):
    from sparkmart.operators.merge import repair_keys

    path = table()
    spark.range(5).selectExpr("id", "id as customer_key", "'r' as ref").write.parquet(path)
    dim = spark.range(3).selectExpr("concat('C', id) as ref", "id as customer_key")
    text = plan(repair_keys(spark.read.parquet(path), dim, "ref", "customer_key"))
    assert "EqualTo(customer_key,-1)" in text


def test_margin_sums_units_before_joining_products(shop):
    text = plan(analytics.margin_by_subcategory(shop.fct_sales, shop.dim_products))
    join = min(i for i in (text.find("BroadcastHashJoin"), text.find("SortMergeJoin")) if i >= 0)
    assert text.find("keys=[product_scd_key", join) > 0


def test_questions_read_only_what_they_need(shop):
    text = plan(analytics.margin_by_subcategory(shop.fct_sales, shop.dim_products))
    assert "ReadSchema: struct<product_scd_key:string,order_quantity:bigint,is_deleted:boolean>" in text
    assert "PushedFilters: [IsNotNull(is_deleted), Not(EqualTo(is_deleted,true))" in text


def test_orphans_count_before_a_shuffled_anti_join(spark, shop):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = checks.orphans(shop.fct_returns, "product_key", shop.dim_products, "product_key")
        text = plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    anti = text.find("LeftAnti")
    assert 0 <= anti < text.find("partial_count")


def test_no_query_uses_cross_joins_or_row_udfs(spark, shop):
    from sparkmart.catalog.registry import QUERIES

    lazy = [n for n in QUERIES if re.match(r"(a|m1_|m4_scd2_f|m5|m8|m9|m10|m11|p|q[0-9])", n)]
    assert len(lazy) > 30
    for name in lazy:
        text = plan(QUERIES[name](spark, SF))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert word not in text, (name, word)


def test_freshness_uses_the_given_day(shop):
    text = plan(checks.stale(shop.fct_sales, "order_date_key", date(2024, 1, 2)))
    assert "current_date" not in text


def test_bucket_expression_uses_key_columns_only():
    table = facts.sales_table("/nowhere")
    assert isinstance(table, KeyedTable) and "order_number" in str(number_range_bucket("order_number", 5))


def test_hot_keys_are_not_gathered_in_one_task(spark):
    from sparkmart.operators.joins import hot_keys

    df = spark.range(3000).selectExpr("if(id < 2000, 0, id) AS k")
    found = hot_keys(df, ["k"], 1000)
    assert [r["k"] for r in found.collect()] == [0]
    assert hot_keys(df, ["k"], 100_000) is None
