from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sparkmart.operators.checks import ChecksFailed
from sparkmart.plans import pipeline
from sparkmart.sources.loads import read_loads

from test_stream import RAW_LOG

FIRST, SECOND = date(2024, 1, 1), date(2024, 1, 2)


def sources(spark, price="2.00", returned=1):
    day = datetime(2023, 12, 31)
    customers = spark.createDataFrame(
        [(1, date(1980, 1, 1), "M", "F", "Y", Decimal("10.00"))],
        "customer_key bigint, birth_date date, marital_status string, gender string, home_owner string, "
        "annual_income decimal(18,2)",
    )
    for name in ("prefix", "first_name", "last_name", "email_address", "education_level", "occupation"):
        customers = customers.withColumn(name, F.lit("x"))
    products = spark.createDataFrame(
        [(1, "a", "1.00", price), (2, "b", "1.00", "3.00"), (3, " ", "1.00", "3.00")],
        "product_key bigint, product_name string, product_cost string, product_price string",
    ).withColumn("product_subcategory_key", F.lit(1))
    for name in (
        "product_sku", "model_name", "product_description", "product_color", "product_size", "product_style",
    ):
        products = products.withColumn(name, F.lit("M"))
    return {
        "customers": customers.withColumn("total_children", F.lit(0)),
        "product_categories": spark.createDataFrame(
            [(1, "Bikes")], "product_category_key int, category_name string"
        ),
        "product_subcategories": spark.createDataFrame(
            [(1, "Road", 1)], "product_subcategory_key int, subcategory_name string, product_category_key int"
        ),
        "products": products,
        "returns": spark.createDataFrame(
            [(day, 5, returned, 1)],
            "return_date timestamp_ntz, territory_key int, product_key int, return_quantity int",
        ),
        "territories": spark.createDataFrame(
            [(1, "r", "c", "k")], "sales_territory_key int, region string, country string, continent string"
        ),
        "sales": spark.createDataFrame(
            [(day, day, "SO-1", 1, 1, 1, 1, 10), (day, day, "SO-2", 2, 77, 1, 1, 20)],
            "order_date timestamp_ntz, stock_date timestamp_ntz, order_number string, product_key int, "
            "customer_key int, territory_key int, order_line_item int, order_quantity int",
        ),
    }


def log(spark, events):
    day = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(day, day, f"SO-{o}", p, None, 1, 1, q, op, f"{lsn:020x}", "0" * 20) for o, p, q, op, lsn in events],
        RAW_LOG,
    )


def facts_of(wh):
    return rows(wh.sales.read(wh.spark), "order_number", "order_quantity", "is_deleted", "customer_key")


def test_warehouse_life(spark, table):
    wh = pipeline.Warehouse(spark, table())
    before = log(spark, [(1, 1, 10, 2, 1), (2, 2, 20, 2, 2)])
    pipeline.bootstrap(wh, sources(spark), before, FIRST, "boot")
    assert facts_of(wh) == [("SO-1", 10, False, 1), ("SO-2", 20, False, 77)]
    assert rows(wh.mart("dim_customers"), "customer_key", "is_inferred") == [(-1, False), (1, False), (77, True)]
    assert rows(wh.mart("dim_territories"), "territory_key", "is_inferred") == [(-1, False), (1, False), (5, True)]
    assert rows(spark.read.parquet(wh.path("quarantine", "products")), "product_key", "error_reason") == [
        (3, "blank_name")
    ]

    # Nothing new right after the first load.
    pipeline.run_increment(wh, before, "inc-0")
    assert facts_of(wh) == [("SO-1", 10, False, 1), ("SO-2", 20, False, 77)]

    # An event the baseline already holds is not read again; a new one is merged.
    after = before.unionByName(log(spark, [(1, 1, 11, 4, 3), (2, 2, 20, 1, 4), (3, 9, 5, 2, 5)]))
    for _ in range(2):  # the second time as a retry
        results = pipeline.run_increment(wh, after, "inc-1")
    assert facts_of(wh) == [("SO-1", 11, False, -1), ("SO-2", 20, True, -1), ("SO-3", 5, False, -1)]
    assert {r["status"] for r in results.collect()} <= {"pass", "warn"}
    appended = read_loads(spark, wh.path("raw", "sales_log"), after.schema)
    assert appended.count() == 3

    # Nothing new: nothing changes.
    fact_before = facts_of(wh)
    pipeline.run_increment(wh, after, "inc-2")
    assert facts_of(wh) == fact_before

    # A price change opens a version; running the day again changes nothing.
    for _ in range(2):
        pipeline.refresh_dimensions(wh, sources(spark, price="2.50"), SECOND, "day-2")
    versions = wh.mart("dim_products").where("product_key = 1")
    assert rows(versions, "product_price", "valid_from_key", "valid_to_key") == [
        (Decimal("2.00"), 19000101, 20240102), (Decimal("2.50"), 20240102, None),
    ]

    # Products that only returns know get a row.
    pipeline.refresh_dimensions(wh, sources(spark, returned=99), SECOND, "day-2a")
    assert wh.mart("dim_products").where("product_scd_key = 'pending-99'").count() == 1

    # A failing check stops the job, unless it is accepted.
    twice = sources(spark)
    twice["customers"] = twice["customers"].unionByName(twice["customers"])
    with pytest.raises(ChecksFailed, match="dim_customers.customer_key.unique"):
        pipeline.refresh_dimensions(wh, twice, SECOND, "day-2b")
    pipeline.refresh_dimensions(
        wh, twice, SECOND, "day-2c", accepted=["dim_customers.customer_key.unique"]
    )
    audited = read_loads(spark, wh.path("raw", "audit"))
    assert audited.where("load_id = 'boot-baseline'").count() == 1
    assert audited.where("load_id = 'day-2'").count() == len(pipeline.DAILY_TABLES)


def test_increment_brings_its_members_and_days(spark, table):
    wh = pipeline.Warehouse(spark, table())
    before = log(spark, [(1, 1, 10, 2, 1)])
    pipeline.bootstrap(wh, sources(spark), before, FIRST, "boot")
    later = datetime(2024, 1, 3)
    new = spark.createDataFrame(
        [(later, later, "SO-9", 55, 4711, 8, 1, 3, 2, f"{9:020x}", "0" * 20)], RAW_LOG
    )
    for _ in range(2):  # the second time as a retry
        results = pipeline.run_increment(wh, before.unionByName(new), "inc")
    assert {r["status"] for r in results.collect()} == {"pass"}
    assert wh.mart("dim_customers").where("customer_key = 4711 and is_inferred").count() == 1
    assert wh.mart("dim_territories").where("territory_key = 8 and is_inferred").count() == 1
    assert rows(wh.mart("dim_calendar"), "date_key") == [(20231231 if d == 0 else 20240100 + d,) for d in range(4)]
    with pytest.raises(ChecksFailed, match="fct_sales.fresh"):
        pipeline.run_increment(wh, before.unionByName(new), "inc-2", as_of=date(2024, 2, 1))


def test_sales_before_their_product_are_repaired(spark, table):
    wh = pipeline.Warehouse(spark, table())
    before = log(spark, [(1, 1, 10, 2, 1)])
    first = sources(spark)
    first["products"] = first["products"].where("product_key <> 2")
    pipeline.bootstrap(wh, first, before, FIRST, "boot")
    versions = lambda: rows(wh.sales.read(spark), "order_number", "product_scd_key", "lsn")
    assert [v == "-1" for _, v, _ in versions()] == [False, True]
    at = [lsn for *_, lsn in versions()]
    for day in ("day-2", "day-2-again"):
        pipeline.refresh_dimensions(wh, sources(spark), SECOND, day)
    known = {r[0] for r in rows(wh.mart("dim_products").where("product_key = 2"), "product_scd_key")}
    assert versions()[1][1] in known - {"-1"}
    assert [lsn for *_, lsn in versions()] == at
    assert facts_of(wh) == [("SO-1", 10, False, 1), ("SO-2", 20, False, 77)]


def test_failing_first_load_leaves_the_fact(spark, table):
    wh = pipeline.Warehouse(spark, table())
    twice = sources(spark)
    twice["customers"] = twice["customers"].unionByName(twice["customers"])
    with pytest.raises(ChecksFailed):
        pipeline.bootstrap(wh, twice, log(spark, [(1, 1, 10, 2, 1)]), FIRST, "boot")
    assert wh.sales.read(spark).count() == 2


def test_volume_bounds_reach_the_scan(spark, table):
    from sparkmart.plans import star

    wh = pipeline.Warehouse(spark, table())
    pipeline.bootstrap(wh, sources(spark), log(spark, [(1, 1, 10, 2, 1)]), FIRST, "boot")
    volume = star.volume_checks(wh.star(), SECOND)[1]
    plan = volume.table._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(order_date_key,20231225)" in plan
