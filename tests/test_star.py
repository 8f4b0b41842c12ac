"""The business questions and the star's checks on a small star, against plain Python."""

from collections import defaultdict
from datetime import date
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sparkmart.operators import checks
from sparkmart.plans import analytics
from sparkmart.plans.calendar import date_spine, dim_calendar
from sparkmart.plans.star import Star, all_checks, staging_checks

PRODUCTS = [
    # version, product, category, subcategory, colour, cost, price, from, to
    ("v1", 1, "Bikes", "Road", "red", "1.10", "2.25", 19000101, 20240110),
    ("v2", 1, "Bikes", "Road", "red", "1.10", "2.75", 20240110, None),
    ("v3", 2, "Bikes", "Track", "blue", "5.00", "5.00", 19000101, None),
    ("v4", 3, None, None, None, "0.05", "0.10", 19000101, None),
    ("-1", -1, None, None, None, "0.00", "0.00", 19000101, None),
]
SALES = [
    # order, line, day, version, product, customer, territory, quantity, deleted
    ("SO-1", 1, 20240105, "v1", 1, 7, 1, 2, False),
    ("SO-1", 2, 20240105, "v3", 2, 7, 1, 1, False),
    ("SO-2", 1, 20240112, "v2", 1, -1, 1, 3, False),
    ("SO-3", 1, 20240112, "v4", 3, 7, -1, 10, False),
    ("SO-4", 1, 20240113, "v2", 1, 7, 1, 99, True),
    ("SO-5", 1, 20240113, "-1", 8, 7, 1, 4, False),
]
RETURNS = [(20240106, 1, 1, 2), (20240120, 1, 2, 5), (20240104, 1, 3, 1)]


def star_of(spark, sales=SALES, products=PRODUCTS, returns=RETURNS):
    dim = spark.createDataFrame(
        [(*p[:5], Decimal(p[5]), Decimal(p[6]), *p[7:]) for p in products],
        "product_scd_key string, product_key bigint, category_name string, subcategory_name string, "
        "product_color string, product_cost decimal(18,2), product_price decimal(18,2), "
        "valid_from_key int, valid_to_key int",
    ).withColumns(
        {"product_name": F.lit("x"), "product_size_type": F.lit("No Size"), "product_style": F.lit("N/A")}
    )
    fact = spark.createDataFrame(
        sales,
        "order_number string, order_line_item bigint, order_date_key int, product_scd_key string, "
        "product_key bigint, customer_key bigint, territory_key bigint, order_quantity bigint, "
        "is_deleted boolean",
    ).withColumn("stock_date_key", F.col("order_date_key"))
    customers = spark.createDataFrame(
        [(-1, "g@x", date(1900, 1, 1), "N/A", "N/A", False), (7, "c@x", date(1980, 1, 1), "Single", "Male", True)],
        "customer_key bigint, email_address string, birth_date date, marital_status string, gender string, "
        "is_home_owner boolean",
    )
    territories = spark.createDataFrame(
        [(-1, "N/A", "N/A", "N/A"), (1, "a", "b", "c")],
        "territory_key bigint, region string, country string, continent string",
    )
    returned = spark.createDataFrame(
        returns, "return_date_key int, territory_key bigint, product_key bigint, return_quantity bigint"
    )
    return Star(
        calendar=dim_calendar(date_spine(spark, date(2024, 1, 31))),
        customers=customers, products=dim, territories=territories, sales=fact, returns=returned,
    )


def prices():
    return {p[0]: Decimal(p[6]) for p in PRODUCTS}


def test_gross_revenue(spark):
    star = star_of(spark)
    live = [s for s in SALES if not s[8]]
    revenue = sum(s[7] * prices()[s[3]] for s in live)
    expected = (len({s[0] for s in live}), sum(s[7] for s in live), revenue)
    assert rows(analytics.gross_revenue(star.sales, star.products)) == [expected]


def test_gross_revenue_per_version_counts_a_sale_per_version(spark):
    star = star_of(spark)
    joined = [
        (s[0], s[7], s[7] * Decimal(p[6]) if p else None)
        for s in SALES
        for p in ([p for p in PRODUCTS if p[1] == s[4]] or [None])
    ]
    expected = (
        len({j[0] for j in joined}), sum(j[1] for j in joined), sum(j[2] for j in joined if j[2] is not None),
    )
    out = analytics.gross_revenue_per_version(star.sales, star.products)
    assert rows(out, "orders", "all_quantity", "revenue") == [expected]


def test_both_ways_agree_without_history(spark):
    products = [p for p in PRODUCTS if p[0] != "v1"]
    sales = [(*s[:3], "v2" if s[3] == "v1" else s[3], *s[4:]) for s in SALES if not s[8] and s[4] != 8]
    star = star_of(spark, sales, products)
    columns = ("orders", "all_quantity", "revenue")
    assert rows(analytics.gross_revenue(star.sales, star.products), *columns) == rows(
        analytics.gross_revenue_per_version(star.sales, star.products), *columns
    )


@pytest.mark.parametrize("bounded", [True, False])
def test_revenue_by_category(spark, bounded, monkeypatch):
    if not bounded:
        monkeypatch.setattr("sparkmart.operators.joins.is_bounded", lambda df, n: False)
    star = star_of(spark)
    out = analytics.revenue_by_category(star.sales, star.products).collect()
    assert [tuple(r) for r in out] == [
        ("Bikes", 2, 6, Decimal("17.75")), (None, 2, 14, Decimal("1.00")),
    ]
    total = analytics.gross_revenue(star.sales, star.products).first()
    assert sum(r["revenue"] for r in out) == total["revenue"]
    assert sum(r["units_sold"] for r in out) == total["all_quantity"]


def test_returned_quantity(spark):
    star = star_of(spark)
    assert rows(analytics.returned_quantity(star.returns, star.calendar)) == [
        (3, date(2024, 1, 4), date(2024, 1, 20), 8)
    ]
    nothing = star.returns.where(F.lit(False))
    assert rows(analytics.returned_quantity(nothing, star.calendar)) == [(0, None, None, None)]


def test_products_by_color(spark):
    star = star_of(spark)
    assert rows(analytics.products_by_color(star.products)) == [
        (None, 1, 1, Decimal("0.10"), Decimal("33.33")),
        ("blue", 1, 1, Decimal("5.00"), Decimal("33.33")),
        ("red", 2, 1, Decimal("2.50"), Decimal("33.33")),
    ]


def test_margin_by_subcategory(spark):
    star = star_of(spark)
    margins = defaultdict(Decimal)
    by_version = {p[0]: p for p in PRODUCTS}
    for s in SALES:
        if not s[8]:
            p = by_version[s[3]]
            margins[p[3]] += s[7] * (Decimal(p[6]) - Decimal(p[5]))
    out = analytics.margin_by_subcategory(star.sales, star.products).collect()
    assert {r["subcategory_name"]: r["gross_margin"] for r in out} == margins
    assert [r["gross_margin"] for r in out] == sorted(margins.values(), reverse=True)


def failing(results):
    return {r["name"]: r["status"] for r in results.collect() if r["status"] != "pass"}


def test_checks_pass_on_a_sound_star(spark):
    results = checks.run(all_checks(star_of(spark), date(2024, 1, 14)))
    assert failing(results) == {"fct_returns.after_first_order": "warn"}
    assert results.count() == 60


def test_checks_fire_on_planted_defects(spark):
    star = star_of(
        spark,
        [*SALES, (None, 1, 20240113, "v9", None, 8, 9, None, None)],
        [*PRODUCTS, ("v1", 1, "Bikes", "Road", "red", "9.00", "2.25", 20240105, 20240106)],
        [*RETURNS, (20240301, 9, 9, None)],
    )
    assert failing(checks.run(all_checks(star, date(2024, 2, 14)))) == {
        "dim_products.no_overlap": "fail",
        "dim_products.positive_margin": "fail",
        "dim_products.version_key_unique": "fail",
        "fct_returns.after_first_order": "warn",
        "fct_returns.product_key.relationship": "fail",
        "fct_returns.return_date_key.relationship": "fail",
        "fct_returns.return_quantity.not_null": "fail",
        "fct_returns.territory_key.relationship": "fail",
        "fct_sales.customer_key.relationship": "fail",
        "fct_sales.fresh": "fail",
        "fct_sales.is_deleted.not_null": "fail",
        "fct_sales.order_number.not_null": "fail",
        "fct_sales.order_quantity.not_null": "fail",
        "fct_sales.product_key.not_null": "fail",
        "fct_sales.product_scd_key.relationship": "fail",
        "fct_sales.territory_key.relationship": "fail",
        "fct_sales.volume": "fail",
    }


def test_staging_checks(spark):
    cats = spark.createDataFrame([(1, "a"), (1, None)], "product_category_key bigint, category_name string")
    subs = spark.createDataFrame(
        [(1, "s", 1), (2, "t", 7)],
        "product_subcategory_key bigint, subcategory_name string, product_category_key bigint",
    )
    products = spark.createDataFrame([(None,)], "product_key bigint")
    results = checks.run(
        staging_checks({"product_categories": cats, "product_subcategories": subs, "products": products})
    )
    assert failing(results) == {
        "staged_product_categories.category_name.not_null": "fail",
        "staged_product_categories.product_category_key.unique": "fail",
        "staged_product_subcategories.product_category_key.relationship": "fail",
        "staged_products.product_key.not_null": "warn",
    }
