"""Business questions over the star schema.

Each takes the tables it needs and gives a DataFrame. Measures that need no distinct count
are summed per dimension key before the dimension is joined.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.keys import UNKNOWN_KEY, UNKNOWN_VERSION
from sparkmart.operators.joins import lookup_join
from sparkmart.operators.ranks import tile, with_row_number
from sparkmart.plans.calendar import key_to_date
from sparkmart.plans.facts import live

AMOUNT = "decimal(38,2)"


def _priced(sales: DataFrame, products: DataFrame, *attributes: str) -> DataFrame:
    """Live sales with the price of their version and further product attributes."""
    lines = live(sales).select("order_number", "product_scd_key", "order_quantity")
    versions = products.select("product_scd_key", "product_price", *attributes)
    return lookup_join(lines, versions, ["product_scd_key"]).withColumn(
        "_amount", (F.col("order_quantity") * F.col("product_price")).cast(AMOUNT)
    )


def gross_revenue(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, units and revenue of the whole dataset, at the price of the order date."""
    return _priced(sales, products).agg(
        F.count_distinct("order_number").alias("orders"),
        F.sum("order_quantity").alias("all_quantity"),
        F.sum("_amount").cast(AMOUNT).alias("revenue"),
    )


def gross_revenue_per_version(sales: DataFrame, products: DataFrame) -> DataFrame:
    """The same question with every sale counted once per version of its product.

    This is what joining on the natural key alone gives, deleted sales included. Instead of
    multiplying rows, units per product are multiplied by its number of versions and by the
    sum of its prices.
    """
    units = sales.groupBy("product_key").agg(F.sum("order_quantity").alias("_units"))
    versions = products.groupBy("product_key").agg(
        F.count(F.lit(1)).alias("_versions"), F.sum("product_price").alias("_prices")
    )
    per_product = units.join(versions, "product_key", "left").select(
        (F.col("_units") * F.coalesce("_versions", F.lit(1))).alias("_quantity"),
        (F.col("_units") * F.col("_prices")).cast(AMOUNT).alias("_amount"),
    )
    orders = sales.agg(F.count_distinct("order_number").alias("orders"))
    return per_product.agg(
        F.sum("_quantity").alias("all_quantity"), F.sum("_amount").cast(AMOUNT).alias("revenue")
    ).select(orders.scalar().alias("orders"), "all_quantity", "revenue")


def revenue_by_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, units and revenue per category, best first.

    Distinct orders are counted per (category, order), which no large category can skew.
    """
    return (
        _priced(sales, products, "category_name")
        .groupBy("category_name")
        .agg(
            F.count_distinct("order_number").alias("orders"),
            F.sum("order_quantity").alias("units_sold"),
            F.sum("_amount").cast(AMOUNT).alias("revenue"),
        )
        .orderBy(F.col("revenue").desc_nulls_last(), "category_name")
    )


def returned_quantity(returns: DataFrame, calendar: DataFrame) -> DataFrame:
    """How much was returned, and between which dates."""
    per_day = returns.groupBy(F.col("return_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("_records"), F.sum("return_quantity").alias("_quantity")
    )
    return per_day.join(calendar.select("date_key", "full_date"), "date_key", "left").agg(
        F.coalesce(F.sum("_records"), F.lit(0)).alias("return_records"),
        F.min("full_date").alias("min_date"),
        F.max("full_date").alias("max_date"),
        F.sum("_quantity").alias("total_quantity_return"),
    )


def products_by_color(products: DataFrame) -> DataFrame:
    """Versions, products, mean price and share of the catalogue per colour."""
    catalogue = products.where(F.col("product_scd_key") != UNKNOWN_VERSION)
    total = catalogue.agg(F.count_distinct("product_key")).scalar()
    return (
        catalogue.groupBy("product_color")
        .agg(
            F.count("product_key").alias("version_count"),
            F.count_distinct("product_key").alias("product_count"),
            F.round(F.sum("product_price") / F.count("product_price"), 2)
            .cast("decimal(18,2)")
            .alias("avg_price"),
        )
        .withColumn(
            "pct",
            F.round(
                F.col("product_count").cast("decimal(20,0)") * 100 / total.cast("decimal(20,0)"), 2
            ).cast("decimal(5,2)"),
        )
    )


def margin_by_subcategory(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Lines, units and gross margin per subcategory, most profitable first."""
    per_version = (
        live(sales)
        .groupBy("product_scd_key")
        .agg(F.count(F.lit(1)).alias("_lines"), F.sum("order_quantity").alias("_units"))
    )
    versions = products.select(
        "product_scd_key", "subcategory_name", "product_price", "product_cost"
    )
    margin = F.col("_units") * (F.col("product_price") - F.col("product_cost"))
    return (
        per_version.join(versions, "product_scd_key", "left")
        .groupBy("subcategory_name")
        .agg(
            F.sum("_lines").alias("sales_lines"),
            F.sum("_units").alias("total_quantity"),
            F.sum(margin.cast(AMOUNT)).cast(AMOUNT).alias("gross_margin"),
        )
        .orderBy(F.col("gross_margin").desc_nulls_last(), "subcategory_name")
    )


def revenue_trend(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per month, with the change to the month before and to the year before.

    The months have no gaps; one without sales has a revenue of 0. There is one row per month by
    the time they are compared. A change in per cent is NULL where there is nothing to compare.
    """
    units = (
        live(sales)
        .groupBy("product_scd_key", F.floor(F.col("order_date_key") / 100).alias("_month"))
        .agg(F.sum("order_quantity").alias("_units"))
    )
    prices = products.select("product_scd_key", "product_price")
    amount = (F.col("_units") * F.col("product_price")).cast(AMOUNT)
    monthly = (
        lookup_join(units, prices, ["product_scd_key"], keys_from=live(sales))
        .groupBy(key_to_date(F.col("_month") * 100 + 1).alias("month"))
        .agg(F.sum("_units").alias("units"), F.sum(amount).cast(AMOUNT).alias("revenue"))
    )
    bounds = monthly.agg(F.min("month").alias("first"), F.max("month").alias("last"))
    months = bounds.where("first IS NOT NULL").select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MONTH"))).alias("month")
    )
    grid = months.join(monthly, "month", "left").select(
        "month",
        F.coalesce("units", F.lit(0)).alias("units"),
        F.coalesce("revenue", F.lit(0).cast(AMOUNT)).alias("revenue"),
    )
    order = Window.partitionBy().orderBy("month")

    def change(months_before: int) -> tuple[Column, Column]:
        then = F.lag("revenue", months_before).over(order)
        share = F.col("revenue").cast("double") / F.nullif(then.cast("double"), F.lit(0.0))
        return F.col("revenue") - then, F.round((share - 1) * 100, 2)

    month, year = change(1), change(12)
    return grid.select(
        "month",
        "units",
        "revenue",
        month[0].cast(AMOUNT).alias("month_over_month"),
        month[1].alias("month_over_month_pct"),
        year[0].cast(AMOUNT).alias("year_over_year"),
        year[1].alias("year_over_year_pct"),
    )


def customer_segments(
    sales: DataFrame, products: DataFrame, as_of: date, tiles: int = 5
) -> DataFrame:
    """Recency, frequency and value of every customer with orders, and a score of each.

    Scores are exact quantiles, from 1 to ``tiles``, the best being the highest; customers that
    are equal go by their key. The unknown customer is none. Prices are joined per customer and
    version, and only one row per customer is ranked.
    """
    known = live(sales).where(F.col("customer_key") != UNKNOWN_KEY)
    orders = known.groupBy("customer_key").agg(
        F.max("order_date_key").alias("last_order_date_key"),
        F.count_distinct("order_number").alias("frequency"),
    )
    units = known.groupBy("customer_key", "product_scd_key").agg(
        F.sum("order_quantity").alias("_units")
    )
    prices = products.select("product_scd_key", "product_price")
    amount = (F.col("_units") * F.col("product_price")).cast(AMOUNT)
    value = (
        lookup_join(units, prices, ["product_scd_key"], keys_from=known)
        .groupBy("customer_key")
        .agg(F.coalesce(F.sum(amount), F.lit(0)).cast(AMOUNT).alias("value"))
    )
    days = F.datediff(F.lit(as_of), key_to_date(F.col("last_order_date_key")))
    scored = orders.join(value, "customer_key").withColumn("recency_days", days)
    for name, order in (
        ("recency", F.col("recency_days").desc()),
        ("frequency", F.col("frequency").asc()),
        ("value", F.col("value").asc()),
    ):
        ranked = with_row_number(scored, [order, F.col("customer_key").asc()], "_at", "_all")
        score = tile(F.col("_at"), F.col("_all"), tiles)
        scored = ranked.withColumn(f"{name}_score", score).drop("_at", "_all")
    return scored.select(
        "customer_key",
        "recency_days",
        "frequency",
        "value",
        "recency_score",
        "frequency_score",
        "value_score",
    )
