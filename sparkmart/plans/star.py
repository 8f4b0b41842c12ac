"""The star schema and its checks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.decode import GENDER, MARITAL_STATUS, NOT_AVAILABLE, STYLE
from sparkmart.operators.checks import (
    Check,
    Relation,
    accepted_values,
    duplicates,
    future_dates,
    negative_margins,
    not_null,
    returned_before_ordered,
    scd2_overlaps,
    stale,
    volume_anomaly,
)
from sparkmart.plans.calendar import key_to_date
from sparkmart.plans.facts import live


@dataclass(frozen=True)
class Star:
    """The tables that queries and checks read."""

    calendar: DataFrame
    customers: DataFrame
    products: DataFrame
    territories: DataFrame
    sales: DataFrame
    returns: DataFrame
    #: First orders and orders by day as the fact's summaries have them, where they are at hand.
    first_orders: DataFrame | None = None
    order_days: DataFrame | None = None


def _column_checks(
    table: str,
    df: DataFrame,
    required: tuple[str, ...],
    unique: tuple[str, ...] = (),
    accepted: dict[str, tuple[object, ...]] | None = None,
    warn_only: tuple[str, ...] = (),
) -> list[Check]:
    """not_null, unique and accepted_values checks of one table."""

    def severity(column: str) -> str:
        return "warn" if column in warn_only else "error"

    checks = [
        Check(f"{table}.{c}.not_null", df, not_null(c), severity(c)) for c in required
    ]
    checks += [
        Check(f"{table}.{c}.accepted_values", df, accepted_values(c, values), severity(c))
        for c, values in (accepted or {}).items()
    ]
    checks += [Check(f"{table}.{c}.unique", duplicates(df, c)) for c in unique]
    return checks


def _relationship(
    table: str, df: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> Check:
    relation = Relation(column, parent, parent_column)
    return Check(f"{table}.{column}.relationship", df, relation=relation)


def staging_checks(staged: dict[str, DataFrame]) -> list[Check]:
    """Checks of the staged tables, by table name; tables not given are left out."""
    specs: dict[str, dict] = {
        "sales": {
            "required": (
                "order_number", "order_line_item", "order_date_key", "product_key", "customer_key",
            ),
        },
        "sales_log": {
            "required": ("order_number", "order_line_item", "op", "is_deleted"),
            "accepted": {"op": (1, 2, 3, 4)},
        },
        "customers": {"required": ("customer_key",), "unique": ("customer_key",)},
        "products": {"required": ("product_key",), "warn_only": ("product_key",)},
        "territories": {
            "required": ("sales_territory_key",), "unique": ("sales_territory_key",),
        },
        "returns": {"required": ("return_date_key", "product_key", "territory_key")},
        "product_categories": {
            "required": ("product_category_key", "category_name"),
            "unique": ("product_category_key", "category_name"),
        },
        "product_subcategories": {
            "required": ("product_subcategory_key", "subcategory_name", "product_category_key"),
            "unique": ("product_subcategory_key",),
        },
        "date_spine": {"required": ("full_date",), "unique": ("full_date",)},
        "loads": {"required": ("load_id", "status")},
    }
    checks: list[Check] = []
    for name, spec in specs.items():
        if name in staged:
            checks += _column_checks(f"staged_{name}", staged[name], **spec)
    if {"product_categories", "product_subcategories"} <= staged.keys():
        checks.append(
            _relationship(
                "staged_product_subcategories",
                staged["product_subcategories"],
                "product_category_key",
                staged["product_categories"],
                "product_category_key",
            )
        )
    return checks


def dimension_checks(star: Star, as_of: date) -> list[Check]:
    """Column checks of the dimensions and the rules about versions, births and margins."""
    checks = _column_checks(
        "dim_calendar",
        star.calendar,
        ("date_key", "full_date", "year", "quarter", "month", "day_of_month", "is_weekend"),
        ("date_key", "full_date"),
        {"quarter": tuple(range(1, 5)), "month": tuple(range(1, 13))},
    )
    checks += _column_checks(
        "dim_customers",
        star.customers,
        ("customer_key", "email_address", "birth_date", "is_home_owner"),
        ("customer_key",),
        {
            "marital_status": (*MARITAL_STATUS.values(), NOT_AVAILABLE),
            "gender": (*GENDER.values(), NOT_AVAILABLE),
        },
        warn_only=("marital_status", "gender"),
    )
    checks += _column_checks(
        "dim_products",
        star.products,
        (
            "product_scd_key", "product_key", "product_name", "product_cost", "product_price",
            "valid_from_key",
        ),
        (),
        {
            "product_size_type": ("Clothing", "Frame (cm)", "No Size"),
            "product_style": (*STYLE.values(), NOT_AVAILABLE),
        },
    )
    checks += _column_checks(
        "dim_territories",
        star.territories,
        ("territory_key", "region", "country", "continent"),
        ("territory_key",),
    )
    checks += [
        Check("dim_products.version_key_unique", duplicates(star.products, "product_scd_key")),
        Check("dim_products.no_overlap", scd2_overlaps(star.products, "product_key")),
        Check(
            "dim_products.positive_margin",
            negative_margins(star.products, "product_price", "product_cost"),
        ),
        Check(
            "dim_customers.future_birth_date",
            future_dates(star.customers, "birth_date", as_of),
            severity="warn",
        ),
    ]
    return checks


def returns_checks(star: Star) -> list[Check]:
    checks = _column_checks(
        "fct_returns",
        star.returns,
        ("return_date_key", "territory_key", "product_key", "return_quantity"),
    )
    return checks + [
        _relationship("fct_returns", star.returns, "return_date_key", star.calendar, "date_key"),
        _relationship(
            "fct_returns", star.returns, "territory_key", star.territories, "territory_key"
        ),
        _relationship("fct_returns", star.returns, "product_key", star.products, "product_key"),
        return_order_check(star),
    ]


def return_order_check(star: Star) -> Check:
    """Deleted sales are no orders. With first orders at hand the fact is not read."""
    orders = live(star.sales) if star.first_orders is None else star.first_orders
    return Check(
        "fct_returns.after_first_order",
        returned_before_ordered(orders, star.returns),
        severity="warn",
        warn_if=0,
        error_if=50,
    )


def sales_checks(star: Star) -> list[Check]:
    checks = _column_checks(
        "fct_sales",
        star.sales,
        (
            "order_number", "order_line_item", "order_date_key", "stock_date_key",
            "customer_key", "product_scd_key", "product_key", "territory_key",
            "order_quantity", "is_deleted",
        ),
    )
    parents = (
        ("order_date_key", star.calendar, "date_key"),
        ("stock_date_key", star.calendar, "date_key"),
        ("customer_key", star.customers, "customer_key"),
        ("product_scd_key", star.products, "product_scd_key"),
        ("territory_key", star.territories, "territory_key"),
    )
    return checks + [
        _relationship("fct_sales", star.sales, c, parent, pc) for c, parent, pc in parents
    ]


def volume_checks(star: Star, as_of: date) -> list[Check]:
    """Freshness and volume of the sales fact, as seen on the morning of ``as_of``.

    Deleted sales do not count. The days that do are also given as bounds on the stored key,
    which reach the scan. With orders by day at hand the fact is not read.
    """
    if star.order_days is not None:
        dated = star.order_days.withColumn("order_date", key_to_date(F.col("order_date_key")))
        return [
            Check("fct_sales.fresh", stale(star.order_days, "order_date_key", as_of)),
            Check("fct_sales.volume", volume_anomaly(dated, "order_date", as_of, rows="n")),
        ]
    first, last = (int(f"{as_of - timedelta(days=n):%Y%m%d}") for n in (8, 1))
    recent = live(star.sales.where(F.col("order_date_key").between(first, last)))
    dated = recent.select(key_to_date(F.col("order_date_key")).alias("order_date"))
    return [
        Check("fct_sales.fresh", stale(live(star.sales), "order_date_key", as_of)),
        Check("fct_sales.volume", volume_anomaly(dated, "order_date", as_of)),
    ]


def all_checks(star: Star, as_of: date) -> list[Check]:
    return (
        dimension_checks(star, as_of)
        + returns_checks(star)
        + sales_checks(star)
        + volume_checks(star, as_of)
    )
