"""Typed staging projections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.keys import date_key


@dataclass(frozen=True)
class Field:
    """One staged column: its name, type and the raw column it comes from.

    The type ``date_key`` turns a date into an integer day key. A lenient field gives NULL
    for what cannot be cast, where the others fail the job. An optional one is left out where
    the raw table does not have it.
    """

    name: str
    type: str
    source: str | None = None
    lenient: bool = False
    optional: bool = False

    def column(self) -> Column:
        raw = F.col(self.source or self.name)
        if self.type == "date_key":
            return date_key(raw.try_cast("date") if self.lenient else raw.cast("date")).alias(self.name)
        return (raw.try_cast(self.type) if self.lenient else raw.cast(self.type)).alias(self.name)


def conform(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Cast and rename; columns that are not listed are dropped before they are read."""
    return df.select(
        *[f.column() for f in fields if not f.optional or (f.source or f.name) in df.columns]
    )


MONEY = "decimal(18,2)"

CUSTOMERS = (
    Field("customer_key", "bigint"),
    Field("prefix", "string"),
    Field("first_name", "string"),
    Field("last_name", "string"),
    Field("birth_date", "date"),
    Field("marital_status", "string"),
    Field("gender", "string"),
    Field("email_address", "string"),
    Field("yearly_income", MONEY, "annual_income"),
    Field("total_children", "bigint"),
    Field("education_level", "string"),
    Field("occupation", "string"),
    Field("home_owner", "string"),
    Field("customer_reference", "string", optional=True),
)
PRODUCT_CATEGORIES = (
    Field("product_category_key", "bigint"),
    Field("category_name", "string"),
)
PRODUCT_SUBCATEGORIES = (
    Field("product_subcategory_key", "bigint"),
    Field("subcategory_name", "string"),
    Field("product_category_key", "bigint"),
)
PRODUCTS = (
    Field("product_key", "bigint"),
    Field("product_subcategory_key", "bigint"),
    Field("product_sku", "string"),
    Field("product_name", "string"),
    Field("model_name", "string"),
    Field("product_description", "string"),
    Field("product_color", "string"),
    Field("product_size", "string"),
    Field("product_style", "string"),
    Field("product_cost", MONEY),
    Field("product_price", MONEY),
)
RETURNS = (
    Field("return_date_key", "date_key", "return_date"),
    Field("territory_key", "bigint"),
    Field("product_key", "bigint"),
    Field("return_quantity", "bigint"),
)
SALES = (
    Field("order_number", "string"),
    Field("order_line_item", "bigint"),
    Field("order_date_key", "date_key", "order_date"),
    Field("stock_date_key", "date_key", "stock_date"),
    Field("product_key", "bigint"),
    Field("customer_key", "bigint"),
    Field("territory_key", "bigint"),
    Field("order_quantity", "bigint"),
    Field("customer_reference", "string", optional=True),
)
SALES_LOG = (
    *SALES,
    Field("op", "int", "_operation"),
    Field("lsn", "string", "_start_lsn"),
    Field("seqval", "string", "_seqval"),
)
TERRITORIES = (
    Field("sales_territory_key", "bigint"),
    Field("region", "string"),
    Field("country", "string"),
    Field("continent", "string"),
)

#: Staging of every source table by its raw name.
SPECS: dict[str, tuple[Field, ...]] = {
    "customers": CUSTOMERS,
    "product_categories": PRODUCT_CATEGORIES,
    "product_subcategories": PRODUCT_SUBCATEGORIES,
    "products": PRODUCTS,
    "returns": RETURNS,
    "sales": SALES,
    "sales_log": SALES_LOG,
    "territories": TERRITORIES,
}


def staged(name: str, raw: DataFrame) -> DataFrame:
    """The staging projection of the source table ``name``."""
    return conform(raw, SPECS[name])
