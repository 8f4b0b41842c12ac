"""The customer, territory and product dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.decode import (
    GENDER,
    MARITAL_STATUS,
    NOT_AVAILABLE,
    decode,
    home_owner,
    product_size,
    size_type,
    style,
)
from sparkmart.functions.keys import BEGINNING_OF_TIME, UNKNOWN_KEY, UNKNOWN_VERSION
from sparkmart.operators import scd2
from sparkmart.operators.joins import ROWS_PER_TASK, lookup_join
from sparkmart.operators.members import complete, pending
from sparkmart.operators.quality import Rule

#: Columns whose change opens a new product version.
TRACKED = ("product_price", "product_cost")

# What placeholder members say.
PLACEHOLDER_BIRTH_DATE = date(1900, 1, 1)
NO_TERRITORY = {"region": NOT_AVAILABLE, "country": NOT_AVAILABLE, "continent": NOT_AVAILABLE}


def _blank_customer(first_name: str, last_name: str, email: str) -> dict[str, object]:
    return {
        "prefix": NOT_AVAILABLE,
        "first_name": first_name,
        "last_name": last_name,
        "birth_date": PLACEHOLDER_BIRTH_DATE,
        "marital_status": NOT_AVAILABLE,
        "gender": NOT_AVAILABLE,
        "email_address": email,
        "yearly_income": 0,
        "total_children": 0,
        "education_level": NOT_AVAILABLE,
        "occupation": NOT_AVAILABLE,
        "is_home_owner": False,
    }


def decode_customers(staged: DataFrame) -> DataFrame:
    """Staged customers with their codes spelled out."""
    return staged.select(
        "customer_key",
        "prefix",
        "first_name",
        "last_name",
        "birth_date",
        decode(F.col("marital_status"), MARITAL_STATUS, NOT_AVAILABLE).alias("marital_status"),
        decode(F.col("gender"), GENDER, NOT_AVAILABLE).alias("gender"),
        "email_address",
        "yearly_income",
        "total_children",
        "education_level",
        "occupation",
        home_owner(F.col("home_owner")).alias("is_home_owner"),
    )


def customers(
    staged: DataFrame, fact_keys: DataFrame, email_domain: str = "example.com"
) -> DataFrame:
    """Customers, one pending row per key only facts know, and the guest."""
    return complete(
        decode_customers(staged),
        fact_keys,
        "customer_key",
        _blank_customer("Pending", "Pending", f"unknown@{email_domain}"),
        {
            "customer_key": UNKNOWN_KEY,
            **_blank_customer("Guest", "Unknown", f"guest@{email_domain}"),
        },
    )


def territories(staged: DataFrame, fact_keys: DataFrame) -> DataFrame:
    """Territories, one blank row per key only facts know, and the unknown member."""
    return complete(
        staged.withColumnRenamed("sales_territory_key", "territory_key"),
        fact_keys,
        "territory_key",
        NO_TERRITORY,
        {"territory_key": UNKNOWN_KEY, **NO_TERRITORY},
    )


def pending_customers(
    dim: DataFrame, fact_keys: DataFrame, email_domain: str = "example.com"
) -> DataFrame:
    """Rows to append to a finished customer dimension for new keys."""
    blank = _blank_customer("Pending", "Pending", f"unknown@{email_domain}")
    return pending(dim, fact_keys, "customer_key", {**blank, "is_inferred": True}, UNKNOWN_KEY)


def pending_territories(dim: DataFrame, fact_keys: DataFrame) -> DataFrame:
    """Rows to append to a finished territory dimension for new keys."""
    blank = {**NO_TERRITORY, "is_inferred": True}
    return pending(dim, fact_keys, "territory_key", blank, UNKNOWN_KEY)


def pending_products(dim: DataFrame, fact_keys: DataFrame) -> DataFrame:
    """Rows for products that only facts know, such as rejected ones.

    They are valid on no day, so no sale is resolved to them.
    """
    rows = pending(
        dim,
        fact_keys,
        "product_key",
        {
            "product_name": "Pending",
            "product_size_type": "No Size",
            "product_style": NOT_AVAILABLE,
            "product_cost": 0,
            "product_price": 0,
            "updated_key": BEGINNING_OF_TIME,
            "valid_from_key": BEGINNING_OF_TIME,
            "valid_to_key": BEGINNING_OF_TIME,
        },
        UNKNOWN_KEY,
    )
    return rows.withColumn(
        "product_scd_key", F.concat(F.lit("pending-"), F.col("product_key").cast("string"))
    )


def product_rules() -> list[Rule]:
    """Why a staged product is rejected, first match."""
    name, price, cost = F.col("product_name"), F.col("product_price"), F.col("product_cost")
    return [
        ("missing_key", F.col("product_key").isNull()),
        ("blank_name", name.isNull() | (F.trim(name) == "")),
        ("missing_price", price.isNull()),
        ("non_positive_price", price <= 0),
        ("missing_cost", cost.isNull()),
        ("cost_above_price", cost > price),
    ]


def flatten_categories(subcategories: DataFrame, categories: DataFrame) -> DataFrame:
    """Each subcategory with its category."""
    named = categories.withColumn("_category_key", F.col("product_category_key"))
    return lookup_join(subcategories, named, ["product_category_key"]).select(
        "product_subcategory_key",
        "subcategory_name",
        F.col("_category_key").alias("product_category_key"),
        "category_name",
    )


def products(
    history: DataFrame,
    subcategories: DataFrame,
    categories: DataFrame,
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Product versions with day-key intervals, current categories and normalised codes.

    Subcategory and category are those of today, not those of the version. The unknown
    member is what facts without a matching version point to.
    """
    versions = scd2.day_intervals(history, "product_key", rows_per_task=rows_per_task)
    flat = flatten_categories(subcategories, categories)
    dim = lookup_join(
        versions, flat, ["product_subcategory_key"], rows_per_task=rows_per_task
    ).select(
        F.col("version_key").alias("product_scd_key"),
        "product_key",
        "product_subcategory_key",
        "subcategory_name",
        "product_category_key",
        "category_name",
        "product_sku",
        "product_name",
        "model_name",
        "product_description",
        "product_color",
        product_size(F.col("product_size")).alias("product_size"),
        size_type(F.col("product_size")).alias("product_size_type"),
        style(F.col("product_style")).alias("product_style"),
        "product_cost",
        "product_price",
        "updated_key",
        "valid_from_key",
        "valid_to_key",
    )
    known = {
        "product_scd_key": UNKNOWN_VERSION,
        "product_key": UNKNOWN_KEY,
        "product_name": "Unknown",
        "product_size_type": "No Size",
        "product_style": NOT_AVAILABLE,
        "product_cost": 0,
        "product_price": 0,
        "updated_key": BEGINNING_OF_TIME,
        "valid_from_key": BEGINNING_OF_TIME,
    }
    unknown = dim.sparkSession.range(1).select(
        *[F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(unknown)
