"""The sales and returns facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.keys import UNKNOWN_KEY, UNKNOWN_VERSION
from sparkmart.operators.asof import asof_join
from sparkmart.operators.cdc import FIRST_LSN, latest_state
from sparkmart.operators.joins import BROADCAST_ROWS, ROWS_PER_TASK, lookup_join
from sparkmart.operators.merge import Summary, VersionedTable, Waiting, number_range_bucket
from sparkmart.session import materialise, workspace

SALES_KEYS = ("order_number", "order_line_item")
#: Version ids and log positions, which make up most of a row.
HEX_WIDTHS = (("product_scd_key", 32), ("lsn", 20), ("seqval", 20))
SALES_SCHEMA = (
    "order_number string, order_line_item bigint, order_date_key int, stock_date_key int, "
    "product_scd_key string, product_key bigint, customer_key bigint, territory_key bigint, "
    "order_quantity bigint, is_deleted boolean, lsn string, seqval string, "
    "customer_reference string"
)
#: What sales wait for when they come before their dimension row. Some sources know only a
#: reference of a new customer (an account number, say), and the key comes with the customer.
WAITING = (
    Waiting("product", "product_key", "product_scd_key", UNKNOWN_VERSION),
    Waiting("customer", "customer_reference", "customer_key", UNKNOWN_KEY),
)


def resolve(
    sales: DataFrame,
    dim_products: DataFrame,
    *,
    keys_from: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Point each sale to the product version valid on its order date.

    The version key is stored next to the natural one, so that queries join on equality. A
    sale without customer or territory goes to the unknown member. ``keys_from`` has at least
    the products of ``sales``, as often, and is cheaper to read.
    """
    found = asof_join(
        sales,
        dim_products,
        "product_key",
        "order_date_key",
        ["product_scd_key"],
        keys_from=keys_from,
        broadcast_rows=broadcast_rows,
        rows_per_task=rows_per_task,
    )
    reference = F.col("customer_reference") if "customer_reference" in sales.columns else F.lit(None)
    return found.select(
        "order_number",
        "order_line_item",
        "order_date_key",
        "stock_date_key",
        F.coalesce("product_scd_key", F.lit(UNKNOWN_VERSION)).alias("product_scd_key"),
        "product_key",
        F.coalesce("customer_key", F.lit(UNKNOWN_KEY).cast("bigint")).alias("customer_key"),
        F.coalesce("territory_key", F.lit(UNKNOWN_KEY).cast("bigint")).alias("territory_key"),
        "order_quantity",
        "is_deleted",
        "lsn",
        "seqval",
        reference.cast("string").alias("customer_reference"),
    )


def sales_base(
    staged: DataFrame, dim_products: DataFrame, lsn: str = FIRST_LSN, **tuning: int
) -> DataFrame:
    """The full build from the baseline table, positioned at the snapshot's checkpoint."""
    positioned = staged.withColumns(
        {"is_deleted": F.lit(False), "lsn": F.lit(lsn), "seqval": F.lit(FIRST_LSN)}
    )
    return resolve(positioned, dim_products, **tuning)


def sales_increment(staged_log: DataFrame, dim_products: DataFrame, **tuning: int) -> DataFrame:
    """The increment: last event per key, resolved, ready for the upsert.

    Deduplication comes first, so that superseded events are never looked up. Products with very
    many events are looked for in the log itself, which is not reduced for that.
    """
    tuning = {"keys_from": staged_log, **tuning}
    return resolve(latest_state(staged_log, SALES_KEYS), dim_products, **tuning)


def late_versions(sales: DataFrame, dim_products: DataFrame, **tuning: int) -> DataFrame:
    """Sales on the unknown product version, pointed to the version known by now.

    Rows that still have none are left out; the others keep their position, to be merged as
    corrections.
    """
    pending = sales.where(F.col("product_scd_key") == UNKNOWN_VERSION).drop("product_scd_key")
    return resolve(pending, dim_products, **tuning).where(
        F.col("product_scd_key") != UNKNOWN_VERSION
    )


def late_customers(sales: DataFrame, known: DataFrame) -> DataFrame:
    """Sales on the unknown customer whose reference is in ``known``, with its key.

    ``known`` has customer_reference and customer_key; of several keys for a reference the
    smallest one counts.
    """
    keys = (
        known.where(F.col("customer_reference").isNotNull() & (F.col("customer_key") != UNKNOWN_KEY))
        .groupBy("customer_reference")
        .agg(F.min("customer_key").alias("_found"))
    )
    pending = sales.where(F.col("customer_key") == UNKNOWN_KEY)
    found = lookup_join(pending, keys, ["customer_reference"], "inner")
    return found.withColumn("customer_key", F.col("_found")).select(*sales.columns)


def _correct(table: VersionedTable, found: DataFrame) -> None:
    spark = found.sparkSession
    table.upsert(materialise(found, workspace(spark, "repaired-sales")), corrects=True)


def repair_products(table: VersionedTable, dim_products: DataFrame) -> None:
    """Point stored sales that came before their product to its version.

    The fact's summaries tell which buckets hold rows that wait for a product known by now;
    those alone are read and rewritten.
    """
    known = dim_products.where(~F.col("product_scd_key").startswith("pending-"))
    names = known.select("product_key").where(F.col("product_key") != UNKNOWN_KEY)
    waiting = table.waiting_rows(known.sparkSession, "product", names)
    if waiting is not None:
        _correct(table, late_versions(waiting, known))


def repair_customers(table: VersionedTable, customers: DataFrame) -> None:
    """Give stored sales their customer's key once the customer has come.

    ``customers`` has customer_key and, else there is nothing to do, customer_reference. Buckets
    are found as in ``repair_products``.
    """
    if "customer_reference" not in customers.columns:
        return
    names = customers.select("customer_reference")
    waiting = table.waiting_rows(customers.sparkSession, "customer", names)
    if waiting is not None:
        _correct(table, late_customers(waiting, customers))


def sales_table(
    path: str,
    orders_per_bucket: int = 2_000_000,
    rows_per_file: int = 1_000_000,
    delete_mode: str = "soft",
) -> VersionedTable:
    """The sales fact as a versioned keyed table, bucketed by ranges of the order number.

    Increments concern recent orders, hence few buckets; old buckets are never rewritten.
    """
    return VersionedTable(
        path,
        T.StructType.fromDDL(SALES_SCHEMA),
        SALES_KEYS,
        number_range_bucket("order_number", orders_per_bucket),
        rows_per_file=rows_per_file,
        delete_mode=delete_mode,
        hex_widths=HEX_WIDTHS,
        waiting=WAITING,
        summaries=check_summaries(),
    )


def check_summaries() -> tuple[Summary, ...]:
    """What the checks ask of the fact; deleted sales count nowhere."""
    kept, day = ~F.col("is_deleted"), F.col("order_date_key")
    return (
        Summary("first_order", kept, F.col("product_key"), day),
        Summary("order_days", kept, day, day),
    )


def first_orders(sales: VersionedTable, spark: SparkSession) -> DataFrame:
    """product_key and order_date_key: its first order, once for each bucket that has one."""
    found = sales.summary(spark, "first_order")
    return found.select(
        F.col("key").cast("bigint").alias("product_key"), F.col("least").alias("order_date_key")
    )


def order_days(sales: VersionedTable, spark: SparkSession) -> DataFrame:
    """order_date_key and the number of sales n, once for each bucket that has any."""
    found = sales.summary(spark, "order_days")
    return found.select(F.col("least").cast("int").alias("order_date_key"), "n")


def live(sales: DataFrame) -> DataFrame:
    """Sales that have not been deleted."""
    return sales.where(~F.col("is_deleted"))


def returns(staged: DataFrame) -> DataFrame:
    """The returns fact: the staged columns as they are."""
    return staged.select("return_date_key", "territory_key", "product_key", "return_quantity")
