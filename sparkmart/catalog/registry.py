"""The registered queries: every operator run over the whole driver tables.

Each takes a session and the folder of the driver tables. Results are projected to plain
types (``portable``) so that they compare exactly across engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.catalog.derive import LAST_BASELINE_DAY, OBSERVATIONS, Shop, shop
from sparkmart.functions.decode import product_size, size_type, style
from sparkmart.functions.keys import UNKNOWN_KEY, date_key, version_id
from sparkmart.operators import cdc, checks, scd2
from sparkmart.operators.asof import asof_join, asof_merge
from sparkmart.operators.joins import lookup_join
from sparkmart.operators.merge import repair_keys
from sparkmart.operators.staging import staged
from sparkmart.plans import analytics, dims, facts, pipeline, star
from sparkmart.plans.calendar import spine_over
from sparkmart.session import materialise, workspace
from sparkmart.sources import files, loads, versions
from sparkmart.streaming.cdc_stream import cdc_to_fact, read_log_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Integers as bigint, decimals as double, dates and times as ISO text."""

    def plain(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        return c.alias(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str) -> Callable[[Callable[[Shop], DataFrame]], Callable[[Shop], DataFrame]]:
    """Register a function of the shop under ``name``."""

    def register(build: Callable[[Shop], DataFrame]) -> Callable[[Shop], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: portable(build(shop(spark, sf_dir)))
        return build

    return register


def _scratch(s: Shop, name: str) -> str:
    return workspace(s.spark, name)


# Sources and loads.


def _write_csv(df: DataFrame, path: str) -> None:
    # As exports have them: padded headers in mixed case, columns in another order, quotes doubled.
    untidy = df.toDF(*[f" {c.title()} " for c in df.columns])
    untidy = untidy.select(*[f"`{c}`" for c in reversed(untidy.columns)])
    untidy.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


@query("s1_csv_directory_load")
def _(s: Shop) -> DataFrame:
    """The row counts and the contents; names hold quotes, commas and line breaks."""
    folder, target, schemas = _scratch(s, "csv"), _scratch(s, "csv-loaded"), {}
    named = {"customer": "c_name", "nation": "n_name", "orders": "o_orderpriority"}
    for name, text in named.items():
        table = s.table(name)
        table = table.withColumn(text, F.concat(F.lit('a "b", '), F.col(text), F.lit("\n-")))
        _write_csv(table, f"{folder}/{name.title()}.csv")
        schemas[name] = table.schema
    counts = files.load_csv_dir(
        s.spark, folder, target, schemas, ["o_orderdate"], multi_line=True
    )
    keys = {"customer": "c_custkey", "nation": "n_nationkey", "orders": "o_orderkey"}
    contents = None
    for name, text in named.items():
        rows = s.spark.read.parquet(f"{target}/{name}").select(
            F.lit(name).alias("table_name"), F.col(keys[name]).cast("long").alias("key"), F.col(text).alias("text")
        )
        contents = rows if contents is None else contents.unionByName(rows)
    return contents.join(F.broadcast(counts), "table_name")  # one row per table


@query("s2_date_coercion")
def _(s: Shop) -> DataFrame:
    folder = _scratch(s, "dates")
    day = F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    orders = s.table("orders").select("o_orderkey", day.alias("o_orderdate"))
    _write_csv(orders, f"{folder}/orders.csv")
    loaded = files.read_csv(s.spark, f"{folder}/orders.csv", orders.schema, ["o_orderdate"])
    return loaded.select("o_orderkey", date_key("o_orderdate").alias("order_day"))


@query("s3_read_source")
def _(s: Shop) -> DataFrame:
    orders = files.read_source(s.spark, "parquet", f"{s.sf_dir}/orders.parquet")
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query("s4_replace_load")
def _(s: Shop) -> DataFrame:
    path, customer = _scratch(s, "replace"), s.table("customer").select("c_custkey", "c_acctbal")
    versions.replace(customer, path)
    versions.replace(versions.read(s.spark, path).where(F.col("c_acctbal") >= 0), path)
    return versions.read(s.spark, path)


@query("s5_append_load")
def _(s: Shop) -> DataFrame:
    """Two loads, the second one delivered twice."""
    path, log = _scratch(s, "append"), s.raw_log
    late = log.where(F.col("stock_date") > F.lit(LAST_BASELINE_DAY))
    loads.load_append(log.where(F.col("stock_date") <= F.lit(LAST_BASELINE_DAY)), path, "001")
    loads.load_append(late, path, "002")
    loads.load_append(late, path, "002")
    return (
        loads.read_loads(s.spark, path, log.schema)
        .groupBy("load_id")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("order_quantity").alias("quantity"))
    )


@query("s6_read_since")
def _(s: Shop) -> DataFrame:
    return s.increment()


@query("s7_checkpoint")
def _(s: Shop) -> DataFrame:
    baseline = s.staged_log.where(F.col("stock_date_key") <= date_key(F.lit(LAST_BASELINE_DAY)))
    return cdc.checkpoint(baseline, "sales", "baseline")


@query("s8_load_once")
def _(s: Shop) -> DataFrame:
    """The second load offers all days again and brings only those not yet there."""
    path = _scratch(s, "archives")
    events = s.table("events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("archive")
    )
    loads.append_unseen(events.where(F.col("archive") < "2024-01-16"), path, "archive", "first")
    loads.append_unseen(events, path, "archive", "second")
    return (
        loads.read_loads(s.spark, path, events.schema)
        .groupBy("load_id", "archive")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query("s9_load_audit")
def _(s: Shop) -> DataFrame:
    path = _scratch(s, "audit")
    tables = {"customers": s.customers(), "products": s.raw_products, "returns": s.raw_returns}
    loads.audit(path, "day1", "loaded", tables)
    loads.audit(path, "day2", "loaded", tables | {"products": s.raw_products.drop("product_sku")})
    audited = loads.read_loads(s.spark, path)
    digest = F.col("schema_version_hash")
    others = Window.partitionBy("schema_name")
    return audited.select(
        "load_id", "schema_name", "status", "row_count",
        F.length(digest).alias("hash_length"),
        (F.min(digest).over(others) == F.max(digest).over(others)).alias("same_schema"),
        F.size(F.collect_set(digest).over(Window.partitionBy("load_id"))).alias("hashes"),
    )


@query("s13_date_spine")
def _(s: Shop) -> DataFrame:
    return spine_over([(s.table("orders"), "o_orderdate"), (s.table("lineitem"), "l_shipdate")])


@query("s14_snapshot_diff")
def _(s: Shop) -> DataFrame:
    current = cdc.latest_state(s.staged_log, facts.SALES_KEYS).where(~F.col("is_deleted"))
    baseline = staged("sales", s.raw_sales)
    return cdc.snapshot_diff(baseline, current.select(*baseline.columns), facts.SALES_KEYS)


@query("s14_stored_snapshot_diff")
def _(s: Shop) -> DataFrame:
    """Both snapshots stored with checksums by bucket; only buckets that differ are compared."""
    current = cdc.latest_state(s.staged_log, facts.SALES_KEYS).where(~F.col("is_deleted"))
    baseline = staged("sales", s.raw_sales)
    old, new = _scratch(s, "snapshot-old"), _scratch(s, "snapshot-new")
    buckets = max(16, s.log_rows // 1_000_000)
    cdc.store_snapshot(baseline, old, facts.SALES_KEYS, buckets)
    cdc.store_snapshot(current.select(*baseline.columns), new, facts.SALES_KEYS, buckets)
    return cdc.stored_diff(s.spark, old, new, facts.SALES_KEYS)


# Staging and expressions.


@query("p1_staged_customers")
def _(s: Shop) -> DataFrame:
    return staged("customers", s.customers())


@query("p1_staged_products")
def _(s: Shop) -> DataFrame:
    return staged("products", s.products())


@query("p1_staged_product_categories")
def _(s: Shop) -> DataFrame:
    return staged("product_categories", s.product_categories())


@query("p1_staged_product_subcategories")
def _(s: Shop) -> DataFrame:
    return staged("product_subcategories", s.product_subcategories())


@query("p1_staged_territories")
def _(s: Shop) -> DataFrame:
    return staged("territories", s.territories())


@query("p1_staged_returns")
def _(s: Shop) -> DataFrame:
    return staged("returns", s.raw_returns)


@query("p1_staged_sales")
def _(s: Shop) -> DataFrame:
    return staged("sales", s.raw_sales)


@query("p1_staged_sales_log")
def _(s: Shop) -> DataFrame:
    return staged("sales_log", s.sales_log())


@query("p5_decode_customers")
def _(s: Shop) -> DataFrame:
    return dims.decode_customers(staged("customers", s.customers())).select(
        "customer_key", "marital_status", "gender", "is_home_owner"
    )


@query("p6_p7_product_codes")
def _(s: Shop) -> DataFrame:
    size = F.col("product_size")
    return staged("products", s.products()).select(
        "product_sku",
        product_size(size).alias("product_size"),
        size_type(size).alias("product_size_type"),
        style(F.col("product_style")).alias("product_style"),
    )


@query("f1_date_key")
def _(s: Shop) -> DataFrame:
    return s.table("orders").select("o_orderkey", date_key("o_orderdate").alias("order_day"))


@query("f14_version_id")
def _(s: Shop) -> DataFrame:
    return s.observed.select(
        "product_key", "observed_on", version_id("product_key", "observed_on").alias("version_key")
    )


# Joins.


def _asof(s: Shop, **tuning: int) -> DataFrame:
    log = s.staged_log.select(
        "order_number", "order_line_item", "op", "lsn", "seqval", "product_key", "order_date_key"
    )
    return asof_join(
        log, s.dim_products, "product_key", "order_date_key", ["product_scd_key"], **tuning
    ).drop("product_key", "order_date_key")


@query("j1_asof_join")
def _(s: Shop) -> DataFrame:
    return _asof(s)


@query("j1_asof_join_salted")
def _(s: Shop) -> DataFrame:
    """The way taken for large dimensions: shuffled, products above 1/2000 of the rows salted."""
    return _asof(s, broadcast_rows=0, rows_per_task=max(1, s.log_rows // 2000))


@query("j1_asof_join_merged")
def _(s: Shop) -> DataFrame:
    """The way for keys with many versions: one sorted stream per key, hot ones in stretches."""
    log = s.staged_log.select(
        "order_number", "order_line_item", "op", "lsn", "seqval", "product_key", "order_date_key"
    )
    return asof_merge(
        log,
        s.dim_products,
        "product_key",
        "order_date_key",
        ["product_scd_key"],
        rows_per_task=max(1, s.log_rows // 500),
    ).drop("product_key", "order_date_key")


@query("j2_flatten_categories")
def _(s: Shop) -> DataFrame:
    return dims.flatten_categories(
        staged("product_subcategories", s.product_subcategories()),
        staged("product_categories", s.product_categories()),
    )


# Warehouse operators.


@query("m1_latest_state")
def _(s: Shop) -> DataFrame:
    return cdc.latest_state(s.staged_log, facts.SALES_KEYS)


def _fact(sales: DataFrame) -> DataFrame:
    """The fact without its bucket and the reference of customers, which these sources lack."""
    return sales.drop("bucket", "customer_reference")


def _merged(s: Shop, delete_mode: str) -> DataFrame:
    table = s.sales_table(_scratch(s, "fct_sales"), delete_mode)
    table.replace(s.sales_base(), keys_from=s.raw_sales)
    increment = s.increment()
    table.upsert(facts.sales_increment(increment, s.dim_products), keys_from=increment)
    return _fact(table.read(s.spark))


@query("m2_upsert")
def _(s: Shop) -> DataFrame:
    return _merged(s, "soft")


@query("m2_upsert_hard_delete")
def _(s: Shop) -> DataFrame:
    return _merged(s, "hard")


@query("m3_dim_calendar")
def _(s: Shop) -> DataFrame:
    return s.dim_calendar


@query("m4_scd2_from_history")
def _(s: Shop) -> DataFrame:
    return scd2.from_history(s.observed, "product_key", dims.TRACKED, "observed_on")


@query("m4_scd2_apply")
def _(s: Shop) -> DataFrame:
    """One run per observation day, each rewriting the open versions and adding closed ones."""
    history = scd2.History(_scratch(s, "snapshots"), "product_key", dims.TRACKED)
    for day in OBSERVATIONS:
        seen = s.observed.where(F.col("observed_on") == F.lit(day)).drop("observed_on")
        history.observe(seen, day)
    return history.read(s.spark)


def _event_history(s: Shop, **tuning: int) -> DataFrame:
    log = s.table("events").select("user_id", "event_type", "ts")
    micro = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return scd2.from_history(log, "user_id", ["event_type"], "ts", **tuning).select(
        "user_id",
        "event_type",
        F.date_format("valid_from", micro).alias("valid_from"),
        F.date_format("valid_to", micro).alias("valid_to"),
    )


@query("m4_scd2_events")
def _(s: Shop) -> DataFrame:
    return _event_history(s)


@query("m4_scd2_events_split")
def _(s: Shop) -> DataFrame:
    """Users with more than 1/500 of the events cut into stretches."""
    return _event_history(s, rows_per_task=max(1, s.table("events").count() // 500))


@query("m5_inferred_members")
def _(s: Shop) -> DataFrame:
    log = s.staged_log
    customers = dims.customers(staged("customers", s.arrived_customers()), log.select("customer_key"))
    territories = dims.territories(
        staged("territories", s.arrived_territories()), log.select("territory_key")
    )
    return (
        customers.where("is_inferred")
        .select(F.lit("customer").alias("dimension"), F.col("customer_key").alias("member_key"))
        .unionByName(
            territories.where("is_inferred").select(
                F.lit("territory").alias("dimension"), F.col("territory_key").alias("member_key")
            )
        )
    )


@query("m6_accepted_products")
def _(s: Shop) -> DataFrame:
    return s.split_products[0]


@query("m6_quarantined_products")
def _(s: Shop) -> DataFrame:
    return s.split_products[1]


@query("m7_repair_keys")
def _(s: Shop) -> DataFrame:
    """Customers without a profile arrive after their sales have been loaded."""
    reference = F.concat(F.lit("C-"), F.col("customer_key").cast("string"))
    known = s.dim_customers.where(~F.col("is_inferred") & (F.col("customer_key") >= 0)).select(
        "customer_key", F.col("customer_key").alias("_known")
    )
    sales = s.fct_sales.select("order_number", "order_line_item", "customer_key").withColumn(
        "customer_reference", F.when(F.col("customer_key") != UNKNOWN_KEY, reference)
    )
    loaded = lookup_join(sales, known, ["customer_key"]).select(
        "order_number",
        "order_line_item",
        "customer_reference",
        F.coalesce("_known", F.lit(UNKNOWN_KEY).cast("bigint")).alias("customer_key"),
    )
    arrived = s.table("customer").select(F.col("c_custkey").alias("customer_key")).withColumn(
        "customer_reference", reference
    )
    return repair_keys(loaded, arrived, "customer_reference", "customer_key").drop(
        "customer_reference"
    )


@query("m7_repair_stored_fact")
def _(s: Shop) -> DataFrame:
    """The stored fact after customers have come who were known by reference only.

    Customers with a negative balance have no key in the log. Two increments are loaded, the
    customers arrive, and the repair reads and rewrites the buckets with waiting rows.
    """
    table = s.sales_table(_scratch(s, "fct_sales_references"))
    arrived = s.table("customer").select("c_custkey", (F.col("c_acctbal") >= 0).alias("_known"))
    named = F.concat(F.lit("C-"), F.col("customer_key").cast("string"))
    log = lookup_join(
        s.staged_log.withColumn("customer_reference", named),
        arrived.withColumnRenamed("c_custkey", "customer_key"),
        ["customer_key"],
    ).withColumn("customer_key", F.when(F.col("_known"), F.col("customer_key")))
    log = materialise(log.drop("_known"), _scratch(s, "log-references"))
    early = F.col("stock_date_key") <= date_key(F.lit(LAST_BASELINE_DAY))
    for events in (log.where(early), log.where(~early)):
        table.upsert(facts.sales_increment(events, s.dim_products), keys_from=events)
        versions.vacuum(s.spark, table.path, last=1)
    customers = s.table("customer").select(
        F.col("c_custkey").alias("customer_key"),
        F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("customer_reference"),
    )
    facts.repair_customers(table, customers)
    versions.vacuum(s.spark, table.path, last=1)
    return table.read(s.spark).select(
        "order_number", "order_line_item", "customer_key", "is_deleted", "lsn"
    )


@query("m8_dim_products")
def _(s: Shop) -> DataFrame:
    return dims.products(
        s.history,
        staged("product_subcategories", s.raw_subcategories),
        staged("product_categories", s.raw_categories),
    )


@query("m9_sales_base")
def _(s: Shop) -> DataFrame:
    return _fact(s.sales_base())


@query("m10_sales_increment")
def _(s: Shop) -> DataFrame:
    return _fact(facts.sales_increment(s.increment(), s.dim_products))


@query("m11_dim_customers")
def _(s: Shop) -> DataFrame:
    return dims.customers(staged("customers", s.arrived_customers()), s.staged_log.select("customer_key"))


@query("m11_dim_territories")
def _(s: Shop) -> DataFrame:
    return dims.territories(
        staged("territories", s.arrived_territories()), s.staged_log.select("territory_key")
    )


@query("m12_fct_returns")
def _(s: Shop) -> DataFrame:
    return facts.returns(staged("returns", s.raw_returns))


# Checks.

#: The morning on which the sales are looked at.
AS_OF = date(2001, 8, 2)


@query("q0_column_checks")
def _(s: Shop) -> DataFrame:
    products = staged("products", s.raw_products)
    required = ("product_key", "product_name", "product_style", "product_cost", "product_price")
    rules = [
        checks.Check(f"products.{c}.not_null", products, checks.not_null(c)) for c in required
    ]
    rules.append(
        checks.Check(
            "products.product_size.accepted_values",
            products,
            checks.accepted_values("product_size", ["0", "M", "XL"]),
        )
    )
    return checks.run(rules)


@query("q0_staging_checks")
def _(s: Shop) -> DataFrame:
    audited = _scratch(s, "staging-audit")
    loads.audit(audited, "day1", "loaded", {"customers": s.customers()})
    tables = {
        "sales": staged("sales", s.raw_sales),
        "sales_log": cdc.latest_state(s.staged_log, facts.SALES_KEYS),
        "customers": staged("customers", s.customers()),
        "products": staged("products", s.raw_products),
        "territories": staged("territories", s.territories()),
        "returns": staged("returns", s.raw_returns),
        "product_categories": staged("product_categories", s.raw_categories),
        "product_subcategories": staged("product_subcategories", s.raw_subcategories),
        "date_spine": s.dim_calendar.select("full_date"),
        "loads": loads.read_loads(s.spark, audited),
    }
    return checks.run(star.staging_checks(tables))


@query("q0b_duplicates")
def _(s: Shop) -> DataFrame:
    return checks.duplicates(s.table("lineitem"), "l_orderkey", "l_linenumber")


@query("q1_scd2_overlaps")
def _(s: Shop) -> DataFrame:
    """Ends moved to one day, so that versions after it overlap with the ones before."""
    wrong = F.when(F.col("valid_to_key").isNotNull(), F.lit(19980101))
    return checks.scd2_overlaps(s.dim_products.withColumn("valid_to_key", wrong), "product_key")


@query("q2_future_birth_date")
def _(s: Shop) -> DataFrame:
    return checks.future_dates(s.dim_customers, "birth_date", date(1942, 1, 1)).select(
        "customer_key", "birth_date"
    )


@query("q3_duplicate_versions")
def _(s: Shop) -> DataFrame:
    return checks.duplicates(s.dim_products, "product_key")


@query("q4_orphans")
def _(s: Shop) -> DataFrame:
    return checks.orphans(s.fct_returns, "product_key", s.dim_products, "product_key")


@query("q5_returned_before_ordered")
def _(s: Shop) -> DataFrame:
    return checks.returned_before_ordered(s.fct_sales, s.fct_returns)


@query("q6_stale")
def _(s: Shop) -> DataFrame:
    return checks.stale(s.fct_sales, "order_date_key", date(2001, 9, 3))


def _event_days(s: Shop) -> DataFrame:
    return s.table("events").select(F.col("ts").cast("date").alias("day"))


@query("q7_volume_stats")
def _(s: Shop) -> DataFrame:
    return checks.volume_stats(_event_days(s), "day", date(2024, 1, 31))


@query("q7_volume_anomaly")
def _(s: Shop) -> DataFrame:
    """Seen three days after the events have stopped."""
    return checks.volume_anomaly(_event_days(s), "day", date(2024, 2, 3))


@query("q8_negative_margin")
def _(s: Shop) -> DataFrame:
    products = staged("products", s.raw_products)
    return checks.negative_margins(products, "product_price", "product_cost").select(
        "product_sku", "product_price", "product_cost"
    )


@query("q9_all_checks")
def _(s: Shop) -> DataFrame:
    return checks.run(star.all_checks(s.star, AS_OF))


@query("q10_gated_fact_checks")
def _(s: Shop) -> DataFrame:
    results = checks.run(star.sales_checks(s.star))
    checks.gate(results)
    return results


# Business questions.


@query("a1_gross_revenue")
def _(s: Shop) -> DataFrame:
    return analytics.gross_revenue(s.fct_sales, s.dim_products)


@query("a1_gross_revenue_per_version")
def _(s: Shop) -> DataFrame:
    return analytics.gross_revenue_per_version(s.fct_sales, s.dim_products)


@query("a2_revenue_by_category")
def _(s: Shop) -> DataFrame:
    return analytics.revenue_by_category(s.fct_sales, s.dim_products)


@query("a4_returned_quantity")
def _(s: Shop) -> DataFrame:
    return analytics.returned_quantity(s.fct_returns, s.dim_calendar)


@query("a5_products_by_color")
def _(s: Shop) -> DataFrame:
    return analytics.products_by_color(s.dim_products)


@query("a6_margin_by_subcategory")
def _(s: Shop) -> DataFrame:
    return analytics.margin_by_subcategory(s.fct_sales, s.dim_products)


@query("a7_revenue_trend")
def _(s: Shop) -> DataFrame:
    return analytics.revenue_trend(s.fct_sales, s.dim_products)


@query("a8_customer_segments")
def _(s: Shop) -> DataFrame:
    return analytics.customer_segments(s.fct_sales, s.dim_products, AS_OF)


# Streaming and jobs.


def _log_slices(s: Shop) -> list[DataFrame]:
    """The raw log in four slices by day."""
    year, log = F.year("stock_date"), s.raw_log
    return [
        log.where(year <= 1996),
        log.where(year == 1997),
        log.where((year > 1997) & (year < 2000)),
        log.where(year >= 2000),
    ]


@query("t1_cdc_stream")
def _(s: Shop) -> DataFrame:
    """The log arrives in four parts, with a run of the stream after each two."""
    folder = _scratch(s, "stream")
    table, slices = s.sales_table(f"{folder}/fct_sales"), _log_slices(s)
    dim_products = s.dim_products
    for first in (0, 2):
        for i in (first, first + 1):
            loads.load_append(slices[i], f"{folder}/log", f"part{i}")
        stream = read_log_stream(s.spark, f"{folder}/log", s.raw_log.schema)
        cdc_to_fact(stream, lambda _: dim_products, table, f"{folder}/progress").awaitTermination()
    return _fact(table.read(s.spark))


@query("t3_out_of_order_increments")
def _(s: Shop) -> DataFrame:
    """Increments delivered newest first, the newest once more at the end.

    No one reads the fact in between, so each increment's version goes with the next one.
    """
    table = s.sales_table(_scratch(s, "late"))
    slices = _log_slices(s)
    for part in (*reversed(slices), slices[-1]):
        events = staged("sales_log", part)
        table.upsert(facts.sales_increment(events, s.dim_products), keys_from=events)
        versions.vacuum(s.spark, table.path, last=1)
    return _fact(table.read(s.spark))


@query("t3_compacted_increments")
def _(s: Shop) -> DataFrame:
    """Increments out of order, with a compaction once all of the first two have arrived.

    Marks of deleted rows below that position are forgotten, and the log that is kept holds the
    last event of each key; it is loaded again at the end, after the later increments.
    """
    table = s.sales_table(_scratch(s, "compacted"), "hard")
    first, second, third, fourth = (staged("sales_log", part) for part in _log_slices(s))

    def load(events: DataFrame) -> None:
        table.upsert(facts.sales_increment(events, s.dim_products), keys_from=events)

    load(second)
    load(first)
    settled = first.unionByName(second)
    mark = cdc.cursor(cdc.checkpoint(settled, "sales", "mark"), "sales")
    kept = materialise(cdc.compact_log(settled, facts.SALES_KEYS, mark), _scratch(s, "kept-log"))
    table.forget(s.spark, mark)
    load(fourth)
    load(third)
    load(kept)
    return _fact(table.read(s.spark))


def _warehouse(s: Shop) -> tuple[pipeline.Warehouse, DataFrame]:
    """First two daily refreshes, then the first load, then the increment job, all gated.

    Sales keep the product version they were resolved to, so the history must be complete
    before the baseline is; the daily refreshes therefore run first. Some customers and
    territories arrive with the last day only. Gives the results of the last checks too.
    """
    if "jobs" in s.__dict__:
        return s.__dict__["jobs"]
    wh = pipeline.Warehouse(s.spark, _scratch(s, "warehouse"))
    seen, last = s.observed, OBSERVATIONS[-1]
    # Returned lines of the driver tables were never sold before, and at the smallest scale the
    # last day has a single sale, which is less than 30 % of the usual number.
    known = ("fct_returns.after_first_order", "fct_sales.volume")

    def sources(day: date) -> dict[str, DataFrame]:
        return {
            "customers": s.customers() if day == last else s.arrived_customers(),
            "product_categories": s.raw_categories,
            "product_subcategories": s.raw_subcategories,
            "products": seen.where(F.col("observed_on") == F.lit(day)).drop("observed_on"),
            "returns": s.raw_returns,
            "territories": s.territories() if day == last else s.arrived_territories(),
            "sales": s.raw_sales,
        }

    for day in OBSERVATIONS[:-1]:
        pipeline.refresh_dimensions(wh, sources(day), day, f"day-{day}", accepted=known)
    baseline = s.baseline_log().select(*s.raw_log.columns)
    pipeline.bootstrap(wh, sources(last), baseline, last, f"day-{last}", accepted=known)
    results = pipeline.run_increment(
        wh, s.raw_log, "increment-1", as_of=AS_OF, accepted=known
    )
    s.__dict__["jobs"] = (wh, results)
    return wh, results


@query("t2_warehouse_jobs")
def _(s: Shop) -> DataFrame:
    return _fact(_warehouse(s)[0].star().sales)


@query("t2_job_checks")
def _(s: Shop) -> DataFrame:
    """What the checks of the increment found, freshness and volume included."""
    return _warehouse(s)[1].select("name", "severity", "failures", "status")


@query("t2_job_calendar")
def _(s: Shop) -> DataFrame:
    """The days of the calendar after the jobs: all that facts have, without gaps."""
    return _warehouse(s)[0].mart("dim_calendar").select("full_date")


@query("t2_job_customers")
def _(s: Shop) -> DataFrame:
    return _warehouse(s)[0].mart("dim_customers").select("customer_key", "is_inferred")


@query("f15_binary_position")
def _(s: Shop) -> DataFrame:
    """Binary log positions as text that sorts alike."""
    position = F.unhex(F.lpad(F.hex("l_orderkey"), 20, "0"))
    return s.table("lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
        cdc.hex_lsn(position).alias("position"),
    )
