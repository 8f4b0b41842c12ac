"""The retail source tables, derived from the given driver tables.

Every row of the driver tables takes part. Defects the checks should find (missing keys,
blank names, prices out of order) are planted by rules on the values, and the customer and
territory sources lack members that the sales refer to.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.keys import date_key
from sparkmart.operators import quality, scd2
from sparkmart.operators.cdc import (
    AFTER,
    BEFORE,
    DELETE,
    INSERT,
    checkpoint,
    cursor,
    latest_state,
    read_since,
)
from sparkmart.operators.joins import lookup_join
from sparkmart.operators.merge import VersionedTable
from sparkmart.operators.staging import staged
from sparkmart.plans import dims, facts
from sparkmart.plans.calendar import dim_calendar, spine_over
from sparkmart.plans.star import Star
from sparkmart.session import allow_for, allow_scans, materialise, workspace

#: Changes up to this day belong to the baseline, later ones come as increments.
LAST_BASELINE_DAY = date(1997, 12, 31)
#: Days on which the product source was observed.
OBSERVATIONS = (date(1995, 1, 1), date(1997, 7, 1), date(1999, 7, 1))


def _hex10(number: Column) -> Column:
    return F.lower(F.lpad(F.hex(number), 10, "0"))


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") / 100).cast("decimal(18,2)")


class Sources:
    """Driver tables and the raw source tables derived from them; nothing is computed yet."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def order_lines(self) -> DataFrame:
        """Order lines with the date, customer and nation of their order."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        customer = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"), "c_nationkey"
        )
        headers = lookup_join(orders, customer, ["o_custkey"], "inner").withColumnRenamed(
            "o_orderkey", "l_orderkey"
        )
        lines = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
            "l_shipdate",
        )
        rows = lines.count()
        allow_for(self.spark, rows)
        allow_scans(self.spark, rows)
        return lookup_join(lines, headers, ["l_orderkey"], "inner", sized_by=orders)

    def sales_log(self, lines: DataFrame | None = None) -> DataFrame:
        """Change rows of order lines: inserts, deletes, and updates with both images."""
        lines = self.order_lines() if lines is None else lines
        flag = F.col("l_returnflag")
        operations = (
            F.when(flag == "R", F.array(F.lit(DELETE)))
            .when(flag == "N", F.array(F.lit(INSERT)))
            .otherwise(F.array(F.lit(BEFORE), F.lit(AFTER)))
        )
        quantity = F.col("l_quantity").cast("bigint")
        return lines.select("*", F.explode(operations).alias("_operation")).select(
            F.concat(F.lit("SO-"), F.col("l_orderkey").cast("string")).alias("order_number"),
            F.col("l_linenumber").alias("order_line_item"),
            F.col("o_orderdate").alias("order_date"),
            F.col("l_shipdate").alias("stock_date"),
            F.col("l_partkey").alias("product_key"),
            F.when(F.col("l_orderkey") % 50 != 0, F.col("o_custkey")).alias("customer_key"),
            F.col("c_nationkey").alias("territory_key"),
            F.when(F.col("_operation") == BEFORE, quantity + 1)
            .otherwise(quantity)
            .alias("order_quantity"),
            "_operation",
            F.lower(F.lpad(F.hex(date_key("l_shipdate").cast("bigint")), 20, "0")).alias("_start_lsn"),
            F.concat(_hex10(F.col("l_partkey")), _hex10(F.col("l_suppkey"))).alias("_seqval"),
        )

    def products(self) -> DataFrame:
        part, key = self.table("part"), F.col("p_partkey")
        base = F.round(F.col("p_retailprice") * 100).cast("bigint")
        price = (
            F.when(key % 97 == 96, F.lit(None))
            .when(key % 79 == 78, F.lit(-100))
            .otherwise(base)
        )
        cost = F.when(
            key % 89 != 88, F.floor(base * (key % 11 + 1) / 10).cast("bigint")
        )
        words = F.split("p_name", " ")
        return part.select(
            F.when(key % 101 != 100, key).alias("product_key"),
            _subcategory_key().alias("product_subcategory_key"),
            F.concat(F.lit("SKU-"), key.cast("string")).alias("product_sku"),
            F.when(key % 83 == 82, F.lit(" ")).otherwise(F.col("p_name")).alias("product_name"),
            words[1].alias("model_name"),
            F.concat_ws(" by ", "p_name", "p_brand").alias("product_description"),
            words[0].alias("product_color"),
            F.when(F.col("p_size") % 4 == 0, F.lit("0"))
            .when(F.col("p_size") % 4 == 1, F.lit("M"))
            .when(F.col("p_size") % 4 == 2, F.col("p_size").cast("string"))
            .otherwise(F.lit("XL"))
            .alias("product_size"),
            F.when(key % 5 == 0, F.lit("U"))
            .when(key % 5 == 1, F.lit("W"))
            .when(key % 5 == 2, F.lit("M"))
            .when(key % 5 == 3, F.lit("0"))
            .alias("product_style"),
            _money(cost).alias("product_cost"),
            _money(price).alias("product_price"),
        )

    def product_subcategories(self) -> DataFrame:
        return (
            self.table("part")
            .select("p_brand", "p_type")
            .distinct()
            .select(
                _subcategory_key().alias("product_subcategory_key"),
                F.concat_ws(" ", "p_brand", "p_type").alias("subcategory_name"),
                _category_key().alias("product_category_key"),
            )
        )

    def product_categories(self) -> DataFrame:
        return (
            self.table("part")
            .select("p_type")
            .distinct()
            .select(
                _category_key().alias("product_category_key"),
                F.col("p_type").alias("category_name"),
            )
        )

    def arrived_customers(self) -> DataFrame:
        """Customers with a non-negative balance; the others play late-arriving profiles."""
        return self.customers().where(F.col("annual_income") >= 0)

    def customers(self) -> DataFrame:
        """All customers."""
        key, segment = F.col("c_custkey"), F.col("c_mktsegment")
        gender = F.when(key % 3 == 0, F.lit("M")).when(key % 3 == 1, F.lit("F"))
        return (
            self.table("customer")
            .select(
                key.alias("customer_key"),
                F.when(gender == "M", F.lit("MR."))
                .when(gender == "F", F.lit("MS."))
                .alias("prefix"),
                F.split("c_name", "#")[0].alias("first_name"),
                F.split("c_name", "#")[1].alias("last_name"),
                F.date_add(F.lit(date(1940, 1, 1)), (key % 20000).cast("int")).alias("birth_date"),
                F.when(segment == "BUILDING", F.lit("S"))
                .when(segment == "AUTOMOBILE", F.lit("M"))
                .when(segment == "MACHINERY", F.lit("D"))
                .when(segment == "HOUSEHOLD", F.lit("W"))
                .otherwise(F.lit("X"))
                .alias("marital_status"),
                gender.alias("gender"),
                F.concat(F.lower(F.translate("c_name", "#", ".")), F.lit("@example.com")).alias(
                    "email_address"
                ),
                F.col("c_acctbal").alias("annual_income"),
                (key % 6).alias("total_children"),
                F.initcap(segment).alias("education_level"),
                F.lower(segment).alias("occupation"),
                F.when(key % 13 == 0, F.lit(None))
                .when(F.col("c_acctbal") < 5000, F.lit("N"))
                .otherwise(F.lit("Y"))
                .alias("home_owner"),
            )
        )

    def arrived_territories(self) -> DataFrame:
        """Nations of all regions but one, which play master data that comes late."""
        return self.territories().where(F.col("country") != "MIDDLE EAST")

    def territories(self) -> DataFrame:
        """All nations. Nations and regions do not grow with the data."""
        return (
            self.table("nation")
            .join(F.broadcast(self.table("region")), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").alias("sales_territory_key"),
                F.col("n_name").alias("region"),
                F.col("r_name").alias("country"),
                F.col("r_name").alias("continent"),
            )
        )


def _category_key() -> Column:
    return F.ascii("p_type") + F.length("p_type")


def _subcategory_key() -> Column:
    return F.regexp_extract("p_brand", "([0-9]+)", 1).cast("bigint") * 1000 + _category_key()


def observations(accepted: DataFrame) -> DataFrame:
    """What the product source showed on each observation day.

    Every third product becomes dearer at the second observation, every fifth cheaper to
    make at the third, and products with frame sizes above 40 are gone by then.
    """
    key, day = F.col("product_key"), F.col("observed_on")
    price = F.when(
        (key % 3 == 0) & (day >= F.lit(OBSERVATIONS[1])),
        (F.floor(F.col("product_price") * 110) / 100).cast("decimal(18,2)"),
    ).otherwise(F.col("product_price"))
    cost = F.when(
        (key % 5 == 0) & (day >= F.lit(OBSERVATIONS[2])),
        (F.floor(F.col("product_cost") * 90) / 100).cast("decimal(18,2)"),
    ).otherwise(F.col("product_cost"))
    days = F.array(*[F.lit(d) for d in OBSERVATIONS])
    gone = F.col("product_size").try_cast("int") > 40
    return (
        accepted.select("*", F.explode(days).alias("observed_on"))
        .where(~(F.coalesce(gone, F.lit(False)) & (day >= F.lit(OBSERVATIONS[2]))))
        .withColumns({"product_price": price, "product_cost": cost})
    )


class Shop(Sources):
    """The warehouse over one scale of driver tables.

    Each table is written when first asked for, as the jobs would, and read from then on.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(spark, sf_dir)
        self.root = workspace(spark, "shop")

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        return materialise(df, f"{self.root}/{name}")

    @cached_property
    def raw_log(self) -> DataFrame:
        """The change log in log order, as capture delivers it.

        Files then cover disjoint ranges of positions, and reading on from a position skips
        the older ones. Parts and suppliers split a day that has very many changes. The
        narrow order lines are shuffled and only then spelled out as log rows.
        """
        position = ("l_shipdate", "l_partkey", "l_suppkey")
        lines = self.order_lines().repartitionByRange(*position).sortWithinPartitions(*position)
        return self._written("raw/sales_log", self.sales_log(lines))

    @property
    def staged_log(self) -> DataFrame:
        return staged("sales_log", self.raw_log)

    @cached_property
    def raw_products(self) -> DataFrame:
        return self._written("raw/products", self.products())

    @cached_property
    def raw_subcategories(self) -> DataFrame:
        return self._written("raw/product_subcategories", self.product_subcategories())

    @cached_property
    def raw_categories(self) -> DataFrame:
        return self._written("raw/product_categories", self.product_categories())

    @cached_property
    def raw_sales(self) -> DataFrame:
        """The baseline: the sales table as it stood at the end of the last baseline day."""
        final = latest_state(self.baseline_log(), facts.SALES_KEYS)
        columns = [c for c in self.raw_log.columns if not c.startswith("_")]
        keyed = final.where(~F.col("is_deleted"))
        return self._written("raw/sales", keyed.select(*columns))

    @cached_property
    def raw_returns(self) -> DataFrame:
        """Goods of deleted lines, per day, territory and product."""
        returned = (
            self.raw_log.where(F.col("_operation") == DELETE)
            .groupBy(F.col("stock_date").alias("return_date"), "territory_key", "product_key")
            .agg(F.sum("order_quantity").alias("return_quantity"))
        )
        return self._written("raw/returns", returned)

    def baseline_log(self) -> DataFrame:
        """Raw log rows of the baseline, under the names ``latest_state`` expects."""
        return self.raw_log.where(F.col("stock_date") <= F.lit(LAST_BASELINE_DAY)).withColumns(
            {"op": F.col("_operation"), "lsn": F.col("_start_lsn"), "seqval": F.col("_seqval")}
        )

    @cached_property
    def checkpoint_lsn(self) -> str:
        """The log position at which the baseline was taken."""
        return cursor(checkpoint(self.baseline_log(), "sales", "baseline"), "sales")

    def increment(self) -> DataFrame:
        """Staged changes after the baseline."""
        return read_since(self.staged_log, self.checkpoint_lsn)

    @property
    def split_products(self) -> tuple[DataFrame, DataFrame]:
        return quality.split(
            staged("products", self.raw_products),
            dims.product_rules(),
            F.to_timestamp_ntz(F.lit(str(OBSERVATIONS[0]))),
        )

    @cached_property
    def observed(self) -> DataFrame:
        return self._written("raw/product_observations", observations(self.split_products[0]))

    @cached_property
    def history(self) -> DataFrame:
        return self._written(
            "snapshots/products",
            scd2.from_history(self.observed, "product_key", dims.TRACKED, "observed_on"),
        )

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._written(
            "marts/dim_products",
            dims.products(
                self.history,
                staged("product_subcategories", self.raw_subcategories),
                staged("product_categories", self.raw_categories),
            ),
        )

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._written(
            "marts/dim_customers",
            dims.customers(
                staged("customers", self.arrived_customers()), self.staged_log.select("customer_key")
            ),
        )

    @cached_property
    def dim_territories(self) -> DataFrame:
        return self._written(
            "marts/dim_territories",
            dims.territories(
                staged("territories", self.arrived_territories()), self.staged_log.select("territory_key")
            ),
        )

    @cached_property
    def dim_calendar(self) -> DataFrame:
        spine = spine_over([(self.raw_log, "order_date"), (self.raw_log, "stock_date")])
        return self._written("marts/dim_calendar", dim_calendar(spine))

    def sales_base(self) -> DataFrame:
        return facts.sales_base(
            staged("sales", self.raw_sales), self.dim_products, self.checkpoint_lsn
        )

    def sales_table(self, path: str, delete_mode: str = "soft") -> VersionedTable:
        """A sales fact at ``path``, with files small enough to share out little data."""
        share = self.log_rows // 64
        return facts.sales_table(
            path, rows_per_file=max(50_000, min(1_000_000, share)), delete_mode=delete_mode
        )

    @cached_property
    def log_rows(self) -> int:
        return self.raw_log.count()

    @cached_property
    def fct_sales(self) -> DataFrame:
        """The baseline build, then one increment merged into it."""
        table = self.sales_table(f"{self.root}/marts/fct_sales")
        table.replace(self.sales_base(), keys_from=self.raw_sales)
        increment = self.increment()
        table.upsert(
            facts.sales_increment(increment, self.dim_products), keys_from=increment
        )
        return table.read(self.spark).drop("bucket", "customer_reference")

    @cached_property
    def fct_returns(self) -> DataFrame:
        return self._written(
            "marts/fct_returns", facts.returns(staged("returns", self.raw_returns))
        )

    @property
    def star(self) -> Star:
        return Star(
            calendar=self.dim_calendar,
            customers=self.dim_customers,
            products=self.dim_products,
            territories=self.dim_territories,
            sales=self.fct_sales,
            returns=self.fct_returns,
        )


_shops: dict[tuple[str, str], Shop] = {}


def shop(spark: SparkSession, sf_dir: str) -> Shop:
    """The shop over ``sf_dir``, one per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _shops:
        _shops[key] = Shop(spark, sf_dir)
    return _shops[key]
