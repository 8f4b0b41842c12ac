"""The jobs that keep a warehouse folder up to date.

Layout below the root: ``raw/<table>``, ``raw/state``, ``raw/audit``, ``snapshots/products``,
``quarantine/products``, ``marts/<table>``.

A job writes, checks, and only then lets readers see: tables are published by version, and
``marts/_releases`` names the versions that belong together. Readers take the tables of the last
release (``star``, ``mart``); a job works on the newest ones (``draft``). Where a check fails, or
a job is cut off, the release stays what it was.
"""

from __future__ import annotations

import warnings
from collections.abc import Collection, Mapping
from dataclasses import dataclass, replace
from datetime import date, datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkmart.operators import cdc, checks, quality, scd2
from sparkmart.operators.merge import VersionedTable
from sparkmart.operators.staging import staged
from sparkmart.plans import dims, facts, star
from sparkmart.plans.calendar import dim_calendar, key_to_date, spine_over
from sparkmart.sources import versions
from sparkmart.sources.files import exists
from sparkmart.sources.loads import audit, load_append, load_replace, read_loads, table_path
from sparkmart.streaming.cdc_stream import cdc_to_fact, read_log_stream

# The tables replaced daily; the baseline loads the sales table as well.
DAILY_TABLES = (
    "customers",
    "product_categories",
    "product_subcategories",
    "products",
    "returns",
    "territories",
)
SALES_SOURCE = "sales_log"
#: The tables a release holds.
STAR_TABLES = (
    "dim_calendar",
    "dim_customers",
    "dim_products",
    "dim_territories",
    "fct_returns",
    "fct_sales",
)


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return table_path(self.root, layer, name)

    def raw(self, name: str) -> DataFrame:
        return versions.read(self.spark, self.path("raw", name))

    def staged(self, name: str) -> DataFrame:
        return staged(name, self.raw(name))

    def mart(self, name: str) -> DataFrame:
        """A dimension or the returns as readers see them."""
        number = versions.released(self.spark, self.path("marts", ""))[name]
        return versions.read(self.spark, self.path("marts", name), number)

    def draft(self, name: str) -> DataFrame:
        """A dimension or the returns as a job has written them last."""
        return versions.read(self.spark, self.path("marts", name))

    def write(self, name: str, df: DataFrame) -> None:
        versions.replace(df, self.path("marts", name))

    @property
    def sales(self) -> VersionedTable:
        """The sales fact, as a job has written it last."""
        return facts.sales_table(self.path("marts", "fct_sales"))

    @property
    def history(self) -> scd2.History:
        return scd2.History(self.path("snapshots", "products"), "product_key", dims.TRACKED)

    def star(self, *, draft: bool = False) -> star.Star:
        """The tables that readers see or, with ``draft``, those of the job under way.

        A job's star has the fact's summaries too, for the checks.
        """
        sales, read = self.sales, self.draft
        if not draft:
            seen = versions.released(self.spark, self.path("marts", ""))
            sales, read = sales.at(seen["fct_sales"]), self.mart
        return star.Star(
            calendar=read("dim_calendar"),
            customers=read("dim_customers"),
            products=read("dim_products"),
            territories=read("dim_territories"),
            sales=sales.read(self.spark),
            returns=read("fct_returns"),
            first_orders=facts.first_orders(sales, self.spark) if draft else None,
            order_days=facts.order_days(sales, self.spark) if draft else None,
        )

    def release(self) -> None:
        """Let readers see the newest version of every table, all at once."""
        marts = self.path("marts", "")
        found = {}
        for name in STAR_TABLES:
            done = versions.numbers(self.spark, f"{marts}{name}/{versions.POINTERS}")
            if done:
                found[name] = done[-1]
        if found != versions.released(self.spark, marts):
            versions.release(self.spark, marts, found)

    def vacuum(self) -> None:
        """Delete what neither a job nor readers of the last two releases need."""
        marts = self.path("marts", "")
        kept = versions.releases(self.spark, marts)[-2:]
        for name in STAR_TABLES:
            keep = [r[name] for r in kept if name in r]
            versions.vacuum(self.spark, f"{marts}{name}", keep)
        for name in (*DAILY_TABLES, "sales"):
            versions.vacuum(self.spark, self.path("raw", name))


def _load(
    wh: Warehouse, sources: Mapping[str, DataFrame], names: tuple[str, ...], load_id: str
) -> None:
    for name in names:
        versions.replace(sources[name], wh.path("raw", name))
    audit(wh.path("raw", "audit"), load_id, "loaded", {name: wh.raw(name) for name in names})


def _run_checks(
    wh: Warehouse,
    rules: list[checks.Check],
    load_id: str,
    gated: bool,
    accepted: Collection[str],
) -> DataFrame:
    """Run the checks once, keep their results, raise if one fails, else release the tables."""
    path = wh.path("raw", "check_results")
    load_append(checks.run(rules), path, load_id)
    results = read_loads(wh.spark, path).where(F.col("load_id") == load_id).drop("load_id")
    if gated:
        checks.gate(results, accepted)
    wh.release()
    return results


def snapshot_products(wh: Warehouse, as_of: date) -> DataFrame:
    """Judge today's products, store the rejected ones, extend the history by the rest."""
    good, bad = quality.split(
        wh.staged("products"), dims.product_rules(), datetime.combine(as_of, time())
    )
    load_replace(bad, wh.path("quarantine", "products"))
    return wh.history.read(wh.spark, wh.history.observe(good, as_of).number)


def refresh_dimensions(
    wh: Warehouse,
    sources: Mapping[str, DataFrame],
    as_of: date,
    load_id: str,
    *,
    gated: bool = True,
    accepted: Collection[str] = (),
) -> DataFrame:
    """The daily job: replace the raw tables, extend the history, rebuild the dimensions and
    the returns, repair the fact, check everything and, if ``gated``, raise if a check fails
    that is not among the ``accepted`` names. Gives the results."""
    _load(wh, sources, DAILY_TABLES, load_id)
    _build_dimensions(wh, as_of)
    repair_sales(wh)
    tables = wh.star(draft=True)
    rules = (
        star.dimension_checks(tables, as_of)
        + star.returns_checks(tables)
        + star.sales_checks(tables)
    )
    results = _run_checks(wh, rules, load_id, gated, accepted)
    wh.vacuum()
    return results


def _build_dimensions(wh: Warehouse, as_of: date) -> None:
    history = snapshot_products(wh, as_of)
    wh.write("fct_returns", facts.returns(wh.staged("returns")))
    sales = wh.sales.read(wh.spark)
    loaded = versions.published(wh.spark, wh.path("raw", "sales"))
    baseline = wh.staged("sales") if loaded else sales
    returned = wh.draft("fct_returns")
    dated = dims.products(
        history, wh.staged("product_subcategories"), wh.staged("product_categories")
    )
    sold = baseline.select("product_key").unionByName(sales.select("product_key"))
    known = sold.unionByName(returned.select("product_key"))
    wh.write("dim_products", dated.unionByName(dims.pending_products(dated, known)))
    _complete_members(wh, baseline, sales)
    days = [(wh.spark.range(1).select(F.lit(as_of).alias("day")), "day")]
    days += [
        (df.select(key_to_date(F.col(c)).alias("day")), "day")
        for df, columns in (
            (baseline, ("order_date_key", "stock_date_key")),
            (sales, ("order_date_key", "stock_date_key")),
            (returned, ("return_date_key",)),
        )
        for c in columns
    ]
    wh.write("dim_calendar", dim_calendar(spine_over(days)))


def repair_sales(wh: Warehouse) -> None:
    """Point sales that came before their product or their customer to it."""
    facts.repair_products(wh.sales, wh.draft("dim_products"))
    facts.repair_customers(wh.sales, wh.staged("customers"))


def _complete_members(wh: Warehouse, baseline: DataFrame, sales: DataFrame) -> None:
    """Customers and territories, completed by the keys that sales and returns use."""
    wh.write(
        "dim_customers",
        dims.customers(
            wh.staged("customers").drop("customer_reference"),
            baseline.select("customer_key").unionByName(sales.select("customer_key")),
        ),
    )
    wh.write(
        "dim_territories",
        dims.territories(
            wh.staged("territories"),
            baseline.select("territory_key")
            .unionByName(sales.select("territory_key"))
            .unionByName(wh.draft("fct_returns").select("territory_key")),
        ),
    )


def bootstrap(
    wh: Warehouse,
    sources: Mapping[str, DataFrame],
    log: DataFrame,
    as_of: date,
    load_id: str,
    *,
    gated: bool = True,
    accepted: Collection[str] = (),
) -> DataFrame:
    """The first load: note the log position, take the baseline, build everything.

    The position is taken before the baseline, so no change can fall between the two; the
    baseline rows carry it, and the increments start after it. Checks run once everything is
    built, so a failing one leaves tables to look at.
    """
    state = wh.path("raw", "state")
    load_append(
        cdc.checkpoint(staged("sales_log", log), SALES_SOURCE, load_id).drop("load_id"),
        state,
        load_id,
    )
    lsn = cdc.cursor(read_loads(wh.spark, state), SALES_SOURCE)
    _load(wh, sources, ("sales",), f"{load_id}-baseline")
    _load(wh, sources, DAILY_TABLES, load_id)
    _build_dimensions(wh, as_of)
    baseline = wh.staged("sales")
    wh.sales.replace(
        facts.sales_base(baseline, wh.draft("dim_products"), lsn), keys_from=baseline
    )
    repair_sales(wh)
    tables = wh.star(draft=True)
    rules = (
        star.dimension_checks(tables, as_of)
        + star.returns_checks(tables)
        + star.sales_checks(tables)
    )
    return _run_checks(wh, rules, load_id, gated, accepted)


def _position_before(wh: Warehouse, load_id: str) -> str:
    """The log position that all other loads have reached."""
    earlier = read_loads(wh.spark, wh.path("raw", "state")).where(F.col("load_id") != load_id)
    return cdc.cursor(earlier, SALES_SOURCE)


def extract_changes(wh: Warehouse, log: DataFrame, load_id: str) -> None:
    """Append what the log holds beyond the stored position, then move the position on."""
    state = wh.path("raw", "state")
    fresh = cdc.read_since(log, _position_before(wh, load_id), "_start_lsn")
    load_append(fresh, wh.path("raw", "sales_log"), load_id)
    if not exists(wh.spark, wh.path("raw", "sales_log")):
        return
    appended = read_loads(wh.spark, wh.path("raw", "sales_log"), log.schema).where(
        F.col("load_id") == load_id
    )
    load_append(
        cdc.checkpoint(appended, SALES_SOURCE, load_id, "_start_lsn").drop("load_id"),
        state,
        load_id,
    )


def merge_changes(wh: Warehouse, schema: T.StructType) -> StreamingQuery | None:
    """Merge the appended log files, of the given raw schema, that no run has merged yet."""
    log_path = wh.path("raw", "sales_log")
    if not exists(wh.spark, log_path):
        return None
    query = cdc_to_fact(
        read_log_stream(wh.spark, log_path, schema),
        lambda spark: versions.read(spark, wh.path("marts", "dim_products")),
        wh.sales,
        wh.path("raw", "sales_log_checkpoint"),
    )
    query.awaitTermination()
    return query


def extend_dimensions(wh: Warehouse, schema: T.StructType, load_id: str) -> None:
    """Append the members and days that a load of changes brings and no dimension has yet.

    Only the load's rows are read, each key once; running it again adds nothing.
    """
    path = wh.path("raw", "sales_log")
    if not exists(wh.spark, path):
        return
    loaded = read_loads(wh.spark, path, schema).where(F.col("load_id") == load_id)
    events = staged("sales_log", loaded.drop("load_id"))
    days = [
        (events.select(key_to_date(F.col(c)).alias("day")), "day")
        for c in ("order_date_key", "stock_date_key")
    ]
    calendar = wh.draft("dim_calendar")
    spine = spine_over([(calendar, "full_date"), *days])
    additions = {
        "dim_customers": dims.pending_customers(
            wh.draft("dim_customers"), events.select("customer_key")
        ),
        "dim_territories": dims.pending_territories(
            wh.draft("dim_territories"), events.select("territory_key")
        ),
        "dim_products": dims.pending_products(
            wh.draft("dim_products"), events.select("product_key")
        ),
        "dim_calendar": dim_calendar(spine.join(calendar, "full_date", "left_anti")),
    }
    for name, rows in additions.items():
        if not rows.isEmpty():
            versions.append(rows, wh.path("marts", name))


def run_increment(
    wh: Warehouse,
    log: DataFrame,
    load_id: str,
    *,
    as_of: date | None = None,
    gated: bool = True,
    accepted: Collection[str] = (),
) -> DataFrame:
    """The half-hourly job: extract, merge, check the fact and raise if a check fails.

    Members and days that the changes bring are added before the checks. Column and key
    checks read the rows that this load has brought; the daily job checks all. With ``as_of``
    the freshness and the volume of that morning are checked as well; a job should pass it,
    as no other check sees that sales have stopped.
    """
    if as_of is None:
        warnings.warn("run_increment without as_of checks no freshness or volume", stacklevel=2)
    before = _position_before(wh, load_id)
    extract_changes(wh, log, load_id)
    merge_changes(wh, log.schema)
    extend_dimensions(wh, log.schema, load_id)
    repair_sales(wh)
    tables = wh.star(draft=True)
    brought = replace(tables, sales=tables.sales.where(F.col("lsn") > before))
    rules = [*star.sales_checks(brought), star.return_order_check(tables)]
    if as_of is not None:
        rules += star.volume_checks(tables, as_of)
    return _run_checks(wh, rules, load_id, gated, accepted)
