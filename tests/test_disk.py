"""What a job of several writes holds on disk: its tables, not what led to them."""

from __future__ import annotations

from datetime import datetime
from glob import glob

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.catalog.registry import QUERIES
from sparkmart.operators.merge import KeyedTable, Summary, VersionedTable, hash_bucket
from sparkmart.session import materialise, shuffles_dropped

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SCHEMA = "id bigint, lsn string, seqval string, is_deleted boolean"


def _shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


def _events(spark, lsn):
    ids = spark.range(300).select((F.col("id") % 100).alias("id")).distinct()
    marks = [F.lit(lsn).alias("lsn"), F.lit("0").alias("seqval"), F.lit(False).alias("is_deleted")]
    return ids.select("id", *marks)


@pytest.mark.parametrize("kind", [KeyedTable, VersionedTable])
def test_writes_leave_no_shuffles_behind(spark, table, kind):
    schema = T.StructType.fromDDL(SCHEMA)
    rule = Summary("ids", F.lit(True), F.col("id"), F.lit(0))
    options = {"summaries": (rule,)} if kind is VersionedTable else {}
    keyed = kind(table(), schema, ("id",), hash_bucket(["id"], 4), rows_per_file=20, **options)
    before = _shuffles(spark)
    materialise(_events(spark, "0"), table())
    assert not _shuffles(spark) - before
    first = keyed._bucketed(_events(spark, "1"))
    keyed._store(keyed._clustered(first, {b: 40 for b in range(4)}).drop("_part"), None)
    assert not _shuffles(spark) - before
    sizes = {b: 40 for b in keyed._sizes(keyed.read(spark))}
    before = _shuffles(spark)
    again = keyed._clustered(keyed._bucketed(_events(spark, "2")), sizes).drop("_part")
    keyed._store(again, [*sizes])
    assert not _shuffles(spark) - before
    assert keyed.read(spark).where("lsn = '2'").count() == 100


def test_the_setting_of_the_session_is_put_back(spark):
    assert spark.conf.get(CLEANUP) == "false"
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        assert spark.conf.get(CLEANUP) == "true"
        1 / 0  # noqa: B018
    assert spark.conf.get(CLEANUP) == "false"
    spark.conf.set(CLEANUP, "true")
    try:
        with shuffles_dropped(spark):
            pass
        assert spark.conf.get(CLEANUP) == "true"
    finally:
        spark.conf.unset(CLEANUP)


@pytest.fixture
def shop_dir(spark, table):
    """Driver tables of 40 orders with two lines each, shipped from 1995 to 2001."""
    folder = table()

    def write(name, columns, rows):
        spark.createDataFrame(rows, columns).write.parquet(f"{folder}/{name}.parquet")

    write("nation", "n_nationkey int, n_name string, n_regionkey int", [(1, "X", 1)])
    write(
        "customer",
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(c, f"Customer#{c}", 1, -1.0 if c % 3 == 0 else 5.0, "BUILDING") for c in range(1, 9)],
    )
    write(
        "part",
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(p, f"red thing {p}", f"Brand#{p}", "TYPE", p, 10.0 + p) for p in range(1, 6)],
    )
    days = [datetime(1995 + n % 7, 3, 1 + n % 28) for n in range(40)]
    write(
        "orders",
        "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
        [(n + 1, n % 8 + 1, days[n]) for n in range(40)],
    )
    write(
        "lineitem",
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, "
        "l_returnflag string, l_shipdate timestamp_ntz",
        [(n + 1, k, n % 5 + 1, 1, 2.0, "RNA"[(n + k) % 3], days[n]) for n in range(40) for k in (1, 2)],
    )
    return folder


def _folders(spark, name):
    shared = spark.conf.get("spark.checkpoint.dir")
    return set(glob(f"{shared}/{spark.sparkContext.applicationId}/{name}-*"))


def test_increments_out_of_order_keep_one_version(spark, shop_dir):
    before = _folders(spark, "late")
    fact = QUERIES["t3_out_of_order_increments"](spark, shop_dir)
    assert fact.count() == 80 == fact.select("order_number", "order_line_item").distinct().count()
    (folder,) = _folders(spark, "late") - before
    assert len(glob(f"{folder}/_gen=*")) == 1 == len(glob(f"{folder}/_summary/_gen=*"))


def test_the_repaired_fact_keeps_one_version(spark, shop_dir):
    before = _folders(spark, "fct_sales_references")
    fact = QUERIES["m7_repair_stored_fact"](spark, shop_dir)
    assert fact.count() == 80 and fact.where("customer_key = -1").count() == 0
    (folder,) = _folders(spark, "fct_sales_references") - before
    assert len(glob(f"{folder}/_gen=*")) == 1 == len(glob(f"{folder}/_summary/_gen=*"))


def test_customers_are_not_broadcast_where_they_are_many(spark, shop_dir, monkeypatch):
    usual = QUERIES["m7_repair_keys"](spark, shop_dir)
    monkeypatch.setattr("sparkmart.operators.joins.is_bounded", lambda df, n: False)
    many = QUERIES["m7_repair_keys"](spark, shop_dir)
    assert "Broadcast" in usual._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
    assert rows(many) == rows(usual) and many.count() > 0
