"""What keeps the work of a task and the bytes of a job in step with the rows."""

from __future__ import annotations

import glob
from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart import session
from sparkmart.operators import cdc, joins
from sparkmart.operators.merge import KeyedTable, dealt_out, hash_bucket
from sparkmart.plans import analytics, facts


def _table(path, rows_per_file):
    schema = "id bigint, lsn string, seqval string, is_deleted boolean"
    return KeyedTable(
        path, T.StructType.fromDDL(schema), ("id",), hash_bucket(["id"], 12), rows_per_file=rows_per_file
    )


def _events(spark, n):
    return spark.range(n).select(
        "id", F.lit("1").alias("lsn"), F.lit("1").alias("seqval"), F.lit(False).alias("is_deleted")
    )


def test_tasks_of_an_upsert_share_the_rows_evenly(spark, table):
    keyed, events = _table(table(), 100), _events(spark, 2400)
    sizes = keyed._sizes(events)
    rows = keyed._clustered(keyed._bucketed(events), sizes)
    per_task = [r[1] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 2400
    # A bucket of about 200 rows is cut by hash into two or three parts.
    assert max(per_task) <= 150


def test_a_key_stays_in_one_task_and_no_row_is_lost(spark, table):
    keyed = _table(table(), 50)
    keyed.replace(_events(spark, 500))
    keyed.upsert(_events(spark, 700).withColumn("lsn", F.lit("2")))
    stored = keyed.read(spark)
    assert stored.count() == 700 == stored.select("id").distinct().count()
    assert stored.where("lsn = '2'").count() == 700


def test_small_buckets_share_a_task_and_large_ones_have_their_own():
    dealt, tasks = dealt_out({3: 40, 1: 50, 2: 250, 4: 30, 5: 60, -1: 10}, 100)
    assert dealt == [(-1, 0, 1), (1, 0, 1), (2, 1, 3), (3, 4, 1), (4, 4, 1), (5, 5, 1)]
    assert tasks == 6
    assert dealt_out({}, 100) == ([], 0)


def _looked_at(monkeypatch):
    seen, find = [], joins.hot_keys

    def recorded(df, *args):
        seen.append(df._jdf.queryExecution().analyzed().toString())
        return find(df, *args)

    monkeypatch.setattr(joins, "hot_keys", recorded)
    return seen


def test_hot_products_are_looked_for_in_the_log_itself(spark, monkeypatch):
    log = spark.range(40).select(
        F.concat(F.lit("SO-"), "id").alias("order_number"), F.lit(1).cast("long").alias("order_line_item"),
        F.lit(20200101).alias("order_date_key"), F.lit(20200101).alias("stock_date_key"),
        (F.col("id") % 2).alias("product_key"), F.col("id").alias("customer_key"),
        F.lit(1).cast("long").alias("territory_key"), F.lit(1).cast("long").alias("order_quantity"),
        F.lit(cdc.INSERT).alias("op"), F.lit("1").alias("lsn"), F.lit("1").alias("seqval"),
    )
    products = spark.createDataFrame(
        [("a", 0, 19000101, None), ("b", 1, 19000101, None)],
        "product_scd_key string, product_key bigint, valid_from_key int, valid_to_key int",
    )
    seen = _looked_at(monkeypatch)
    found = facts.sales_increment(log, products, broadcast_rows=0, rows_per_task=10)
    assert {r[0]: r[1] for r in found.groupBy("product_scd_key").count().collect()} == {"a": 20, "b": 20}
    assert len(seen) == 1 and "row_number" not in seen[0]


def test_hot_versions_of_customers_are_looked_for_in_the_sales(spark, monkeypatch):
    sales = spark.range(30).select(
        (F.col("id") % 3).alias("customer_key"), F.lit("a").alias("product_scd_key"),
        F.lit(20200101).alias("order_date_key"), F.col("id").cast("string").alias("order_number"),
        F.lit(2).cast("long").alias("order_quantity"), F.lit(False).alias("is_deleted"),
    )
    products = spark.createDataFrame([("a", 1.5)], "product_scd_key string, product_price double")
    monkeypatch.setattr(joins, "is_bounded", lambda *_: False)
    seen = _looked_at(monkeypatch)
    segments = analytics.customer_segments(sales, products, date(2020, 2, 1))
    assert sorted((r["customer_key"], r["frequency"], float(r["value"])) for r in segments.collect()) == [
        (0, 10, 30.0), (1, 10, 30.0), (2, 10, 30.0)
    ]
    assert seen and not any("Aggregate" in plan for plan in seen)


def test_tables_are_stored_compressed(spark, table):
    path = table()
    session.materialise(_events(spark, 10), path)
    assert glob.glob(f"{path}/*.zstd.parquet")
    assert len(glob.glob(f"{path}/*.parquet")) == len(glob.glob(f"{path}/*.zstd.parquet"))


def test_shuffles_start_with_enough_partitions(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    try:
        session.allow_for(spark, 10)
        assert spark.conf.get(name, None) == before
        session.allow_for(spark, 400 * session.ROWS_PER_SHUFFLE_TASK)
        assert spark.conf.get(name) == "400"
        session.allow_for(spark, 40 * session.ROWS_PER_SHUFFLE_TASK)
        assert spark.conf.get(name) == "400"
    finally:
        spark.conf.unset(name)
        if before is not None:
            spark.conf.set(name, before)


def test_buckets_of_a_snapshot_have_a_task_each(spark, table, monkeypatch):
    path, placed = table(), []
    frame = type(spark.range(1))
    by_id = frame.repartitionById

    def recorded(self, n, column):
        out = by_id(self, n, column)
        placed.extend(out.groupBy(F.spark_partition_id()).agg(F.count_distinct(column)).collect())
        return out

    monkeypatch.setattr(frame, "repartitionById", recorded)
    cdc.store_snapshot(spark.range(500), path, ["id"], 16)
    assert len(placed) == 16 and {r[1] for r in placed} == {1}
    assert spark.read.parquet(f"{path}/rows").count() == 500


def test_a_large_table_is_read_by_enough_tasks(spark, table):
    name, path = "spark.sql.files.minPartitionNum", table()
    before, cost = spark.conf.get(name, None), "spark.sql.files.openCostInBytes"
    many = spark.sparkContext.defaultParallelism * 10
    try:
        session.allow_scans(spark, 10)
        assert spark.conf.get(name, None) == before
        spark.conf.set(cost, "1")
        spark.range(40_000).repartition(many // 2).write.parquet(path)
        few = spark.read.parquet(path).rdd.getNumPartitions()
        session.allow_scans(spark, many * session.ROWS_PER_SCAN_TASK)
        assert spark.conf.get(name) == str(many)
        assert spark.read.parquet(path).rdd.getNumPartitions() > 2 * few
        session.allow_scans(spark, session.ROWS_PER_SCAN_TASK)
        assert spark.conf.get(name) == str(many)
    finally:
        spark.conf.unset(cost)
        spark.conf.unset(name)
        if before is not None:
            spark.conf.set(name, before)
