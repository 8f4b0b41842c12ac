import random
from datetime import datetime

from helpers import rows
from pyspark.sql import types as T

from sparkmart.operators.staging import staged
from sparkmart.plans import facts
from sparkmart.sources.loads import load_append
from sparkmart.streaming.cdc_stream import cdc_to_fact, read_log_stream

RAW_LOG = (
    "order_date timestamp_ntz, stock_date timestamp_ntz, order_number string, product_key bigint, "
    "customer_key bigint, territory_key bigint, order_line_item int, order_quantity bigint, "
    "_operation int, _start_lsn string, _seqval string"
)
DAY = datetime(2024, 5, 15)


def raw(spark, events):
    data = [
        (DAY, DAY, f"SO-{order}", 100, None, 1, 1, q, op, f"{lsn:020x}", "0" * 20)
        for order, q, op, lsn in events
    ]
    return spark.createDataFrame(data, RAW_LOG)


def versions(spark):
    return spark.createDataFrame(
        [("v1", 100, 19000101, 20240515), ("v2", 100, 20240515, None)],
        "product_scd_key string, product_key bigint, valid_from_key int, valid_to_key int",
    )


def run(spark, folder, max_files=None):
    """Run the stream to its end; the number of batches that had rows."""
    stream = read_log_stream(
        spark, f"{folder}/log", T.StructType.fromDDL(RAW_LOG), max_files_per_trigger=max_files
    )
    query = cdc_to_fact(
        stream, versions, facts.sales_table(f"{folder}/fact", orders_per_bucket=5), f"{folder}/progress"
    )
    query.awaitTermination()
    return sum(p["numInputRows"] > 0 for p in query.recentProgress)


def fact(spark, folder):
    return rows(
        facts.sales_table(f"{folder}/fact", orders_per_bucket=5).read(spark),
        "order_number", "order_quantity", "is_deleted", "product_scd_key", "customer_key",
    )


def test_delete_and_reinsert_over_two_batches(spark, table):
    folder = table()
    load_append(raw(spark, [(1, 5, 2, 1), (1, 5, 1, 2)]), f"{folder}/log", "a")
    assert run(spark, folder) == 1
    assert fact(spark, folder) == [("SO-1", 5, True, "v2", -1)]
    load_append(raw(spark, [(1, 6, 2, 3)]), f"{folder}/log", "b")
    assert run(spark, folder) == 1
    assert fact(spark, folder) == [("SO-1", 6, False, "v2", -1)]
    assert run(spark, folder) == 0


def test_batches_in_any_cut_and_order_equal_one_shot(spark, table):
    rng = random.Random(11)
    events = [(rng.randrange(12), i, rng.choice([1, 2, 3, 4]), i) for i in range(60)]
    whole = facts.sales_increment(staged("sales_log", raw(spark, events)), versions(spark))
    expected = rows(
        whole, "order_number", "order_quantity", "is_deleted", "product_scd_key", "customer_key"
    )
    folder = table()
    parts = [events[i::4] for i in range(4)]
    rng.shuffle(parts)
    for i, part in enumerate(parts):
        load_append(raw(spark, part).coalesce(1), f"{folder}/log", f"part{i}")
    assert run(spark, folder, max_files=1) == 4
    assert fact(spark, folder) == expected
