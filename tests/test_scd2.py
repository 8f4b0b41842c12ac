from datetime import date, datetime, timedelta
from decimal import Decimal

from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkmart.operators import scd2
from sparkmart.operators.checks import scd2_overlaps
from sparkmart.operators.neighbours import plan_stretches, with_neighbours
from sparkmart.plans import dims

LOG = "product_key bigint, product_price bigint, product_cost bigint, product_name string, day date"
DAYS = [date(2024, 1, 1) + timedelta(days=10 * i) for i in range(5)]
CHECKED = ["product_price", "product_cost"]


def fold(spark, log, table, **options):
    seen = spark.createDataFrame(log, LOG)
    history = scd2.empty_history(seen.drop("day"))
    for day in DAYS:
        today = seen.where(F.col("day") == F.lit(day)).drop("day")
        result = scd2.apply(history, today, "product_key", CHECKED, F.lit(day), **options)
        path = table(f"history-{day}")
        result.write.parquet(path)
        history = spark.read.schema(result.schema).parquet(path)
    return history


def test_change_and_change_back(spark):
    log = [(1, p, 5, "x", d) for p, d in zip((10, 10, 12, 10, 10), DAYS)]
    history = scd2.from_history(spark.createDataFrame(log, LOG), "product_key", CHECKED, "day")
    assert rows(history, "product_price", "valid_from", "valid_to") == [
        (10, DAYS[0], DAYS[2]),
        (10, DAYS[3], None),
        (12, DAYS[2], DAYS[3]),
    ]


def test_null_counts_as_a_value(spark):
    log = [(1, p, None, "x", d) for p, d in zip((10, None, None, 10), DAYS)]
    history = scd2.from_history(spark.createDataFrame(log, LOG), "product_key", CHECKED, "day")
    assert [r[0] for r in rows(history.orderBy("valid_from"), "valid_from")] == [DAYS[0], DAYS[1], DAYS[3]]


def test_untracked_columns_open_no_version_and_stay_as_they_were(spark):
    log = [(1, 10, 5, "old", DAYS[0]), (1, 10, 5, "new", DAYS[1]), (1, 11, 5, "newest", DAYS[2])]
    history = scd2.from_history(spark.createDataFrame(log, LOG), "product_key", CHECKED, "day")
    assert rows(history, "product_name", "valid_from") == [("newest", DAYS[2]), ("old", DAYS[0])]


observation = st.tuples(
    st.integers(1, 3), st.integers(1, 2), st.sampled_from([1, 2, None]), st.sampled_from(DAYS)
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(observation, min_size=1, unique_by=lambda o: (o[0], o[3])))
def test_folding_apply_equals_from_history(spark, table, log):
    log = [(k, p, c, "n", d) for k, p, c, d in log]
    whole = scd2.from_history(spark.createDataFrame(log, LOG), "product_key", CHECKED, "day")
    assert rows(fold(spark, log, table).select(*whole.columns)) == rows(whole)


def test_vanished_key_stays_open_or_is_closed_on_request(spark, table):
    log = [(1, 10, 5, "x", DAYS[0]), (1, 10, 5, "x", DAYS[3]), (2, 1, 1, "y", DAYS[0])]
    columns = ("product_key", "valid_from", "valid_to")
    assert rows(fold(spark, log, table), *columns) == [(1, DAYS[0], None), (2, DAYS[0], None)]
    assert rows(fold(spark, log, table, invalidate_missing=True), *columns) == [
        (1, DAYS[0], DAYS[1]),
        (1, DAYS[3], DAYS[4]),
        (2, DAYS[0], DAYS[1]),
    ]


def test_intervals_tile_time(spark):
    log = [(k, (k * d.day) % 3, 1, "x", d) for k in range(6) for d in DAYS]
    history = scd2.from_history(spark.createDataFrame(log, LOG), "product_key", CHECKED, "day")
    versions = scd2.day_intervals(history, "product_key")
    assert scd2_overlaps(versions, "product_key").count() == 0
    per_key = {}
    for r in versions.collect():
        per_key.setdefault(r["product_key"], []).append((r["valid_from_key"], r["valid_to_key"]))
    for intervals in per_key.values():
        intervals.sort()
        assert intervals[0][0] == 19000101 and intervals[-1][1] is None
        assert all(a[1] == b[0] for a, b in zip(intervals, intervals[1:]))


def test_two_changes_in_a_day_leave_an_empty_interval(spark):
    log = spark.createDataFrame(
        [(1, p, datetime(2024, 1, 2, h)) for p, h in ((1, 1), (2, 9), (3, 17))]
        + [(1, 0, datetime(2024, 1, 1))],
        "k bigint, p bigint, ts timestamp_ntz",
    )
    versions = scd2.day_intervals(scd2.from_history(log, "k", ["p"], "ts"), "k")
    assert rows(versions, "p", "valid_from_key", "valid_to_key") == [
        (0, 19000101, 20240102), (1, 20240102, 20240102), (2, 20240102, 20240102), (3, 20240102, None),
    ]
    assert scd2_overlaps(versions, "k").count() == 0


def test_hot_key_cut_into_stretches_gives_the_same_neighbours(spark):
    data = [(1, i % 400, i) for i in range(900)] + [(k, 1, k) for k in range(2, 30)] + [
        (50, i, i) for i in range(130)
    ]
    df = spark.createDataFrame(data, "k bigint, t bigint, i bigint")
    wanted = {"previous": {"p": F.col("i")}, "following": {"n": F.col("i")}}
    plain = plan_stretches(df, ["k"], ["t", "i"])
    cut = plan_stretches(df, ["k"], ["t", "i"], rows_per_task=50)
    assert plain.cuts is None
    pieces = {r["k"]: len(r["_cuts"]) for r in cut.cuts.collect()}
    assert pieces.keys() == {1, 50} and pieces[1] >= 10 and 1 <= pieces[50] <= 4
    assert rows(with_neighbours(df, cut, **wanted)) == rows(with_neighbours(df, plain, **wanted))


def test_hot_null_key_is_cut_too(spark):
    data = [(None, i, i) for i in range(300)] + [(1, i, i) for i in range(5)]
    df = spark.createDataFrame(data, "k bigint, t bigint, i bigint")
    wanted = {"previous": {"p": F.col("i")}, "following": {"n": F.col("i")}}
    cut = plan_stretches(df, ["k"], ["t"], rows_per_task=50)
    assert [r["k"] for r in cut.cuts.collect()] == [None]
    assert rows(with_neighbours(df, cut, **wanted)) == rows(
        with_neighbours(df, plan_stretches(df, ["k"], ["t"]), **wanted)
    )


def test_product_dimension(spark):
    history = spark.createDataFrame(
        [
            (1, 11, "M", "U", Decimal("1.00"), Decimal("2.00"), "v1", DAYS[0], DAYS[0], DAYS[1]),
            (1, 11, "M", "U", Decimal("1.00"), Decimal("3.00"), "v2", DAYS[1], DAYS[1], None),
            (2, 99, "48", "0", Decimal("1.00"), Decimal("2.00"), "v3", DAYS[2], DAYS[2], None),
        ],
        "product_key bigint, product_subcategory_key bigint, product_size string, product_style string, "
        "product_cost decimal(18,2), product_price decimal(18,2), version_key string, "
        "updated_at date, valid_from date, valid_to date",
    )
    for name in ("product_sku", "product_name", "model_name", "product_description", "product_color"):
        history = history.withColumn(name, F.lit("x"))
    subs = spark.createDataFrame(
        [(11, "Road", 1)], "product_subcategory_key bigint, subcategory_name string, product_category_key bigint"
    )
    cats = spark.createDataFrame([(1, "Bikes")], "product_category_key bigint, category_name string")
    dim = dims.products(history, subs, cats)
    columns = (
        "product_scd_key", "product_key", "subcategory_name", "category_name", "product_size_type",
        "product_style", "valid_from_key", "valid_to_key",
    )
    assert rows(dim, *columns) == [
        ("-1", -1, None, None, "No Size", "N/A", 19000101, None),
        ("v1", 1, "Road", "Bikes", "Clothing", "Unisex", 19000101, 20240111),
        ("v2", 1, "Road", "Bikes", "Clothing", "Unisex", 20240111, None),
        ("v3", 2, None, None, "Frame (cm)", "N/A", 19000101, None),
    ]
