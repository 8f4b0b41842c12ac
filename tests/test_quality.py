from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sparkmart.operators import checks, quality
from sparkmart.operators.members import complete
from sparkmart.plans import dims

PRODUCTS = "product_key bigint, product_name string, product_price decimal(18,2), product_cost decimal(18,2)"


def money(x):
    return None if x is None else Decimal(x)


@pytest.mark.parametrize(
    ("key", "name", "price", "cost", "reason"),
    [
        (1, "a", "2", "1", None),
        (1, "a", "2", "2", None),
        (None, "", "0", "1", "missing_key"),
        (1, None, "0", "1", "blank_name"),
        (1, "  ", "2", "1", "blank_name"),
        (1, "\t", "2", "1", None),  # trim takes spaces only
        (1, "a", None, None, "missing_price"),
        (1, "a", "0", "1", "non_positive_price"),
        (1, "a", "-1", None, "non_positive_price"),
        (1, "a", "2", None, "missing_cost"),
        (1, "a", "2", "3", "cost_above_price"),
    ],
)
def test_each_product_goes_one_way(spark, key, name, price, cost, reason):
    df = spark.createDataFrame([(key, name, money(price), money(cost))], PRODUCTS)
    good, bad = quality.split(df, dims.product_rules(), datetime(2024, 1, 1))
    if reason is None:
        assert good.count() == 1 and bad.count() == 0
    else:
        assert good.count() == 0
        assert rows(bad, "error_reason", "quarantined_at") == [(reason, datetime(2024, 1, 1))]


def test_split_conserves_rows(spark):
    values = [None, "-1", "0", "1", "2"]
    data = [
        (k, n, money(p), money(c))
        for k in (None, 1) for n in (None, " ", "x") for p in values for c in values
    ]
    df = spark.createDataFrame(data, PRODUCTS)
    good, bad = quality.split(df, dims.product_rules(), datetime(2024, 1, 1))
    assert good.count() > 0 and bad.count() > 0
    both = good.unionByName(bad.drop("error_reason", "quarantined_at"))
    assert rows(both) == rows(df)


def test_members_are_completed_once_each(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, name string")
    used = spark.createDataFrame([(1,), (3,), (3,), (None,), (-1,), (9,)], "k int")
    full = complete(dim, used, "k", {"name": "pending"}, {"k": -1, "name": "guest"})
    assert rows(full) == [
        (-1, "guest", False), (1, "a", False), (2, "b", False), (3, "pending", True), (9, "pending", True),
    ]
    assert full.schema["k"].dataType.simpleString() == "bigint"


def test_territories(spark):
    staged = spark.createDataFrame(
        [(1, "North", "Utopia", "Nowhere")],
        "sales_territory_key bigint, region string, country string, continent string",
    )
    used = spark.createDataFrame([(1,), (4,)], "territory_key bigint")
    assert rows(dims.territories(staged, used)) == [
        (-1, "N/A", "N/A", "N/A", False), (1, "North", "Utopia", "Nowhere", False), (4, "N/A", "N/A", "N/A", True),
    ]


# Each check must fire on a planted violation and stay silent without one.


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, None)], "k bigint, v string")
    results = checks.run(
        [
            checks.Check("k.not_null", df, checks.not_null("k")),
            checks.Check("v.accepted", df, checks.accepted_values("v", ["a"]), "warn"),
            checks.Check("v.known", df, checks.accepted_values("v", ["a", "b"])),
        ]
    )
    assert rows(results) == [
        ("k.not_null", "error", 2, "fail"), ("v.accepted", "warn", 1, "warn"), ("v.known", "error", 0, "pass"),
    ]


def test_column_checks_of_a_table_share_one_scan(spark, table):
    path = table()
    spark.range(10).select("id", F.col("id").alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    results = checks.run([checks.Check(c, df, checks.not_null(c)) for c in ("id", "v")])
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k bigint")
    assert rows(checks.duplicates(df, "k")) == [(1, 2)]


def test_orphans_count_rows_not_keys(spark):
    child = spark.createDataFrame([(1,), (5,), (5,), (None,)], "fk bigint")
    parent = spark.createDataFrame([(1,), (None,)], "pk bigint")
    found = checks.orphans(child, "fk", parent, "pk")
    assert rows(found) == [(5, 2)]
    assert rows(checks.run([checks.Check("fk", found)]), "failures") == [(2,)]


def test_overlaps(spark):
    schema = "k bigint, valid_from_key int, valid_to_key int"
    clean = [(1, 10, 20), (1, 20, 20), (1, 20, None), (2, 10, None)]
    assert checks.scd2_overlaps(spark.createDataFrame(clean, schema), "k").count() == 0
    planted = spark.createDataFrame([*clean, (1, 15, 17)], schema)
    assert rows(checks.scd2_overlaps(planted, "k")) == [(1, 10, 20, 15)]
    assert rows(checks.scd2_overlaps(planted, "k", rows_per_task=1)) == [(1, 10, 20, 15)]


def test_future_dates_and_margins(spark):
    births = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 2),), (None,)], "d date")
    assert rows(checks.future_dates(births, "d", date(2024, 1, 2))) == [(date(2024, 1, 2),)]
    prices = spark.createDataFrame([(1, 2), (2, 2), (None, 1)], "price bigint, cost bigint")
    assert rows(checks.negative_margins(prices, "price", "cost")) == [(1, 2)]


def test_return_before_order_and_its_thresholds(spark):
    sales = spark.createDataFrame([(i, 20240110) for i in range(100)], "product_key bigint, order_date_key int")

    def outcome(early):
        returns = spark.createDataFrame(
            [(i, 20240101 if i < early else 20240111) for i in range(100)],
            "product_key bigint, return_date_key int",
        )
        rule = checks.Check(
            "r", checks.returned_before_ordered(sales, returns), severity="warn", warn_if=0, error_if=50
        )
        return rows(checks.run([rule]), "failures", "status")[0]

    assert outcome(0) == (0, "pass")
    assert outcome(50) == (50, "warn")
    assert outcome(51) == (51, "fail")


def test_stale(spark):
    schema = "day_key int"
    assert rows(checks.stale(spark.createDataFrame([], schema), "day_key", date(2024, 1, 2))) == [(None,)]
    old = spark.createDataFrame([(20231230,), (20231231,)], schema)
    assert rows(checks.stale(old, "day_key", date(2024, 1, 2))) == [(20231231,)]
    assert checks.stale(old, "day_key", date(2024, 1, 1)).count() == 0


def volume(spark, per_day, **bounds):
    data = [(date(2024, 1, d),) for d, n in per_day.items() for _ in range(n)]
    df = spark.createDataFrame(data, "day date")
    return rows(checks.volume_anomaly(df, "day", date(2024, 1, 10), **bounds), "yesterday_rows", "usual_rows")


def test_volume(spark):
    usual = {d: 10 for d in range(2, 9)}
    assert volume(spark, {**usual, 9: 3}) == []
    assert volume(spark, {**usual, 9: 2}) == [(2, 10.0)]
    assert volume(spark, usual) == [(0, 10.0)]  # an outage
    assert volume(spark, {}) == [(0, None)]
    assert volume(spark, {1: 1000, 9: 5, 8: 10}) == []  # older days do not count
    assert volume(spark, {**usual, 9: 40}) == []
    assert volume(spark, {**usual, 9: 40}, high=3.0) == [(40, 10.0)]


def test_gate(spark):
    df = spark.createDataFrame([(None,)], "k bigint")
    warned = checks.run([checks.Check("k", df, checks.not_null("k"), "warn")])
    checks.gate(warned)
    failed = checks.run([checks.Check("k", df, checks.not_null("k"))])
    with pytest.raises(checks.ChecksFailed, match=r"k \(1\)"):
        checks.gate(failed)
    with pytest.raises(ValueError):
        checks.run([checks.Check("k", df), checks.Check("k", df)])
