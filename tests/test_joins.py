import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from sparkmart.operators.asof import asof_join
from sparkmart.operators.joins import hot_keys, lookup_join, salted_join
from sparkmart.operators.members import missing_keys
from sparkmart.plans.facts import resolve, sales_base

VERSIONS = "product_scd_key string, product_key bigint, valid_from_key int, valid_to_key int"
FACTS = "id bigint, product_key bigint, order_date_key int"


def lookup(spark, facts, versions, **tuning):
    joined = asof_join(
        spark.createDataFrame(facts, FACTS),
        spark.createDataFrame(versions, VERSIONS),
        "product_key",
        "order_date_key",
        ["product_scd_key"],
        **tuning,
    )
    return {r["id"]: r["product_scd_key"] for r in joined.collect()}


@pytest.mark.parametrize("tuning", [{}, {"broadcast_rows": 0, "rows_per_task": 1}])
def test_asof_boundaries(spark, tuning):
    versions = [
        ("v1", 100, 20240101, 20240501),
        ("v2", 100, 20240501, 99991231),
        ("w1", 200, 19000101, 20240301),
        ("w2", 200, 20240301, 20240301),  # two changes in a day: can match nothing
        ("w3", 200, 20240301, None),
    ]
    facts = [
        (1, 100, 20240515),  # second version
        (2, 100, 20240101),  # on valid_from
        (3, 100, 20240501),  # on valid_to
        (4, 100, 20231231),  # before the first
        (5, 200, 20240301),
        (6, 200, 20991231),  # open end
        (7, 300, 20240101),  # no such product
        (8, None, 20240101),
    ]
    assert lookup(spark, facts, versions, **tuning) == {
        1: "v2", 2: "v1", 3: "v2", 4: None, 5: "w3", 6: "w3", 7: None, 8: None,
    }


def test_hot_key_is_spread_and_the_result_unchanged(spark):
    rng = random.Random(1)
    facts = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.randrange(20240101, 20240131)) for i in range(600)]
    versions = [
        (f"v{k}-{d}", k, 20240100 + d, 20240100 + d + 10 if d < 21 else None)
        for k in (1, 2) for d in (1, 11, 21)
    ]
    broadcast = lookup(spark, facts, versions)
    salted = lookup(spark, facts, versions, broadcast_rows=0, rows_per_task=25)
    assert salted == broadcast

    def expected(key, at):
        hits = [v for v, k, lo, hi in versions if k == key and lo <= at and (hi is None or at < hi)]
        return hits[0] if hits else None

    assert broadcast == {i: expected(k, at) for i, k, at in facts}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.createDataFrame(
        [(i, None if i % 7 == 0 else i % 3) for i in range(300)], "id bigint, k bigint"
    )
    right = spark.createDataFrame([(0, "a"), (1, "b"), (9, "c")], "k bigint, v string")
    plain = rows(left.join(right, ["k"], how))
    assert rows(salted_join(left, right, ["k"], how, rows_per_task=10)) == plain
    assert rows(lookup_join(left, right, ["k"], how, broadcast_rows=0)) == plain
    assert rows(lookup_join(left, right, ["k"], how)) == plain


def test_salting_limits_rows_per_task(spark):
    left = spark.range(4000).select("id", F.lit(5).cast("bigint").alias("k"))
    right = spark.createDataFrame([(5, "x")], "k bigint, v string")
    joined = salted_join(left, right, ["k"], rows_per_task=250)
    text = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in text
    salts = left.select(F.pmod(F.xxhash64("id", "k"), F.lit(16)).alias("s")).groupBy("s").count()
    assert salts.count() == 16 and salts.agg(F.max("count")).first()[0] < 350


def test_small_side_is_broadcast_and_large_side_is_not(spark):
    left, right = spark.range(100).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(lookup_join(left, right, ["k"]))
    beyond = plan(lookup_join(left, right, ["k"], broadcast_rows=5))
    assert "strategy=broadcast" not in beyond


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [False, True])
def test_spark_may_not_broadcast_what_has_very_many_rows(spark, how, hot, monkeypatch):
    left = spark.range(60).select((F.col("id") % (3 if hot else 30)).alias("k"), "id")
    right = spark.range(0, 20, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))

    def joined(**options):
        return lookup_join(left, right, ["k"], how, broadcast_rows=5, rows_per_task=10, **options)

    def small(df):
        return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")

    spreading = 2 if hot else 0  # of both sides, by the few hot keys
    expected = rows(left.join(right, ["k"], how))
    assert small(joined()) == spreading + 1 and rows(joined()) == expected
    monkeypatch.setattr("sparkmart.operators.joins.LEFT_TO_SPARK_ROWS", 9)
    assert small(joined()) == spreading == small(joined(rows=10)) and rows(joined()) == expected
    assert small(joined(rows=9)) == spreading + 1
    if how == "left":
        residual = {"residual": F.col("id") > F.col("v")}
        matched = (F.col("k") == F.col("_k")) & (F.col("id") > F.col("v"))
        plain = left.join(right.withColumnRenamed("k", "_k"), matched, "left").drop("_k")
        assert small(joined(**residual)) == spreading and rows(joined(**residual)) == rows(plain)


def test_members_of_a_large_dimension_are_not_broadcast(spark):
    key = F.when(F.col("id") < 3, F.col("id").cast("int"))
    dim = spark.range(1, 4).select(key.alias("k"))  # 1, 2 and NULL; Spark knows that they are few
    used = spark.createDataFrame([(1,), (3,), (3,), (None,), (-1,)], "k bigint")
    missing = missing_keys(dim, used, "k", -1)
    assert "Broadcast" not in missing._jdf.queryExecution().executedPlan().toString()
    assert rows(missing) == [(3,)]


SALE = (
    "order_number string, order_line_item bigint, order_date_key int, stock_date_key int, "
    "product_key bigint, customer_key bigint, territory_key bigint, order_quantity bigint"
)


def test_sales_base_resolves_versions_and_unknown_members(spark):
    sales = spark.createDataFrame(
        [("SO-101", 1, 20240515, 20240516, 100, 7, 3, 1), ("SO-102", 1, 20240515, 20240516, 101, None, None, 2)],
        SALE,
    )
    dim = spark.createDataFrame(
        [("hash_v1", 100, 20240101, 20240501), ("hash_v2", 100, 20240501, 99991231)], VERSIONS
    )
    fact = sales_base(sales, dim, "00ff")
    columns = ("order_number", "product_scd_key", "customer_key", "territory_key", "is_deleted", "lsn")
    assert rows(fact, *columns) == [
        ("SO-101", "hash_v2", 7, 3, False, "00ff"),
        ("SO-102", "-1", -1, -1, False, "00ff"),
    ]


def test_resolving_never_changes_the_number_of_rows(spark):
    sales = spark.createDataFrame(
        [(f"SO-{i}", 1, 20240100 + i, 20240101, i % 4, 1, 1, 1) for i in range(1, 29)], SALE
    ).withColumns({"is_deleted": F.lit(False), "lsn": F.lit("0"), "seqval": F.lit("0")})
    dim = spark.createDataFrame(
        [(f"{k}-{d}", k, 20240100 + d, 20240110 + d if d < 20 else None) for k in (1, 2) for d in (0, 10, 20)],
        VERSIONS,
    )
    assert resolve(sales, dim).count() == 28


def test_hot_keys_are_found_in_a_sample(spark, monkeypatch):
    monkeypatch.setattr("sparkmart.operators.joins.SAMPLE_ROWS", 100)
    df = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 4 == 1, None).otherwise(F.col("id")).alias("k")
    )
    hot = {r["k"]: r["_n"] for r in hot_keys(df, ["k"], 2000).collect()}
    assert hot.keys() == {7, None}
    assert 15_000 < hot[7] < 25_000 and 7_000 < hot[None] < 13_000
    assert hot_keys(df, ["k"], 40_000) is None


def test_without_hot_keys_the_join_is_plain(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    joined = salted_join(left, left.withColumn("v", F.lit(1)), ["k"])
    assert "_salt" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_known_sizes_spare_the_looking(spark, monkeypatch):
    left = spark.createDataFrame([(1, i) for i in range(50)] + [(None, 50), (2, 51)], "k int, x int")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "k int, y string")
    expected = rows(left.join(right, ["k"], "left"))
    spread = lookup_join(left, right, ["k"], rows=10, broadcast_rows=5, rows_per_task=10)
    assert rows(spread) == expected

    def never(*_):
        raise AssertionError("a known size needs no job")

    monkeypatch.setattr("sparkmart.operators.joins.is_bounded", never)
    monkeypatch.setattr("sparkmart.operators.joins.hot_keys", never)
    assert rows(lookup_join(left, right, ["k"], rows=2)) == expected
    assert rows(salted_join(left, right, ["k"], left_rows=52)) == expected
