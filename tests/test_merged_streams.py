"""As-of by merge, running last values, stored snapshots, compaction and exact tiles."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators import cdc, checks
from sparkmart.operators.asof import asof_join, asof_merge
from sparkmart.operators.merge import VersionedTable, number_range_bucket
from sparkmart.operators.ranks import tile, with_row_number


@pytest.mark.parametrize("rows_per_task", [1_000_000, 20])
def test_asof_merge_equals_the_join(spark, rows_per_task):
    rng = random.Random(4)
    versions = []
    for key in (1, 2, None):
        ends = sorted(rng.sample(range(100), 12 if key == 1 else 3))
        versions += [(key, a, b, f"{key}-{a}") for a, b in zip(ends, [*ends[1:-1], None, None], strict=True)][:-1]
    versions += [(1, 200, 200, "empty"), (3, 5, 9, "closed")]
    facts = [(i, rng.choice([1, 1, 1, 2, 3, 4, None]), rng.choice([None, *range(-5, 110)])) for i in range(300)]
    left = spark.createDataFrame(facts, "id int, k int, d int")
    right = spark.createDataFrame(versions, "k int, valid_from_key int, valid_to_key int, v string")
    got = asof_merge(left, right, "k", "d", ["v"], rows_per_task=rows_per_task)
    expected = asof_join(left, right, "k", "d", ["v"])
    assert rows(got, "id", "k", "d", "v") == rows(expected, "id", "k", "d", "v")
    assert got.where("v IS NOT NULL").count() > 50


def test_only_buckets_that_differ_are_read(spark, table):
    old, new = table(), table()
    before = spark.range(2000).selectExpr("id", "if(id % 3 = 0, NULL, 'a') AS x", "if(id % 3 = 0, 'a', NULL) AS y")
    after = before.where("id <> 7").withColumn("y", F.expr("if(id = 9, 'b', y)"))
    # Swapped NULLs are a change as well.
    after = after.withColumns({"x": F.expr("if(id = 12, 'a', x)"), "y": F.expr("if(id = 12, NULL, y)")})
    after = after.unionByName(spark.createDataFrame([(5000, "n", None)], "id bigint, x string, y string"))
    cdc.store_snapshot(before, old, ["id"], 50)
    cdc.store_snapshot(after, new, ["id"], 50)
    got = cdc.stored_diff(spark, old, new, ["id"])
    assert rows(got) == rows(cdc.snapshot_diff(before, after, ["id"]))
    assert len({f.split("_bucket=")[1].split("/")[0] for f in got.inputFiles()}) <= 4
    assert cdc.stored_diff(spark, old, old, ["id"]).count() == 0


def test_marks_are_forgotten_and_the_log_compacted(spark, table):
    fields = [("order_number", T.StringType()), ("q", T.LongType()), ("is_deleted", T.BooleanType()),
              ("lsn", T.StringType()), ("seqval", T.StringType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    t = VersionedTable(table(), schema, ("order_number",), number_range_bucket("order_number", 10), delete_mode="hard")
    t.upsert(spark.createDataFrame(
        [(f"SO-{n}", n, n % 2 == 0, f"{n:02d}", "0") for n in range(1, 30)], schema))
    stored = lambda: t._rows(spark).where("is_deleted").count()
    assert stored() == 14
    seen = rows(t.read(spark), "order_number")
    t.forget(spark, "20")
    assert stored() == 4 and rows(t.read(spark), "order_number") == seen
    log = spark.createDataFrame(
        [("a", "01", "0", 2, 1), ("a", "02", "0", 3, 1), ("a", "02", "0", 4, 2), ("b", "01", "0", 2, 5),
         ("b", "03", "0", 1, 5), ("c", "05", "0", 2, 7), ("c", "06", "0", 4, 8)],
        "k string, lsn string, seqval string, op int, q int",
    )
    assert rows(cdc.compact_log(log, ["k"], "03"), "k", "lsn", "op") == [
        ("a", "02", 4), ("c", "05", 2), ("c", "06", 4)
    ]


@pytest.mark.parametrize("n", [0, 3, 5, 17, 100])
def test_tiles_equal_ntile(spark, n):
    df = spark.range(n).selectExpr("id", "id % 7 AS v")
    got = with_row_number(df, [F.col("v").desc(), F.col("id")], "place", "total")
    got = got.withColumn("t", tile(F.col("place"), F.col("total"), 5))
    expected = df.selectExpr("id", "row_number() OVER (ORDER BY v DESC, id) AS place", "ntile(5) OVER (ORDER BY v DESC, id) AS t")
    assert rows(got, "id", "place", "t") == rows(expected)


def test_foreign_keys_of_a_table_take_one_scan(spark, table):
    path = table()
    spark.createDataFrame([(1, "x", 9), (2, None, 9), (3, "y", None)], "a int, b string, c bigint").write.parquet(path)
    child = spark.read.parquet(path)
    parents = {"a": spark.range(2), "b": spark.createDataFrame([("x",)], "id string"), "c": spark.range(9)}
    rules = [checks.Check(f"t.{c}", child, relation=checks.Relation(c, p, "id")) for c, p in parents.items()]
    found = checks.run(rules)
    assert rows(found, "name", "failures", "status") == [("t.a", 2, "fail"), ("t.b", 1, "fail"), ("t.c", 2, "fail")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
