import random
from glob import glob
from os.path import getmtime

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators.merge import KeyedTable, hash_bucket, number_range_bucket, repair_keys
from sparkmart.sources.files import exists

SCHEMA = T.StructType(
    [
        T.StructField("order_number", T.StringType()),
        T.StructField("q", T.LongType()),
        T.StructField("is_deleted", T.BooleanType()),
        T.StructField("lsn", T.StringType()),
        T.StructField("seqval", T.StringType()),
    ]
)


def keyed(path, **options):
    options.setdefault("bucket", number_range_bucket("order_number", 10))
    return KeyedTable(path, SCHEMA, ("order_number",), **options)


def event(n, q, lsn, deleted=False):
    return (f"SO-{n}", q, deleted, lsn, "00")


def frame(spark, events):
    return spark.createDataFrame(events, SCHEMA)


def content(table, spark):
    return rows(table.read(spark), "order_number", "q", "is_deleted", "lsn")


def test_buckets(spark):
    df = spark.createDataFrame([("SO-7",), ("SO-10",), ("X",), ("SO-99x",)], "order_number string")
    by_range = df.select("order_number", number_range_bucket("order_number", 10).alias("b"))
    found = dict(rows(by_range))
    assert found["SO-10"] == 1 and found["SO-7"] == 0
    assert -1024 <= found["X"] < 0 and -1024 <= found["SO-99x"] < 0
    by_hash = df.select(hash_bucket(["order_number"], 4).alias("b"))
    assert by_hash.where("b < 0 or b > 3").count() == 0


@pytest.mark.parametrize("rows_per_file", [1000, 3])
def test_upsert_inserts_updates_and_marks_deletes(spark, table, rows_per_file):
    t = keyed(table(), rows_per_file=rows_per_file)
    t.replace(frame(spark, [event(n, n, "00") for n in range(30)]))
    t.upsert(frame(spark, [event(5, 50, "01"), event(6, 6, "01", True), event(40, 40, "01")]))
    expected = {n: (n, False, "00") for n in range(30)}
    expected.update({5: (50, False, "01"), 6: (6, True, "01"), 40: (40, False, "01")})
    assert content(t, spark) == sorted((f"SO-{n}", *v) for n, v in expected.items())


def test_a_hot_bucket_is_written_by_many_tasks(spark, table):
    t = keyed(table(), bucket=number_range_bucket("order_number", 1000), rows_per_file=100)
    t.replace(frame(spark, [event(n, n, "00") for n in range(500)]))
    assert 2 <= len(glob(f"{t.path}/bucket=0/*.parquet")) <= 5
    t.upsert(frame(spark, [event(n, -n, "01") for n in range(250, 1200)]))
    expected = {f"SO-{n}": n if n < 250 else -n for n in range(1200)}
    assert dict(rows(t.read(spark), "order_number", "q")) == expected


def test_repeated_upsert_changes_nothing(spark, table):
    t = keyed(table())
    t.upsert(frame(spark, [event(1, 1, "01"), event(11, 1, "01")]))
    before = content(t, spark)
    t.upsert(frame(spark, [event(1, 1, "01"), event(11, 1, "01")]))
    assert content(t, spark) == before


def test_only_touched_buckets_are_rewritten(spark, table):
    t = keyed(table())
    t.replace(frame(spark, [event(n, n, "00") for n in range(50)]))
    before = {f: getmtime(f) for f in glob(f"{t.path}/bucket=*/*.parquet")}
    t.upsert(frame(spark, [event(12, 0, "01")]))
    after = set(glob(f"{t.path}/bucket=*/*.parquet"))
    gone = {f.split("bucket=")[1][0] for f in before.keys() - after}
    assert gone == {"1"}
    assert all(getmtime(f) == before[f] for f in before.keys() & after)


def test_older_event_arriving_later_is_ignored(spark, table):
    t = keyed(table())
    t.upsert(frame(spark, [event(1, 9, "05", True)]))
    t.upsert(frame(spark, [event(1, 3, "04"), event(2, 2, "01")]))
    assert content(t, spark) == [("SO-1", 9, True, "05"), ("SO-2", 2, False, "01")]
    t.upsert(frame(spark, [event(1, 4, "06")]))
    assert content(t, spark)[0] == ("SO-1", 4, False, "06")


def test_result_does_not_depend_on_how_the_events_are_cut(spark, table):
    rng = random.Random(5)
    events = [event(rng.randrange(25), i, f"{i:04d}", rng.random() < 0.3) for i in range(120)]
    final = {}
    for e in events:
        final[e[0]] = (e[0], e[1], e[2], e[3])
    expected = sorted(final.values())
    for cut in (1, 3):
        shuffled = [events[i::cut] for i in range(cut)]
        rng.shuffle(shuffled)
        t = keyed(table(), rows_per_file=4)
        for part in shuffled:
            newest = {}
            for e in part:
                newest[e[0]] = e
            t.upsert(frame(spark, list(newest.values())))
        assert content(t, spark) == expected


def test_hard_delete_empties_a_bucket(spark, table):
    t = keyed(table(), delete_mode="hard")
    t.replace(frame(spark, [event(1, 1, "00"), event(11, 1, "00"), event(12, 1, "00")]))
    t.upsert(frame(spark, [event(1, 1, "01", True), event(11, 1, "01", True)]))
    assert content(t, spark) == [("SO-12", 1, False, "00")]
    with pytest.raises(ValueError):
        keyed(table(), delete_mode="gone")


def test_hard_delete_survives_a_replay(spark, table):
    t = keyed(table(), delete_mode="hard")
    inserted, deleted = event(1, 1, "01"), event(1, 7, "02", True)
    for step in (inserted, deleted, inserted, deleted):
        t.upsert(frame(spark, [step]))
    assert content(t, spark) == []
    stored = spark.read.parquet(t.path).select("order_number", "q", "lsn")
    assert rows(stored) == [("SO-1", None, "02")]
    t.upsert(frame(spark, [event(1, 3, "03")]))
    assert content(t, spark) == [("SO-1", 3, False, "03")]


def test_sparse_numbers_do_not_multiply_buckets(spark, table):
    rng = random.Random(3)
    numbers = rng.sample(range(10**15), 400)
    t = keyed(table(), bucket=number_range_bucket("order_number", 10, buckets=4))
    t.upsert(frame(spark, [event(n, i, "01") for i, n in enumerate(numbers)]))
    assert len(glob(f"{t.path}/bucket=*")) <= 4
    assert len(content(t, spark)) == 400


def test_corrections_replace_rows_of_their_own_position_only(spark, table):
    t = keyed(table())
    t.upsert(frame(spark, [event(1, 1, "01"), event(2, 2, "05")]))
    t.upsert(frame(spark, [event(1, 9, "01"), event(2, 9, "04")]), corrects=True)
    assert content(t, spark) == [("SO-1", 9, False, "01"), ("SO-2", 2, False, "05")]


def test_crash_before_the_result_is_complete_leaves_the_table(spark, table, monkeypatch):
    t = keyed(table())
    t.replace(frame(spark, [event(1, 1, "00")]))
    broken = frame(spark, [event(1, 2, "01")]).withColumn(
        "q", F.when(F.col("q") > 0, F.raise_error(F.lit("crash"))).cast("bigint")
    )
    with pytest.raises(Exception, match="crash"):
        t.upsert(broken)
    assert content(t, spark) == [("SO-1", 1, False, "00")]
    t.upsert(frame(spark, [event(1, 2, "01")]))
    assert content(t, spark) == [("SO-1", 2, False, "01")]


def test_crash_while_publishing_is_recovered(spark, table, monkeypatch):
    t = keyed(table())
    t.replace(frame(spark, [event(n, n, "00") for n in range(20)]))

    def crash(self, session):
        # The worst moment: a bucket of the table is already gone.
        from sparkmart.sources.files import remove

        remove(session, f"{self.path}/bucket=0")
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_publish", crash)
        with pytest.raises(RuntimeError):
            t.upsert(frame(spark, [event(1, 100, "01")]))
    assert exists(spark, f"{t.path}__staged/_SUCCESS")
    t.upsert(frame(spark, [event(1, 100, "01"), event(15, 5, "02")]))
    assert not exists(spark, f"{t.path}__staged")
    expected = {n: (n, "00") for n in range(20)}
    expected.update({1: (100, "01"), 15: (5, "02")})
    assert rows(t.read(spark), "order_number", "q", "lsn") == sorted(
        (f"SO-{n}", *v) for n, v in expected.items()
    )


def test_upsert_of_nothing(spark, table):
    t = keyed(table())
    t.upsert(frame(spark, []))
    assert content(t, spark) == []


@pytest.mark.parametrize("many", [False, True])
def test_repair_gives_known_customers_their_key(spark, many, monkeypatch):
    if many:
        monkeypatch.setattr("sparkmart.operators.joins.is_bounded", lambda df, n: False)
    fact = spark.createDataFrame(
        [(1, "C-5", -1), (2, "C-6", -1), (3, "C-5", 77), (4, None, -1), (5, "C-5", None)],
        "id bigint, customer_reference string, customer_key bigint",
    )
    dim = spark.createDataFrame(
        [("C-5", 5), ("C-7", 7), (None, 9), ("C-6", -1)], "customer_reference string, customer_key bigint"
    )
    repaired = repair_keys(fact, dim, "customer_reference", "customer_key")
    assert rows(repaired, "id", "customer_key") == [(1, 5), (2, -1), (3, 77), (4, -1), (5, None)]
