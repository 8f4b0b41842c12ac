"""Publication by version: what readers see while a writer writes, fails or is cut off."""

import random
from glob import glob

import pytest
from helpers import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators import checks, scd2
from sparkmart.operators.checks import ChecksFailed
from sparkmart.operators.merge import Summary, VersionedTable, Waiting, number_range_bucket
from sparkmart.plans import facts, pipeline
from sparkmart.sources import versions

from datetime import date, datetime
from test_pipeline import FIRST, log, sources
from test_stream import RAW_LOG

TEXT, LONG, FLAG = T.StringType(), T.LongType(), T.BooleanType()
COLUMNS = {
    "order_number": TEXT, "ref": TEXT, "key": LONG, "day": LONG, "is_deleted": FLAG, "lsn": TEXT, "seqval": TEXT,
}
SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in COLUMNS.items()])


def table_at(path):
    return VersionedTable(
        path,
        SCHEMA,
        ("order_number",),
        number_range_bucket("order_number", 10),
        waiting=(Waiting("customer", "ref", "key", -1),),
        summaries=(
            Summary("first", ~F.col("is_deleted"), F.col("key"), F.col("day")),
            Summary("days", ~F.col("is_deleted"), F.col("day"), F.col("day")),
        ),
    )


def event(n, key, lsn, deleted=False, ref=None, day=None):
    return (f"SO-{n}", ref, key, n if day is None else day, deleted, lsn, "00")


def frame(spark, events):
    return spark.createDataFrame(events, SCHEMA)


def content(t, spark):
    return rows(t.read(spark), "order_number", "key", "is_deleted")


def test_replace_append_and_old_versions(spark, table):
    path = table()
    assert not versions.published(spark, path)
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    versions.replace(spark.range(5), path)
    versions.replace(versions.read(spark, path).where("id < 2"), path)
    versions.append(spark.range(7, 9), path)
    assert rows(versions.read(spark, path)) == [(0,), (1,), (7,), (8,)]
    assert versions.read(spark, path, 1).count() == 5
    versions.vacuum(spark, path, last=1)
    assert rows(versions.read(spark, path)) == [(0,), (1,), (7,), (8,)]
    assert versions.numbers(spark, f"{path}/{versions.POINTERS}") == [3]
    assert len(glob(f"{path}/_gen=*")) == 2
    empty = table()
    versions.replace(spark.range(0).selectExpr("id", "'x' AS name"), empty)
    assert versions.read(spark, empty).dtypes == [("id", "bigint"), ("name", "string")]


def test_second_writer_of_a_version_fails(spark, table):
    path = table()
    versions.replace(spark.range(1), path)
    with pytest.raises(versions.Conflict):
        versions.publish(spark, path, spark.range(1).schema, [], 0)


def test_upsert_writes_touched_buckets_once(spark, table):
    t = table_at(table())
    t.replace(frame(spark, [event(n, 1, "00") for n in range(50)]))
    t.upsert(frame(spark, [event(12, 2, "01"), event(45, 3, "01", True)]))
    first, second = sorted(glob(f"{t.path}/_gen=*"), key=lambda f: len(glob(f"{f}/bucket=*")))[::-1]
    assert len(glob(f"{first}/bucket=*")) == 5 and len(glob(f"{second}/bucket=*")) == 2
    found = dict((n, (k, d)) for n, k, d in content(t, spark))
    assert len(found) == 50 and found["SO-12"] == (2, False) and found["SO-45"] == (3, True)
    assert t.at(1).read(spark).where("key <> 1").count() == 0
    with pytest.raises(ValueError):
        t.at(1).upsert(frame(spark, [event(1, 1, "09")]))
    versions.vacuum(spark, t.path, last=1)
    assert len(glob(f"{first}/bucket=*")) == 3 and content(t, spark) == sorted(
        (n, k, d) for n, (k, d) in found.items()
    )


@pytest.mark.parametrize("step", ["write", "summary", "pointer"])
def test_crash_at_any_step_leaves_the_version_before(spark, table, monkeypatch, step):
    t = table_at(table())
    t.replace(frame(spark, [event(n, 1, "00") for n in range(20)]))
    before = content(t, spark)
    reader = t.read(spark)  # planned before, read afterwards
    events = frame(spark, [event(1, 2, "01")])

    def crash(*_):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        if step == "write":
            events = events.withColumn("key", F.raise_error(F.lit("crash")).cast("bigint"))
        elif step == "summary":
            m.setattr(VersionedTable, "_summarise", crash)
        else:
            m.setattr(versions, "write_once", crash)
        with pytest.raises(Exception, match="crash"):
            t.upsert(events)
    assert content(t, spark) == before
    t.upsert(frame(spark, [event(1, 2, "01")]))
    assert content(t, spark)[1] == ("SO-1", 2, False)
    assert rows(reader, "order_number", "key", "is_deleted") == before
    versions.vacuum(spark, t.path, last=1)
    assert len(glob(f"{t.path}/_gen=*")) == 2 and len(content(t, spark)) == 20


def test_waiting_rows_are_found_by_reference(spark, table):
    t = table_at(table())
    t.upsert(frame(spark, [event(n, -1 if n % 7 == 3 else 1, "00", ref=f"C-{n}") for n in range(60)]))
    names = lambda *found: spark.createDataFrame([(f,) for f in found], "r string")
    assert rows(t.waiting_rows(spark, "customer", names("C-17", "C-9")), "order_number") == [
        ("SO-10",), ("SO-17",)
    ]
    assert t.waiting_rows(spark, "customer", names("C-9", "C-4711")) is None
    # A bucket that is rewritten takes its part of the index along.
    t.upsert(frame(spark, [event(17, 5, "01", ref="C-17")]))
    assert t.waiting_rows(spark, "customer", names("C-17")) is None
    assert t.waiting_rows(spark, "customer", names("C-10")).count() == 1
    plan = t.waiting_rows(spark, "customer", names("C-10"))._jdf.queryExecution().toString()
    assert "bucket" in plan and "EqualTo(key,-1)" in plan


def test_summaries_equal_the_table_after_random_upserts(spark, table):
    rng = random.Random(2)
    t = table_at(table())
    for step in range(4):
        chosen = rng.sample(range(80), 25)
        t.upsert(frame(spark, [
            event(n, rng.randrange(5), f"{step:02d}", rng.random() < 0.4, day=rng.randrange(6)) for n in chosen
        ]))
    live = t.read(spark).where("NOT is_deleted")
    first = t.summary(spark, "first").groupBy("key").agg(F.min("least").alias("d"))
    assert rows(first.selectExpr("cast(key as bigint)", "d")) == rows(live.groupBy("key").agg(F.min("day")))
    days = t.summary(spark, "days").groupBy("key").agg(F.sum("n").alias("n"))
    assert rows(days.selectExpr("cast(key as bigint)", "n")) == rows(live.groupBy("day").agg(F.count("*")))
    assert first.inputFiles() and all("/_summary/" in f for f in first.inputFiles())


def test_closed_versions_are_written_once(spark, table):
    history = scd2.History(table(), "k", ("v",))
    seen = lambda *found: spark.createDataFrame(found, "k bigint, v string")
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    plain = scd2.empty_history(seen())
    closed = []
    for day, found in zip(days, (seen((1, "a"), (2, "b")), seen((1, "x"), (2, "b")), seen((1, "y"), (3, "c"))), strict=True):
        history.observe(found, day)
        plain = spark.createDataFrame(scd2.apply(plain, found, "k", ("v",), F.lit(day)).collect(), plain.schema)
        assert rows(history.read(spark)) == rows(plain.select(*history.read(spark).columns))
        now = {f for f in glob(f"{history.path}/_gen=*/_state=closed/*.parquet")}
        assert set(closed) <= now
        closed = sorted(now)
    assert len(closed) >= 2
    last = history.before(spark, "9999")
    assert [p.kind for p in last.parts] == ["closed", "closed", "open"]
    # A day run again builds on the day before it.
    again = history.observe(seen((1, "y"), (3, "c")), days[2])
    assert rows(history.read(spark, again.number)) == rows(history.read(spark, last.number))
    assert history.read(spark).where("valid_to IS NULL").count() == 3


def test_readers_keep_the_release_of_before_a_failing_check(spark, table):
    wh = pipeline.Warehouse(spark, table())
    first = sources(spark)
    for name in ("sales", "customers"):
        known = F.concat(F.lit("A-"), F.col("customer_key"))
        first[name] = first[name].withColumn("customer_reference", known)
    first["sales"] = first["sales"].withColumn("customer_key", F.when(F.col("customer_key") != 77, F.col("customer_key")))
    pipeline.bootstrap(wh, first, log(spark, [(1, 1, 10, 2, 1)]), FIRST, "boot")
    assert rows(wh.star().sales, "order_number", "customer_key") == [("SO-1", 1), ("SO-2", -1)]
    released = versions.released(spark, wh.path("marts", ""))

    # A sale without a quantity is loaded and found; readers never see it.
    day = datetime(2024, 1, 1)
    bad = spark.createDataFrame([(day, day, "SO-9", 1, 1, 1, 1, None, 2, f"{9:020x}", "0" * 20)], RAW_LOG)
    before = log(spark, [(1, 1, 10, 2, 1)])
    with pytest.raises(ChecksFailed, match="order_quantity.not_null"):
        pipeline.run_increment(wh, before.unionByName(bad), "inc", as_of=date(2024, 1, 2))
    assert wh.sales.read(spark).count() == 3 and wh.star().sales.count() == 2
    assert versions.released(spark, wh.path("marts", "")) == released

    # It is put right, the customer of SO-2 has come, and the next release has both.
    good = spark.createDataFrame([(day, day, "SO-9", 1, 1, 1, 1, 5, 4, f"{10:020x}", "0" * 20)], RAW_LOG)
    pipeline.run_increment(
        wh, before.unionByName(bad).unionByName(good), "inc-2", as_of=date(2024, 1, 2), accepted=["fct_sales.volume"]
    )
    late = dict(first)
    late["customers"] = first["customers"].unionByName(
        first["customers"].withColumns({"customer_key": F.lit(77).cast("bigint"), "customer_reference": F.lit("A-77")})
    )
    pipeline.refresh_dimensions(wh, late, date(2024, 1, 2), "day-2")
    assert rows(wh.star().sales, "order_number", "order_quantity", "customer_key") == [
        ("SO-1", 10, 1), ("SO-2", 20, 77), ("SO-9", 5, 1)
    ]


def test_checks_of_an_increment_do_not_read_the_fact(spark, table):
    t = facts.sales_table(table())
    day = facts.order_days(t, spark).withColumn("order_date", F.lit(date(2024, 1, 1)))
    stats = checks.volume_stats(
        spark.createDataFrame([(date(2024, 1, 1), 4), (date(2024, 1, 1), 3), (date(2023, 12, 31), 7)], "d date, n bigint"),
        "d", date(2024, 1, 2), "n",
    )
    assert rows(stats) == [(7, 7.0, 100.0)]
    assert day.count() == 0 and facts.first_orders(t, spark).columns == ["product_key", "order_date_key"]
