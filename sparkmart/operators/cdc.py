"""Change logs: latest state, cursor, capture by comparing two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.session import STORED

# Operation codes of a change log.
DELETE, INSERT, BEFORE, AFTER = 1, 2, 3, 4

#: Ten zero bytes in hexadecimal, before every log position.
FIRST_LSN = "0" * 20

STATE_SCHEMA = "source string, lsn string, load_id string"


def hex_lsn(lsn: Column) -> Column:
    """A binary log position as fixed-width lower-case hexadecimal, which sorts alike."""
    return F.lower(F.hex(lsn))


def latest_state(
    log: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str] = ("lsn", "seqval"),
    op_col: str = "op",
) -> DataFrame:
    """The last event of every key, with ``is_deleted``.

    Before-images describe the past and are dropped; of events at one position the higher
    operation wins. Keeping only the first row lets Spark thin out each key before the
    shuffle, so a hot key arrives as one row per map task.
    """
    newest_first = [F.col(c).desc() for c in (*order_cols, op_col)]
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return (
        log.where(F.col(op_col) != BEFORE)
        .withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank")
        .withColumn("is_deleted", F.col(op_col) == DELETE)
    )


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The change rows that lead from ``old`` to ``new``; keys are unique on each side.

    Gives one delete or insert row, or a before- and an after-image, per changed key. One
    full outer join; rows without change produce nothing.
    """
    columns = list(old.columns)
    left = old.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.struct(*columns).alias("_old"))
    right = new.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.struct(*columns).alias("_new"))
    matched = F.lit(True)
    for k in keys:
        matched = matched & (F.col(f"_o_{k}") == F.col(f"_n_{k}"))
    gone, born = F.col("_new").isNull(), F.col("_old").isNull()
    changed = ~gone & ~born & ~F.col("_old").eqNullSafe(F.col("_new"))

    def image(side: str, op: int) -> Column:
        return F.struct(F.lit(op).alias("op"), *[F.col(side)[c].alias(c) for c in columns])

    events = F.array_compact(
        F.array(
            F.when(gone, image("_old", DELETE)),
            F.when(born, image("_new", INSERT)),
            F.when(changed, image("_old", BEFORE)),
            F.when(changed, image("_new", AFTER)),
        )
    )
    return (
        left.join(right, matched, "full_outer")
        .where(gone | born | changed)
        .select(F.explode(events).alias("_event"))
        .select("_event.*")
    )


def apply_changes(table: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``table`` after ``changes`` with at most one final event per key."""
    final = changes.where(F.col("op") != BEFORE)
    survivors = table.join(final.select(*keys), list(keys), "left_anti")
    return survivors.unionByName(final.where(F.col("op") != DELETE).select(*table.columns))


def store_snapshot(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256
) -> None:
    """Write a snapshot by bucket of its keys, with a checksum of every bucket beside it.

    Two snapshots to be compared take the same ``buckets``; their number should grow with the
    table, as one of them is what a single change costs.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    stored = df.withColumn("_bucket", bucket).repartitionById(buckets, "_bucket")
    stored.write.mode("overwrite").options(**STORED).partitionBy("_bucket").parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(stored.schema).parquet(f"{path}/rows")
    # NULLs leave a hash as it was, so where they are is hashed too.
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("string") for c in df.columns])
    values = [F.col(f"`{c}`") for c in df.columns]
    sums = rows.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.xxhash64(nulls, *values).cast("decimal(38,0)")).alias("_sum"),
        F.bit_xor(F.xxhash64(F.lit(1), nulls, *values)).alias("_xor"),
    )
    sums.write.mode("overwrite").options(**STORED).parquet(f"{path}/checksums")


def stored_diff(spark: SparkSession, old: str, new: str, keys: Sequence[str]) -> DataFrame:
    """``snapshot_diff`` of two stored snapshots; only buckets that differ are read.

    One number for each of those reaches the driver.
    """
    sums = [spark.read.parquet(f"{path}/checksums") for path in (old, new)]
    same = ["_bucket", "_rows", "_sum", "_xor"]
    either = sums[0].join(sums[1], same, "left_anti").select("_bucket")
    either = either.union(sums[1].join(sums[0], same, "left_anti").select("_bucket")).distinct()
    differing = either.join(
        sums[0].select("_bucket", F.lit(True).alias("_old")), "_bucket", "left"
    ).join(sums[1].select("_bucket", F.lit(True).alias("_new")), "_bucket", "left")
    buckets = differing.collect()

    def rows(path: str, side: str) -> DataFrame:
        paths = [f"{path}/rows/_bucket={r['_bucket']}" for r in buckets if r[side]]
        if not paths:
            return spark.read.parquet(f"{path}/rows").where(F.lit(False)).drop("_bucket")
        found = spark.read.option("basePath", f"{path}/rows").parquet(*paths)
        return found.drop("_bucket")

    before, after = rows(old, "_old"), rows(new, "_new")
    return snapshot_diff(before, after.select(*before.columns), keys)


def compact_log(
    log: DataFrame,
    keys: Sequence[str],
    below: str,
    order_cols: Sequence[str] = ("lsn", "seqval"),
    op_col: str = "op",
) -> DataFrame:
    """The log without what no one can ask of it any more.

    ``below`` is the low-water mark: all events up to that position have arrived. Of those the
    last one of each key stays, before-images and superseded events go, and so do deletes if the
    table holds no key they concern, which is for ``KeyedTable.forget`` to see to.
    """
    position = F.col(order_cols[0])
    settled = latest_state(log.where(position <= F.lit(below)), keys, order_cols, op_col)
    kept = settled.where(~F.col("is_deleted")).select(*log.columns)
    return kept.unionByName(log.where(position > F.lit(below)))


def checkpoint(log: DataFrame, source: str, load_id: str, lsn_col: str = "lsn") -> DataFrame:
    """One state row holding the highest position in ``log``; the start if it is empty."""
    return log.agg(F.coalesce(F.max(lsn_col), F.lit(FIRST_LSN)).alias("lsn")).select(
        F.lit(source).alias("source"), "lsn", F.lit(load_id).alias("load_id")
    )


def cursor(state: DataFrame, source: str) -> str:
    """The position up to which ``source`` has been read."""
    row = state.where(F.col("source") == source).agg(F.max("lsn")).first()
    return row[0] or FIRST_LSN


def read_since(log: DataFrame, lsn: str, lsn_col: str = "lsn") -> DataFrame:
    """The events after ``lsn``; a plain literal comparison, so it reaches the file scan."""
    return log.where(F.col(lsn_col) > F.lit(lsn))


def no_state(spark: SparkSession) -> DataFrame:
    """The state table before the first load."""
    return spark.createDataFrame([], STATE_SCHEMA)
