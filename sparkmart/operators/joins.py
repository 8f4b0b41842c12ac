"""Joins of a large table to a lookup table, safe against hot keys on either scale.

A lookup side is broadcast only after its row count has been checked. Beyond the bound the
join shuffles, and keys too frequent for one task are salted in proportion to their count. Spark
goes by stored size, which is small for many rows stored well, and is only left to choose up to a
second bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.session import materialise, workspace

#: Most rows a broadcast side may have.
BROADCAST_ROWS = 1_000_000
#: Most rows of a larger side that Spark may still broadcast, where it takes it for small.
LEFT_TO_SPARK_ROWS = 2_000_000
#: Most rows of one key that a single task should be given.
ROWS_PER_TASK = 4_000_000
#: Rows a key of that size has in the sample that hot keys are looked for in.
SAMPLE_ROWS = 1_000


def is_bounded(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows.

    A count combines within each task and, over a stored table, reads no column at all; a
    ``limit`` would move the rows themselves to a single task.
    """
    return df.count() <= max_rows


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    residual: Column | None = None,
    sized_by: DataFrame | None = None,
    rows: int | None = None,
    keys_from: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``left`` to the lookup table ``right`` on equal ``on`` columns.

    ``how`` is ``left``, ``inner``, ``left_anti`` or ``left_semi``. Apart from ``on`` the
    two sides must share no column name; ``residual`` may then refer to columns of both by
    name. ``sized_by`` is a cheaper table to count that has at least as many rows as
    ``right``; ``rows`` is such a number, where it is known already, and nothing is counted.
    ``keys_from`` is as for ``salted_join``.
    """
    def within(bound: int) -> bool:
        if rows is not None:
            return rows <= bound
        return is_bounded(right if sized_by is None else sized_by, bound)

    if within(broadcast_rows):
        return _equi_join(left, F.broadcast(right), on, how, residual)
    return salted_join(
        left,
        right,
        on,
        how,
        residual=residual,
        keys_from=keys_from,
        rows_per_task=rows_per_task,
        shuffled=not within(LEFT_TO_SPARK_ROWS),
    )


def sampled(df: DataFrame, rows_per_task: int) -> tuple[DataFrame, float]:
    """A sample that holds about a thousand of every ``rows_per_task`` rows, and its fraction."""
    fraction = min(1.0, SAMPLE_ROWS / rows_per_task)
    return (df if fraction == 1.0 else df.sample(fraction, seed=1)), fraction


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int) -> DataFrame | None:
    """Keys with more than ``rows_per_task`` rows and how many (``_n``); None if there are none.

    They are found in a sample: a key that hot cannot hide in it, and an error only shifts
    work between tasks. There are at most about ``rows / rows_per_task`` of them, so they
    may be broadcast. They are written once, for every part of a plan that uses them to see
    the same ones, also when a lost task is run again.
    """
    some, fraction = sampled(df.select(*keys), rows_per_task)
    found = (
        some.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > rows_per_task * fraction)
        .withColumn("_n", F.ceil(F.col("_n") / F.lit(fraction)))
    )
    written = materialise(found, workspace(df.sparkSession, "hot-keys"))
    return None if written.isEmpty() else written


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    *,
    residual: Column | None = None,
    left_rows: int | None = None,
    keys_from: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    shuffled: bool = False,
) -> DataFrame:
    """Shuffle join that spreads each hot ``left`` key over as many tasks as it needs.

    Without hot keys it is a plain join; none is looked for where ``left`` is known to have so few
    rows (``left_rows``) that one task can take them all. ``keys_from`` is a table to look in that is
    cheaper to read than ``left`` and has each key at least as often, such as the one ``left`` was
    reduced from; else ``left`` itself, with all that leads to it, is computed once more. Salts are a hash of the row, hence the same when a
    lost task is run again. Exact copies of a row share a salt; should they alone fill a
    task, adaptive execution splits it by its inputs, which a plain shuffle join such as
    this one allows. With ``shuffled`` Spark may not broadcast a side it takes for small.
    """
    fits = left_rows is not None and left_rows <= rows_per_task
    hot = None if fits else hot_keys(left if keys_from is None else keys_from, on, rows_per_task)
    if hot is None:
        return _equi_join(left, right, on, how, residual, shuffled)
    hot = F.broadcast(
        hot.select(*on, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))
    )
    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    has_null_key = F.lit(False)
    for c in on:
        has_null_key = has_null_key | F.col(c).isNull()
    # A NULL key matches nothing, so its rows may go anywhere.
    salts = F.when(has_null_key, F.lit(1 << 20)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = left.join(hot, list(on), "left").select(
        *left.columns, F.pmod(row_hash, salts).cast("int").alias("_salt")
    )
    salted_right = right.join(hot, list(on), "left").select(
        *right.columns,
        F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)).alias("_salt"),
    )
    return _equi_join(salted_left, salted_right, [*on, "_salt"], how, residual, shuffled).drop("_salt")


def _equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    residual: Column | None,
    shuffled: bool = False,
) -> DataFrame:
    if residual is not None:
        right = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    if shuffled:
        right = right.hint("merge")
    if residual is None:
        return left.join(right, list(on), how)
    condition = residual
    for c in on:
        condition = (F.col(c) == F.col(f"_r_{c}")) & condition
    return left.join(right, condition, how).drop(*[f"_r_{c}" for c in on])
