"""Previous and next row of each key, without ever holding a hot key in one task.

A plain ``lag``/``lead`` window sends all rows of a key to one task. Here hot keys are looked
for first. If there are none the plain window is used. Otherwise each hot key is cut into
stretches of its order by approximate quantiles; the window runs within stretches, and the
edges between stretches, few by construction, are stitched afterwards. The result is exact
either way: quantiles only decide where a key is cut.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.operators.joins import ROWS_PER_TASK, hot_keys, sampled
from sparkmart.session import materialise, workspace

@dataclass(frozen=True)
class Stretches:
    """How the rows of each key are cut: ``cuts`` holds the hot keys' boundaries, if any."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: DataFrame | None


def _matched(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on equal columns where NULL equals NULL: a window holds the NULL key as one key."""
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(right, same, how).drop(*[f"_r_{c}" for c in on])


def plan_stretches(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> Stretches:
    """Find the keys above ``rows_per_task`` and boundaries that cut them into stretches.

    A key gets boundaries in proportion to its own rows, so there are at most about
    ``rows / rows_per_task`` of them in all. They come from a sample and are written once:
    quantiles may differ from run to run, and all parts of a plan must see the same ones.
    """
    hot = hot_keys(df, keys, rows_per_task)
    if hot is None:
        return Stretches(tuple(keys), tuple(order), None)
    most = hot.agg(F.max("_n")).first()[0]
    pieces = max(2, -(-most // rows_per_task))
    fractions = [i / pieces for i in range(1, pieces)]
    every = F.greatest(F.lit(1), F.floor(F.lit(pieces * rows_per_task) / F.col("_n")))
    some, _ = sampled(df.select(*keys, order[0]), rows_per_task)
    cuts = (
        _matched(some, F.broadcast(hot), keys, "inner")
        .groupBy(*keys, "_n")
        .agg(F.percentile_approx(order[0], fractions, max(10_000, 5 * pieces)).alias("_all"))
        .withColumn("_every", every)
        .select(
            *keys,
            F.filter("_all", lambda _, i: (i + 1) % F.col("_every") == 0).alias("_cuts"),
        )
    )
    written = materialise(cuts, workspace(df.sparkSession, "stretches"))
    return Stretches(tuple(keys), tuple(order), written)


def with_neighbours(
    df: DataFrame,
    stretches: Stretches,
    *,
    previous: dict[str, Column] | None = None,
    following: dict[str, Column] | None = None,
) -> DataFrame:
    """Add columns taken from the previous and the following row of the same key.

    ``previous`` and ``following`` map new column names to expressions over a row; the
    value is NULL where there is no such row.
    """
    keys, order = list(stretches.keys), list(stretches.order)
    previous, following = previous or {}, following or {}
    if stretches.cuts is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.select(
            "*",
            *[F.lag(e).over(window).alias(n) for n, e in previous.items()],
            *[F.lead(e).over(window).alias(n) for n, e in following.items()],
        )

    # Rows up to and including a boundary lie before it, so equal values stay together.
    position = F.size(
        F.filter("_cuts", lambda cut: cut < F.col(order[0]))
    )
    cut_up = (
        _matched(df, F.broadcast(stretches.cuts), keys, "left")
        .withColumn("_stretch", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(position))
        .select(*df.columns, "_stretch", (F.col("_cuts").isNotNull()).alias("_hot"))
    )

    def packed(columns: dict[str, Column]) -> Column:
        return F.struct(F.lit(True).alias("_row"), *[e.alias(n) for n, e in columns.items()])

    inside = Window.partitionBy(*keys, "_stretch").orderBy(*order)
    rows = cut_up.select(
        "*",
        F.lag(packed(previous)).over(inside).alias("_prev"),
        F.lead(packed(following)).over(inside).alias("_next"),
    )
    across = Window.partitionBy(*keys).orderBy("_stretch")
    rank = F.struct(*order)
    edges = (
        cut_up.where("_hot")
        .groupBy(*keys, "_stretch")
        .agg(
            F.max_by(packed(previous), rank).alias("_last"),
            F.min_by(packed(following), rank).alias("_first"),
        )
        .select(
            *keys,
            "_stretch",
            F.lag("_last").over(across).alias("_edge_prev"),
            F.lead("_first").over(across).alias("_edge_next"),
        )
    )
    stitched = _matched(rows, F.broadcast(edges), [*keys, "_stretch"], "left")
    prev, nxt = F.coalesce("_prev", "_edge_prev"), F.coalesce("_next", "_edge_next")
    return stitched.select(
        *df.columns,
        *[prev.getField(n).alias(n) for n in previous],
        *[nxt.getField(n).alias(n) for n in following],
    )


def with_last(df: DataFrame, stretches: Stretches, column: str, into: str) -> DataFrame:
    """Add the last value of ``column`` that is not NULL, of the rows up to and including each.

    As with neighbours, hot keys run in stretches; the value a stretch ends with is handed on to
    the ones after it.
    """
    keys, order = list(stretches.keys), list(stretches.order)
    if stretches.cuts is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(into, F.last(column, ignorenulls=True).over(window))
    position = F.size(F.filter("_cuts", lambda cut: cut < F.col(order[0])))
    cut_up = (
        _matched(df, F.broadcast(stretches.cuts), keys, "left")
        .withColumn("_stretch", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(position))
        .select(*df.columns, "_stretch", (F.col("_cuts").isNotNull()).alias("_hot"))
    )
    inside = Window.partitionBy(*keys, "_stretch").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = cut_up.withColumn("_own", F.last(column, ignorenulls=True).over(inside))
    before = (
        Window.partitionBy(*keys)
        .orderBy("_stretch")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    edges = (
        cut_up.where("_hot")
        .groupBy(*keys, "_stretch")
        .agg(F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*order))).alias("_end"))
        .select(
            *keys, "_stretch", F.last("_end", ignorenulls=True).over(before).alias("_handed")
        )
    )
    stitched = _matched(rows, F.broadcast(edges), [*keys, "_stretch"], "left")
    return stitched.select(*df.columns, F.coalesce("_own", "_handed").alias(into))
