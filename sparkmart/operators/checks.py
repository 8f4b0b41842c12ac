"""Declarative data-quality checks.

A check is a DataFrame of violating rows or, for the column checks, a condition counted in
one pass over the table together with all its other conditions. The outcome is one row per
check.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.keys import date_key
from sparkmart.operators.joins import ROWS_PER_TASK
from sparkmart.operators.neighbours import plan_stretches, with_neighbours


@dataclass(frozen=True)
class Relation:
    """A foreign key: ``column`` of the checked table has to be in ``key`` of ``parent``."""

    column: str
    parent: DataFrame
    key: str


@dataclass(frozen=True)
class Check:
    """A named rule over ``table``.

    ``condition`` marks violating rows of ``table``; without one, ``table`` itself holds
    the violations, one per row, or as many as its column ``violations`` says. With a
    ``relation`` the violations are rows of ``table`` whose key has no parent. More than
    ``warn_if`` violations warn, more than ``error_if`` fail.
    """

    name: str
    table: DataFrame
    condition: Column | None = None
    severity: str = "error"
    warn_if: int = 0
    error_if: int | None = None
    relation: Relation | None = None


# Column checks: conditions that mark violating rows.


def not_null(column: str) -> Column:
    return F.col(column).isNull()


def accepted_values(column: str, values: Sequence[object]) -> Column:
    """NULL is not a violation."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


# Table checks: DataFrames of violations.


def duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """Non-NULL values (or combinations) that occur more than once."""
    present = df
    for c in columns:
        present = present.where(F.col(c).isNotNull())
    return present.groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences")).where(
        F.col("occurrences") > 1
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-NULL foreign keys without a parent, with the number of rows that hold them.

    The rows are counted per key before the anti join, so a hot key is one row by then.
    """
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("violations"))
    )
    keys = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull())
    return used.join(keys, column, "left_anti")


def scd2_overlaps(
    versions: DataFrame,
    key: str,
    valid_from: str = "valid_from_key",
    valid_to: str = "valid_to_key",
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Versions that are not over when the next one of their key starts.

    Versions starting together are ordered by their end, so the empty interval left by two
    changes in a day comes first and raises no alarm.
    """
    ordered = versions.select(key, valid_from, valid_to).withColumn(
        "_end", F.coalesce(F.col(valid_to), F.lit(99991231))
    )
    stretches = plan_stretches(ordered, [key], [valid_from, "_end"], rows_per_task)
    return (
        with_neighbours(ordered, stretches, following={"next_valid_from": F.col(valid_from)})
        .where(F.col("next_valid_from") < F.col(valid_to))
        .drop("_end")
    )


def future_dates(df: DataFrame, column: str, as_of: date) -> DataFrame:
    return df.where(F.col(column) >= F.lit(as_of))


def negative_margins(df: DataFrame, price: str, cost: str) -> DataFrame:
    return df.where(F.col(price) < F.col(cost))


def returned_before_ordered(sales: DataFrame, returns: DataFrame) -> DataFrame:
    """Products whose first return lies before their first order."""
    ordered = sales.groupBy("product_key").agg(F.min("order_date_key").alias("first_order_date_key"))
    returned = returns.groupBy("product_key").agg(
        F.min("return_date_key").alias("first_return_date_key")
    )
    return returned.join(ordered, "product_key").where(
        F.col("first_return_date_key") < F.col("first_order_date_key")
    )


def stale(df: DataFrame, day_key: str, as_of: date) -> DataFrame:
    """One row if the newest day is older than yesterday or there is none, else no row."""
    yesterday = date_key(F.lit(as_of - timedelta(days=1)))
    newest = df.agg(F.max(day_key).alias("latest_day_key"))
    return newest.where(F.col("latest_day_key").isNull() | (F.col("latest_day_key") < yesterday))


def volume_stats(
    df: DataFrame, day: str, as_of: date, rows: str | None = None
) -> DataFrame:
    """Rows of yesterday against the mean of the days present in the week before.

    ``day`` is a date column. A missing yesterday counts as zero. ``rows`` names a column with
    the number of rows each row of ``df`` stands for.
    """
    number = F.count(F.lit(1)) if rows is None else F.sum(rows)
    yesterday = F.lit(as_of - timedelta(days=1))
    daily = (
        df.where(F.col(day).between(F.lit(as_of - timedelta(days=8)), yesterday))
        .groupBy(day)
        .agg(number.alias("_rows"))
    )
    return daily.agg(
        F.coalesce(F.max(F.when(F.col(day) == yesterday, F.col("_rows"))), F.lit(0)).alias(
            "yesterday_rows"
        ),
        F.avg(F.when(F.col(day) < yesterday, F.col("_rows"))).alias("usual_rows"),
    ).withColumn(
        "percentage_of_normal",
        F.col("yesterday_rows") / F.nullif(F.col("usual_rows"), F.lit(0.0)) * 100,
    )


def volume_anomaly(
    df: DataFrame,
    day: str,
    as_of: date,
    low: float = 0.3,
    high: float | None = None,
    rows: str | None = None,
) -> DataFrame:
    """One row if yesterday's volume is out of bounds, or nothing is there to compare."""
    stats = volume_stats(df, day, as_of, rows)
    off = (
        F.col("usual_rows").isNull()
        | (F.col("yesterday_rows") < F.col("usual_rows") * low)
    )
    if high is not None:
        off = off | (F.col("yesterday_rows") > F.col("usual_rows") * high)
    return stats.where(off)


# Running checks.


def _without_parent(group: Sequence[Check]) -> DataFrame:
    """Rows of (name, failures) of all foreign keys of one table.

    One pass counts the rows per foreign key and value, within each task first, so a hot value
    is one row by then; one anti join meets the keys of all parents.
    """
    used = F.array(
        *[
            F.when(
                F.col(c.relation.column).isNotNull(),
                F.struct(
                    F.lit(c.name).alias("name"), F.col(c.relation.column).cast("string").alias("key")
                ),
            )
            for c in group
        ]
    )
    counted = (
        group[0]
        .table.select(F.inline(F.array_compact(used)))
        .groupBy("name", "key")
        .agg(F.count(F.lit(1)).alias("failures"))
    )
    parents = [
        c.relation.parent.select(
            F.lit(c.name).alias("name"), F.col(c.relation.key).cast("string").alias("key")
        )
        for c in group
    ]
    known = reduce(DataFrame.unionByName, parents)
    return counted.join(known, ["name", "key"], "left_anti").select("name", "failures")


def _violations(checks: Sequence[Check]) -> DataFrame:
    """Rows of (name, failures) that add up to the violations of each check.

    Conditions on one table are counted in a single pass over it, and so are its foreign keys.
    """
    fused: dict[int, list[Check]] = {}
    related: dict[int, list[Check]] = {}
    parts: list[DataFrame] = []
    for check in checks:
        if check.relation is not None:
            related.setdefault(id(check.table), []).append(check)
            continue
        if check.condition is not None:
            fused.setdefault(id(check.table), []).append(check)
            continue
        counted = "violations" in check.table.columns
        parts.append(
            check.table.select(
                F.lit(check.name).alias("name"),
                (F.col("violations") if counted else F.lit(1)).cast("bigint").alias("failures"),
            )
        )
    parts += [_without_parent(group) for group in related.values()]
    for group in fused.values():
        row = group[0].table.agg(
            *[F.count_if(c.condition).alias(f"_{i}") for i, c in enumerate(group)]
        )
        pairs = F.array(
            *[
                F.struct(F.lit(c.name).alias("name"), F.col(f"_{i}").alias("failures"))
                for i, c in enumerate(group)
            ]
        )
        parts.append(row.select(F.inline(pairs)))
    return reduce(DataFrame.unionByName, parts)


def run(checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, severity, failures and status (pass, warn or fail).

    All violations are added up by one aggregation, within each task first.
    """
    if len({c.name for c in checks}) != len(checks):
        raise ValueError("check names must be unique")
    never = 2**63 - 1
    rules = checks[0].table.sparkSession.createDataFrame(
        [
            (
                c.name,
                c.severity,
                c.warn_if,
                c.error_if
                if c.error_if is not None
                else (c.warn_if if c.severity == "error" else never),
            )
            for c in checks
        ],
        "name string, severity string, warn_if bigint, error_if bigint",
    )
    counts = _violations(checks).groupBy("name").agg(F.sum("failures").alias("failures"))
    # One row per rule on either side.
    judged = rules.join(F.broadcast(counts), "name", "left").withColumn(
        "failures", F.coalesce("failures", F.lit(0).cast("bigint"))
    )
    status = (
        F.when(F.col("failures") > F.col("error_if"), "fail")
        .when(F.col("failures") > F.col("warn_if"), "warn")
        .otherwise("pass")
    )
    return judged.select("name", "severity", "failures", status.alias("status"))


class ChecksFailed(Exception):
    """At least one check failed."""


def gate(results: DataFrame, accepted: Collection[str] = ()) -> None:
    """Raise if a check failed; ``results`` has one row per check.

    Failures of the ``accepted`` checks stay in the results and stop nothing.
    """
    failed = results.where(F.col("status") == "fail").select("name", "failures").collect()
    failed = [r for r in failed if r["name"] not in accepted]
    if failed:
        raise ChecksFailed(", ".join(f"{r['name']} ({r['failures']})" for r in failed))
