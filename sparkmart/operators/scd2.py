"""History of slowly changing dimensions (type 2, check strategy).

A version is opened when a key is first seen or one of the checked columns differs from the
current version (NULL equals NULL); the version before it is closed at the same moment.
Columns that are not checked keep the value they had when the version was opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.keys import BEGINNING_OF_TIME, date_key, version_id
from sparkmart.operators.joins import ROWS_PER_TASK
from sparkmart.operators.neighbours import plan_stretches, with_neighbours
from sparkmart.session import STORED
from sparkmart.sources import versions
from sparkmart.sources.files import children

#: Columns a history has on top of those of its source.
META = ("version_key", "updated_at", "valid_from", "valid_to")


def _differs(left: dict[str, Column], right: dict[str, Column]) -> Column:
    out = F.lit(False)
    for name in left:
        out = out | ~left[name].eqNullSafe(right[name])
    return out


def from_history(
    log: DataFrame,
    key: str,
    check_cols: Sequence[str],
    ts: str,
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The whole history from a log of observations; (key, ts) must be unique.

    Change points come from comparing each observation with the one before, their ends from
    the change point after; both share one shuffle and sort unless a hot key forces the
    split described in ``neighbours``.
    """
    stretches = plan_stretches(log, [key], [ts], rows_per_task)
    observed = with_neighbours(
        log,
        stretches,
        previous={"_seen": F.lit(True), **{f"_prev_{c}": F.col(c) for c in check_cols}},
    )
    changed = _differs(
        {c: F.col(c) for c in check_cols}, {c: F.col(f"_prev_{c}") for c in check_cols}
    )
    change_points = observed.where(F.col("_seen").isNull() | changed).select(*log.columns)
    versions = with_neighbours(change_points, stretches, following={"valid_to": F.col(ts)})
    return versions.select(
        *[c for c in log.columns if c != ts],
        version_id(key, ts).alias("version_key"),
        F.col(ts).alias("updated_at"),
        F.col(ts).alias("valid_from"),
        "valid_to",
    )


def apply(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    ts: Column,
    *,
    invalidate_missing: bool = False,
) -> DataFrame:
    """The history after one more observation of the source, taken at ``ts``.

    Closed versions pass through untouched; only open ones meet the incoming rows, in one
    full outer join on the unique key. Keys that have vanished stay open unless
    ``invalidate_missing``.
    """
    columns = [c for c in current.columns if c not in META]
    closed = current.where(F.col("valid_to").isNotNull())
    old = current.where(F.col("valid_to").isNull()).select(
        F.col(key).alias("_old_key"), F.struct(*current.columns).alias("_old")
    )
    new = incoming.select(
        F.col(key).alias("_new_key"),
        F.struct(
            *columns,
            version_id(F.col(key), ts).alias("version_key"),
            ts.alias("updated_at"),
            ts.alias("valid_from"),
            F.lit(None).cast(current.schema["valid_to"].dataType).alias("valid_to"),
        ).alias("_new"),
    )
    old_seen, new_seen = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    changed = _differs(
        {c: F.col("_old")[c] for c in check_cols}, {c: F.col("_new")[c] for c in check_cols}
    )
    ended = F.col("_old").withField("valid_to", ts)
    missing_row = ended if invalidate_missing else F.col("_old")
    kept = (
        F.when(old_seen & new_seen & changed, ended)
        .when(old_seen & new_seen, F.col("_old"))
        .when(old_seen, missing_row)
    )
    opened = F.when(new_seen & (~old_seen | changed), F.col("_new"))
    merged = (
        old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
        .select(F.explode(F.array_compact(F.array(kept, opened))).alias("_row"))
        .select(*[F.col("_row")[c].alias(c) for c in current.columns])
    )
    return closed.select(*current.columns).unionByName(merged)


@dataclass(frozen=True)
class History:
    """A stored history at ``path``: closed versions are written once, open ones every day.

    Each observation is a version of the table (see ``sources.versions``) that names the folders
    of closed versions so far and one folder of open ones. A day reads and writes the open
    versions alone, so its cost follows the number of keys and not the length of the history.
    """

    path: str
    key: str
    check_cols: tuple[str, ...]

    def before(self, spark: SparkSession, day: str) -> versions.Version | None:
        """The state that the observation of ``day`` builds on: the newest of an earlier day."""
        folder = f"{self.path}/{versions.POINTERS}"
        found = [versions.load(spark, self.path, n) for n in versions.numbers(spark, folder)]
        earlier = [v for v in found if v.label < day]
        return max(earlier, key=lambda v: (v.label, v.number), default=None)

    def read(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        return versions.read(spark, self.path, number)

    def observe(
        self, incoming: DataFrame, as_of: date, *, invalidate_missing: bool = False
    ) -> versions.Version:
        """Extend the history by what the source showed on ``as_of``.

        Running a day again builds on the day before it and gives the same history.
        """
        spark, day = incoming.sparkSession, as_of.isoformat()
        previous = self.before(spark, day)
        newest = versions.numbers(spark, f"{self.path}/{versions.POINTERS}")
        if previous is None:
            current, closed = empty_history(incoming), []
        else:
            open_ = [p for p in previous.parts if p.kind == "open"]
            closed = [p for p in previous.parts if p.kind == "closed"]
            current = versions.read_parts(spark, self.path, previous.schema, open_)
        seen = apply(
            current,
            incoming,
            self.key,
            self.check_cols,
            F.lit(as_of),
            invalidate_missing=invalidate_missing,
        )
        folder = versions.fresh_folder()
        kind = F.when(F.col("valid_to").isNull(), "open").otherwise("closed")
        (
            seen.withColumn("_state", kind)
            .write.options(**STORED)
            .partitionBy("_state")
            .parquet(f"{self.path}/{folder}")
        )
        written = children(spark, f"{self.path}/{folder}")
        parts = closed + [
            versions.Part(f"{folder}/_state={k}", kind=k)
            for k in ("closed", "open")
            if f"_state={k}" in written
        ]
        after = newest[-1] if newest else 0
        return versions.publish(spark, self.path, current.schema, parts, after, day)


def empty_history(incoming: DataFrame, ts_type: str = "date") -> DataFrame:
    """A history without versions, shaped like ``incoming``, to ``apply`` the first load to."""
    ts = F.lit(None).cast(ts_type)
    return incoming.where(F.lit(False)).select(
        "*",
        F.lit("").alias("version_key"),
        ts.alias("updated_at"),
        ts.alias("valid_from"),
        ts.alias("valid_to"),
    )


def day_intervals(
    history: DataFrame, key: str, *, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Replace the timestamps of a history by day keys, half-open ``[from, to)``.

    The first version of a key reaches back to the beginning of time, so that facts older
    than the first observation find it. Two changes within a day leave an empty interval:
    the day belongs to its last version.
    """
    stretches = plan_stretches(history, [key], ["valid_from"], rows_per_task)
    return (
        with_neighbours(history, stretches, previous={"_earlier": F.lit(True)})
        .withColumn(
            "valid_from_key",
            F.when(F.col("_earlier").isNull(), F.lit(BEGINNING_OF_TIME))
            .otherwise(date_key("valid_from")),
        )
        .withColumn("valid_to_key", date_key("valid_to"))
        .withColumn("updated_key", date_key("updated_at"))
        .drop("_earlier", "updated_at", "valid_from", "valid_to")
    )
