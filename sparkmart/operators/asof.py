"""Point-in-time lookup of the dimension version valid at the time of a fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.joins import BROADCAST_ROWS, ROWS_PER_TASK, lookup_join
from sparkmart.operators.neighbours import plan_stretches, with_last


def valid_at(at: Column, valid_from: Column, valid_to: Column) -> Column:
    """``at`` lies in the half-open interval; an open end is NULL."""
    return (at >= valid_from) & ((at < valid_to) | valid_to.isNull())


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    payload: Sequence[str],
    *,
    valid_from: str = "valid_from_key",
    valid_to: str = "valid_to_key",
    keys_from: DataFrame | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join each fact to the version of its key valid at ``at``; no match gives NULLs.

    Empty intervals can match nothing and are dropped first. What is left of one key are
    disjoint, non-empty intervals of whole days, so a key has at most one version per day
    and the range test looks at a bounded number of versions per fact. Facts of a hot key
    are split over tasks by the join itself; ``keys_from`` is where it may look for them.
    """
    candidates = versions.where(
        F.col(key).isNotNull()
        & (F.col(valid_to).isNull() | (F.col(valid_from) < F.col(valid_to)))
    ).select(
        key,
        F.col(valid_from).alias("_valid_from"),
        F.col(valid_to).alias("_valid_to"),
        *payload,
    )
    return lookup_join(
        facts,
        candidates,
        [key],
        "left",
        residual=valid_at(F.col(at), F.col("_valid_from"), F.col("_valid_to")),
        keys_from=keys_from,
        broadcast_rows=broadcast_rows,
        rows_per_task=rows_per_task,
    ).drop("_valid_from", "_valid_to")


def asof_merge(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    payload: Sequence[str],
    *,
    valid_from: str = "valid_from_key",
    valid_to: str = "valid_to_key",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``asof_join`` as one sorted stream per key, for keys with very many versions.

    Facts and versions are united and ordered by time; a running last value hands each fact the
    version that began last, and only its end is compared. The rows looked at grow with facts
    plus versions, where the join looks at every version of a fact's key. Hot keys are cut into
    stretches. Intervals of one key must not overlap.
    """
    begun = versions.where(
        F.col(key).isNotNull()
        & F.col(valid_from).isNotNull()
        & (F.col(valid_to).isNull() | (F.col(valid_from) < F.col(valid_to)))
    ).select(
        F.col(key).alias("_key"),
        F.col(valid_from).alias("_at"),
        F.lit(0).alias("_kind"),
        F.struct(F.col(valid_to).alias("_valid_to"), *payload).alias("_version"),
        F.lit(None).cast(facts.schema).alias("_fact"),
    )
    whole = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    placed = F.col(key).isNotNull() & F.col(at).isNotNull()
    asked = facts.where(placed).select(
        F.col(key).alias("_key"),
        F.col(at).alias("_at"),
        F.lit(1).alias("_kind"),
        F.lit(None).cast(begun.schema["_version"].dataType).alias("_version"),
        whole.alias("_fact"),
    )
    both = begun.unionByName(asked)
    stretches = plan_stretches(both, ["_key"], ["_at", "_kind"], rows_per_task)
    ran = with_last(both, stretches, "_version", "_last").where(F.col("_kind") == 1)
    ends = F.col("_last._valid_to")
    valid = F.col("_last").isNotNull() & (ends.isNull() | (F.col("_at") < ends))
    found = ran.select(
        "_fact.*", *[F.when(valid, F.col("_last").getField(c)).alias(c) for c in payload]
    )
    # Facts without key or time match nothing and take no part.
    others = facts.where(~placed).select(
        "*", *[F.lit(None).cast(versions.schema[c].dataType).alias(c) for c in payload]
    )
    return found.unionByName(others)
