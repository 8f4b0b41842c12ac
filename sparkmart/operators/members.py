"""Dimension completion: placeholder rows for keys that only facts know."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_keys(
    dim: DataFrame, fact_keys: DataFrame, key: str, unknown_key: object
) -> DataFrame:
    """Each key of ``fact_keys`` once that ``dim`` lacks; NULL and the unknown key aside.

    The keys are dealt out by then, so only those of ``dim`` are shuffled; Spark would broadcast
    millions of them where they are stored in few bytes.
    """
    return (
        fact_keys.where(F.col(key).isNotNull() & (F.col(key) != F.lit(unknown_key)))
        .select(F.col(key).cast(dim.schema[key].dataType).alias(key))
        .distinct()
        .join(dim.select(key).hint("merge"), key, "left_anti")
    )


def pending(
    dim: DataFrame, fact_keys: DataFrame, key: str, placeholder: Mapping[str, object], unknown_key: object
) -> DataFrame:
    """Placeholder rows, in the columns of ``dim``, for the keys it lacks.

    Columns that ``placeholder`` does not name are NULL.
    """
    return missing_keys(dim, fact_keys, key, unknown_key).select(
        *[
            F.col(key) if f.name == key else F.lit(placeholder.get(f.name)).cast(f.dataType).alias(f.name)
            for f in dim.schema.fields
        ]
    )


def complete(
    dim: DataFrame,
    fact_keys: DataFrame,
    key: str,
    placeholder: Mapping[str, object],
    unknown: Mapping[str, object],
) -> DataFrame:
    """``dim`` plus one inferred row per missing fact key plus the unknown member.

    ``fact_keys`` has the single column ``key`` and may hold duplicates, NULLs and the
    unknown key itself. Duplicates go before the anti join, which therefore meets every key
    once, however hot it is among the facts.
    """
    unknown_key = unknown[key]

    def row_of(values: Mapping[str, object]) -> list[Column]:
        return [
            F.lit(values[f.name]).cast(f.dataType).alias(f.name)
            for f in dim.schema.fields
            if f.name != key
        ]

    missing = missing_keys(dim, fact_keys, key, unknown_key)
    inferred = missing.select(
        key, F.lit(True).alias("is_inferred"), *row_of(placeholder)
    )
    guest = dim.sparkSession.range(1).select(
        F.lit(unknown_key).cast(dim.schema[key].dataType).alias(key),
        F.lit(False).alias("is_inferred"),
        *row_of(unknown),
    )
    actual = dim.select("*", F.lit(False).alias("is_inferred"))
    return actual.unionByName(inferred).unionByName(guest).select(*dim.columns, "is_inferred")
