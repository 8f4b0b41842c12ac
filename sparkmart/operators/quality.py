"""Rule-based split of a table into accepted and quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def with_reason(df: DataFrame, rules: Sequence[Rule], name: str = "error_reason") -> DataFrame:
    """Add the reason of the first rule whose condition is true, NULL if none is."""
    return df.withColumn(name, F.coalesce(*[F.when(c, F.lit(r)) for r, c in rules]))


def split(
    df: DataFrame, rules: Sequence[Rule], quarantined_at: datetime | Column
) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected rows with reason and time.

    Both come from the one rule list, so each row is in exactly one of the two whatever its
    NULLs do to the conditions.
    """
    judged = with_reason(df, rules)
    at = quarantined_at if isinstance(quarantined_at, Column) else F.lit(quarantined_at)
    good = judged.where(F.col("error_reason").isNull()).drop("error_reason")
    bad = judged.where(F.col("error_reason").isNotNull()).withColumn("quarantined_at", at)
    return good, bad
