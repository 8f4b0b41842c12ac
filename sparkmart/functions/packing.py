"""Hexadecimal text as bytes, for the way through a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PACKED = "_packed"


def pack_hex(df: DataFrame, widths: Sequence[tuple[str, int]]) -> DataFrame:
    """Lower-case hexadecimal text of the given (column, width) pairs as one column of bytes.

    A row is packed if all of them have their width, and their text is NULL then; any other row
    keeps its text. Hashes and log positions hardly compress, so this halves them.
    """
    text = F.concat(*[F.col(c) for c, _ in widths])
    fits = text.rlike(f"^[0-9a-f]{{{sum(width for _, width in widths)}}}$")
    for c, width in widths:
        fits = fits & (F.length(c) == width)
    fits = F.coalesce(fits, F.lit(False))
    names = [c for c, _ in widths]
    return df.select(
        *[F.when(~fits, F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns],
        F.when(fits, F.unhex(text)).alias(PACKED),
    )


def unpack_hex(df: DataFrame, widths: Sequence[tuple[str, int]]) -> DataFrame:
    """What ``pack_hex`` was given."""
    text, restored, at = F.lower(F.hex(PACKED)), {}, 1
    for c, width in widths:
        restored[c] = F.coalesce(F.substring(text, at, width), F.col(c)).alias(c)
        at += width
    return df.select(*[restored.get(c, F.col(c)) for c in df.columns if c != PACKED])
