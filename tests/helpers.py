"""What several test modules use."""

from __future__ import annotations


def rows(df, *columns):
    """Rows as a sorted list of tuples, NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda r: tuple((v is not None, str(type(v)), v) for v in r),
    )
