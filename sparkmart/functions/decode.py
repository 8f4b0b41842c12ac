"""Code decoding and attribute classification."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "N/A"

# Fixed values.
MARITAL_STATUS = {"S": "Single", "M": "Married", "D": "Divorced", "W": "Widowed"}
GENDER = {"M": "Male", "F": "Female"}
STYLE = {"U": "Unisex", "W": "Women", "M": "Men"}
CLOTHING_SIZES = ("S", "M", "L", "XL")


def decode(code: Column, mapping: Mapping[str, object], default: Column | object) -> Column:
    """Look ``code`` up in ``mapping``; anything else, NULL too, gives ``default``."""
    branches = F
    for key, value in mapping.items():
        branches = branches.when(code == key, F.lit(value))
    return branches.otherwise(default if isinstance(default, Column) else F.lit(default))


def home_owner(flag: Column) -> Column:
    """True for ``Y`` only; NULL counts as not owning."""
    return F.coalesce(flag == "Y", F.lit(False))


def product_size(size: Column) -> Column:
    """The size, with the placeholder ``0`` turned into NULL."""
    return F.nullif(size, F.lit("0"))


def size_type(size: Column) -> Column:
    """Clothing letter sizes, positive whole numbers as frame sizes, the rest without size.

    The digits test keeps decimals such as ``48.5`` out, whatever the cast would do with
    them.
    """
    whole_number = F.when(size.rlike("^ *[0-9]+ *$"), F.trim(size).try_cast("int"))
    return (
        F.when(size.isin(*CLOTHING_SIZES), "Clothing")
        .when(whole_number > 0, "Frame (cm)")
        .otherwise("No Size")
    )


def style(code: Column) -> Column:
    """Known codes by name, ``0`` and NULL as not available, other values as they are."""
    return decode(code, {**STYLE, "0": NOT_AVAILABLE}, F.coalesce(code, F.lit(NOT_AVAILABLE)))
