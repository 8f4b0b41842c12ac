"""Smart date keys and row-version ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Day key that the first version of every key is floored to.
BEGINNING_OF_TIME = 19000101
#: Version key of a fact that matches no dimension version.
UNKNOWN_VERSION = "-1"
#: Natural key of the unknown member of a dimension.
UNKNOWN_KEY = -1


def date_key(date: Column | str) -> Column:
    """The day as an integer ``yyyymmdd``.

    Arithmetic on the date parts stays in generated code, where formatting to a string
    and casting back would not.
    """
    date = F.col(date) if isinstance(date, str) else date
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def version_id(*parts: Column | str) -> Column:
    """MD5 of the parts, ``~`` between them: the surrogate key of a row version."""
    return F.md5(F.concat_ws("~", *[(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]))
