"""Number parsing that yields NULL for unreadable text, without an exception per bad value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def readable(df: DataFrame, name: str, kind: str) -> Column:
    """Column ``name`` as ``kind``, NULL where it does not fit.

    Text that is no whole number never reaches the cast: a failing ``try_cast`` raises and
    catches inside Spark, which is slow when many values are bad.
    """
    column, stored = F.col(f"`{name}`"), df.schema[name].dataType
    if stored == T.DataType.fromDDL(kind):
        return column
    cast = column.try_cast(kind)
    if isinstance(stored, T.StringType) and kind in _INTEGRAL:
        return F.when(column.rlike(r"^\s*[+-]?\d+\s*$"), cast)
    if isinstance(stored, (T.DoubleType, T.FloatType, T.DecimalType)) and kind in _INTEGRAL:
        return F.when(cast.cast(stored) == column, cast)  # a fraction does not fit
    return cast
