"""Academic periods: labels ``YYYY-YY`` that start on 1 April."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"
FIRST_MONTH = 4


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def period_label(ts: Column | str, first_month: int = FIRST_MONTH) -> Column:
    """Label of the period a date or timestamp falls in."""
    ts = _col(ts)
    start = F.year(ts) - F.when(F.month(ts) < first_month, 1).otherwise(0)
    suffix = F.lpad(((start + 1) % 100).cast("string"), 2, "0")
    return F.concat(start.cast("string"), F.lit("-"), suffix)


def period_sk(period: Column | str) -> Column:
    """``2020-21`` -> 202021; NULL when the label is malformed."""
    period = _col(period)
    return F.concat(F.substring(period, 1, 4), F.substring(period, 6, 2)).try_cast("int")


def period_start(period: Column | str) -> Column:
    year = F.substring(_col(period), 1, 4).try_cast("int")
    return F.make_date(year, F.lit(FIRST_MONTH), F.lit(1))


def period_end(period: Column | str) -> Column:
    return F.date_sub(F.add_months(period_start(period), 12), 1)


def is_period(period: Column | str) -> Column:
    """Well-formed label whose suffix is the following year: at most 10,000 of them exist."""
    period = _col(period)
    start = F.substring(period, 1, 4).try_cast("int")
    suffix = F.substring(period, 6, 2).try_cast("int")
    shape = period.rlike(r"^\d{4}-\d{2}$")
    return F.coalesce(shape & ((start + 1) % 100 == suffix), F.lit(False))
