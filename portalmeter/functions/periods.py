"""Months: labels, bounds and the last day they cover."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalmeter import fixed_values as fixed
from portalmeter.schemas import ALL_TIME


@dataclass(frozen=True)
class Period:
    """A month up to the last day it covers."""

    year_month: str
    end_day: int
    start: dt.date
    end: dt.date


def as_date(value: dt.date | str | None) -> dt.date:
    if value is None:
        return dt.date.today()
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def choose_period(period: str, as_of: dt.date | str | None = None) -> Period:
    """``latest`` (the running month), ``last_month`` or ``YYYY-MM``; the running month ends at ``as_of``."""
    today = as_date(as_of)
    if period == "latest":
        start = today.replace(day=1)
    elif period == "last_month":
        start = (today.replace(day=1) - dt.timedelta(days=1)).replace(day=1)
    else:
        start = dt.datetime.strptime(period, "%Y-%m").date()
    is_running = (start.year, start.month) == (today.year, today.month)
    end_day = today.day if is_running else calendar.monthrange(start.year, start.month)[1]
    return Period(start.strftime("%Y-%m"), end_day, start, start.replace(day=end_day))


def in_days(ts: Column, start: dt.date | str, end: dt.date | str) -> Column:
    """``ts`` from the first moment of ``start`` to the last of ``end``; a plain range, so it reaches the scan."""
    first = as_date(start)
    after = as_date(end) + dt.timedelta(days=1)
    return (ts >= F.lit(first).cast("timestamp_ntz")) & (ts < F.lit(after).cast("timestamp_ntz"))


def year_month(day: Column) -> Column:
    """``YYYY-MM`` of a day or timestamp, as the calendar has it whatever the session's time zone."""
    return F.substring(F.to_date(day).cast("string"), 1, 7)


def end_day(month: Column, as_of: dt.date | str | None) -> Column:
    """Last day a month covers: ``as_of``'s in the running month, the last one in any other."""
    today = as_date(as_of)
    is_running = F.trunc(month, "MM") == F.lit(today.replace(day=1))
    return F.when(is_running, F.lit(today.day)).otherwise(F.dayofmonth(F.last_day(month))).cast("int")


def with_period(
    df: DataFrame, ts_col: str, as_of: dt.date | str | None, period: str | None = None
) -> DataFrame:
    """Add ``year_month`` and ``end_day``; with ``period``, keep only the rows of that month."""
    ts = F.col(ts_col)
    if period is not None:
        chosen = choose_period(period, as_of)
        df = df.where(in_days(ts, chosen.start, chosen.end))
    return df.withColumns({"year_month": year_month(ts), "end_day": end_day(ts, as_of)})


def month_range(first: str, as_of: dt.date | str | None) -> list[str]:
    """Month names from ``first`` to the last complete month before ``as_of``."""
    start = dt.datetime.strptime(first, "%Y-%m").date()
    today = as_date(as_of)
    count = (today.year - start.year) * 12 + today.month - start.month
    return [f"{start.year + i // 12:04d}-{i % 12 + 1:02d}" for i in range(start.month - 1, start.month - 1 + count)]


def month_number(year_month_col: Column) -> Column:
    """``YYYY-MM`` as an integer that sorts the same way."""
    return F.regexp_replace(year_month_col, "-", "").try_cast("int")


def month_title(year_month_col: Column, names: Sequence[str] = fixed.MONTH_NAMES) -> Column:
    """``2024-02`` as ``Febrero 2024``."""
    index = F.substring(year_month_col, 6, 2).try_cast("int")
    name = F.get(F.array(*[F.lit(n) for n in names]), index - 1)
    return F.concat(name, F.lit(" "), F.substring(year_month_col, 1, 4))


def period_title(
    year_month_col: Column, end_day_col: Column, names: Sequence[str] = fixed.MONTH_NAMES
) -> Column:
    """The month's title, with the last covered day where the month counts as partial.

    A month is whole at day 30 or 31, and February also at 28 or 29.
    """
    title = month_title(year_month_col, names)
    is_february = F.substring(year_month_col, 6, 2) == "02"
    is_whole = end_day_col.isin(30, 31) | (is_february & end_day_col.isin(28, 29))
    partial = F.concat(title, F.lit(" (hasta el "), end_day_col.cast("string"), F.lit(")"))
    return (
        F.when(year_month_col == ALL_TIME, F.lit(fixed.ALL_TIME_LABEL)).when(is_whole, title).otherwise(partial)
    )
