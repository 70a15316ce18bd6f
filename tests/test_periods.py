from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from portalmeter.functions.periods import choose_period, month_range, period_title, with_period


@pytest.mark.parametrize(
    ("period", "as_of", "expected"),
    [
        ("latest", "2024-03-10", ("2024-03", 10)),
        ("last_month", "2024-03-10", ("2024-02", 29)),
        ("last_month", "2024-01-31", ("2023-12", 31)),
        ("2023-02", "2024-03-10", ("2023-02", 28)),
        ("2024-03", "2024-03-10", ("2024-03", 10)),
    ],
)
def test_choose_period(period, as_of, expected):
    chosen = choose_period(period, as_of)
    assert (chosen.year_month, chosen.end_day) == expected
    assert chosen.start == dt.date.fromisoformat(expected[0] + "-01")
    assert chosen.end == chosen.start.replace(day=expected[1])


def test_with_period_marks_the_running_month(spark):
    df = spark.sql("select timestamp_ntz'2024-02-05 10:00:00' ts union all select timestamp_ntz'2024-03-09 23:59:59'")
    got = sorted(tuple(r) for r in with_period(df, "ts", "2024-03-10").select("year_month", "end_day").collect())
    assert got == [("2024-02", 29), ("2024-03", 10)]


def test_with_period_keeps_whole_days_of_the_chosen_month(spark):
    df = spark.sql(
        "select timestamp_ntz'2024-02-29 23:59:59.999' ts union all select timestamp_ntz'2024-03-01 00:00:00' "
        "union all select timestamp_ntz'2024-03-10 23:59:59.999' union all select timestamp_ntz'2024-03-11 00:00:00'"
    )
    got = sorted(str(r["ts"]) for r in with_period(df, "ts", "2024-03-10", "latest").collect())
    assert got == ["2024-03-01 00:00:00", "2024-03-10 23:59:59.999000"]


def test_month_range_ends_with_the_last_complete_month():
    assert month_range("2016-11", "2017-02-28") == ["2016-11", "2016-12", "2017-01"]
    assert month_range("2016-11", "2016-11-30") == []


@pytest.mark.parametrize(
    ("month", "day", "expected"),
    [
        ("2024-01", 30, "Enero 2024"),
        ("2024-01", 31, "Enero 2024"),
        ("2024-02", 28, "Febrero 2024"),
        ("2024-03", 28, "Marzo 2024 (hasta el 28)"),
        ("2024-12", 15, "Diciembre 2024 (hasta el 15)"),
        ("All", 0, "Total acumulado"),
    ],
)
def test_period_title(spark, month, day, expected):
    df = spark.createDataFrame([(month, day)], "m string, d int")
    assert rows_of(df.select(period_title(F.col("m"), F.col("d")))) == [(expected,)]
