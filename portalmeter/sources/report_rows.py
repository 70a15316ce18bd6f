"""Stored rows of the analytics feeds.

A stored report is text with one JSON row per line, in folders ``<root>/<report>/year_month=YYYY-MM``. Rows are read in
one pass that also says what is wrong with each; a load keeps those it cannot use in a table of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portalmeter import schemas
from portalmeter.functions.periods import Period

NESTED = "nested"
POSITIONAL = "positional"


def parse_report_rows(lines: DataFrame, layout: str, text_col: str = "value") -> DataFrame:
    """One JSON report row per line of text, parsed to the layout's columns.

    Blank lines are skipped; a line that cannot be read raises, so that no total is silently too small.
    """
    schema = schemas.NESTED_REPORT_ROW if layout == NESTED else schemas.POSITIONAL_REPORT_ROW
    row = F.from_json(F.col(text_col), schema, {"mode": "FAILFAST"})
    lines = lines.where(F.trim(F.regexp_replace(text_col, "\\s", "")) != "")
    if layout == NESTED:
        return lines.select(row.alias("row")).select("row.*")
    return lines.select(row.alias("row"))


def read_report_rows(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Stored report rows, one JSON value per line."""
    return parse_report_rows(spark.read.text(path), layout)


def flatten_report_rows(rows: DataFrame, dims: Sequence[str], metric: str, layout: str) -> DataFrame:
    """Report rows as flat columns: the dimensions by name, then the metric as a long."""
    if layout == NESTED:
        values = [F.col("dimensionValues")[i]["value"].alias(name) for i, name in enumerate(dims)]
        number = F.col("metricValues")[0]["value"]
    elif layout == POSITIONAL:
        values = [F.col("row")[i].alias(name) for i, name in enumerate(dims)]
        number = F.col("row")[len(dims)]
    else:
        raise ValueError(f"unknown layout: {layout}")
    return rows.select(*values, number.cast("bigint").alias(metric))


UNREADABLE, INCOMPLETE, NOT_A_NUMBER = "unreadable", "incomplete", "not a number"


def checked_report_rows(lines: DataFrame, dims: Sequence[str], metric: str, layout: str, text_col: str = "value") -> DataFrame:
    """Every line with what it says and what is wrong with it.

    Columns: those of ``lines`` but the text, then the dimensions, the metric as a long, ``line`` and ``reason``. The
    reason is null for a row that can be used, else ``unreadable`` (no JSON of the layout), ``incomplete`` (a dimension
    or the metric is missing) or ``not a number`` (the metric is none, or negative). Blank lines are no rows.
    """
    text = F.col(text_col)
    kept = [c for c in lines.columns if c != text_col]
    lines = lines.where(F.trim(F.regexp_replace(text, "\\s", "")) != "")
    if layout == NESTED:
        schema = f"{schemas.NESTED_REPORT_ROW}, _corrupt string"
        row = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        read = lines.select(*kept, text.alias("line"), row.alias("row"))
        values = [F.get("row.dimensionValues", i)["value"] for i in range(len(dims))]
        number, bad = F.get("row.metricValues", 0)["value"], F.col("row").isNull() | F.col("row._corrupt").isNotNull()
    elif layout == POSITIONAL:
        read = lines.select(*kept, text.alias("line"), F.from_json(text, schemas.POSITIONAL_REPORT_ROW, {"mode": "PERMISSIVE"}).alias("row"))
        values = [F.get("row", i) for i in range(len(dims))]
        number, bad = F.get("row", len(dims)), F.col("row").isNull()
    else:
        raise ValueError(f"unknown layout: {layout}")
    flat = read.select(*kept, "line", bad.alias("bad"), *[v.alias(d) for v, d in zip(values, dims, strict=True)], number.alias("number"))
    missing = F.col("number").isNull()
    for name in dims:
        missing = missing | F.col(name).isNull()
    counted = F.col("number").try_cast("bigint")
    reason = F.when(F.col("bad"), UNREADABLE).when(missing, INCOMPLETE).when(counted.isNull() | (counted < 0), NOT_A_NUMBER)
    return flat.select(*kept, *dims, counted.alias(metric), "line", reason.alias("reason"))


def read_stored_report(spark: SparkSession, root: str, report: str, period: Period, dims: Sequence[str], metric: str, layout: str) -> DataFrame:
    """The checked rows of one month's report, with ``year_month`` and ``end_day``; only that month's folder is read."""
    lines = spark.read.schema("value string, year_month string").text(f"{root}/{report}")
    month = lines.where(F.col("year_month") == period.year_month).withColumn("end_day", F.lit(period.end_day))
    return checked_report_rows(month, dims, metric, layout)


def usable(rows: DataFrame) -> DataFrame:
    return rows.where("reason is null").drop("line", "reason")


def rejected(rows: DataFrame, report: str) -> DataFrame:
    """(year_month, report, reason, line) of the rows that cannot be used."""
    return rows.where("reason is not null").select("year_month", F.lit(report).alias("report"), "reason", "line")


def report_totals(rows: DataFrame, left_out: DataFrame, stored: DataFrame, report: str, metric: str) -> DataFrame:
    """Per month what a report held and what became of it.

    ``rows`` are checked rows, ``left_out`` those of the usable ones that are of no dataset page, ``stored`` the fact rows
    made of the others; each has year_month and the metric. Columns: year_month, report, lines, used, rejected, read (the
    metric of the used rows), stored, left_out. A sum that does not come out raises when it is read.
    """
    zero = F.lit(0).cast("bigint")
    part = lambda df, name: df.groupBy("year_month").agg(F.sum(metric).alias(name))
    held = rows.groupBy("year_month").agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("reason").isNull()).alias("used"),
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
        F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.col(metric))), zero).alias("read"),
    )
    sums = held.join(part(stored, "stored"), "year_month", "left").join(part(left_out, "left_out"), "year_month", "left")
    sums = sums.withColumns({"stored": F.coalesce("stored", zero), "left_out": F.coalesce("left_out", zero)})
    wrong = F.raise_error(F.concat(F.lit(f"{report}: of "), F.col("read").cast("string"), F.lit(" read, "), F.col("stored").cast("string"), F.lit(" are stored")))
    checked = F.when(F.col("read") == F.col("stored") + F.col("left_out"), F.col("stored")).otherwise(wrong.cast("bigint"))
    return sums.select("year_month", F.lit(report).alias("report"), "lines", "used", "rejected", "read", checked.alias("stored"), "left_out")
