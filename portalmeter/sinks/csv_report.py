"""Reports as quoted CSV."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalmeter import fixed_values as fixed
from portalmeter.functions.periods import as_date


def report_path(root: str, as_of: dt.date | str | None, name: str) -> str:
    """``<root>/<date>/<file>.csv``."""
    return f"{root}/{as_date(as_of).isoformat()}/{fixed.REPORT_FILES.get(name, name)}.csv"


def _write(df: DataFrame, path: str, header: bool) -> None:
    (
        df.write.mode("overwrite")
        .option("header", header)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("lineSep", "\r\n")
        .option("encoding", "UTF-8")
        # Values go out as they are: the writer would otherwise trim them.
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def csv_report_sink(
    df: DataFrame, root: str, as_of: dt.date | str | None, name: str, single_file: bool = False
) -> str:
    """Write ``df`` with a header and every field quoted; returns the folder written.

    ``single_file`` gathers the rows in one task, so it is for reports of bounded size. Other reports come out
    as one part per task, in the report's order, each with a header; ``csv_report_parts`` writes one header.
    """
    path = report_path(root, as_of, name)
    _write(df.coalesce(1) if single_file else df, path, True)
    return path


def csv_report_parts(df: DataFrame, root: str, as_of: dt.date | str | None, name: str, order: Sequence[str | Column]) -> str:
    """Write a report of any size in order, as parts that, one after another by name, are one file with one header.

    Rows are dealt by ranges of ``order``, so each part is sorted and all of it comes after the part before; rows of
    equal order may come in any order. The header is a row in front of all others, so only the first part has it. Every
    value goes out as text.
    """
    path = report_path(root, as_of, name)
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    spark, names = df.sparkSession, [f"k{i}" for i in range(len(keys))]
    body = df.select(F.lit(1).alias("part"), *[k.alias(n) for k, n in zip(keys, names, strict=True)], *[F.col(f"`{c}`").cast("string").alias(f"c{i}") for i, c in enumerate(df.columns)])
    head = spark.createDataFrame([(0, *df.columns)], ", ".join(["part int", *[f"c{i} string" for i in range(len(df.columns))]]))
    both = head.unionByName(body, allowMissingColumns=True)
    dealt = both.repartitionByRange("part", *names).sortWithinPartitions("part", *names)
    _write(dealt.select(*[f"c{i}" for i in range(len(df.columns))]), path, False)
    return path
