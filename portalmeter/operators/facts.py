"""The monthly fact tables: replacing a month, and the all-time rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from portalmeter import schemas
from portalmeter.functions.periods import month_number
from portalmeter.schemas import ALL_TIME
from portalmeter.staging import FolderSwap


def replace_period(fact: DataFrame, new_rows: DataFrame, period: str) -> DataFrame:
    """The fact table with a month's rows replaced, also by none. ``All`` stands for the all-time rows.

    New rows of another month raise. Removing everything is ``delete_period``.
    """
    rows = only_of_period(new_rows, period).select(*fact.columns)
    return fact.where(F.col("year_month") != period).unionByName(rows)


def only_of_period(rows: DataFrame, period: str) -> DataFrame:
    """The rows as they are; one of another month, or of none, raises when it is read."""
    found = F.coalesce(F.col("year_month"), F.lit("null"))
    wrong = F.raise_error(F.concat(F.lit(f"a row of {period} was expected, not of "), found))
    return rows.withColumn("year_month", F.when(F.col("year_month") == period, F.col("year_month")).otherwise(wrong))


def _swap(spark: SparkSession, root: str, period: str) -> FolderSwap:
    return FolderSwap(spark, root, f"year_month={period}")


def write_period(spark: SparkSession, new_rows: DataFrame, root: str, period: str) -> None:
    """Replace one month of a stored fact table, partitioned by ``year_month``; other months stay untouched.

    The rows are written beside the table and then swapped in by renames, so they may be computed from the month that
    they replace, an empty result leaves the month without rows, and a crash leaves the old month or the new one:
    writing it again, or ``recover_period``, sets right what was left half done. Rows of another month raise before
    anything is changed.
    """
    rows = only_of_period(new_rows, period)
    # The check is part of the rows' one condition, so that dropping the column does not drop the check.
    checked = rows.where(F.col("year_month") == period).drop("year_month")
    _swap(spark, root, period).replace(checked.hint("rebalance"))


def recover_period(spark: SparkSession, root: str, period: str) -> None:
    """After a crash while a month was written: the month is as before or as it should become."""
    _swap(spark, root, period).recover()


def clear_period(empty: DataFrame, root: str, period: str) -> None:
    """Leave a month of a stored fact table without rows; ``empty`` gives the columns."""
    _swap(empty.sparkSession, root, period).replace(empty.drop("year_month"))


def delete_period(spark: SparkSession, roots: Mapping[str, str], period: str) -> None:
    """Remove a month, or with ``All`` everything, from stored fact tables (table name -> folder)."""
    for name, root in roots.items():
        empty = spark.createDataFrame([], schemas.TABLES[name])
        if period == ALL_TIME:
            overwrite = empty.write.mode("overwrite").option("partitionOverwriteMode", "static")
            overwrite.partitionBy("year_month").parquet(root)
        else:
            clear_period(empty, root, period)


#: A number that goes before text keys, so that sorts mostly compare numbers; equal numbers are still told apart by the keys.
SPOT = "__spot"


def _by(rows: DataFrame, *key: str) -> GroupedData:
    """Grouped by the key, its number first."""
    return rows.withColumn(SPOT, F.hash(*key)).groupBy(SPOT, *key)


def _not_all_time() -> Column:
    return F.lower("year_month") != ALL_TIME.lower()


def _filled(columns: Sequence[str]) -> Column:
    """All of the columns hold text; NULL counts as not filled."""
    test = F.lit(True)
    for name in columns:
        test = test & F.coalesce(F.col(name) != "", F.lit(False))
    return test


def package_parts(packages_fact: DataFrame) -> DataFrame:
    """Views per month, dataset and pair of organisation and publisher, with the least path: what all-time rows add up.

    Parts of one month depend on that month's rows alone.
    """
    rows = packages_fact.where(_not_all_time() & (F.col("package_name") != ""))
    parts = _by(rows, "year_month", "package_name", "organization_id", "publisher_id")
    return parts.agg(F.sum("pageviews").alias("views"), F.min("url").alias("url")).drop(SPOT)


def package_all_time(packages_fact: DataFrame) -> DataFrame:
    """One all-time row per dataset over its months.

    Views count where dataset, organisation and publisher are known. A dataset seen under one pair of
    organisation and publisher keeps it. One seen under several gets the total over all, labelled with the pair
    of its newest month, known or not.

    Each task adds up its rows per dataset before they are brought together, so a dataset with very many rows
    spreads over all tasks.
    """
    rows = packages_fact.where(_not_all_time() & (F.col("package_name") != ""))
    return _package_totals(rows.withColumnRenamed("pageviews", "views"))


def _package_totals(rows: DataFrame) -> DataFrame:
    """All-time rows from rows or parts (year_month, package_name, organization_id, publisher_id, views, url)."""
    pair = F.struct("organization_id", "publisher_id")
    is_known = _filled(["package_name", "organization_id", "publisher_id"])
    known_pair = F.when(is_known, pair)
    per_package = (
        _by(rows, "package_name")
        .agg(
            F.sum(F.when(is_known, F.col("views"))).alias("pageviews"),
            F.min(known_pair).alias("first_pair"),
            F.max(known_pair).alias("last_pair"),
            F.min_by(pair, F.struct((-month_number(F.col("year_month"))).alias("age"), "url")).alias("newest_pair"),
        )
        .where(F.col("pageviews").isNotNull())
    )
    label = F.when(F.col("first_pair") == F.col("last_pair"), F.col("first_pair")).otherwise(F.col("newest_pair"))
    return per_package.withColumn("label", label).select(
        F.lit(ALL_TIME).alias("year_month"),
        F.lit(0).alias("end_day"),
        F.col("pageviews").cast("bigint").alias("pageviews"),
        F.lit("").alias("url"),
        "package_name",
        F.col("label.organization_id").alias("organization_id"),
        F.col("label.publisher_id").alias("publisher_id"),
    )


def _changed(all_time: DataFrame, touched: DataFrame, now: DataFrame, key: list[str], totals) -> DataFrame:
    """All-time rows where those of the touched keys are made anew from the fact rows, and the others stay.

    Fact rows of other keys go before anything is added up. The number before the text keys spares comparing those.
    """
    touched = touched.withColumn(SPOT, F.hash(*key)).alias("touched")

    def by_key(rows: DataFrame, how: str) -> DataFrame:
        same = F.col(f"rows.{SPOT}") == F.col(f"touched.{SPOT}")
        for name in key:
            same = same & F.col(f"rows.{name}").eqNullSafe(F.col(f"touched.{name}"))
        return rows.withColumn(SPOT, F.hash(*key)).alias("rows").join(touched, same, how).drop(SPOT)

    return by_key(all_time, "left_anti").unionByName(totals(by_key(now, "left_semi")))


def package_all_time_changed(all_time: DataFrame, old_parts: DataFrame, new_parts: DataFrame, now: DataFrame) -> DataFrame:
    """All-time rows after a month was replaced: only datasets of the month, before or now, are added up again.

    ``old_parts`` and ``new_parts`` are the month's parts before and now (one of them may be empty), ``now`` the fact rows
    of all months with the month as it is now, of which only those of touched datasets become parts, or such parts. Equal
    to ``package_all_time`` of the whole fact table.
    """
    touched = old_parts.select("package_name").union(new_parts.select("package_name")).distinct()
    return _changed(
        all_time, touched, now, ["package_name"], lambda rows: _package_totals(rows if "views" in rows.columns else package_parts(rows))
    )


RESOURCE_KEY = ["url", "resource_id", "package_name"]


def resource_parts(resources_fact: DataFrame) -> DataFrame:
    """Events per month, file, dataset, pair and format, with the least page: what all-time rows add up."""
    rows = resources_fact.where(_not_all_time() & (F.col("resource_id") != "") & (F.col("package_name") != ""))
    parts = _by(rows, "year_month", *RESOURCE_KEY, "organization_id", "publisher_id", "format")
    return parts.agg(F.sum("total_events").alias("events"), F.min("package_url").alias("package_url")).drop(SPOT)


def resource_all_time_changed(
    all_time: DataFrame, old_parts: DataFrame, new_parts: DataFrame, now: DataFrame, catalogue_segment: str = "catalogo"
) -> DataFrame:
    """As ``package_all_time_changed``, for files."""
    touched = old_parts.select(*RESOURCE_KEY).union(new_parts.select(*RESOURCE_KEY)).distinct()
    return _changed(
        all_time, touched, now, RESOURCE_KEY,
        lambda rows: _resource_totals(rows if "events" in rows.columns else resource_parts(rows), catalogue_segment),
    )


def resource_all_time(resources_fact: DataFrame, catalogue_segment: str = "catalogo") -> DataFrame:
    """One all-time row per file, dataset and address over all months; the rules are those of datasets.

    Formats add up. With one pair the row takes the format of the largest part, with several the format of the
    newest month's row.
    """
    rows = resources_fact.where(_not_all_time() & (F.col("resource_id") != "") & (F.col("package_name") != ""))
    return _resource_totals(rows.withColumnRenamed("total_events", "events"), catalogue_segment)


def _resource_totals(rows: DataFrame, catalogue_segment: str) -> DataFrame:
    """All-time rows from rows or parts of files, which have ``events`` and ``package_url``."""
    key = RESOURCE_KEY
    pair = F.struct("organization_id", "publisher_id")
    is_known = _filled(["resource_id", "package_name", "organization_id", "publisher_id"])
    newest = F.min(F.struct((-month_number(F.col("year_month"))).alias("age"), "package_url")).alias("newest")
    # A file has few rows, about one a month and page, so they come together once and are sorted once for both steps.
    placed = rows.withColumn(SPOT, F.hash(*key)).repartition(SPOT)
    per_format = placed.groupBy(SPOT, *key, "organization_id", "publisher_id", "format").agg(F.sum("events").alias("events"), newest)
    per_file = (
        per_format.withColumns(
            {
                "labels": F.struct("organization_id", "publisher_id", "format"),
                "known_pair": F.when(is_known, pair),
                # Largest part first, then the smallest format.
                "rank": F.when(is_known, F.struct((-F.col("events")).alias("less"), "format")),
            }
        )
        .groupBy(SPOT, *key)
        .agg(
            F.sum(F.when(F.col("known_pair").isNotNull(), F.col("events"))).alias("total_events"),
            F.min("known_pair").alias("first_pair"),
            F.max("known_pair").alias("last_pair"),
            F.min("rank").alias("rank"),
            F.min_by("labels", "newest").alias("newest_labels"),
        )
        .where(F.col("total_events").isNotNull())
    )
    single = F.struct(
        F.col("first_pair.organization_id").alias("organization_id"),
        F.col("first_pair.publisher_id").alias("publisher_id"),
        F.col("rank.format").alias("format"),
    )
    label = F.when(F.col("first_pair") == F.col("last_pair"), single).otherwise(F.col("newest_labels"))
    return per_file.withColumn("label", label).select(
        F.lit(ALL_TIME).alias("year_month"),
        F.lit(0).alias("end_day"),
        F.col("total_events").cast("bigint").alias("total_events"),
        "url",
        F.col("label.format").alias("format"),
        F.concat(F.lit(f"/{catalogue_segment}/"), "package_name").alias("package_url"),
        "resource_id",
        "package_name",
        F.col("label.organization_id").alias("organization_id"),
        F.col("label.publisher_id").alias("publisher_id"),
    )
