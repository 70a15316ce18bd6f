"""Reports of the public dashboard.

Each takes the tables it needs by name (a mapping of table name to DataFrame), and the day that stands for today.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portalmeter import fixed_values as fixed
from portalmeter import schemas
from portalmeter.config import PortalConfig
from portalmeter.functions.labels import label_of, place_of
from portalmeter.functions.periods import as_date, period_title

Tables = Mapping[str, DataFrame]
Day = dt.date | str | None

TOP_DATASETS = 10


def day_text(as_of: Day) -> Column:
    return F.lit(as_date(as_of).isoformat())


def published(package: DataFrame) -> DataFrame:
    """Active public datasets."""
    return package.where((F.col("type") == "dataset") & (F.col("state") == "active") & ~F.col("private"))


def sums_by_value(
    df: DataFrame, by: Column, value_col: str, values: Mapping[str, Sequence[str]], amount_col: str, absent: int | None
) -> DataFrame:
    """One row per ``by`` and one sum per named set of values, in one pass; ``absent`` stands in for no rows."""
    wanted = [v for members in values.values() for v in members]
    sums = []
    for name, members in values.items():
        total = F.sum(F.when(F.col(value_col).isin(*members), F.col(amount_col)))
        sums.append((total if absent is None else F.coalesce(total, F.lit(absent))).cast("bigint").alias(name))
    return df.where(F.col(value_col).isin(*wanted)).groupBy(by).agg(*sums)


def _each(values: Sequence[str]) -> dict[str, list[str]]:
    return {v: [v] for v in values}


def datasets_evolution(tables: Tables, as_of: Day = None) -> DataFrame:
    """Published datasets per month."""
    return (
        tables["published_datasets"]
        .where(F.col("key") == "total")
        .select(F.col("year_month").alias("year"), F.col("num_datasets").alias("value"))
        .orderBy("year")
    )


def datasets_by_admin_level(tables: Tables, as_of: Day = None) -> DataFrame:
    """Datasets per administration level of their publisher.

    Counting per publisher first keeps a publisher of very many datasets out of the joins with the groups.
    """
    publishers = tables["package_extra"].where(F.col("key") == "publisher").select("package_id", "value")
    codes = (
        tables["group_extra"].where(F.col("key") == fixed.ORG_CODE_KEY).select("group_id", F.col("value").alias("code"))
    )
    groups = tables["group"].select(F.col("id").alias("known_group"))
    per_publisher = (
        published(tables["package"])
        .join(publishers, F.col("id") == F.col("package_id"))
        .groupBy("value")
        .agg(F.count("title").alias("n"))
    )
    letter = F.substring("code", 1, 1)
    level = F.when(letter.isin("G", "I"), F.lit("G/I")).otherwise(letter)
    labels = {("G/I" if code in "GI" else code): text for code, text in fixed.LEVEL_LABELS.items()}
    return (
        per_publisher.join(groups, F.col("value") == F.col("known_group"), "left")
        .join(codes, F.col("known_group") == F.col("group_id"), "left")
        .groupBy(level.alias("level"))
        .agg(F.sum("n").alias("num_datasets"))
        .orderBy(place_of(F.col("level"), fixed.LEVEL_CODE_ORDER), F.col("level").asc_nulls_last())
        .select(day_text(as_of).alias("date"), label_of(F.col("level"), labels).alias("administration_level"), "num_datasets")
    )


def datasets_by_theme(tables: Tables, as_of: Day = None, cfg: PortalConfig = PortalConfig()) -> DataFrame:
    """Datasets per theme address. Two addresses with the same label stay two rows."""
    themes = tables["package_extra"].where(F.col("key") == "theme").select("package_id", "value")
    # The outer form keeps Spark from parsing the JSON a second time just to test that there is something in it.
    uris = F.explode_outer(F.from_json("value", "array<string>"))
    prefix = f"http://{cfg.portal_host}{fixed.THEME_SECTOR_PATH}"
    labels = {prefix + name: text for name, text in fixed.THEME_LABELS.items()}
    return (
        published(tables["package"])
        .join(themes, F.col("id") == F.col("package_id"))
        .select("title", uris.alias("uri"))
        .where(F.col("uri").contains(cfg.portal_host + fixed.THEME_PATH))
        .groupBy("uri")
        .agg(F.count("title").alias("value"))
        .select(
            day_text(as_of).alias("date"),
            F.coalesce(label_of(F.col("uri"), labels), F.lit(fixed.THEME_OTHER)).alias("theme"),
            "value",
        )
        .orderBy(F.desc("value"), "theme")
    )


def unreadable_themes(tables: Tables) -> DataFrame:
    """How many theme values are no JSON array and so are left out of ``datasets_by_theme``."""
    themes = tables["package_extra"].where((F.col("key") == "theme") & F.col("value").isNotNull())
    return themes.agg(F.count_if(F.from_json("value", "array<string>").isNull()).alias("unreadable"))


def datasets_by_format(tables: Tables, as_of: Day = None) -> DataFrame:
    """Files of datasets per stored format. Two formats with the same label stay two rows.

    Files are counted per dataset and format before the join, so a dataset of very many files joins as few rows.
    """
    files = (
        tables["resource"].where(F.col("state") == "active").groupBy("package_id", "format").agg(F.count("*").alias("n"))
    )
    titled = F.when(F.col("title").isNotNull(), F.col("n")).otherwise(0)
    return (
        published(tables["package"])
        .select("id", "title")
        .join(files, F.col("id") == F.col("package_id"))
        .groupBy("format")
        .agg(F.sum(titled).alias("value"))
        .select(
            day_text(as_of).alias("date"),
            F.coalesce(label_of(F.col("format"), fixed.FORMAT_LABELS), F.col("format")).alias("format"),
            "value",
        )
        .orderBy(F.desc("value"), "format")
    )


def contents_by_type(tables: Tables, as_of: Day = None) -> DataFrame:
    """Contents per month, a column per type."""
    return sums_by_value(
        tables["content_counts"],
        F.col("year_month").alias("date"),
        "content_type",
        _each(fixed.COUNTED_CONTENT_TYPES),
        "num_contents",
        None,
    ).orderBy("date")


def visits_evolution(tables: Tables, as_of: Day = None) -> DataFrame:
    """Visits of the whole portal per month."""
    return (
        tables["visits_fact"]
        .where(F.col("key") == "all")
        .select(F.col("year_month").alias("date"), F.col("sessions").alias("value"))
        .orderBy("date")
    )


def catalogue_visits_evolution(tables: Tables, as_of: Day = None) -> DataFrame:
    """Visits of the catalogue per month."""
    return (
        tables["visits_fact"]
        .where(F.col("key_value") == "catalogo")
        .select(F.col("year_month").alias("date"), F.col("sessions").alias("catalogo"))
        .orderBy("date")
    )


def content_section_visits(tables: Tables, as_of: Day = None) -> DataFrame:
    """Visits per month, a column per content section."""
    return sums_by_value(
        tables["visits_fact"],
        F.col("year_month").alias("date"),
        "key_value",
        _each(fixed.CONTENT_SECTIONS),
        "sessions",
        0,
    ).orderBy("date")


def sector_visits(tables: Tables, as_of: Day = None) -> DataFrame:
    """Visits per month, a column per sector."""
    return sums_by_value(
        tables["visits_fact"],
        F.col("year_month").alias("date"),
        "key_value",
        _each(fixed.SECTOR_SECTIONS),
        "sessions",
        0,
    ).orderBy("date")


def top_datasets_per_month(tables: Tables, as_of: Day = None, cfg: PortalConfig = PortalConfig()) -> DataFrame:
    """The ten most viewed datasets of each month and of all time.

    Spark keeps at most ten rows per month and task before the shuffle by month, so no task sees a whole month.
    Equal views rank by dataset name, then by path.
    """
    views = tables["packages_fact"].where(F.col("publisher_id").isNotNull())
    publishers = tables["group"].select(F.col("id").alias("group_id"), F.col("title").alias("publisher"))
    datasets = tables["package"].where(~F.col("private")).select("name", F.col("title").alias("dataset"))
    ranked = Window.partitionBy("year_month").orderBy(
        F.desc("pageviews"), "name", "url", F.col("publisher").asc_nulls_last()
    )
    return (
        views.join(publishers, F.col("publisher_id") == F.col("group_id"))
        .join(datasets, F.col("package_name") == F.col("name"))
        .select("year_month", "end_day", "pageviews", "name", "url", "dataset", "publisher")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= TOP_DATASETS)
        .orderBy(F.desc("year_month"), "rank")
        .select(
            period_title(F.col("year_month"), F.col("end_day"), cfg.month_names).alias(fixed.COL_MONTH),
            F.concat(F.lit(cfg.dataset_url_prefix), "name").alias(fixed.COL_URL),
            F.col("dataset").alias(fixed.COL_DATASET),
            F.col("publisher").alias(fixed.COL_PUBLISHER),
            F.col("pageviews").alias(fixed.COL_VISITS),
        )
    )
