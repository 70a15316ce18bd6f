"""From page hits to monthly counts per dataset page and per file."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalmeter import fixed_values as fixed
from portalmeter.config import HitRule, PortalConfig
from portalmeter.functions.periods import in_days, with_period
from portalmeter.functions.urls import decode_plus, normalise_page_path

CURRENT = "current"
LEGACY = "legacy"


def cutover_union(
    legacy: DataFrame, current: DataFrame, cutover_month: str, month_col: str = "year_month"
) -> DataFrame:
    """Months up to and including the cut-over from the legacy feed, later ones from the current feed."""
    return legacy.where(F.col(month_col) <= cutover_month).unionByName(
        current.where(F.col(month_col) > cutover_month)
    )


def full_match(pattern: str) -> str:
    """A pattern for the whole value, whatever its case."""
    return rf"(?iu)\A(?:{pattern})\z"


def dimension(name: str) -> Column:
    """A dimension of a hit; one that is not set counts as empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def rule_predicate(rule: HitRule) -> Column:
    """One rule as a column."""
    value = dimension(rule.column)
    if rule.match == "exact":
        test = F.lower(value) == rule.value.lower()
    elif rule.match == "full_regex":
        test = value.rlike(full_match(rule.value))
    elif rule.match == "regex":
        test = value.rlike(f"(?iu){rule.value}")
    elif rule.match == "begins_with":
        test = F.lower(value).startswith(rule.value.lower())
    elif rule.match == "ends_with":
        test = F.lower(value).endswith(rule.value.lower())
    elif rule.match == "contains":
        test = F.lower(value).contains(rule.value.lower())
    else:
        raise ValueError(f"unknown match: {rule.match}")
    return ~test if rule.negate else test


def hit_filter(hits: DataFrame, rules: Sequence[HitRule]) -> DataFrame:
    """Hits that pass every rule."""
    return hits.where(reduce(lambda a, b: a & b, map(rule_predicate, rules))) if rules else hits


def counts_for(metric: str) -> Column:
    """Whether a hit counts for a metric.

    Hits without an event category are page views, the others are tracked events; both are events of the
    current feed.
    """
    if metric == "eventCount":
        return F.lit(True)
    if metric == "pageviews":
        return dimension("event_category") == ""
    if metric == "totalEvents":
        return dimension("event_category") != ""
    raise ValueError(f"unknown metric: {metric}")


def metric_column(metric: str) -> Column:
    """The aggregate behind a metric's name."""
    return F.count_distinct("session_id") if metric == "sessions" else F.count_if(counts_for(metric))


def metric_counts(hits: DataFrame, dims: Sequence[str | Column], metric: str, rules: Sequence[HitRule]) -> DataFrame:
    """The metric per combination of dimensions, in no order."""
    return hit_filter(hits, rules).groupBy(*dims).agg(metric_column(metric).cast("bigint").alias(metric))


def metric_report(
    hits: DataFrame,
    dims: Sequence[str],
    metric: str,
    start: dt.date | str,
    end: dt.date | str,
    rules: Sequence[HitRule] = (),
    ts_col: str = "ts",
) -> DataFrame:
    """The metric per combination of dimensions between two days, highest first; without dimensions one row.

    Only combinations that count something appear. Equal counts are ordered by the dimensions, which also keeps
    a count shared by very many rows from landing in a single sort range.
    """
    counts = metric_counts(hits.where(in_days(F.col(ts_col), start, end)), dims, metric, rules)
    if not dims:
        return counts
    return counts.where(F.col(metric) > 0).orderBy(F.desc(metric), *dims)


def package_rules(cfg: PortalConfig, feed: str = CURRENT) -> list[HitRule]:
    """Hits that show a dataset: the catalogue section with a third section below it."""
    has_third_section = HitRule("section_s3", "full_regex", fixed.NOT_SET_PATTERN, negate=True)
    section = HitRule("section_s2", "full_regex", cfg.catalogue_phrases)
    rules = [section, has_third_section]
    if feed == CURRENT:
        rules.insert(0, HitRule("event_name", "exact", fixed.LOAD_EVENT))
    rules += [HitRule("page_path", "full_regex", path, negate=True) for path in cfg.excluded_package_paths]
    return rules + ([cfg.extra_rule] if cfg.extra_rule else [])


def resource_rules(cfg: PortalConfig, feed: str = CURRENT) -> list[HitRule]:
    """Events on a file, told from a dataset page."""
    rules = [HitRule("event_category", "exact", fixed.RESOURCE_CATEGORY)]
    if feed == LEGACY:
        rules.append(HitRule("event_action", "exact", fixed.DOWNLOAD_ACTION))
    rules.append(HitRule("page_path", "regex", cfg.dataset_page_pattern))
    if cfg.hostname_pattern:
        match = "full_regex" if feed == CURRENT else "regex"
        rules.append(HitRule("host_name", match, cfg.hostname_pattern))
    rules += [HitRule("page_path", "full_regex", path, negate=True) for path in cfg.excluded_resource_paths]
    return rules + ([cfg.extra_rule] if cfg.extra_rule else [])


def _monthly_counts(
    hits: DataFrame, dims: Sequence[str], metric: str, rules: Sequence[HitRule], as_of: dt.date | str | None, ts_col: str
) -> DataFrame:
    # Grouping by the first day of the month keeps the key an integer; the month's name is made once per group.
    month = F.trunc(F.col(ts_col), "MM").alias("month")
    return with_period(metric_counts(hits, [month, *dims], metric, rules), "month", as_of).drop("month")


def cleaned_pages(counts: DataFrame, cfg: PortalConfig, url: str) -> DataFrame:
    """``counts`` with ``page_path`` cleaned, named ``url``, and ``is_page``: whether it is the page of a dataset."""
    pages = normalise_page_path(counts.withColumnRenamed("page_path", url), url, cfg.languages)
    return pages.withColumn("is_page", F.col(url).rlike(cfg.dataset_page_pattern))


def page_views(counts: DataFrame, cfg: PortalConfig, metric: str) -> DataFrame:
    """Views per month and dataset page from counts per raw path: (year_month, end_day, url, pageviews).

    ``counts`` has year_month, end_day, page_path and the metric; paths that come out equal add up, others than those of
    dataset pages are left out.
    """
    pages = cleaned_pages(counts, cfg, "url").where(F.col("is_page") & (F.col(metric) > 0))
    return pages.groupBy("year_month", "end_day", "url").agg(F.sum(metric).alias("pageviews"))


def file_events(counts: DataFrame, cfg: PortalConfig, metric: str) -> DataFrame:
    """Events per month, file and dataset page from counts per raw label and path, as ``page_views``."""
    pages = cleaned_pages(counts, cfg, "package_url").where(F.col("is_page") & (F.col(metric) > 0))
    named = pages.withColumn("url", decode_plus(F.coalesce(F.col("event_label"), F.lit(""))))
    return named.groupBy("year_month", "end_day", "url", "package_url").agg(F.sum(metric).alias("total_events"))


def package_hits(
    hits: DataFrame, cfg: PortalConfig, as_of: dt.date | str | None = None, feed: str = CURRENT, ts_col: str = "ts"
) -> DataFrame:
    """Views per month and dataset page: (year_month, end_day, url, pageviews).

    Hits are counted per raw path first, so the cleaning runs once per path and month and not once per hit.
    """
    metric = "eventCount" if feed == CURRENT else "pageviews"
    return page_views(_monthly_counts(hits, ["page_path"], metric, package_rules(cfg, feed), as_of, ts_col), cfg, metric)


def resource_hits(
    hits: DataFrame, cfg: PortalConfig, as_of: dt.date | str | None = None, feed: str = CURRENT, ts_col: str = "ts"
) -> DataFrame:
    """Events per month, file and dataset page: (year_month, end_day, url, package_url, total_events)."""
    metric = "eventCount" if feed == CURRENT else "totalEvents"
    counts = _monthly_counts(hits, ["event_label", "page_path"], metric, resource_rules(cfg, feed), as_of, ts_col)
    return file_events(counts, cfg, metric)
