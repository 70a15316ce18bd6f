"""The monthly load: hits or stored reports to fact rows, and the all-time rows after it."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portalmeter.config import PortalConfig
from portalmeter.functions.periods import Period, choose_period, in_days
from portalmeter.operators import facts, identity
from portalmeter.operators import hits as hit_counts
from portalmeter.operators.facts import delete_period, package_all_time, recover_period, resource_all_time, write_period
from portalmeter.operators.identity import backfill_package, backfill_resource, resolve_package, resolve_resource
from portalmeter.operators.visits import section_visits, visits_from_report
from portalmeter.plans.public_reports import Day, Tables
from portalmeter.schemas import ALL_TIME, HITS_PARTITION
from portalmeter.session import folder_exists
from portalmeter.sources.report_rows import NESTED, read_stored_report, rejected, report_totals, usable
from portalmeter.sources.tables import portal_tables, table_source
from portalmeter.staging import Staging

FACT_TABLES = ("packages_fact", "resources_fact", "visits_fact")
LOAD_TABLES = ("rejected_rows", "load_totals")
#: Up to so many datasets are sent to all tasks.
FEW_DATASETS = 100_000


def feed_of(period: str, cfg: PortalConfig) -> str:
    """The feed that holds a month: the legacy one up to and including the cut-over month."""
    return hit_counts.LEGACY if period <= cfg.cutover_month else hit_counts.CURRENT


def resolved_pages(counted: DataFrame, catalogue: Tables, cfg: PortalConfig, staging: Staging) -> DataFrame:
    """Counted views with what the catalogue knows of them, stored: they say what to look up in earlier months."""
    return staging.save(resolve_package(counted, catalogue["package"], catalogue["package_extra"], catalogue["group"], cfg))


def resolved_files(counted: DataFrame, catalogue: Tables, cfg: PortalConfig, staging: Staging) -> DataFrame:
    """Counted events with what the catalogue knows of them, stored, as for pages.

    Files of datasets without a hit cannot be found. Where few datasets have hits, those files are left out before files
    and hits are brought together; where many have, a join to leave them out would move as much as it spares.
    """
    counted = staging.save(counted)
    package, resource = catalogue["package"], catalogue["resource"]
    seen = staging.save(identity.datasets_of_pages(counted, package, cfg))
    if seen.count() <= FEW_DATASETS:
        resource = resource.join(F.broadcast(seen), "package_id", "left_semi").select(*resource.columns)
    return staging.save(resolve_resource(counted, package, resource, catalogue["package_extra"], catalogue["group"], cfg))


def package_rows(
    hits: DataFrame, catalogue: Tables, packages_fact: DataFrame, cfg: PortalConfig, as_of: Day, feed: str,
    period: str | None = None, staging: Staging | None = None,
) -> DataFrame:
    """Fact rows for dataset pages, one per month and path."""
    staging = staging or Staging(hits.sparkSession)
    counted = hit_counts.package_hits(hits, cfg, as_of, feed)
    return backfill_package(resolved_pages(counted, catalogue, cfg, staging), packages_fact, period)


def resource_rows(
    hits: DataFrame, catalogue: Tables, resources_fact: DataFrame, cfg: PortalConfig, as_of: Day, feed: str,
    period: str | None = None, staging: Staging | None = None,
) -> DataFrame:
    """Fact rows for files, one per month, address and page."""
    staging = staging or Staging(hits.sparkSession)
    counted = hit_counts.resource_hits(hits, cfg, as_of, feed)
    return backfill_resource(resolved_files(counted, catalogue, cfg, staging), resources_fact, period)


def visit_rows(spark: SparkSession, hits: DataFrame, cfg: PortalConfig, chosen: Period, as_of: Day) -> DataFrame:
    """Fact rows for the sections of one month; a month without any hit gets a 0 for every section."""
    feed = feed_of(chosen.year_month, cfg)
    rules = cfg.sections(feed)
    zeros = spark.createDataFrame(
        [(chosen.year_month, chosen.end_day, 0, rule.key, rule.name) for rule in rules],
        "year_month string, end_day int, sessions bigint, key string, key_value string",
    )
    return section_visits(hits, rules, as_of, feed, history=zeros, extra_rule=cfg.extra_rule)


@dataclass(frozen=True)
class FactStore:
    """Where the fact tables live: ``<root>/packages_fact`` and so on.

    ``checkpoint_fallback`` is where stored steps go if the session names no shared folder, on one machine only.
    """

    root: str
    checkpoint_fallback: str | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return table_source(spark, name, portal_tables(self.root))

    def replace(self, spark: SparkSession, rows: DataFrame, name: str, period: str) -> None:
        write_period(spark, rows, self.path(name), period)

    def recover(self, spark: SparkSession, period: str) -> None:
        """Sets right what a load of a month that did not come to its end left behind."""
        for name in (*FACT_TABLES, *LOAD_TABLES):
            for part in (period, ALL_TIME):
                recover_period(spark, self.path(name), part)

    def staging(self, spark: SparkSession) -> Staging:
        return Staging(spark, self.checkpoint_fallback)


def hits_between(hits: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The hits of some days; where hits are stored by day only the folders of these days are read."""
    chosen = hits.where(in_days(F.col("ts"), start, end))
    if HITS_PARTITION in hits.columns:
        chosen = chosen.where(F.col(HITS_PARTITION).between(F.lit(start), F.lit(end)))
    return chosen


def write_hits(hits: DataFrame, path: str) -> None:
    """Stores hits by day, as loads read them; a day with very many hits is spread over several files."""
    by_day = hits.withColumn(HITS_PARTITION, F.to_date("ts"))
    by_day.hint("rebalance", HITS_PARTITION).write.mode("append").partitionBy(HITS_PARTITION).parquet(path)


def _of_month(hits: DataFrame, period: str, as_of: Day) -> tuple[DataFrame, str]:
    chosen = choose_period(period, as_of)
    return hits_between(hits, chosen.start, chosen.end), chosen.year_month


def _write_packages(spark: SparkSession, store: FactStore, rows: DataFrame, staging: Staging, months: list[str]) -> None:
    """Replaces months of dataset rows, then the all-time rows of the datasets that stand in them before or now."""
    before = facts.package_parts(store.read(spark, "packages_fact").where(F.col("year_month").isin(months)))
    old, rows = staging.save(before), staging.save(rows)
    for month in months:
        store.replace(spark, rows.where(F.col("year_month") == month), "packages_fact", month)
    now = store.read(spark, "packages_fact")
    if now.where(F.col("year_month") == ALL_TIME).isEmpty():
        store.replace(spark, package_all_time(now), "packages_fact", ALL_TIME)
        return
    all_time, monthly = now.where(F.col("year_month") == ALL_TIME), now.where(F.col("year_month") != ALL_TIME)
    changed = facts.package_all_time_changed(all_time, old, facts.package_parts(rows), monthly)
    store.replace(spark, changed, "packages_fact", ALL_TIME)


def _write_resources(spark: SparkSession, store: FactStore, rows: DataFrame, staging: Staging, months: list[str], cfg: PortalConfig) -> None:
    """As ``_write_packages``, for files."""
    before = facts.resource_parts(store.read(spark, "resources_fact").where(F.col("year_month").isin(months)))
    old, rows = staging.save(before), staging.save(rows)
    for month in months:
        store.replace(spark, rows.where(F.col("year_month") == month), "resources_fact", month)
    now = store.read(spark, "resources_fact")
    if now.where(F.col("year_month") == ALL_TIME).isEmpty():
        store.replace(spark, resource_all_time(now, cfg.catalogue_segment), "resources_fact", ALL_TIME)
        return
    all_time, monthly = now.where(F.col("year_month") == ALL_TIME), now.where(F.col("year_month") != ALL_TIME)
    changed = facts.resource_all_time_changed(all_time, old, facts.resource_parts(rows), monthly, cfg.catalogue_segment)
    store.replace(spark, changed, "resources_fact", ALL_TIME)


def load_pages(
    spark: SparkSession, hits: DataFrame, catalogue: Tables, store: FactStore, cfg: PortalConfig, period: str, as_of: Day
) -> None:
    """Load a month of dataset views and file events, then the all-time rows of what the month changed."""
    month_hits, month = _of_month(hits, period, as_of)
    store.recover(spark, month)
    feed, staging = feed_of(month, cfg), store.staging(spark)
    packages = package_rows(month_hits, catalogue, store.read(spark, "packages_fact"), cfg, as_of, feed, month, staging)
    _write_packages(spark, store, packages, staging, [month])
    resources = resource_rows(month_hits, catalogue, store.read(spark, "resources_fact"), cfg, as_of, feed, month, staging)
    _write_resources(spark, store, resources, staging, [month], cfg)
    staging.clear()


def load_visits(
    spark: SparkSession, hits: DataFrame, store: FactStore, cfg: PortalConfig, period: str, as_of: Day
) -> None:
    """Load a month of section visits; a month without any hit gets a 0 for every section."""
    chosen = choose_period(period, as_of)
    store.replace(spark, visit_rows(spark, hits_between(hits, chosen.start, chosen.end), cfg, chosen, as_of), "visits_fact", chosen.year_month)


# --- several months ------------------------------------------------------------------------------------------


def months_between(first: str, last: str) -> list[str]:
    """Month names from ``first`` to ``last``."""
    number = lambda name: int(name[:4]) * 12 + int(name[5:]) - 1
    return [f"{i // 12:04d}-{i % 12 + 1:02d}" for i in range(number(first), number(last) + 1)]


def _of_feeds(hits: DataFrame, first: Period, last: Period, cfg: PortalConfig, count) -> DataFrame:
    """Counts of months of which the earlier may be in the legacy feed; each hit is read once."""
    cut = choose_period(cfg.cutover_month, "9999-12-31")
    parts = []
    if first.start <= cut.end:
        parts.append(count(hits_between(hits, first.start, min(cut.end, last.end)), hit_counts.LEGACY))
    if last.end > cut.end:
        parts.append(count(hits_between(hits, max(first.start, cut.end + dt.timedelta(days=1)), last.end), hit_counts.CURRENT))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def load_range(
    spark: SparkSession, hits: DataFrame, catalogue: Tables, store: FactStore, cfg: PortalConfig, first: str, last: str, as_of: Day
) -> None:
    """Load the months from ``first`` to ``last`` (YYYY-MM) as one after another, but count their hits in one pass.

    Lost pages and files see what each month would have seen (``backfill_package_range``).
    """
    begin, end = choose_period(first, as_of), choose_period(last, as_of)
    months, staging = months_between(first, last), store.staging(spark)
    for month in months:
        store.recover(spark, month)
    counted = _of_feeds(hits, begin, end, cfg, lambda part, feed: hit_counts.package_hits(part, cfg, as_of, feed))
    pages = identity.backfill_package_range(resolved_pages(counted, catalogue, cfg, staging), store.read(spark, "packages_fact"), first)
    _write_packages(spark, store, pages, staging, months)
    counted = _of_feeds(hits, begin, end, cfg, lambda part, feed: hit_counts.resource_hits(part, cfg, as_of, feed))
    files = identity.backfill_resource_range(resolved_files(counted, catalogue, cfg, staging), store.read(spark, "resources_fact"), first)
    _write_resources(spark, store, files, staging, months, cfg)
    staging.clear()


# --- stored reports ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class StoredReports:
    """Reports of the analytics service as text, in ``<root>/<report>/year_month=YYYY-MM``: packages and resources."""

    root: str
    layout: str = NESTED


def load_reports(
    spark: SparkSession, reports: StoredReports, catalogue: Tables, store: FactStore, cfg: PortalConfig, period: str, as_of: Day
) -> None:
    """Load a month of dataset views and file events from stored report rows instead of hits.

    Rows that cannot be used go to ``rejected_rows`` with their line; ``load_totals`` says what became of all others,
    and a total that does not come out stops the load after the facts are written and before the totals are.
    """
    chosen = choose_period(period, as_of)
    month, staging = chosen.year_month, store.staging(spark)
    store.recover(spark, month)

    def checked(report: str, dims: list[str], metric: str) -> DataFrame:
        return staging.save(read_stored_report(spark, reports.root, report, chosen, dims, metric, reports.layout))

    views, events = checked("packages", ["page_path"], "pageviews"), checked("resources", ["event_label", "page_path"], "total_events")
    counted = hit_counts.page_views(usable(views), cfg, "pageviews")
    pages = backfill_package(resolved_pages(counted, catalogue, cfg, staging), store.read(spark, "packages_fact"), month)
    _write_packages(spark, store, pages, staging, [month])
    counted = hit_counts.file_events(usable(events), cfg, "total_events")
    files = backfill_resource(resolved_files(counted, catalogue, cfg, staging), store.read(spark, "resources_fact"), month)
    _write_resources(spark, store, files, staging, [month], cfg)

    store.replace(spark, rejected(views, "packages").union(rejected(events, "resources")), "rejected_rows", month)
    stored = {name: store.read(spark, name).where(F.col("year_month") == month) for name in ("packages_fact", "resources_fact")}
    left_out = [hit_counts.cleaned_pages(usable(rows), cfg, "clean").where("not is_page") for rows in (views, events)]
    totals = report_totals(views, left_out[0], stored["packages_fact"], "packages", "pageviews").union(
        report_totals(events, left_out[1], stored["resources_fact"], "resources", "total_events")
    )
    store.replace(spark, totals, "load_totals", month)
    staging.clear()


def load_visit_reports(
    spark: SparkSession, rows: DataFrame, store: FactStore, cfg: PortalConfig, period: str, as_of: Day
) -> None:
    """Load a month of section visits from usable report rows (year_month, end_day, key, key_value, sessions)."""
    chosen = choose_period(period, as_of)
    visits = visits_from_report(rows.where(F.col("year_month") == chosen.year_month), cfg.sections(feed_of(chosen.year_month, cfg)))
    store.replace(spark, visits, "visits_fact", chosen.year_month)


def init_store(spark: SparkSession, store: FactStore, history: DataFrame | None = None) -> None:
    """Create the tables that do not exist yet; those that do stay as they are.

    ``history`` holds visits of the months before the first load; it goes only into a new visits table.
    """
    missing = [name for name in (*FACT_TABLES, *LOAD_TABLES) if not folder_exists(spark, store.path(name))]
    delete_period(spark, {name: store.path(name) for name in missing}, ALL_TIME)
    if history is not None and "visits_fact" in missing:
        history.write.mode("append").partitionBy("year_month").parquet(store.path("visits_fact"))
