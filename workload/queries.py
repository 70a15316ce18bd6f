"""Every operator and report as a query over the given tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portalmeter.config import HitRule, PortalConfig, SectionRule
from portalmeter.functions.periods import choose_period, with_period
from portalmeter.functions.urls import normalise_page_path
from portalmeter.operators import facts, hits, identity, visits
from portalmeter.plans import admin_reports as admin
from portalmeter.plans import monthly_load
from portalmeter.plans import public_reports as public
from portalmeter.plans.catalogue import REPORTS, build_report
from portalmeter.schemas import ALL_TIME
from portalmeter.sinks.csv_report import csv_report_sink, csv_report_parts
from portalmeter.sources.report_rows import NESTED, POSITIONAL, checked_report_rows, flatten_report_rows, parse_report_rows, rejected, report_totals, usable
from portalmeter.sources.tables import ParquetTables, table_source
from portalmeter.staging import Staging
from workload.standins import tables, view

Query = Callable[[SparkSession, str], DataFrame]

# The given pages are in these languages.
CONFIG = PortalConfig(languages=("en", "fr", "es", "de"))
AS_OF = "2024-01-20"
REPLACED_MONTH = "1997-05"
CUTOVER_MONTH = "1998-06"
FIRST_ORG_MONTH, ORG_AS_OF = "1995-01", "2000-01-15"

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _staging(spark: SparkSession) -> Staging:
    """Stored steps in the shared folder; where the session names none, in one that goes with this process."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return Staging(spark)
    folder = tempfile.mkdtemp(prefix="portal-")
    atexit.register(shutil.rmtree, folder, True)
    return Staging(spark, folder)


def _store(spark: SparkSession) -> monthly_load.FactStore:
    """New fact tables in the shared folder."""
    store = monthly_load.FactStore(f"{_staging(spark).root}/facts")
    monthly_load.init_store(spark, store)
    return store


# --- sources and sinks ---------------------------------------------------------------------------------------


@query
def flatten_report_rows_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = view(spark, sf_dir, "hits").groupBy("page_path", "event_name").count()
    stored = counted.select(
        F.to_json(
            F.struct(
                F.array(
                    F.struct(F.col("page_path").alias("value")), F.struct(F.col("event_name").alias("value"))
                ).alias("dimensionValues"),
                F.array(F.struct(F.col("count").cast("string").alias("value"))).alias("metricValues"),
            )
        ).alias("value")
    )
    return flatten_report_rows(
        parse_report_rows(stored, NESTED), ["page_path", "event_name"], "event_count", NESTED
    )


@query
def flatten_report_rows_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = view(spark, sf_dir, "hits").groupBy("page_path").count()
    stored = counted.select(F.to_json(F.array("page_path", F.col("count").cast("string"))).alias("value"))
    return flatten_report_rows(parse_report_rows(stored, POSITIONAL), ["page_path"], "pageviews", POSITIONAL)


@query
def table_source_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table_source(spark, "orders", ParquetTables(sf_dir, suffix=".parquet"))
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@query
def csv_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a written report: quoting, header, empty fields and order of columns as in the file."""
    report = public.contents_by_type(tables(spark, sf_dir, "content_counts"))
    path = csv_report_sink(report, _staging(spark).root, AS_OF, "contents_by_type", single_file=True)
    return spark.read.option("lineSep", "\r\n").text(path).withColumnRenamed("value", "line")


@query
def csv_report_lines_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a report written in ordered parts, of which the first alone has the header."""
    views = view(spark, sf_dir, "packages_fact").select("year_month", "url", "package_name", "pageviews")
    path = csv_report_parts(views, _staging(spark).root, AS_OF, "views", ["year_month", "url"])
    return spark.read.option("lineSep", "\r\n").text(path).withColumnRenamed("value", "line")


def _report_lines(counts: DataFrame, dims: list[str], layout: str) -> DataFrame:
    """Counts as lines of a stored report; of some lengths they are no JSON, without a metric, or not a number."""
    kind = F.col("n")
    for name in dims:
        kind = kind + F.length(F.coalesce(name, F.lit("")))
    kind = kind % 7
    number = F.when(kind == 1, "n/a").otherwise(F.col("n").cast("string"))
    if layout == NESTED:
        entry = lambda c: F.struct(F.coalesce(c, F.lit("")).alias("value"))
        metrics = F.when(kind == 2, F.array().cast("array<struct<value:string>>")).otherwise(F.array(entry(number)))
        line = F.to_json(F.struct(F.array(*[entry(F.col(d)) for d in dims]).alias("dimensionValues"), metrics.alias("metricValues")))
    else:
        values = [F.coalesce(d, F.lit("")) for d in dims]
        line = F.to_json(F.when(kind == 2, F.array(*values)).otherwise(F.array(*values, number)))
    broken = F.concat(F.lit("{ "), F.substring(F.sha2(F.concat_ws("|", *dims), 256), 1, 12))
    return counts.select("year_month", "end_day", F.when(kind == 0, broken).otherwise(line).alias("value"))


def _report_rows(spark: SparkSession, sf_dir: str, dims: list[str], metric: str, layout: str) -> DataFrame:
    """Checked rows of a report per month and dimensions, made of all hits."""
    counts = with_period(view(spark, sf_dir, "hits"), "ts", AS_OF).groupBy("year_month", "end_day", *dims).agg(F.count("*").alias("n"))
    return checked_report_rows(_report_lines(counts, dims, layout), dims, metric, layout)


def _views_from_report(layout: str) -> Query:
    return lambda spark, sf_dir: hits.page_views(usable(_report_rows(spark, sf_dir, ["page_path"], "views", layout)), CONFIG, "views")


def _events_from_report(layout: str) -> Query:
    dims = ["event_label", "page_path"]
    return lambda spark, sf_dir: hits.file_events(usable(_report_rows(spark, sf_dir, dims, "events", layout)), CONFIG, "events")


QUERIES["package_views_from_report"] = _views_from_report(NESTED)
QUERIES["package_views_from_report_positional"] = _views_from_report(POSITIONAL)
QUERIES["resource_events_from_report"] = _events_from_report(NESTED)
QUERIES["resource_events_from_report_positional"] = _events_from_report(POSITIONAL)


@query
def report_rows_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load of the report cannot use, and why."""
    rows = _report_rows(spark, sf_dir, ["page_path"], "views", POSITIONAL)
    return rejected(rows, "packages").groupBy("year_month", "report", "reason").agg(F.count("*").alias("lines"))


@query
def report_load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and views of the report against what the counts made of it hold."""
    rows = _report_rows(spark, sf_dir, ["page_path"], "pageviews", NESTED)
    left_out = hits.cleaned_pages(usable(rows), CONFIG, "clean").where("not is_page")
    return report_totals(rows, left_out, hits.page_views(usable(rows), CONFIG, "pageviews"), "packages", "pageviews")


@query
def section_visits_from_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits from one report row per month and section, as the service gives them; sections without a row have 0."""
    counts = visits.section_visits(view(spark, sf_dir, "hits"), CONFIG.legacy_sections, AS_OF, hits.LEGACY)
    lines = counts.where("sessions > 0").select("year_month", "end_day", "key", "key_value", F.to_json(F.array(F.col("sessions").cast("string"))).alias("value"))
    return visits.visits_from_report(usable(checked_report_rows(lines, [], "sessions", POSITIONAL)), CONFIG.legacy_sections)


# --- hits ----------------------------------------------------------------------------------------------------


@query
def with_period_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "events").select("event_id", "ts")
    return with_period(rows, "ts", AS_OF).drop("ts")


@query
def with_period_last_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return with_period(rows, "o_orderdate", "1999-01-15", "last_month").drop("o_orderdate")


@query
def cutover_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "visits_fact").select("year_month", "key", "key_value", "sessions")
    legacy = rows.withColumn("feed", F.lit("legacy"))
    current = rows.withColumns({"sessions": F.col("sessions") * 2, "feed": F.lit("current")})
    return hits.cutover_union(legacy, current, CUTOVER_MONTH)


HIT_RULES = (
    HitRule("event_name", "exact", "load_complete"),
    HitRule("section_s2", "full_regex", "datasets|conjuntos de datos|blog"),
    HitRule("section_s3", "full_regex", r"|not set|\(not set\)", negate=True),
    HitRule("host_name", "full_regex", r".*\.example\.(com|org)"),
    HitRule("page_path", "full_regex", r".*\.html", negate=True),
    HitRule("event_category", "exact", "error", negate=True),
)


@query
def hit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = hits.hit_filter(view(spark, sf_dir, "hits"), HIT_RULES)
    return passed.select("hit_id", "host_name", "page_path", "section_s2")


@query
def metric_report_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [HitRule("event_name", "exact", "load_complete")]
    return hits.metric_report(
        view(spark, sf_dir, "hits"), ["host_name", "section_s2"], "eventCount", "2024-01-05", "2024-01-20", rules
    )


@query
def metric_report_pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits.metric_report(view(spark, sf_dir, "hits"), ["page_path"], "pageviews", "2024-01-01", "2024-01-31")


@query
def metric_report_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits.metric_report(view(spark, sf_dir, "hits"), [], "sessions", "2024-01-05", "2024-01-20")


@query
def normalise_page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "hits").select("hit_id", F.col("page_path").alias("url"))
    return normalise_page_path(rows, "url", CONFIG.languages)


@query
def package_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits.package_hits(view(spark, sf_dir, "hits"), CONFIG, AS_OF)


@query
def package_hits_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits.package_hits(view(spark, sf_dir, "hits"), CONFIG, AS_OF, hits.LEGACY)


@query
def resource_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits.resource_hits(view(spark, sf_dir, "hits"), CONFIG, AS_OF)


@query
def resource_hits_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hits.resource_hits(view(spark, sf_dir, "hits"), CONFIG, AS_OF, hits.LEGACY)


@query
def section_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = visits.historic_visits(spark)
    return visits.section_visits(
        view(spark, sf_dir, "hits"), CONFIG.current_sections, AS_OF, hits.CURRENT, history=history
    )


@query
def section_visits_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.section_visits(view(spark, sf_dir, "hits"), CONFIG.legacy_sections, AS_OF, hits.LEGACY)


FILTERED_RULES = (
    SectionRule("all", "", None, "", "sessions", (".*/",)),
    SectionRule("section", "datos", "section_s2", "datasets|conjuntos de datos", "eventCount", (".*/", "/catalogo/.*")),
    SectionRule("section", "inicio", "section_s1", "inicio", "eventCount"),
    SectionRule("section", "visitas-turismo", "section_s3", "turismo", "sessions"),
)


@query
def section_visits_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with excluded paths, and one extra rule that holds for all of them."""
    rule = HitRule("host_name", "ends_with", ".ORG", negate=True)
    return visits.section_visits(view(spark, sf_dir, "hits"), FILTERED_RULES, AS_OF, extra_rule=rule)


# --- identities ----------------------------------------------------------------------------------------------


def _resolved_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tables(spark, sf_dir, "page_hits", "package", "package_extra", "group")
    return identity.resolve_package(t["page_hits"], t["package"], t["package_extra"], t["group"], CONFIG)


def _resolved_resources(spark: SparkSession, sf_dir: str, months: Column | None = None) -> DataFrame:
    t = tables(spark, sf_dir, "file_hits", "package", "resource", "package_extra", "group")
    # Months are chosen before the hits meet the files; afterwards it would be too late to leave out other months.
    file_hits = t["file_hits"] if months is None else t["file_hits"].where(months)
    return identity.resolve_resource(file_hits, t["package"], t["resource"], t["package_extra"], t["group"], CONFIG)


@query
def resolve_package(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved_packages(spark, sf_dir)


@query
def backfill_package(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.backfill_package(_staging(spark).save(_resolved_packages(spark, sf_dir)), view(spark, sf_dir, "packages_fact"))


@query
def resolve_resource(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved_resources(spark, sf_dir)


@query
def backfill_resource(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.backfill_resource(_staging(spark).save(_resolved_resources(spark, sf_dir)), view(spark, sf_dir, "resources_fact"))


@query
def backfill_package_from_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill from a table of the newest identities, kept up to date with the month that was replaced last."""
    fact = view(spark, sf_dir, "packages_fact")
    known = identity.package_identities(fact.where(F.col("year_month") != REPLACED_MONTH))
    known = identity.package_identities_changed(_staging(spark).save(known), fact, REPLACED_MONTH)
    return identity.backfill_package_known(_staging(spark).save(_resolved_packages(spark, sf_dir)), known)


@query
def backfill_resource_from_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = view(spark, sf_dir, "resources_fact")
    known = identity.resource_identities(fact.where(F.col("year_month") != REPLACED_MONTH))
    known = identity.resource_identities_changed(_staging(spark).save(known), fact, REPLACED_MONTH)
    return identity.backfill_resource_known(_staging(spark).save(_resolved_resources(spark, sf_dir)), known)


# --- fact tables ---------------------------------------------------------------------------------------------


def _replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = view(spark, sf_dir, "packages_fact")
    page_hits = view(spark, sf_dir, "page_hits").where(F.col("year_month") == REPLACED_MONTH)
    t = tables(spark, sf_dir, "package", "package_extra", "group")
    resolved = identity.resolve_package(page_hits, t["package"], t["package_extra"], t["group"], CONFIG)
    new_rows = identity.backfill_package(_staging(spark).save(resolved), fact, REPLACED_MONTH)
    return facts.replace_period(fact, new_rows, REPLACED_MONTH)


@query
def replace_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced(spark, sf_dir)


@query
def replace_period_by_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = view(spark, sf_dir, "visits_fact")
    return facts.replace_period(fact, fact.where(F.col("sessions") < 0), REPLACED_MONTH)


@query
def package_all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.package_all_time(view(spark, sf_dir, "packages_fact"))


@query
def resource_all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.resource_all_time(view(spark, sf_dir, "resources_fact"))


@query
def replace_period_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month replaced in stored tables: written beside the table and swapped in, twice as after a crash."""
    store, fact = _store(spark), view(spark, sf_dir, "packages_fact")
    fact.hint("rebalance", "year_month").write.mode("append").partitionBy("year_month").parquet(store.path("packages_fact"))
    stored = store.read(spark, "packages_fact")
    resolved = _resolved_packages(spark, sf_dir).where(F.col("year_month") == REPLACED_MONTH)
    rows = identity.backfill_package(_staging(spark).save(resolved), stored, REPLACED_MONTH)
    for _ in range(2):
        store.replace(spark, rows, "packages_fact", REPLACED_MONTH)
    return store.read(spark, "packages_fact")


def _replaced_month(fact: DataFrame, count: str) -> DataFrame:
    """Other rows for a month: some gone, some twice as many, some of datasets that the month did not have."""
    month = fact.where(F.col("year_month") == REPLACED_MONTH).where(F.length("url") % 3 != 0)
    other = fact.where((F.col("year_month") == "1997-07") & (F.length("url") % 2 == 0)).withColumn("year_month", F.lit(REPLACED_MONTH))
    return month.withColumn(count, F.col(count) * 2).unionByName(other)


@query
def package_all_time_by_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-time rows after a month was replaced, where only the datasets of the month are added up again.

    The fact table is stored, as in a load: it is read for the totals before, the month before and now, and the totals now.
    """
    staging = _staging(spark)
    fact = staging.save(view(spark, sf_dir, "packages_fact"))
    before, rows = staging.save(facts.package_all_time(fact)), staging.save(_replaced_month(fact, "pageviews"))
    old = facts.package_parts(fact.where(F.col("year_month") == REPLACED_MONTH))
    now = facts.replace_period(fact, rows, REPLACED_MONTH)
    return facts.package_all_time_changed(before, old, facts.package_parts(rows), now)


@query
def resource_all_time_by_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = _staging(spark)
    fact = staging.save(view(spark, sf_dir, "resources_fact"))
    before, rows = staging.save(facts.resource_all_time(fact)), staging.save(_replaced_month(fact, "total_events"))
    old = facts.resource_parts(fact.where(F.col("year_month") == REPLACED_MONTH))
    now = facts.replace_period(fact, rows, REPLACED_MONTH)
    return facts.resource_all_time_changed(before, old, facts.resource_parts(rows), now)


@query
def monthly_load_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits to dataset fact rows and their all-time rows, in one go.

    The new month is stored, as the load itself does: it is read for the table and again for the totals.
    """
    staging = _staging(spark)
    t = tables(spark, sf_dir, "hits", "package", "package_extra", "group", "packages_fact")
    rows = staging.save(monthly_load.package_rows(t["hits"], t, t["packages_fact"], CONFIG, AS_OF, hits.CURRENT, staging=staging))
    fact = facts.replace_period(t["packages_fact"], rows, "2024-01")
    return facts.replace_period(fact, facts.package_all_time(fact), ALL_TIME)


@query
def monthly_load_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits to fact rows of files and their all-time rows, in one go.

    The fact table is stored, as in a load: it is read for earlier identities, for the table and for the totals.
    """
    staging = _staging(spark)
    t = tables(spark, sf_dir, "hits", "package", "resource", "package_extra", "group")
    stored = staging.save(view(spark, sf_dir, "resources_fact"))
    rows = staging.save(monthly_load.resource_rows(t["hits"], t, stored, CONFIG, AS_OF, hits.CURRENT, staging=staging))
    fact = facts.replace_period(stored, rows, "2024-01")
    return facts.replace_period(fact, facts.resource_all_time(fact), ALL_TIME)


@query
def monthly_load_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits to fact rows of sections, in the table of the other months."""
    fact = view(spark, sf_dir, "visits_fact")
    rows = monthly_load.visit_rows(spark, view(spark, sf_dir, "hits"), CONFIG, choose_period("latest", AS_OF), AS_OF)
    return facts.replace_period(fact, rows, "2024-01")


RANGE = ("1997-03", "1997-06")


@query
def load_month_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several months of dataset rows at once: what is lost sees what it would see if months were loaded in turn."""
    fact, months = view(spark, sf_dir, "packages_fact"), F.col("year_month").between(*RANGE)
    resolved = _staging(spark).save(_resolved_packages(spark, sf_dir).where(months))
    return fact.where(~months).unionByName(identity.backfill_package_range(resolved, fact, RANGE[0]))


@query
def load_month_range_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact, months = view(spark, sf_dir, "resources_fact"), F.col("year_month").between(*RANGE)
    resolved = _staging(spark).save(_resolved_resources(spark, sf_dir, months))
    return fact.where(~months).unionByName(identity.backfill_resource_range(resolved, fact, RANGE[0]))


# --- reports -------------------------------------------------------------------------------------------------


def _with_all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = view(spark, sf_dir, "packages_fact")
    return fact.unionByName(facts.package_all_time(fact))


def _report(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        needed = tables(spark, sf_dir, *[t for t in REPORTS[name].tables if t != "packages_fact"])
        if "packages_fact" in REPORTS[name].tables:
            needed["packages_fact"] = _with_all_time(spark, sf_dir)
        if name == "datasets_by_org_monthly":
            return admin.datasets_by_org_monthly(needed, ORG_AS_OF, FIRST_ORG_MONTH)
        return build_report(name, needed, AS_OF, CONFIG)

    return run


for _name in REPORTS:
    QUERIES[_name] = _report(_name)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["top_datasets_per_month"](spark, sf_dir)
