"""All reports by name, and writing them out."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from portalmeter.config import PortalConfig
from portalmeter.plans import admin_reports as admin
from portalmeter.plans import public_reports as public
from portalmeter.sinks.csv_report import csv_report_sink
from portalmeter.sources.tables import JdbcTables, ParquetTables, table_source


@dataclass(frozen=True)
class Report:
    """A report, the tables it reads, and whether its size is bounded by months, levels, labels or the like."""

    build: Callable[..., DataFrame]
    tables: tuple[str, ...]
    bounded: bool = True
    uses_config: bool = False


REPORTS: dict[str, Report] = {
    "datasets_evolution": Report(public.datasets_evolution, ("published_datasets",)),
    "datasets_by_admin_level": Report(
        public.datasets_by_admin_level, ("package", "package_extra", "group", "group_extra")
    ),
    "datasets_by_theme": Report(
        public.datasets_by_theme, ("package", "package_extra"), bounded=False, uses_config=True
    ),
    "datasets_by_format": Report(public.datasets_by_format, ("package", "resource"), bounded=False),
    "contents_by_type": Report(public.contents_by_type, ("content_counts",)),
    "visits_evolution": Report(public.visits_evolution, ("visits_fact",)),
    "catalogue_visits_evolution": Report(public.catalogue_visits_evolution, ("visits_fact",)),
    "content_section_visits": Report(public.content_section_visits, ("visits_fact",)),
    "sector_visits": Report(public.sector_visits, ("visits_fact",)),
    "top_datasets_per_month": Report(
        public.top_datasets_per_month, ("packages_fact", "package", "group"), uses_config=True
    ),
    "datasets_evolution_by_admin_level": Report(admin.datasets_evolution_by_admin_level, ("published_datasets",)),
    "datasets_by_org_monthly": Report(admin.datasets_by_org_monthly, ("published_datasets", "group"), bounded=False),
    "distributions_histogram": Report(
        admin.distributions_histogram, ("published_datasets",), bounded=False, uses_config=True
    ),
    "dataset_visits_detail": Report(
        admin.dataset_visits_detail, ("packages_fact", "package", "package_extra", "group"), bounded=False
    ),
    "comments_received": Report(admin.comments_received, ("content_counts",)),
    "publishers_evolution": Report(admin.publishers_evolution, ("publisher_counts",)),
    "publishers_by_level_and_mode": Report(
        admin.publishers_by_level_and_mode, ("package", "package_extra", "group", "group_extra")
    ),
    "publisher_update_mode": Report(
        admin.publisher_update_mode, ("package", "package_extra", "group", "group_extra"), bounded=False
    ),
    "contents_by_type_admin": Report(admin.contents_by_type_admin, ("node", "node_field_data")),
    "data_requests_by_state": Report(
        admin.data_requests_by_state, ("node_field_data", "node__field_estado", "taxonomy_term_field_data")
    ),
    "users_by_org": Report(
        admin.users_by_org,
        (
            "users_field_data",
            "user__field_organizacion",
            "taxonomy_term__field_ckan_organization_name",
            "taxonomy_term_field_data",
        ),
        bounded=False,
    ),
    "users_by_admin_level": Report(
        admin.users_by_admin_level,
        ("users_field_data", "user__field_organizacion", "taxonomy_term__field_c_id_ud_organica"),
    ),
}


def build_report(name: str, tables: public.Tables, as_of: public.Day, cfg: PortalConfig = PortalConfig()) -> DataFrame:
    report = REPORTS[name]
    build = partial(report.build, cfg=cfg) if report.uses_config else report.build
    return build(tables, as_of)


def write_reports(
    spark: SparkSession,
    source: ParquetTables | JdbcTables,
    out_root: str,
    as_of: public.Day,
    cfg: PortalConfig = PortalConfig(),
    names: Iterable[str] = tuple(REPORTS),
) -> list[str]:
    """Write reports as CSV; returns the folders written."""
    paths = []
    for name in names:
        report = REPORTS[name]
        tables = {table: table_source(spark, table, source) for table in report.tables}
        df = build_report(name, tables, as_of, cfg)
        paths.append(csv_report_sink(df, out_root, as_of, name, single_file=report.bounded))
    return paths
