"""Reports of the administration dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalmeter import fixed_values as fixed
from portalmeter.config import PortalConfig
from portalmeter.functions.labels import label_of, level_label, place_of
from portalmeter.functions.periods import as_date, month_range, month_title
from portalmeter.plans.public_reports import Day, Tables, day_text, published, sums_by_value

FIRST_ORGANISATION_MONTH = "2016-11"

MANUAL = "manual"
HARVESTED = "federacion"
BOTH = "ambas"


def datasets_evolution_by_admin_level(tables: Tables, as_of: Day = None) -> DataFrame:
    """Published datasets per month, a column per administration level."""
    letters = {"A": ["A"], "E": ["E"], "L": ["L"], "U": ["U"], "I": ["I", "G", "X"], "P": ["P"]}
    rows = tables["published_datasets"].where(F.col("key") == "administration_level")
    # A month with unknown letters only still has its row.
    months = rows.groupBy(F.col("year_month").alias("year"))
    sums = [
        F.sum(F.when(F.col("key_value").isin(*members), F.col("num_datasets"))).cast("bigint").alias(name)
        for name, members in letters.items()
    ]
    return months.agg(*sums).orderBy("year")


def datasets_by_org_monthly(
    tables: Tables, as_of: Day = None, first_month: str = FIRST_ORGANISATION_MONTH
) -> DataFrame:
    """Published datasets per organisation title, a column per month up to the last complete one.

    The list of months is known beforehand, so the pivot needs no look at the data to find its columns.
    """
    months = month_range(first_month, as_of)
    counts = (
        tables["published_datasets"]
        .where(F.col("key") == "organization_id")
        .groupBy("key_value", "year_month")
        .agg(F.sum("num_datasets").alias("n"))
    )
    groups = tables["group"].select("id", F.col("title").alias(fixed.COL_ORGANISATION))
    return (
        counts.join(groups, F.col("key_value") == F.col("id"))
        .groupBy(fixed.COL_ORGANISATION)
        .pivot("year_month", months)
        .agg(F.sum("n").cast("bigint"))
        .orderBy(F.col(fixed.COL_ORGANISATION).asc_nulls_last())
    )


def distributions_histogram(tables: Tables, as_of: Day = None, cfg: PortalConfig = PortalConfig()) -> DataFrame:
    """Datasets by number of files, per month; sorted as text."""
    return (
        tables["published_datasets"]
        .where(F.col("key") == "num_resources")
        .orderBy("key_value", "year_month")
        .select(
            month_title(F.col("year_month"), cfg.month_names).alias(fixed.COL_MONTH),
            F.col("key_value").alias(fixed.COL_FILES_PER_DATASET),
            F.col("num_datasets").alias(fixed.COL_DATASET_COUNT),
        )
    )


def dataset_visits_detail(tables: Tables, as_of: Day = None) -> DataFrame:
    """Views of every dataset in every month and of all time, in no order.

    A dataset appears once per theme value it has. That is settled on the catalogue's side, before the views join.
    """
    themes = tables["package_extra"].where(F.col("key") == "theme").select("package_id")
    datasets = (
        tables["package"]
        .where(~F.col("private"))
        .join(themes, F.col("id") == F.col("package_id"), "left")
        .select("name", F.col("title").alias("conjunto_datos"))
    )
    publishers = tables["group"].select(F.col("id").alias("group_id"), F.col("title").alias("publicador"))
    return (
        tables["packages_fact"]
        .where(F.col("organization_id").isNotNull() & F.col("publisher_id").isNotNull())
        .join(publishers, F.col("publisher_id") == F.col("group_id"))
        .join(datasets, F.col("package_name") == F.col("name"))
        .select(
            F.col("year_month").alias("fecha"), "conjunto_datos", "publicador", F.col("pageviews").alias("visitas")
        )
    )


def comments_received(tables: Tables, as_of: Day = None) -> DataFrame:
    """Comments per month, on contents and on datasets."""
    return sums_by_value(
        tables["content_counts"].where(F.col("key") == "total"),
        F.col("year_month").alias("year"),
        "content_type",
        {name: [name] for name in fixed.COMMENT_TYPES},
        "num_contents",
        0,
    ).orderBy("year")


def publishers_evolution(tables: Tables, as_of: Day = None) -> DataFrame:
    """Publishers per month by the way they publish."""
    return (
        tables["publisher_counts"]
        .select(F.col("year_month").alias("year"), "harvester_publishers", "manual_loading_publishers", "both")
        .orderBy("year")
    )


def publisher_modes(tables: Tables) -> DataFrame:
    """Each publisher of an active public dataset with its way of publishing: (pub, mode).

    A dataset counts as harvested if its owner has an active public harvest source and the dataset carries a
    guid. The three joins on the dataset share one partitioning, and only distinct combinations go on from there.
    """
    extras = tables["package_extra"].where(F.col("state") == "active")
    publishers = extras.where(F.col("key") == "publisher").select("package_id", F.col("value").alias("pub"))
    with_guid = extras.where(F.col("key") == "guid").select(F.col("package_id").alias("guid_package")).distinct()
    datasets = published(tables["package"]).select(F.col("id").alias("package_id"), "owner_org")
    combinations = (
        datasets.join(publishers, "package_id")
        .join(with_guid, F.col("package_id") == F.col("guid_package"), "left")
        .select("owner_org", "pub", F.col("guid_package").isNotNull().alias("guid"))
        .distinct()
    )
    harvesting = (
        tables["package"]
        .where((F.col("type") == "harvest") & (F.col("state") == "active") & ~F.col("private"))
        .select(F.col("owner_org").alias("harvesting_org"))
        .distinct()
    )
    is_harvested = F.col("harvesting_org").isNotNull() & F.col("guid")
    per_publisher = (
        combinations.join(harvesting, F.col("owner_org") == F.col("harvesting_org"), "left")
        .groupBy("pub")
        .agg(F.max(is_harvested).alias("harvested"), F.max(~is_harvested).alias("manual"))
    )
    mode = (
        F.when(F.col("harvested") & F.col("manual"), F.lit(BOTH))
        .when(F.col("manual"), F.lit(MANUAL))
        .otherwise(F.lit(HARVESTED))
    )
    return per_publisher.select("pub", mode.alias("mode"))


def organisation_levels(tables: Tables) -> DataFrame:
    """Active organisations with an active code, and the level it stands for."""
    groups = tables["group"].where((F.col("state") == "active") & (F.col("type") == "organization"))
    codes = tables["group_extra"].where((F.col("state") == "active") & (F.col("key") == fixed.ORG_CODE_KEY))
    return groups.join(codes, F.col("group_id") == F.col("id")).select(
        F.col("id").alias("level_pub"), level_label(F.col("value"), fixed.LEVEL_UNCLASSIFIED).alias("level")
    )


def publishers_by_level_and_mode(tables: Tables, as_of: Day = None) -> DataFrame:
    """Publishers per administration level, a column per way of publishing."""
    return (
        publisher_modes(tables)
        .join(organisation_levels(tables), F.col("pub") == F.col("level_pub"), "left")
        .groupBy("level")
        .agg(
            F.count_if(F.col("mode") == HARVESTED).alias("harvester_publishers"),
            F.count_if(F.col("mode") == MANUAL).alias("manual_loading_publishers"),
            F.count_if(F.col("mode") == BOTH).alias("both"),
        )
        .orderBy(place_of(F.col("level"), fixed.LEVEL_LABEL_ORDER), F.col("level").asc_nulls_last())
        .select(
            day_text(as_of).alias("date"),
            F.col("level").alias("category"),
            "harvester_publishers",
            "manual_loading_publishers",
            "both",
        )
    )


def publisher_update_mode(tables: Tables, as_of: Day = None) -> DataFrame:
    """Each publisher with its level and way of publishing, by title in byte order."""
    titles = tables["group"].select(F.col("id").alias("title_pub"), "title")
    return (
        publisher_modes(tables)
        .join(organisation_levels(tables), F.col("pub") == F.col("level_pub"), "left")
        .join(titles, F.col("pub") == F.col("title_pub"), "left")
        .orderBy(F.col("title").asc_nulls_last(), "pub")
        .select(
            day_text(as_of).alias(fixed.COL_UPDATED),
            F.col("title").alias(fixed.COL_ORGANISATION),
            F.col("level").alias(fixed.COL_LEVEL),
            F.col("mode").alias(fixed.COL_UPDATE_MODE),
        )
    )


def contents_by_type_admin(tables: Tables, as_of: Day = None, collation: str | None = None) -> DataFrame:
    """Different titles of published Spanish contents per node type.

    ``collation`` (for instance ``UNICODE_CI_AI``) makes titles that differ only in case or accents count once.
    """
    types = tables["node"].select("type").distinct()
    title = F.col("title") if collation is None else F.collate("title", collation)
    counts = (
        tables["node_field_data"]
        .where((F.col("status") == 1) & (F.col("langcode") == "es"))
        .join(types, "type", "left_semi")
        .groupBy("type")
        .agg(F.count_distinct(title).alias("n"))
    )
    in_order = place_of(F.col("type"), fixed.CONTENT_TYPE_LABELS)
    return counts.orderBy(in_order, "type").select(
        F.lit(as_date(as_of).strftime("%d/%m/%Y")).alias(fixed.COL_UPDATED),
        F.coalesce(label_of(F.col("type"), fixed.CONTENT_TYPE_LABELS), F.col("type")).alias(fixed.COL_CONTENT_TYPE),
        F.col("n").alias(fixed.COL_CONTENT_COUNT),
    )


def data_requests_by_state(tables: Tables, as_of: Day = None) -> DataFrame:
    """Published Spanish data requests per state.

    Requests are counted per state term before the terms' names join.
    """
    requests = tables["node_field_data"].where(
        (F.col("type") == "peticion_de_datos") & (F.col("langcode") == "es") & (F.col("status") == 1)
    )
    per_term = (
        requests.select("nid")
        .join(tables["node__field_estado"], F.col("nid") == F.col("entity_id"))
        .groupBy("field_estado_target_id")
        .agg(F.count("*").alias("n"))
    )
    terms = tables["taxonomy_term_field_data"].where(F.col("langcode") == "es").select("tid", "name")
    return (
        per_term.join(terms, F.col("field_estado_target_id") == F.col("tid"))
        .groupBy(F.col("name").alias("state"))
        .agg(F.sum("n").alias("value"))
        .orderBy("state")
        .select(day_text(as_of).alias("date"), "state", "value")
    )


def _users_per_organisation(tables: Tables) -> DataFrame:
    """Active users per organisation term: (target, n)."""
    active = tables["users_field_data"].where(F.col("status") == 1).select("uid")
    return (
        active.join(tables["user__field_organizacion"], F.col("uid") == F.col("entity_id"))
        .groupBy(F.col("field_organizacion_target_id").alias("target"))
        .agg(F.count("*").alias("n"))
    )


def users_by_org(tables: Tables, as_of: Day = None) -> DataFrame:
    """Active users per organisation name; a term that is named or listed twice counts its users twice.

    Users and listings are counted per term first; the product of the two counts is the number of joined rows.
    """
    listed = (
        tables["taxonomy_term__field_ckan_organization_name"]
        .groupBy(F.col("entity_id").alias("listed_target"))
        .agg(F.count("*").alias("listings"))
    )
    names = tables["taxonomy_term_field_data"].select("tid", "name")
    return (
        _users_per_organisation(tables)
        .join(listed, F.col("target") == F.col("listed_target"))
        .join(names, F.col("target") == F.col("tid"))
        .groupBy(F.col("name").alias(fixed.COL_ORGANISATION))
        .agg(F.sum(F.col("n") * F.col("listings")).alias(fixed.COL_USER_COUNT))
        .orderBy(fixed.COL_ORGANISATION)
        .select(day_text(as_of).alias(fixed.COL_UPDATED), fixed.COL_ORGANISATION, fixed.COL_USER_COUNT)
    )


def users_by_admin_level(tables: Tables, as_of: Day = None) -> DataFrame:
    """Active users per administration level, most first."""
    codes = tables["taxonomy_term__field_c_id_ud_organica"].select(
        F.col("entity_id").alias("code_target"),
        level_label(F.col("field_c_id_ud_organica_value"), fixed.LEVEL_UNKNOWN).alias("adm_level"),
    )
    return (
        _users_per_organisation(tables)
        .join(codes, F.col("target") == F.col("code_target"))
        .groupBy("adm_level")
        .agg(F.sum("n").alias("num_users"))
        .orderBy(F.desc("num_users"), "adm_level")
        .select(day_text(as_of).alias("date"), "adm_level", "num_users")
    )
