"""Schemas of the stored tables and of the inputs, as Spark DDL."""

from __future__ import annotations

PACKAGES_FACT = (
    "year_month string not null, end_day int not null, pageviews bigint not null, url string not null, "
    "package_name string not null, organization_id string, publisher_id string"
)
RESOURCES_FACT = (
    "year_month string not null, end_day int not null, total_events bigint not null, url string not null, "
    "format string, package_url string not null, resource_id string not null, package_name string, "
    "organization_id string, publisher_id string"
)
VISITS_FACT = (
    "year_month string not null, end_day int not null, sessions bigint not null, key string not null, "
    "key_value string not null"
)

HITS = (
    "hit_id bigint, ts timestamp_ntz, session_id string, host_name string, page_path string, event_name string, "
    "event_category string, event_action string, event_label string, section_s1 string, section_s2 string, "
    "section_s3 string"
)

# Hits are stored by day, so that a load reads the days of its period only.
HITS_PARTITION = "day"

# What a load of stored reports could not use, and what became of the rest.
REJECTED_ROWS = "year_month string not null, report string not null, reason string not null, line string not null"
LOAD_TOTALS = (
    "year_month string not null, report string not null, lines bigint not null, used bigint not null, "
    "rejected bigint not null, read bigint not null, stored bigint not null, left_out bigint not null"
)
# Stored report rows of the two analytics feeds.
NESTED_REPORT_ROW = "dimensionValues array<struct<value:string>>, metricValues array<struct<value:string>>"
POSITIONAL_REPORT_ROW = "array<string>"

PACKAGE = "id string, name string, title string, type string, state string, private boolean, owner_org string"
PACKAGE_EXTRA = "package_id string, key string, value string, state string"
GROUP = "id string, title string, type string, state string, name string"
GROUP_EXTRA = "group_id string, key string, value string, state string"
RESOURCE = "id string, package_id string, url string, format string, state string, position bigint"

PUBLISHED_DATASETS = "year_month string, key string, key_value string, num_datasets bigint"
CONTENT_COUNTS = "year_month string, key string, content_type string, num_contents bigint"
PUBLISHER_COUNTS = (
    "year_month string, harvester_publishers bigint, manual_loading_publishers bigint, both bigint"
)

NODE = "type string"
NODE_FIELD_DATA = "nid bigint, type string, title string, langcode string, status int"
NODE_STATE = "entity_id bigint, field_estado_target_id bigint"
TERM_FIELD_DATA = "tid bigint, name string, langcode string"
USERS_FIELD_DATA = "uid bigint, status int"
USER_ORGANISATION = "entity_id bigint, field_organizacion_target_id bigint"
TERM_ORGANISATION_NAME = "entity_id bigint"
TERM_ORG_CODE = "entity_id bigint, field_c_id_ud_organica_value string"

ALL_TIME = "All"

# Table name -> schema, for readers of a folder of Parquet tables.
TABLES = {
    "packages_fact": PACKAGES_FACT,
    "resources_fact": RESOURCES_FACT,
    "visits_fact": VISITS_FACT,
    "rejected_rows": REJECTED_ROWS,
    "load_totals": LOAD_TOTALS,
    "hits": HITS,
    "package": PACKAGE,
    "package_extra": PACKAGE_EXTRA,
    "group": GROUP,
    "group_extra": GROUP_EXTRA,
    "resource": RESOURCE,
    "published_datasets": PUBLISHED_DATASETS,
    "content_counts": CONTENT_COUNTS,
    "publisher_counts": PUBLISHER_COUNTS,
    "node": NODE,
    "node_field_data": NODE_FIELD_DATA,
    "node__field_estado": NODE_STATE,
    "taxonomy_term_field_data": TERM_FIELD_DATA,
    "users_field_data": USERS_FIELD_DATA,
    "user__field_organizacion": USER_ORGANISATION,
    "taxonomy_term__field_ckan_organization_name": TERM_ORGANISATION_NAME,
    "taxonomy_term__field_c_id_ud_organica": TERM_ORG_CODE,
}
