"""DuckDB SQL for the registered queries, written from the meaning of each and apart from the Spark code.

The statements start from the same derived tables (``sx_...``).
"""

from __future__ import annotations

from portalmeter import fixed_values as fixed
from portalmeter.config import SectionRule
from portalmeter.functions.periods import month_range
from workload import queries as q
from workload.standins import common_table_expressions as ctes

ORACLE_SQL: dict[str, str] = {}

HOST = q.CONFIG.portal_host
LANGUAGES = q.CONFIG.languages
PAGE = "^(" + "|".join([""] + ["/" + language for language in LANGUAGES]) + ")/catalogo/([a-z0-9_-]+)/?$"
AS_OF_DAY = int(q.AS_OF[-2:])


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def case_of(expression: str, pairs: dict[str, str], otherwise: str | None = None) -> str:
    whens = " ".join(f"when {quoted(k)} then {quoted(v)}" for k, v in pairs.items())
    return f"case {expression} {whens} else {otherwise or 'null'} end"


def add(name: str, views: str, sql: str) -> None:
    """Register a statement; ``sql`` may go on with further common table expressions after a comma."""
    head = ctes(*views.split()) if views else "with nothing as (select 1)"
    ORACLE_SQL[name] = f"{head}{sql if sql.lstrip().startswith(',') else chr(10) + sql}"


# --- building blocks -----------------------------------------------------------------------------------------


def cleaned(source: str, url: str, out: str) -> str:
    """CTEs that clean ``url`` of ``source`` step by step; the last one is named ``out``."""
    parts = f"string_split({url}, '/')"
    steps = [
        f"{out}_0 as (select * replace (case when regexp_matches({url}, '^https?://[^/]+[.]') "
        f"then '/' || array_to_string({parts}[4:], '/') "
        f"when regexp_matches({url}, '^/[^/]+[.]') then '/' || array_to_string({parts}[3:], '/') "
        f"else {url} end as {url}), false as done from {source})"
    ]
    for i, language in enumerate(LANGUAGES):
        prefix = f"/{language}/"
        hit = f"(not done and starts_with({url}, {quoted(prefix)}))"
        rest = f"substr({url}, {len(prefix)})"
        steps.append(
            f"{out}_{i + 1} as (select * replace (case when {hit} and ends_with({rest}, '/') "
            f"then substr({rest}, 1, length({rest}) - 1) when {hit} then {rest} else {url} end as {url}, "
            f"done or ({hit} and ends_with({url}, '/')) as done) from {out}_{i})"
        )
    steps.append(f"{out} as (select * exclude (done) from {out}_{len(LANGUAGES)})")
    return ",\n".join(steps)


def end_day_of(month: str) -> str:
    """Last covered day of a month given as a date."""
    running = f"date_trunc('month', date '{q.AS_OF}')"
    return f"cast(case when {month} = {running} then {AS_OF_DAY} else day(last_day({month})) end as integer)"


def unquote(value: str) -> str:
    return f"url_decode(replace({value}, '+', ' '))"


def latin1_as_utf8(value: str) -> str:
    """NULL where a character is beyond Latin-1 or the bytes are no UTF-8."""
    codes = f"list_transform(string_split({value}, ''), lambda c: ord(c))"
    as_hex = f"array_to_string(list_transform({codes}, lambda n: lpad(hex(n), 2, '0')), '')"
    return f"case when list_max({codes}) <= 255 then try(decode(unhex({as_hex}))) end"


def month_name(year_month: str) -> str:
    names = ", ".join(quoted(n) for n in fixed.MONTH_NAMES)
    return f"list_extract([{names}], cast(substr({year_month}, 6, 2) as integer)) || ' ' || substr({year_month}, 1, 4)"


def level(letter: str, otherwise: str) -> str:
    return case_of(letter, fixed.LEVEL_LABELS, otherwise)


# --- sources and sinks ---------------------------------------------------------------------------------------

add(
    "flatten_report_rows_nested",
    "hits",
    "select page_path, event_name, count(*) as event_count from sx_hits group by all",
)
add("flatten_report_rows_positional", "hits", "select page_path, count(*) as pageviews from sx_hits group by all")
add("table_source_parquet", "", "select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders")

_CONTENT_SUMS = ", ".join(
    f"cast(sum(num_contents) filter (content_type = '{t}') as bigint) as {t}" for t in fixed.COUNTED_CONTENT_TYPES
)
_CONTENTS = (
    f"select year_month as date, {_CONTENT_SUMS} from sx_content_counts "
    "where content_type in ('app', 'initiative', 'request', 'success') group by 1"
)
_LINE = " || ',' || ".join(
    f"'\"' || coalesce(cast({c} as varchar), '') || '\"'" for c in ("date",) + fixed.COUNTED_CONTENT_TYPES
)
_HEADER = ",".join(f'"{c}"' for c in ("date",) + fixed.COUNTED_CONTENT_TYPES)
add(
    "csv_report_lines",
    "content_counts",
    f", report as ({_CONTENTS}) select {quoted(_HEADER)} as line union all select {_LINE} from report",
)

add(
    "csv_report_lines_parts",
    "packages_fact",
    """select '"year_month","url","package_name","pageviews"' as line
union all select '"' || year_month || '","' || url || '","' || package_name || '","' || pageviews || '"' from sx_packages_fact""",
)

# --- hits ----------------------------------------------------------------------------------------------------

_MONTH_OF_TS = "cast(date_trunc('month', ts) as date)"
add(
    "with_period_all",
    "",
    f"select event_id, strftime(ts, '%Y-%m') as year_month, {end_day_of(_MONTH_OF_TS)} as end_day from events",
)
add(
    "with_period_last_month",
    "",
    "select o_orderkey, '1998-12' as year_month, cast(31 as integer) as end_day from orders "
    "where year(o_orderdate) = 1998 and month(o_orderdate) = 12",
)
add(
    "cutover_union",
    "visits_fact",
    f"select year_month, key, key_value, sessions, 'legacy' as feed from sx_visits_fact where year_month <= '{q.CUTOVER_MONTH}' "
    f"union all select year_month, key, key_value, sessions * 2, 'current' from sx_visits_fact where year_month > '{q.CUTOVER_MONTH}'",
)
_PASSES = (
    "lower(event_name) = 'load_complete' and lower(section_s2) in ('datasets', 'conjuntos de datos', 'blog') "
    "and lower(coalesce(section_s3, '')) not in ('', 'not set', '(not set)')"
)
add(
    "hit_filter",
    "hits",
    f"select hit_id, host_name, page_path, section_s2 from sx_hits where {_PASSES} "
    "and (host_name like '%.example.com' or host_name like '%.example.org') "
    "and not ends_with(page_path, '.html') and lower(coalesce(event_category, '')) <> 'error'",
)
add(
    "metric_report_events",
    "hits",
    "select host_name, section_s2, count(*) as \"eventCount\" from sx_hits where lower(event_name) = 'load_complete' "
    "and cast(ts as date) between date '2024-01-05' and date '2024-01-20' group by 1, 2",
)
add(
    "metric_report_pageviews",
    "hits",
    "select page_path, count(*) as pageviews from sx_hits where event_category is null "
    "and cast(ts as date) between date '2024-01-01' and date '2024-01-31' group by 1",
)
add(
    "metric_report_sessions",
    "hits",
    "select count(distinct session_id) as sessions from sx_hits "
    "where cast(ts as date) between date '2024-01-05' and date '2024-01-20'",
)
add(
    "normalise_page_paths",
    "hits",
    f", raw as (select hit_id, page_path as url from sx_hits), {cleaned('raw', 'url', 'clean')} select hit_id, url from clean",
)


def _package_hits(passes: str) -> str:
    return (
        f", raw as (select {_MONTH_OF_TS} as m, page_path as url from sx_hits where {passes}), "
        f"{cleaned('raw', 'url', 'clean')} select strftime(m, '%Y-%m') as year_month, {end_day_of('m')} as end_day, url, "
        f"count(*) as pageviews from clean where regexp_matches(url, {quoted(PAGE)}) group by all"
    )


_IN_CATALOGUE = "lower(section_s2) in (" + ", ".join(quoted(p) for p in fixed.CATALOGUE_PHRASES.split("|")) + ")"
_THIRD_SECTION = "lower(coalesce(section_s3, '')) not in ('', 'not set', '(not set)')"
add(
    "package_hits",
    "hits",
    _package_hits(f"lower(event_name) = 'load_complete' and {_IN_CATALOGUE} and {_THIRD_SECTION}"),
)
add("package_hits_legacy", "hits", _package_hits(f"{_IN_CATALOGUE} and {_THIRD_SECTION} and event_category is null"))


def _event_pages(passes: str) -> str:
    return (
        f", raw as (select {_MONTH_OF_TS} as m, event_label, page_path as package_url from sx_hits "
        f"where {passes} and regexp_matches(page_path, {quoted(PAGE)}, 'i') "
        f"and not regexp_matches(page_path, {quoted(PAGE.replace('([a-z0-9_-]+)', 'new'))}, 'i')), "
        f"{cleaned('raw', 'package_url', 'clean')}"
    )


_EVENT_COUNTS = (
    f"select strftime(m, '%Y-%m') as year_month, {end_day_of('m')} as end_day, "
    f"{unquote('event_label')} as url, package_url, count(*) as total_events from clean "
    f"where regexp_matches(package_url, {quoted(PAGE)}) group by all"
)


def _resource_hits(passes: str) -> str:
    return f"{_event_pages(passes)} {_EVENT_COUNTS}"


add("resource_hits", "hits", _resource_hits("lower(event_category) = 'resource'"))
add("resource_hits_legacy", "hits", _resource_hits("lower(event_category) = 'resource' and lower(event_action) = 'download'"))


# Reports made of hits: lines of some lengths cannot be used.
_READ = "kind not in (0, 1, 2)"
_REPORT = f", counted as (select *, (n + length(page_path)) % 7 as kind from (select {_MONTH_OF_TS} as m, page_path, count(*) as n from sx_hits group by all))"
_VIEWS_READ = (
    _REPORT
    + f", raw as (select m, page_path as url, n from counted where {_READ}), {cleaned('raw', 'url', 'clean')} "
    + f"select strftime(m, '%Y-%m') as year_month, {end_day_of('m')} as end_day, url, cast(sum(n) as bigint) as pageviews "
    + f"from clean where regexp_matches(url, {quoted(PAGE)}) group by all"
)
_EVENTS_READ = (
    ", counted as (select *, (n + length(event_label) + length(page_path)) % 7 as kind from "
    f"(select {_MONTH_OF_TS} as m, coalesce(event_label, '') as event_label, page_path, count(*) as n from sx_hits group by all)), "
    f"raw as (select m, event_label, page_path as package_url, n from counted where {_READ}), {cleaned('raw', 'package_url', 'clean')} "
    f"select strftime(m, '%Y-%m') as year_month, {end_day_of('m')} as end_day, {unquote('event_label')} as url, package_url, "
    f"cast(sum(n) as bigint) as total_events from clean where regexp_matches(package_url, {quoted(PAGE)}) group by all"
)
for _layout in ("", "_positional"):
    add(f"package_views_from_report{_layout}", "hits", _VIEWS_READ)
    add(f"resource_events_from_report{_layout}", "hits", _EVENTS_READ)
add(
    "report_rows_rejected",
    "hits",
    _REPORT
    + " select strftime(m, '%Y-%m') as year_month, 'packages' as report, "
    + "case kind when 0 then 'unreadable' when 1 then 'not a number' else 'incomplete' end as reason, count(*) as lines "
    + "from counted where kind in (0, 1, 2) group by all",
)
add(
    "report_load_totals",
    "hits",
    _REPORT
    + f", raw as (select m, page_path as url, n, kind from counted), {cleaned('raw', 'url', 'clean')} "
    + f", marked as (select *, {_READ} as ok, regexp_matches(url, {quoted(PAGE)}) as is_page from clean) "
    + "select strftime(m, '%Y-%m') as year_month, 'packages' as report, count(*) as lines, count(*) filter (ok) as used, "
    + "count(*) filter (not ok) as rejected, cast(coalesce(sum(n) filter (ok), 0) as bigint) as \"read\", "
    + "cast(coalesce(sum(n) filter (ok and is_page), 0) as bigint) as stored, "
    + "cast(coalesce(sum(n) filter (ok and not is_page), 0) as bigint) as left_out from marked group by all",
)


def _visits(rules: tuple[SectionRule, ...], passes: str) -> str:
    phrases = ", ".join(
        f"({quoted(r.key)}, {quoted(r.name)}, {quoted(r.column)}, {quoted(p)})"
        for r in rules
        if r.pattern
        for p in sorted(set(r.pattern.split("|")))
    )
    return f"""
, phrase(key, key_value, col, text) as (values {phrases}),
months as (select distinct {_MONTH_OF_TS} as m from sx_hits),
sections as (
  select {_MONTH_OF_TS} as m, 'section_s1' as col, lower(section_s1) as text from sx_hits where {passes}
  union all select {_MONTH_OF_TS}, 'section_s2', lower(section_s2) from sx_hits where {passes}
  union all select {_MONTH_OF_TS}, 'section_s3', lower(section_s3) from sx_hits where {passes}),
counted as (
  select m, key, key_value, count(*) as sessions from sections join phrase using (col, text) group by all),
live as (
  select m, key, key_value, coalesce(sessions, 0) as sessions
  from (select distinct m, key, key_value from months, phrase) left join counted using (m, key, key_value)
  union all
  select {_MONTH_OF_TS}, 'all', '', count(distinct session_id) from sx_hits group by 1)
select strftime(m, '%Y-%m') as year_month, {end_day_of('m')} as end_day, cast(sessions as bigint) as sessions, key, key_value from live"""


_HISTORY = ", ".join(
    f"(date '{month}-01', cast({sessions} as bigint))" for month, sessions in fixed.HISTORIC_SESSIONS
)
add(
    "section_visits",
    "hits",
    _visits(q.CONFIG.current_sections, "lower(event_name) = 'load_complete'")
    + f" union all select strftime(m, '%Y-%m'), cast(day(last_day(m)) as integer), n, 'all', '' from (values {_HISTORY}) h(m, n)",
)
add("section_visits_from_report", "hits", _visits(q.CONFIG.legacy_sections, "event_category is null"))
_SLASHED, _IN_CATALOGUE_PATH = "page_path like '%/'", "lower(page_path) like '/catalogo/%'"
add(
    "section_visits_filtered",
    "hits",
    f"""
, kept as (select *, {_MONTH_OF_TS} as m, lower(event_name) = 'load_complete' as done from sx_hits where not ends_with(lower(host_name), '.org')),
live as (
  select m, 'all' as key, '' as key_value, count(distinct session_id) filter (not ({_SLASHED})) as sessions from kept group by 1
  union all
  select m, 'section', 'datos', count(*) filter (done and lower(section_s2) in ('datasets', 'conjuntos de datos') and not ({_SLASHED}) and not ({_IN_CATALOGUE_PATH})) from kept group by 1
  union all
  select m, 'section', 'inicio', count(*) filter (done and lower(section_s1) = 'inicio') from kept group by 1
  union all
  select m, 'section', 'visitas-turismo', count(distinct session_id) filter (done and lower(section_s3) = 'turismo') from kept group by 1)
select strftime(m, '%Y-%m') as year_month, {end_day_of('m')} as end_day, sessions, key, key_value from live""",
)
add("section_visits_legacy", "hits", _visits(q.CONFIG.legacy_sections, "event_category is null"))

# --- identities ----------------------------------------------------------------------------------------------

_CATALOGUE = """
, who as (
  select p.id, p.name, o.id as org, g.id as pub
  from sx_package p
  left join sx_group o on o.id = p.owner_org or (o.name = p.owner_org and not exists (select 1 from sx_group x where x.id = p.owner_org))
  left join sx_package_extra e on e.package_id = p.id and e.key = 'publisher'
  left join sx_group g on g.id = e.value or (g.name = e.value and not exists (select 1 from sx_group x where x.id = e.value)))"""
_CATALOGUE_VIEWS = "package package_extra group"
_REF = f"nullif(regexp_extract({{url}}, {quoted(PAGE)}, 2), '')"


def _resolved_packages(hits: str, out: str) -> str:
    ref = _REF.format(url="url")
    return f"""
, {out} as (
  select h.*, w.name as package_name, w.org as organization_id, w.pub as publisher_id
  from (select *, {ref} as ref from {hits}) h
  left join who w on w.id = h.ref or (w.name = h.ref and not exists (select 1 from who x where x.id = h.ref)))"""


def _backfilled_packages(resolved: str, fact: str, out: str, month: str = "-") -> str:
    return f"""
, {out}_past as (
  select url, package_name, organization_id, publisher_id
  from {fact}
  where year_month <> 'All' and year_month <> '{month}' and package_name <> '' and organization_id <> '' and publisher_id <> ''
  qualify row_number() over (partition by url order by year_month desc, package_name, organization_id, publisher_id) = 1)
, {out} as (
  select r.year_month, r.end_day, r.pageviews, r.url,
    coalesce(r.package_name, p.package_name, '') as package_name,
    case when r.package_name is null then p.organization_id else r.organization_id end as organization_id,
    case when r.package_name is null then p.publisher_id else r.publisher_id end as publisher_id
  from {resolved} r left join {out}_past p on p.url = r.url)"""


add(
    "resolve_package",
    f"page_hits {_CATALOGUE_VIEWS}",
    _CATALOGUE + _resolved_packages("sx_page_hits", "found") + " select * exclude (ref) from found",
)
add(
    "backfill_package",
    f"page_hits packages_fact {_CATALOGUE_VIEWS}",
    _CATALOGUE
    + _resolved_packages("sx_page_hits", "found")
    + _backfilled_packages("found", "sx_packages_fact", "filled")
    + " select * from filled",
)

_SHORT = "substr(url, 1, length(url) - 1)"
_SPELLINGS = ", ".join(
    [
        "url",
        unquote("url"),
        latin1_as_utf8("url"),
        latin1_as_utf8(unquote("url")),
    ]
    + [
        f"case when ends_with(url, '/') then {expression} end"
        for expression in (_SHORT, unquote(_SHORT), latin1_as_utf8(_SHORT), latin1_as_utf8(unquote(_SHORT)))
    ]
)

def _resolved_resources(hits: str) -> str:
    return f"""
, page as (
  select h.*, w.id as package_id, w.name as package_name, w.org as organization_id, w.pub as publisher_id
  from (select *, {_REF.format(url='package_url')} as ref from {hits}) h
  left join who w on w.id = h.ref or (w.name = h.ref and not exists (select 1 from who x where x.id = h.ref))),
spelled as (select distinct url, unnest([{_SPELLINGS}]) as spelling from (select distinct url from page)),
file as (
  select p.package_url, p.url, p.package_id, r.id as resource_id, r.format
  from (select distinct package_url, url, package_id from page) p
  join spelled s on s.url = p.url
  join sx_resource r on r.package_id = p.package_id and r.url = s.spelling and r.state <> 'deleted'
  qualify row_number() over (partition by p.package_url, p.url order by r.position, r.id) = 1),
found as (
  select p.year_month, p.end_day, p.url, p.package_url, p.total_events, f.resource_id, p.package_name,
    p.organization_id, p.publisher_id, f.format
  from page p left join file f on f.package_url = p.package_url and f.url = p.url)"""


def _backfilled_resources(resolved: str, fact: str, out: str, month: str = "-") -> str:
    return f"""
, {out}_past as (
  select url, package_url, resource_id, package_name, organization_id, publisher_id, format
  from {fact}
  where year_month <> 'All' and year_month <> '{month}' and resource_id is not null and package_name <> 'All'
    and organization_id <> '' and publisher_id <> '' and format <> ''
  qualify row_number() over (partition by url, package_url
    order by year_month desc, resource_id, package_name, organization_id, publisher_id, format) = 1)
, {out} as (
  select f.year_month, f.end_day, f.url, f.package_url, f.total_events,
    case when missing then coalesce(p.resource_id, '') else f.resource_id end as resource_id,
    case when missing then p.package_name else f.package_name end as package_name,
    case when missing then p.organization_id else f.organization_id end as organization_id,
    case when missing then p.publisher_id else f.publisher_id end as publisher_id,
    case when missing then p.format else f.format end as format
  from (select *, package_name is null or resource_id is null as missing from {resolved}) f
  left join {out}_past p on p.url = f.url and p.package_url = f.package_url)"""


add("resolve_resource", f"file_hits resource {_CATALOGUE_VIEWS}", _CATALOGUE + _resolved_resources("sx_file_hits") + " select * from found")
_BACKFILLED = _CATALOGUE + _resolved_resources("sx_file_hits") + _backfilled_resources("found", "sx_resources_fact", "filled") + " select * from filled"
add("backfill_resource", f"file_hits resource resources_fact {_CATALOGUE_VIEWS}", _BACKFILLED)
add("backfill_resource_from_identities", f"file_hits resource resources_fact {_CATALOGUE_VIEWS}", _BACKFILLED)
add("backfill_package_from_identities", f"page_hits packages_fact {_CATALOGUE_VIEWS}", _CATALOGUE + _resolved_packages("sx_page_hits", "found") + _backfilled_packages("found", "sx_packages_fact", "filled") + " select * from filled")

# --- fact tables ---------------------------------------------------------------------------------------------

add(
    "replace_period",
    f"page_hits packages_fact {_CATALOGUE_VIEWS}",
    _CATALOGUE
    + f", of_month as (select * from sx_page_hits where year_month = '{q.REPLACED_MONTH}')"
    + _resolved_packages("of_month", "found")
    + _backfilled_packages("found", "sx_packages_fact", "filled", q.REPLACED_MONTH)
    + f" select * from sx_packages_fact where year_month <> '{q.REPLACED_MONTH}' union all by name select * from filled",
)
ORACLE_SQL["replace_period_stored"] = ORACLE_SQL["replace_period"]
add("replace_period_by_nothing", "visits_fact", f"select * from sx_visits_fact where year_month <> '{q.REPLACED_MONTH}'")


def _packages_in_total(fact: str, out: str) -> str:
    return f"""
, {out}_sums as (
  select package_name, sum(pageviews) as pageviews, count(distinct (organization_id, publisher_id)) as pairs
  from {fact}
  where lower(year_month) <> 'all' and package_name <> '' and organization_id <> '' and publisher_id <> ''
  group by 1)
, {out}_single as (
  select distinct package_name, organization_id, publisher_id from {fact}
  where lower(year_month) <> 'all' and package_name <> '' and organization_id <> '' and publisher_id <> '')
, {out}_newest as (
  select package_name, organization_id, publisher_id from {fact} where lower(year_month) <> 'all'
  qualify row_number() over (partition by package_name order by year_month desc, url) = 1)
, {out} as (
  select 'All' as year_month, cast(0 as integer) as end_day, cast(s.pageviews as bigint) as pageviews, '' as url,
    s.package_name, l.organization_id, l.publisher_id
  from {out}_sums s join {out}_single l on l.package_name = s.package_name where s.pairs = 1
  union all
  select 'All', 0, cast(s.pageviews as bigint), '', s.package_name, l.organization_id, l.publisher_id
  from {out}_sums s join {out}_newest l on l.package_name = s.package_name where s.pairs > 1)"""


add("package_all_time", "packages_fact", _packages_in_total("sx_packages_fact", "totals") + " select * from totals")


def _resources_in_total(fact: str, out: str) -> str:
    key = "resource_id, package_name, url"
    return f"""
, {out}_known as (
  select * from {fact}
  where lower(year_month) <> 'all' and resource_id <> '' and package_name <> '' and organization_id <> '' and publisher_id <> '')
, {out}_sums as (
  select {key}, sum(total_events) as total_events, count(distinct (organization_id, publisher_id)) as pairs
  from {out}_known group by all)
, {out}_largest as (
  select {key}, organization_id, publisher_id, format
  from (select {key}, organization_id, publisher_id, format, sum(total_events) as n from {out}_known group by all)
  qualify row_number() over (partition by {key} order by n desc, format) = 1)
, {out}_newest as (
  select {key}, organization_id, publisher_id, format
  from {fact} where lower(year_month) <> 'all'
  qualify row_number() over (partition by {key} order by year_month desc, package_url) = 1)
, {out}_label as (
  select s.*, l.organization_id, l.publisher_id, l.format from {out}_sums s join {out}_largest l using ({key}) where pairs = 1
  union all
  select s.*, n.organization_id, n.publisher_id, n.format from {out}_sums s join {out}_newest n using ({key}) where pairs > 1)
, {out} as (
  select 'All' as year_month, cast(0 as integer) as end_day, cast(total_events as bigint) as total_events, url, format,
    '/catalogo/' || package_name as package_url, resource_id, package_name, organization_id, publisher_id
  from {out}_label)"""


add("resource_all_time", "resources_fact", _resources_in_total("sx_resources_fact", "totals") + " select * from totals")


def _month_replaced(fact: str, count: str) -> str:
    return f"""
, fact as (
  select * from {fact} where year_month <> '{q.REPLACED_MONTH}'
  union all by name
  select * replace ({count} * 2 as {count}) from {fact} where year_month = '{q.REPLACED_MONTH}' and length(url) % 3 <> 0
  union all by name
  select * replace ('{q.REPLACED_MONTH}' as year_month) from {fact} where year_month = '1997-07' and length(url) % 2 = 0)"""


add("package_all_time_by_change", "packages_fact", _month_replaced("sx_packages_fact", "pageviews") + _packages_in_total("fact", "totals") + " select * from totals")
add("resource_all_time_by_change", "resources_fact", _month_replaced("sx_resources_fact", "total_events") + _resources_in_total("fact", "totals") + " select * from totals")


def _months() -> list[str]:
    first, last = q.RANGE
    return [f"{first[:4]}-{m:02d}" for m in range(int(first[5:]), int(last[5:]) + 1)]


def _in_turn(columns: str, fact: str, backfilled) -> str:
    """Months loaded one after another: each sees the table that the one before it left."""
    steps, now = "", fact
    for i, month in enumerate(_months()):
        steps += f", of_{i} as (select * from found where year_month = '{month}')"
        steps += backfilled(f"of_{i}", now, f"filled_{i}", month)
        steps += f", fact_{i} as (select * from {now} where year_month <> '{month}' union all by name select {columns} from filled_{i})"
        now = f"fact_{i}"
    return steps + f" select * from {now}"


add(
    "load_month_range",
    f"page_hits packages_fact {_CATALOGUE_VIEWS}",
    _CATALOGUE + _resolved_packages("sx_page_hits", "found") + _in_turn("*", "sx_packages_fact", _backfilled_packages),
)
add(
    "load_month_range_resources",
    f"file_hits resource resources_fact {_CATALOGUE_VIEWS}",
    _CATALOGUE + _resolved_resources("sx_file_hits") + _in_turn("*", "sx_resources_fact", _backfilled_resources),
)
add(
    "monthly_load_resources",
    f"hits resource resources_fact {_CATALOGUE_VIEWS}",
    _CATALOGUE
    + _event_pages("lower(event_category) = 'resource'")
    + f", counted as ({_EVENT_COUNTS})"
    + _resolved_resources("counted")
    + _backfilled_resources("found", "sx_resources_fact", "filled")
    + ", fact as (select * from sx_resources_fact where year_month <> '2024-01' union all by name select * from filled)"
    + _resources_in_total("fact", "totals")
    + " select * from fact union all by name select * from totals",
)
add(
    "monthly_load_visits",
    "hits visits_fact",
    ", old as (select * from sx_visits_fact where year_month <> '2024-01')"
    + _visits(q.CONFIG.current_sections, "lower(event_name) = 'load_complete'")
    + " where strftime(m, '%Y-%m') = '2024-01' union all by name select * from old",
)
add(
    "monthly_load_packages",
    f"hits packages_fact {_CATALOGUE_VIEWS}",
    _CATALOGUE
    + ", raw as (select "
    + f"{_MONTH_OF_TS} as m, page_path as url from sx_hits where lower(event_name) = 'load_complete' and {_IN_CATALOGUE} and {_THIRD_SECTION}), "
    + cleaned("raw", "url", "clean")
    + f", counted as (select strftime(m, '%Y-%m') as year_month, {end_day_of('m')} as end_day, url, count(*) as pageviews "
    + f"from clean where regexp_matches(url, {quoted(PAGE)}) group by all)"
    + _resolved_packages("counted", "found")
    + _backfilled_packages("found", "sx_packages_fact", "filled")
    + ", fact as (select * from sx_packages_fact where year_month <> '2024-01' union all by name select * from filled)"
    + _packages_in_total("fact", "totals")
    + " select * from fact union all by name select * from totals",
)

# --- reports: public -----------------------------------------------------------------------------------------

add(
    "datasets_evolution",
    "published_datasets",
    "select year_month as year, num_datasets as value from sx_published_datasets where key = 'total'",
)
_PUBLIC = "p.type = 'dataset' and p.state = 'active' and not p.private"
_CODE = f"ge.key = '{fixed.ORG_CODE_KEY}'"
_BUCKETS = {**{code: label for code, label in fixed.LEVEL_LABELS.items() if code not in "GI"}, "G/I": fixed.LEVEL_LABELS["G"]}
add(
    "datasets_by_admin_level",
    "package package_extra group group_extra",
    f"""
, coded as (
  select g.id, case when ge.value[1] in ('G', 'I') then 'G/I' else ge.value[1] end as bucket
  from sx_group g, sx_group_extra ge where ge.group_id = g.id and {_CODE})
, titled as (
  select pe.value as publisher, p.title from sx_package p, sx_package_extra pe
  where pe.package_id = p.id and pe.key = 'publisher' and {_PUBLIC})
select '{q.AS_OF}' as date, {case_of('bucket', _BUCKETS)} as administration_level, count(title) as num_datasets
from titled left join coded on coded.id = titled.publisher group by bucket""",
)
_THEMES = {f"http://{HOST}{fixed.THEME_SECTOR_PATH}{k}": v for k, v in fixed.THEME_LABELS.items()}
add(
    "datasets_by_theme",
    "package package_extra",
    f"""select '{q.AS_OF}' as date, {case_of('uri', _THEMES, quoted(fixed.THEME_OTHER))} as theme, value
from (select uri, count(title) as value
      from (select p.title, unnest(cast(json(pe.value) as varchar[])) as uri
            from sx_package p join sx_package_extra pe on p.id = pe.package_id
            where {_PUBLIC} and pe.key = 'theme' and json_valid(pe.value)) t
      where uri like '%{HOST}/kos/%' group by uri) s""",
)
add(
    "datasets_by_format",
    "package resource",
    f"""select '{q.AS_OF}' as date, {case_of('r.format', fixed.FORMAT_LABELS, 'r.format')} as format, count(p.title) as value
from sx_package p join sx_resource r on r.package_id = p.id
where {_PUBLIC} and r.state = 'active' group by r.format""",
)
add("contents_by_type", "content_counts", _CONTENTS)
add("visits_evolution", "visits_fact", "select year_month as date, sessions as value from sx_visits_fact where key = 'all'")
add(
    "catalogue_visits_evolution",
    "visits_fact",
    "select year_month as date, sessions as catalogo from sx_visits_fact where key_value = 'catalogo'",
)


def _section_sums(names: tuple[str, ...]) -> str:
    sums = ", ".join(f'cast(sum(case when key_value = {quoted(n)} then sessions else 0 end) as bigint) as "{n}"' for n in names)
    listed = ", ".join(quoted(n) for n in names)
    return f"select year_month as date, {sums} from sx_visits_fact where key_value in ({listed}) group by 1"


add("content_section_visits", "visits_fact", _section_sums(fixed.CONTENT_SECTIONS))
add("sector_visits", "visits_fact", _section_sums(fixed.SECTOR_SECTIONS))
add(
    "top_datasets_per_month",
    "packages_fact package group",
    _packages_in_total("sx_packages_fact", "totals")
    + f""", fact as (select * from sx_packages_fact union all by name select * from totals)
select case when year_month = 'All' then '{fixed.ALL_TIME_LABEL}'
    when end_day in (30, 31) or (substr(year_month, 6, 2) = '02' and end_day in (28, 29)) then {month_name('year_month')}
    else {month_name('year_month')} || ' (hasta el ' || end_day || ')' end as "Mes",
  'https://{HOST}/{LANGUAGES[0]}/catalogo/' || name as "Url", dataset as "Conjunto de datos", publisher as "Publicador",
  pageviews as "Visitas"
from (select f.year_month, f.end_day, f.pageviews, p.name, p.title as dataset, g.title as publisher
      from fact f join sx_group g on g.id = f.publisher_id join sx_package p on p.name = f.package_name
      where not p.private
      qualify row_number() over (partition by f.year_month order by f.pageviews desc, p.name, f.url, g.title) <= 10) t""",
)

# --- reports: administration ---------------------------------------------------------------------------------

_LETTERS = {"A": "'A'", "E": "'E'", "L": "'L'", "U": "'U'", "I": "'I', 'G', 'X'", "P": "'P'"}
_LETTER_SUMS = ", ".join(
    f'cast(sum(case when key_value in ({members}) then num_datasets end) as bigint) as "{name}"'
    for name, members in _LETTERS.items()
)
add(
    "datasets_evolution_by_admin_level",
    "published_datasets",
    f"select year_month as year, {_LETTER_SUMS} from sx_published_datasets where key = 'administration_level' group by 1",
)
_MONTH_SUMS = ", ".join(
    f"cast(sum(num_datasets) filter (year_month = '{m}') as bigint) as \"{m}\""
    for m in month_range(q.FIRST_ORG_MONTH, q.ORG_AS_OF)
)
add(
    "datasets_by_org_monthly",
    "published_datasets group",
    f"select g.title as \"{fixed.COL_ORGANISATION}\", {_MONTH_SUMS} from sx_published_datasets d "
    "join sx_group g on d.key_value = g.id where d.key = 'organization_id' group by 1",
)
add(
    "distributions_histogram",
    "published_datasets",
    f"select {month_name('year_month')} as \"{fixed.COL_MONTH}\", key_value as \"{fixed.COL_FILES_PER_DATASET}\", "
    f"num_datasets as \"{fixed.COL_DATASET_COUNT}\" from sx_published_datasets where key = 'num_resources'",
)
add(
    "dataset_visits_detail",
    "packages_fact package package_extra group",
    _packages_in_total("sx_packages_fact", "totals")
    + """, fact as (select * from sx_packages_fact union all by name select * from totals)
select f.year_month as fecha, p.title as conjunto_datos, g.title as publicador, f.pageviews as visitas
from fact f join sx_package p on p.name = f.package_name join sx_group g on g.id = f.publisher_id
left join sx_package_extra e on e.package_id = p.id and e.key = 'theme'
where f.organization_id is not null and f.publisher_id is not null and not p.private""",
)
_COMMENT_SUMS = ", ".join(
    f"cast(sum(case when content_type = '{t}' then num_contents else 0 end) as bigint) as {t}" for t in fixed.COMMENT_TYPES
)
add(
    "comments_received",
    "content_counts",
    f"select year_month as year, {_COMMENT_SUMS} from sx_content_counts where key = 'total' "
    "and content_type in ('content_comments', 'dataset_comments') group by 1",
)
add(
    "publishers_evolution",
    "publisher_counts",
    "select year_month as year, harvester_publishers, manual_loading_publishers, \"both\" from sx_publisher_counts",
)
_MODES = f"""
, kinds as (
  select distinct pe.value as pub,
    exists (select 1 from sx_package_extra x where x.package_id = p.id and x.key = 'guid' and x.state = 'active')
    and p.owner_org in (select owner_org from sx_package where type = 'harvest' and state = 'active' and not private) as harvested
  from sx_package p join sx_package_extra pe on pe.package_id = p.id
  where {_PUBLIC} and pe.key = 'publisher' and pe.state = 'active')
, modes as (
  select pub, case when bool_or(harvested) and bool_or(not harvested) then 'ambas' when bool_or(harvested) then 'federacion'
    else 'manual' end as mode from kinds group by 1)
, levels as (
  select g.id as pub, {level('left(ge.value, 1)', quoted(fixed.LEVEL_UNCLASSIFIED))} as lvl
  from sx_group g join sx_group_extra ge on ge.group_id = g.id
  where g.state = 'active' and g.type = 'organization' and ge.state = 'active' and {_CODE})"""
add(
    "publishers_by_level_and_mode",
    "package package_extra group group_extra",
    _MODES
    + f""" select '{q.AS_OF}' as date, lvl as category, count(*) filter (mode = 'federacion') as harvester_publishers,
  count(*) filter (mode = 'manual') as manual_loading_publishers, count(*) filter (mode = 'ambas') as "both"
from modes left join levels using (pub) group by lvl""",
)
add(
    "publisher_update_mode",
    "package package_extra group group_extra",
    _MODES
    + f""" select '{q.AS_OF}' as "{fixed.COL_UPDATED}", g.title as "{fixed.COL_ORGANISATION}", lvl as "{fixed.COL_LEVEL}",
  mode as "{fixed.COL_UPDATE_MODE}"
from modes left join levels using (pub) left join sx_group g on g.id = modes.pub""",
)
_DAY_FIRST = "/".join(reversed(q.AS_OF.split("-")))
add(
    "contents_by_type_admin",
    "node node_field_data",
    f"""select '{_DAY_FIRST}' as "{fixed.COL_UPDATED}", {case_of('type', fixed.CONTENT_TYPE_LABELS, 'type')} as "{fixed.COL_CONTENT_TYPE}",
  count(distinct title) as "{fixed.COL_CONTENT_COUNT}"
from sx_node_field_data where status = 1 and langcode = 'es' and type in (select type from sx_node) group by type""",
)
add(
    "data_requests_by_state",
    "node_field_data node__field_estado taxonomy_term_field_data",
    f"""select '{q.AS_OF}' as date, d.name as state, count(*) as value
from sx_node_field_data n join sx_node__field_estado e on n.nid = e.entity_id
join sx_taxonomy_term_field_data d on d.tid = e.field_estado_target_id
where n.type = 'peticion_de_datos' and n.langcode = 'es' and n.status = 1 and d.langcode = 'es' group by d.name""",
)
add(
    "users_by_org",
    "users_field_data user__field_organizacion taxonomy_term__field_ckan_organization_name taxonomy_term_field_data",
    f"""select '{q.AS_OF}' as "{fixed.COL_UPDATED}", d.name as "{fixed.COL_ORGANISATION}", count(*) as "{fixed.COL_USER_COUNT}"
from sx_users_field_data u join sx_user__field_organizacion o on u.uid = o.entity_id
join sx_taxonomy_term__field_ckan_organization_name t on t.entity_id = o.field_organizacion_target_id
join sx_taxonomy_term_field_data d on d.tid = o.field_organizacion_target_id
where u.status = 1 group by d.name""",
)
add(
    "users_by_admin_level",
    "users_field_data user__field_organizacion taxonomy_term__field_c_id_ud_organica",
    f"""select '{q.AS_OF}' as date, {level('left(c.field_c_id_ud_organica_value, 1)', quoted(fixed.LEVEL_UNKNOWN))} as adm_level,
  count(u.uid) as num_users
from sx_users_field_data u join sx_user__field_organizacion o on u.uid = o.entity_id
join sx_taxonomy_term__field_c_id_ud_organica c on c.entity_id = o.field_organizacion_target_id
where u.status = 1 group by 2""",
)
