"""Portal tables derived from the given tables.

Each view is one text that both Spark SQL and DuckDB read, so both sides of a comparison start from the same rows.
A name in braces is a given table or another view. Every view covers all rows of the tables it reads; where a portal
lacks rows, as a publisher without a code, the row is there under a key or an id that nothing asks for.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from portalmeter import fixed_values as fixed

# Each supplier stands for an organisation; there are 20 parts and 15 customers to one.
PARTS_PER_SUPPLIER, CUSTOMERS_PER_SUPPLIER = 20, 15


def _text(expression: str) -> str:
    return f"cast({expression} as string)"


def _share(key: str, size: int) -> str:
    return f"cast(floor({key} / {size}) as bigint)"


def _month(ts: str) -> str:
    return f"make_date(year({ts}), month({ts}), 1)"


def _month_name(month: str) -> str:
    return f"substring(cast({month} as string), 1, 7)"


def _pick(expression: str, values: tuple[str, ...]) -> str:
    cases = " ".join(f"when {i} then '{value}'" for i, value in enumerate(values))
    return f"case {expression} % {len(values)} {cases} end"


# Address of a file as the catalogue has it, from a dataset and a file number.
FILE_URL = (
    "case when ln = 3 then concat('http://f.example.org/año/', cast(pk as string), '/3') "
    "when ln = 4 then concat('http://f.example.org/a b/', cast(pk as string), '/4') "
    "else concat('http://f.example.org/', cast(pk as string), '/', cast(ln as string)) end"
)
# How a hit tells it: 0 as it is, 1 with a slash, 2 encoded, 3 unknown, 4 in a wrong charset, 5 with a plus sign.
HIT_SPELLING = (
    "case when l_suppkey % 6 = 4 and l_linenumber <> 3 then 0 when l_suppkey % 6 = 5 and l_linenumber <> 4 then 0 "
    "else l_suppkey % 6 end"
)
HIT_FILE_URL = (
    "case spelling when 0 then file_url when 1 then concat(file_url, '/') "
    "when 2 then replace(replace(file_url, ':', '%3A'), '/', '%2F') "
    "when 3 then concat(file_url, '/gone') "
    "when 4 then replace(file_url, 'ñ', 'Ã±') "
    "else replace(file_url, ' ', '+') end"
)
# Page of the dataset: by name, by id, or of a dataset the catalogue does not have.
FILE_PAGE = (
    "case when pk % 17 = 0 then concat('/catalogo/x-', cast(pk as string)) "
    "when pk % 5 = 0 then concat('/catalogo/', cast(pk as string)) "
    "else concat('/catalogo/p-', cast(pk as string)) end"
)
ORG_OF_LINE = f"case when l_partkey % 3 = 0 then {_share('l_partkey', PARTS_PER_SUPPLIER)} else l_suppkey end"

VIEWS: dict[str, str] = {}

# --- catalogue -----------------------------------------------------------------------------------------------

VIEWS["package"] = f"""
select {_text('p_partkey')} id, concat('p-', {_text('p_partkey')}) name,
  case when p_partkey % 23 = 0 then null else p_name end title,
  case when p_partkey % 10 = 9 then 'harvest' else 'dataset' end type,
  case when p_partkey % 13 = 0 then 'deleted' else 'active' end state,
  p_partkey % 7 = 0 private,
  {_text(_share('p_partkey', PARTS_PER_SUPPLIER))} owner_org
from {{part}}"""

_SECTOR = _pick("p_size", ("turismo", "salud", "empleo", "deporte", "otra-cosa"))
VIEWS["package_extra"] = f"""
select {_text('p_partkey')} package_id, 'publisher' as key,
  case when p_partkey % 29 = 0 then concat('none-', {_text('p_partkey')})
       when p_partkey % 16 = 8 then concat('org-', {_text(_share('p_partkey', PARTS_PER_SUPPLIER))})
       else {_text(_share('(p_partkey - p_partkey % 3)', PARTS_PER_SUPPLIER))} end as value,
  case when p_partkey % 37 = 0 then 'deleted' else 'active' end state
from {{part}}
union all
select {_text('p_partkey')}, case when p_partkey % 3 <> 0 then 'guid' else 'note' end, concat('g', {_text('p_partkey')}), 'active' from {{part}}
union all
select {_text('p_partkey')}, 'theme',
  case when p_partkey % 31 = 0 then '["broken'
       else concat('["http://portal.example.org/kos/sector-publico/sector/', {_SECTOR},
                   '","http://portal.example.org/kos/', lower(p_type), '","http://x.example.org/', lower(p_brand), '"]')
  end, 'active'
from {{part}}"""

VIEWS["group"] = f"""
select {_text('s_suppkey')} id,
  case when s_suppkey % 37 = 0 then null
       when s_suppkey % 5 = 0 then concat('Org ', {_text('s_nationkey')}) else s_name end title,
  'organization' type, case when s_acctbal < 0 then 'deleted' else 'active' end state,
  concat('org-', {_text('s_suppkey')}) name
from {{supplier}}"""

VIEWS["group_extra"] = f"""
select {_text('s_suppkey')} group_id, case when s_suppkey % 11 <> 0 then '{fixed.ORG_CODE_KEY}' else 'note' end as key,
  concat(substring('AELGIPUX', s_nationkey % 8 + 1, 1), {_text('s_nationkey')}) as value,
  case when s_suppkey % 19 = 0 then 'deleted' else 'active' end state
from {{supplier}}"""

_FORMATS = tuple(list(fixed.FORMAT_LABELS)[:12]) + ("application/x-unknown",)
VIEWS["resource"] = f"""
select concat({_text('l_orderkey')}, '-', {_text('ln')}, '-', {_text('pk')}, '-', {_text('l_suppkey')}) id,
  {_text('pk')} package_id, {FILE_URL} url,
  {_pick('l_orderkey', _FORMATS)} format,
  case when ln = 7 then 'deleted' else 'active' end state,
  l_orderkey as position
from (select l_orderkey, l_suppkey, l_partkey pk, l_linenumber ln from {{lineitem}}) line"""

# --- fact tables ---------------------------------------------------------------------------------------------

VIEWS["packages_fact"] = f"""
select {_month_name('m')} year_month, end_day, pageviews,
  concat('/catalogo/p-', {_text('pk')}, '-', {_text('org')}) url,
  case when pk % 41 = 7 then '' else concat('p-', {_text('pk')}) end package_name,
  case when pk % 41 = 7 or (pk % 19 = 5 and org % 4 = 0) then null else {_text('org')} end organization_id,
  case when pk % 41 = 7 or (pk % 19 = 5 and org % 4 = 0) then null else {_text('org')} end publisher_id
from (select m, pk, org, cast(max(d) as int) end_day, cast(sum(q) as bigint) pageviews
      from (select {_month('l_shipdate')} m, l_partkey pk, {ORG_OF_LINE} org, day(l_shipdate) d,
              cast(l_quantity as bigint) q
            from {{lineitem}}) line
      group by m, pk, org) monthly"""

VIEWS["resources_fact"] = f"""
select {_month_name('m')} year_month, end_day, total_events, {FILE_URL} url,
  case when is_known then {_pick('format_no', _FORMATS)} else null end format, {FILE_PAGE} package_url,
  case when is_known then concat('r-', {_text('pk')}, '-', {_text('ln')}) else '' end resource_id,
  case when is_known then concat('p-', {_text('pk')}) else null end package_name,
  case when is_known then {_text('org')} else null end organization_id,
  case when is_known then {_text('org')} else null end publisher_id
from (select m, pk, ln, ln <> 6 and not (pk % 19 = 5 and month(m) % 2 = 0) is_known,
        cast(max(d) as int) end_day, cast(sum(q) as bigint) total_events, max(format_no) format_no, max(org) org
      from (select {_month('l_shipdate')} m, l_partkey pk, l_linenumber ln, {ORG_OF_LINE} org, day(l_shipdate) d,
              cast(l_quantity as bigint) q, l_orderkey % {len(_FORMATS)} format_no
            from {{lineitem}}) line
      group by m, pk, ln) monthly"""

_SECTIONS = fixed.CONTENT_SECTIONS + fixed.SECTOR_SECTIONS + ("catalogo", "dashboard")
VIEWS["visits_fact"] = f"""
select {_month_name('m')} year_month, cast(max(d) as int) end_day, count(*) sessions, 'section' as key, key_value
from (select {_month('o_orderdate')} m, day(o_orderdate) d, {_pick('o_custkey', _SECTIONS)} key_value
      from {{orders}}) hit
group by m, key_value
union all
select {_month_name('m')}, cast(max(d) as int), count(*), 'all', ''
from (select {_month('o_orderdate')} m, day(o_orderdate) d from {{orders}}) hit
group by m"""

# --- page hits -----------------------------------------------------------------------------------------------

_PATH = "split_part(url, '/', 3), '/', split_part(url, '/', 4), '/catalogo/p-', split_part(url, '/', 5)"
_SLASH = "case when url like '%/' then '/' else '' end"
VIEWS["hits"] = f"""
select event_id hit_id, ts,
  concat({_text('user_id')}, '-', {_text('day(ts)')}) session_id,
  split_part(url, '/', 3) host_name,
  case event_id % 4
    when 0 then concat('/', {_PATH}, {_SLASH})
    when 1 then concat('/', split_part(url, '/', 4), '/catalogo/p-', split_part(url, '/', 5), {_SLASH})
    when 2 then concat('/catalogo/p-', split_part(url, '/', 5), {_SLASH})
    else concat(split_part(url, '/', 1), '//', {_PATH}, {_SLASH}) end page_path,
  case when event_id % 11 = 0 then 'scroll' when event_id % 13 = 0 then 'LOAD_COMPLETE' else 'load_complete' end event_name,
  case when event_type in ('click', 'purchase') then 'Resource' when event_type = 'error' then 'Error' else null end event_category,
  case when event_type = 'click' then 'Download' when event_type = 'purchase' then 'View' else null end event_action,
  case when event_type in ('click', 'purchase')
       then concat('http%3A%2F%2Ff.example.org%2F', {_text('page_id')}, '+', {_text('user_id % 7')}, '%zz%') else null end event_label,
  {_pick('user_id', ('accesibilidad', 'Aviso Legal', 'inicio'))} section_s1,
  {_pick('user_id', ('datasets', 'Conjuntos de Datos', 'noticias', 'blog', 'otra', 'mapa d´iniciatives', 'comerç'))} section_s2,
  case event_id % 6 when 0 then 'turismo' when 1 then '(not set)' when 2 then '' when 3 then null
    when 4 then 'Comerç' else 'health & wellness' end section_s3
from (select event_id, ts, user_id, event_type, event_id % (select count(*) from {{pages}}) page_no from {{events}}) e
join {{pages}} on page_id = page_no"""

VIEWS["page_hits"] = f"""
select {_month_name('m')} year_month, end_day,
  case kind when 0 then concat('/catalogo/p-', {_text('pk')})
    when 1 then concat('/catalogo/', {_text('pk')}, '/')
    when 2 then concat('/catalogo/p-', {_text('pk')}, '-', {_text('org')})
    else concat('/catalogo/gone-', {_text('pk')}) end url,
  pageviews
from (select m, pk, kind, org, cast(max(d) as int) end_day, cast(sum(q) as bigint) pageviews
      from (select {_month('l_shipdate')} m, day(l_shipdate) d, cast(l_quantity as bigint) q, l_partkey pk,
              l_orderkey % 4 kind, case when l_orderkey % 4 = 2 then l_suppkey else -1 end org
            from {{lineitem}}) line
      group by m, pk, kind, org) hit"""

VIEWS["file_hits"] = f"""
select {_month_name('m')} year_month, end_day, {HIT_FILE_URL} url, {FILE_PAGE} package_url, total_events
from (select m, pk, spelling, end_day, total_events, {FILE_URL} file_url
      from (select m, pk, ln, spelling, cast(max(d) as int) end_day, cast(sum(q) as bigint) total_events
            from (select {_month('l_shipdate')} m, day(l_shipdate) d, cast(l_quantity as bigint) q, l_partkey pk,
                    l_linenumber ln, {HIT_SPELLING} spelling
                  from {{lineitem}}) line
            group by m, pk, ln, spelling) monthly) hit"""

# --- dashboard tables ----------------------------------------------------------------------------------------

VIEWS["published_datasets"] = f"""
select {_month_name('m')} year_month, 'total' as key, '' key_value, count(*) num_datasets
from (select {_month('o_orderdate')} m from {{orders}}) o group by m
union all
select {_month_name('m')}, 'administration_level', case when letter = 'U' and month(m) = 2 then 'Z' else letter end, count(*)
from (select {_month('o_orderdate')} m, substring('AELGIPUX', cast(o_custkey % 8 as int) + 1, 1) letter from {{orders}}) o
group by m, letter
union all
select {_month_name('m')}, 'organization_id', {_text('org')}, count(*)
from (select {_month('o_orderdate')} m, {_share('o_custkey', CUSTOMERS_PER_SUPPLIER)} + 1 org from {{orders}}) o group by m, org
union all
select {_month_name('m')}, 'num_resources', {_text('n')}, count(*)
from (select {_month('o_orderdate')} m, o_custkey % 12 n from {{orders}}) o group by m, n"""

VIEWS["content_counts"] = f"""
select {_month_name('m')} year_month, key, content_type, count(*) num_contents
from (select m, key, case when content_type = 'success' and month(m) = 3 or content_type = 'dataset_comments' and month(m) = 4
        then 'other' else content_type end content_type
      from (select {_month('o_orderdate')} m,
        case when o_orderstatus = 'P' then 'status' else 'total' end as key,
        case substring(o_orderpriority, 1, 1) when '1' then 'app' when '2' then 'initiative' when '3' then 'request'
          when '4' then 'success' else case when o_custkey % 2 = 0 then 'content_comments' else 'dataset_comments' end
        end content_type
      from {{orders}}) o) counted
group by m, key, content_type"""

VIEWS["publisher_counts"] = f"""
select {_month_name('m')} year_month,
  count(distinct case when l_returnflag = 'A' then l_suppkey end) harvester_publishers,
  count(distinct case when l_returnflag = 'R' then l_suppkey end) manual_loading_publishers,
  count(distinct case when l_returnflag = 'N' then l_suppkey end) as both
from (select {_month('l_shipdate')} m, l_returnflag, l_suppkey from {{lineitem}}) line
group by m"""

# --- content site --------------------------------------------------------------------------------------------

_TYPES = tuple(fixed.CONTENT_TYPE_LABELS) + ("banner",)
VIEWS["node"] = f"select {_pick('doc_id', _TYPES[:-2] + ('banner',))} type from {{documents}}"

VIEWS["node_field_data"] = f"""
select doc_id nid, {_pick('doc_id', _TYPES)} type, md5(text) title, lang langcode,
  case when n_chars % 5 = 0 then 0 else 1 end status
from {{documents}}"""

VIEWS["node__field_estado"] = f"""
select case when doc_id % 9 = 0 then -1 - doc_id else doc_id end entity_id, n_chars % 10 field_estado_target_id from {{documents}}"""

VIEWS["taxonomy_term_field_data"] = f"""
select s_suppkey tid, concat('Estado ', {_text('s_nationkey')}) as name, 'es' langcode from {{supplier}}
union all
select case when s_suppkey % 3 = 0 then s_suppkey else -1 - s_suppkey end, concat('State ', {_text('s_nationkey')}), 'en' from {{supplier}}"""

VIEWS["users_field_data"] = """
select c_custkey uid, case when c_acctbal > 0 then 1 else 0 end status from {customer}"""

VIEWS["user__field_organizacion"] = f"""
select c_custkey entity_id, {_share('c_custkey', CUSTOMERS_PER_SUPPLIER)} field_organizacion_target_id from {{customer}}
union all
select case when c_custkey % 10 = 0 then c_custkey else -1 - c_custkey end, c_nationkey from {{customer}}"""

VIEWS["taxonomy_term__field_ckan_organization_name"] = """
select case when s_suppkey % 6 = 0 then -1 - s_suppkey else s_suppkey end entity_id from {supplier}
union all
select case when s_suppkey % 4 = 0 then s_suppkey else -1 - s_suppkey end from {supplier}"""

VIEWS["taxonomy_term__field_c_id_ud_organica"] = f"""
select case when s_suppkey % 8 = 0 then -1 - s_suppkey else s_suppkey end entity_id,
  case when s_suppkey % 13 = 0 then null
       else concat(substring('AELGIPUX', s_nationkey % 8 + 1, 1), {_text('s_nationkey')}) end field_c_id_ud_organica_value
from {{supplier}}"""

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _needs(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a derived one, as a DataFrame."""
    if name in GIVEN:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(VIEWS[name], **{need: view(spark, sf_dir, need) for need in _needs(VIEWS[name])})


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: view(spark, sf_dir, name) for name in names}


def common_table_expressions(*names: str) -> str:
    """The views as the ``with`` part of a DuckDB query, under names that start with ``sx_``."""
    parts = [f"sx_{name} as ({VIEWS[name].format_map({need: need for need in _needs(VIEWS[name])})})" for name in names]
    return "with " + ",\n".join(parts)
