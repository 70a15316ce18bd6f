from __future__ import annotations

import datetime as dt
from dataclasses import replace

from helpers import rows_of, sorted_rows
from portalmeter.config import HitRule, PortalConfig, SectionRule
from portalmeter.operators import hits, visits

CFG = PortalConfig()
JANUARY = dt.datetime(2024, 1, 5, 12)


def hit(i, path="/catalogo/x", event="load_complete", category=None, action=None, label=None, session="s1",
        s1=None, s2="datasets", s3="topic", ts=JANUARY, host="portal.example.org"):
    return (i, ts, session, host, path, event, category, action, label, s1, s2, s3)


def test_cutover_union_takes_the_cutover_month_from_the_legacy_feed(spark):
    months = [("2023-05",), ("2023-06",), ("2023-07",)]
    legacy = spark.createDataFrame([(m, "legacy") for (m,) in months], "year_month string, feed string")
    current = spark.createDataFrame([(m, "current") for (m,) in months], "year_month string, feed string")
    got = sorted_rows(hits.cutover_union(legacy, current, "2023-06"))
    assert got == [("2023-05", "legacy"), ("2023-06", "legacy"), ("2023-07", "current")]


def ids(df):
    return sorted(r["hit_id"] for r in df.collect())


def test_hit_filter_rules(table):
    df = table("hits", [hit(1), hit(2, event="LOAD_COMPLETE"), hit(3, event=None), hit(4, s2="Datasets list")])
    exact = HitRule("event_name", "exact", "Load_Complete")
    assert ids(hits.hit_filter(df, [exact])) == [1, 2, 4]
    whole = HitRule("section_s2", "full_regex", "datasets|other")
    assert ids(hits.hit_filter(df, [whole])) == [1, 2, 3]
    assert ids(hits.hit_filter(df, [replace(whole, match="regex")])) == [1, 2, 3, 4]
    assert ids(hits.hit_filter(df, [whole, replace(exact, negate=True)])) == [3]
    assert ids(hits.hit_filter(df, [])) == [1, 2, 3, 4]


def test_metric_report_counts_and_orders(table):
    df = table(
        "hits",
        [
            hit(1, "/b", session="s1"),
            hit(2, "/b", category="Resource", session="s1"),
            hit(3, "/a", category="Resource", session="s2"),
            hit(4, "/c", ts=dt.datetime(2024, 2, 1), session="s3"),
        ],
    )

    def report(dims, metric):
        return rows_of(hits.metric_report(df, dims, metric, "2024-01-01", "2024-01-31"))

    assert report(["page_path"], "eventCount") == [("/b", 2), ("/a", 1)]
    assert report(["page_path"], "pageviews") == [("/b", 1)]
    assert report(["page_path"], "totalEvents") == [("/a", 1), ("/b", 1)]
    assert report([], "sessions") == [(2,)]


def test_package_hits_adds_up_spellings_and_drops_other_pages(table):
    df = table(
        "hits",
        [
            hit(1, "/catalogo/x"),
            hit(2, "/es/catalogo/x"),
            hit(3, "https://portal.example.org/en/catalogo/x/"),
            hit(4, "/catalogo/x?page=2"),
            hit(5, "/catalogo/X"),
            hit(6, "/catalogo/x", event="scroll"),
            hit(7, "/catalogo/x", s3=None),
            hit(8, "/catalogo/x", s3="(not set)"),
            hit(9, "/catalogo/x", s3="not set"),
            hit(10, "/catalogo/x", s2="noticias"),
            hit(11, "/catalogo/x", s2="CONJUNTOS DE DATOS", ts=dt.datetime(2023, 12, 31, 23, 59)),
        ],
    )
    got = sorted_rows(hits.package_hits(df, CFG, "2024-01-20"))
    assert got == [("2023-12", 31, "/catalogo/x", 1), ("2024-01", 20, "/catalogo/x", 3)]


def test_package_hits_of_the_legacy_feed_counts_page_views_of_any_event(table):
    df = table("hits", [hit(1, event=None), hit(2, event=None, category="Resource"), hit(3, event=None, s3="(not set)")])
    assert rows_of(hits.package_hits(df, CFG, "2024-06-01", hits.LEGACY)) == [("2024-01", 31, "/catalogo/x", 1)]


def test_extra_rule_can_be_negated(table):
    df = table("hits", [hit(1, host="a.example.org"), hit(2, host="b.example.org")])
    only = replace(CFG, extra_rule=HitRule("host_name", "full_regex", "a\\..*"))
    assert [r[3] for r in rows_of(hits.package_hits(df, only, "2024-06-01"))] == [1]
    both = replace(CFG, excluded_package_paths=("/catalogo/x",))
    assert rows_of(hits.package_hits(df, both, "2024-06-01")) == []


def test_resource_hits_decodes_labels_and_checks_the_raw_path(table):
    def event(i, path, label, **more):
        return hit(i, path, event=None, category="Resource", label=label, **more)

    df = table(
        "hits",
        [
            event(1, "/catalogo/x", "http%3A%2F%2Ff%2Fa+b", action="Download"),
            event(2, "/es/catalogo/x", "http://f/a b"),
            event(3, "/portal.example.org/catalogo/x", "http://f/a b"),
            event(4, "/catalogo/new", "http://f/a b"),
            event(5, "/en/catalogo/new/", "http://f/a b"),
            hit(6, "/catalogo/x", category="Other", label="http://f/a b"),
            event(7, "/catalogo/x/", "50%+x%zz%41"),
        ],
    )
    got = sorted_rows(hits.resource_hits(df, CFG, "2024-06-01"))
    assert got == [
        ("2024-01", 31, "50% x%zzA", "/catalogo/x/", 1),
        ("2024-01", 31, "http://f/a b", "/catalogo/x", 2),
    ]
    legacy = sorted_rows(hits.resource_hits(df, CFG, "2024-06-01", hits.LEGACY))
    assert legacy == [("2024-01", 31, "http://f/a b", "/catalogo/x", 1)]


def test_hostname_rule_applies_to_files_only(table):
    cfg = replace(CFG, hostname_pattern="portal\\.example\\.org")
    df = table(
        "hits",
        [
            hit(1, category="Resource", label="l"),
            hit(2, category="Resource", label="l", host="other.example.org"),
        ],
    )
    assert [r[4] for r in rows_of(hits.resource_hits(df, cfg, "2024-06-01"))] == [1]
    assert [r[3] for r in rows_of(hits.package_hits(df, cfg, "2024-06-01"))] == [2]


RULES = (
    SectionRule("all", "", None, "", "sessions"),
    SectionRule("section", "catalogo", "section_s2", "datasets|conjuntos de datos", "eventCount"),
    SectionRule("section", "datos", "section_s2", "datasets", "eventCount"),
    SectionRule("section", "legal", "section_s1", "aviso legal", "eventCount"),
    SectionRule("section", "comercio", "section_s3", "comerç", "eventCount"),
    SectionRule("section", "vacia", "section_s3", "nada", "eventCount"),
)


def test_section_visits(table):
    df = table(
        "hits",
        [
            hit(1, session="a"),
            hit(2, session="a", s2="Conjuntos de datos", s3="COMERÇ"),
            hit(3, session="b", s2="datasets", event="scroll"),
            hit(4, session="c", s1="Aviso legal", s2=None, s3=None),
            hit(5, session="d", event="scroll", ts=dt.datetime(2024, 2, 1)),
        ],
    )
    got = {(r[0], r[3], r[4]): (r[1], r[2]) for r in rows_of(visits.section_visits(df, RULES, "2024-02-10"))}
    assert got == {
        ("2024-01", "all", ""): (31, 3),
        ("2024-01", "section", "catalogo"): (31, 2),
        ("2024-01", "section", "datos"): (31, 1),
        ("2024-01", "section", "legal"): (31, 1),
        ("2024-01", "section", "comercio"): (31, 1),
        ("2024-01", "section", "vacia"): (31, 0),
        # A month whose hits are all of other events has its total and zeros.
        ("2024-02", "all", ""): (10, 1),
        ("2024-02", "section", "catalogo"): (10, 0),
        ("2024-02", "section", "datos"): (10, 0),
        ("2024-02", "section", "legal"): (10, 0),
        ("2024-02", "section", "comercio"): (10, 0),
        ("2024-02", "section", "vacia"): (10, 0),
    }


def test_sections_that_split_all_hits_add_up_to_all_hits(table):
    values = ["a", "b", "c"]
    df = table("hits", [hit(i, s2=values[i % 3]) for i in range(20)])
    rules = [SectionRule("section", v, "section_s2", v, "eventCount") for v in values]
    assert sum(r[2] for r in rows_of(visits.section_visits(df, rules, "2024-06-01"))) == 20


def test_history_goes_under_live_rows(spark, table):
    live = table("visits_fact", [("2017-02", 28, 5, "all", ""), ("2017-03", 31, 6, "all", "")])
    got = {r[0]: r[2] for r in rows_of(visits.with_history(live, visits.historic_visits(spark)))}
    assert len(got) == 65
    assert (got["2011-11"], got["2017-02"], got["2017-03"]) == (3436, 5, 6)


def test_historic_months_are_complete(spark):
    days = {r[0]: r[1] for r in rows_of(visits.historic_visits(spark))}
    assert (days["2012-02"], days["2013-02"], days["2016-11"], days["2016-12"]) == (29, 28, 30, 31)


def test_default_rules():
    assert len(CFG.current_sections) == 53
    assert len(CFG.legacy_sections) == 20
    assert {r.column for r in CFG.current_sections} == {None, "section_s1", "section_s2", "section_s3"}
