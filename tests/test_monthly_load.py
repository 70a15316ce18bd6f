from __future__ import annotations

from dataclasses import replace

from helpers import sorted_rows
from portalmeter.config import HitRule, PortalConfig
from portalmeter.operators.visits import historic_visits
from portalmeter.plans.monthly_load import FactStore, feed_of, init_store, load_pages, load_visits
from test_hits import RULES, hit

CFG = replace(PortalConfig(), current_sections=RULES)


def packages(spark, store):
    columns = ["year_month", "end_day", "pageviews", "url", "package_name", "organization_id", "publisher_id"]
    return sorted_rows(store.read(spark, "packages_fact").select(columns))


def resources(spark, store):
    columns = ["year_month", "total_events", "url", "package_url", "resource_id", "package_name", "format"]
    return sorted_rows(store.read(spark, "resources_fact").select(columns))


def test_two_loads_with_a_dataset_that_disappears(spark, table, tmp_path):
    store = FactStore(str(tmp_path))
    init_store(spark, store)
    extras = table("package_extra", [("1", "publisher", "o1", "active"), ("2", "publisher", "o1", "active")])
    groups = table("group", [("o1", "Org", "organization", "active")])
    files = table("resource", [("r1", "1", "http://f/1", "CSV", "active", 0)])

    def catalogue(*names):
        rows = [(i, n, n, "dataset", "active", False, "o1") for i, n in names]
        return {"package": table("package", rows), "package_extra": extras, "group": groups, "resource": files}

    december = [
        (i, ts.replace(year=2023, month=12), *rest)
        for i, ts, *rest in [
            hit(1, "/catalogo/fuel"),
            hit(2, "/es/catalogo/fuel"),
            hit(3, "/catalogo/rain"),
            hit(4, "/catalogo/fuel", event=None, category="Resource", label="http%3A%2F%2Ff%2F1"),
        ]
    ]
    january = [
        hit(5, "/catalogo/fuel"),
        hit(6, "/catalogo/fuel", event=None, category="Resource", label="http://f/1"),
        hit(7, "/catalogo/none"),
    ]
    hits = table("hits", december + january)
    load_pages(spark, hits, catalogue(("1", "fuel"), ("2", "rain")), store, CFG, "last_month", "2024-01-20")
    after_december = packages(spark, store)
    assert after_december == [
        ("2023-12", 31, 1, "/catalogo/rain", "rain", "o1", "o1"),
        ("2023-12", 31, 2, "/catalogo/fuel", "fuel", "o1", "o1"),
        ("All", 0, 1, "", "rain", "o1", "o1"),
        ("All", 0, 2, "", "fuel", "o1", "o1"),
    ]
    # The dataset is gone from the catalogue: its page and file keep the identity of the month before.
    load_pages(spark, hits, catalogue(("2", "rain")), store, CFG, "latest", "2024-01-20")
    expected_packages = [
        ("2023-12", 31, 1, "/catalogo/rain", "rain", "o1", "o1"),
        ("2023-12", 31, 2, "/catalogo/fuel", "fuel", "o1", "o1"),
        ("2024-01", 20, 1, "/catalogo/fuel", "fuel", "o1", "o1"),
        ("2024-01", 20, 1, "/catalogo/none", "", None, None),
        ("All", 0, 1, "", "rain", "o1", "o1"),
        ("All", 0, 3, "", "fuel", "o1", "o1"),
    ]
    expected_resources = [
        ("2023-12", 1, "http://f/1", "/catalogo/fuel", "r1", "fuel", "CSV"),
        ("2024-01", 1, "http://f/1", "/catalogo/fuel", "r1", "fuel", "CSV"),
        ("All", 2, "http://f/1", "/catalogo/fuel", "r1", "fuel", "CSV"),
    ]
    assert packages(spark, store) == expected_packages
    assert resources(spark, store) == expected_resources
    # Loading a month again changes nothing.
    load_pages(spark, hits, catalogue(("2", "rain")), store, CFG, "2024-01", "2024-01-20")
    assert packages(spark, store) == expected_packages
    assert resources(spark, store) == expected_resources
    # A month without hits is left without rows.
    nothing = hits.where("hit_id < 0")
    load_pages(spark, nothing, catalogue(("2", "rain")), store, CFG, "2024-01", "2024-01-20")
    assert packages(spark, store) == after_december


def test_visits_with_history_and_an_empty_month(spark, table, tmp_path):
    store = FactStore(str(tmp_path))
    init_store(spark, store, historic_visits(spark))
    hits = table("hits", [hit(1, session="a"), hit(2, session="b")])
    load_visits(spark, hits, store, CFG, "2024-01", "2024-03-05")
    load_visits(spark, hits, store, CFG, "2024-02", "2024-03-05")
    visits = store.read(spark, "visits_fact")
    assert visits.where("year_month < '2018'").count() == 64
    recent = visits.where("year_month >= '2024'").select("year_month", "end_day", "key_value", "sessions")
    assert sorted_rows(recent.where("key = 'all' or key_value in ('datos', 'vacia')")) == [
        ("2024-01", 31, "", 2),
        ("2024-01", 31, "datos", 2),
        ("2024-01", 31, "vacia", 0),
        ("2024-02", 29, "", 0),
        ("2024-02", 29, "datos", 0),
        ("2024-02", 29, "vacia", 0),
    ]


def test_feed_of_month():
    assert feed_of("2023-06", CFG) == "legacy"
    assert feed_of("2023-07", CFG) == "current"


def test_init_store_leaves_what_exists(spark, table, tmp_path):
    store = FactStore(str(tmp_path))
    init_store(spark, store, historic_visits(spark))
    store.replace(spark, table("visits_fact", [("2024-01", 31, 5, "all", "")]), "visits_fact", "2024-01")
    init_store(spark, store, historic_visits(spark))
    visits = store.read(spark, "visits_fact")
    assert visits.where("year_month = '2024-01'").count() == 1
    assert visits.where("year_month < '2018'").count() == 64


def test_extra_rule_applies_to_visits(spark, table, tmp_path):
    store = FactStore(str(tmp_path))
    init_store(spark, store)
    hits = table("hits", [hit(1, "/catalogo/fuel", session="a"), hit(2, "/es/rain", session="b")])
    cfg = replace(CFG, extra_rule=HitRule("page_path", "begins_with", "/ES/", negate=True))
    load_visits(spark, hits, store, cfg, "2024-01", "2024-03-05")
    assert [r[0] for r in store.read(spark, "visits_fact").where("key = 'all'").select("sessions").collect()] == [1]
