"""Stored reports, ranges of months, swaps after a crash, hits by day, identities and ordered CSV."""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import rows_of, sorted_rows
from portalmeter import staging
from portalmeter.config import PortalConfig, SectionRule
from portalmeter.functions.periods import choose_period
from portalmeter.operators import facts, identity, visits
from portalmeter.plans import monthly_load as load
from portalmeter.sinks.csv_report import csv_report_parts
from portalmeter.sources.report_rows import NESTED, POSITIONAL, checked_report_rows
from test_hits import RULES, hit

CFG = replace(PortalConfig(), current_sections=RULES)


@pytest.fixture
def store(spark, tmp_path):
    made = load.FactStore(str(tmp_path / "facts"))
    load.init_store(spark, made)
    return made


@pytest.fixture
def catalogue(table):
    rows = [("1", "fuel", "Fuel", "dataset", "active", False, "o1"), ("2", "rain", "Rain", "dataset", "active", False, "the-org")]
    return {
        "package": table("package", rows),
        "package_extra": table("package_extra", [("1", "publisher", "the-org", "active"), ("2", "publisher", "o2", "active")]),
        "group": table("group", [("o1", "Org", "organization", "active", "the-org"), ("o2", "Other", "organization", "active", "o1")]),
        "resource": table("resource", [("r1", "1", "http://f/1", "CSV", "active", 0)]),
    }


def nested(dims, number):
    return json.dumps({"dimensionValues": [{"value": d} for d in dims], "metricValues": [{"value": number}]})


@pytest.mark.parametrize("layout", [NESTED, POSITIONAL])
def test_every_line_is_used_or_has_a_reason(table, layout):
    good = nested(["/a", "x"], "3") if layout == NESTED else '["/a", "x", "3"]'
    lines = {
        good: None, "{": "unreadable", "word": "unreadable", '{"dimensionValues": 5}' if layout == NESTED else '{"a": 1}': "unreadable",
        nested(["/a"], "3") if layout == NESTED else '["/a", "3"]': "incomplete", nested(["/a", None], "3") if layout == NESTED else '["/a", null, "3"]': "incomplete",
        nested(["/a", "x"], "n/a") if layout == NESTED else '["/a", "x", "n/a"]': "not a number", nested(["/a", "x"], "-1") if layout == NESTED else '["/a", "x", "-1"]': "not a number",
    }
    df = table("year_month string, value string", [("2024-01", line) for line in [*lines, "", "  "]])
    got = checked_report_rows(df, ["page_path", "other"], "views", layout)
    assert {r["line"]: r["reason"] for r in got.collect()} == lines and got.count() == len(lines)
    assert [tuple(r) for r in got.where("reason is null").select("year_month", "page_path", "other", "views").collect()] == [("2024-01", "/a", "x", 3)]


def write_reports(spark, root, month, packages, resources):
    for name, lines in (("packages", packages), ("resources", resources)):
        spark.createDataFrame([(line,) for line in lines], "value string").write.text(f"{root}/{name}/year_month={month}")


@pytest.mark.parametrize("layout", [NESTED, POSITIONAL])
def test_reports_load_as_hits_do(spark, catalogue, store, tmp_path, layout):
    line = nested if layout == NESTED else lambda dims, number: json.dumps([*dims, number])
    packages = [line(["/catalogo/fuel"], "5"), line(["/h.example/es/catalogo/fuel/"], "2"), line(["/es/catalogo/rain"], "4"), line(["/blog"], "9"), line(["/catalogo/rain"], "many"), "{"]
    resources = [line(["http%3A%2F%2Ff%2F1", "/catalogo/fuel"], "3"), line(["http://f/1/", "/en/catalogo/fuel"], "1")]
    write_reports(spark, tmp_path / "reports", "2024-01", packages, resources)
    write_reports(spark, tmp_path / "reports", "2023-12", [line(["/catalogo/fuel"], "100")], [])
    reports = load.StoredReports(str(tmp_path / "reports"), layout)
    for _ in range(2):
        load.load_reports(spark, reports, catalogue, store, CFG, "2024-01", "2024-02-03")
    month = store.read(spark, "packages_fact").where("year_month = '2024-01'")
    # A group is told by its id, or else by its name; an id goes before an equal name.
    assert sorted_rows(month.select("pageviews", "url", "package_name", "organization_id", "publisher_id")) == [
        (4, "/catalogo/rain", "rain", "o1", "o2"),
        (7, "/catalogo/fuel", "fuel", "o1", "o1"),
    ]
    events = store.read(spark, "resources_fact").where("year_month = '2024-01'")
    assert sum(r["total_events"] for r in events.collect()) == 4 and {r["resource_id"] for r in events.collect()} == {"r1"}
    bad = sorted_rows(store.read(spark, "rejected_rows").select("report", "reason", "line"))
    assert bad == sorted([("packages", "not a number", packages[4]), ("packages", "unreadable", "{")], key=repr)
    totals = {r["report"]: r for r in store.read(spark, "load_totals").collect()}
    assert (totals["packages"]["lines"], totals["packages"]["used"], totals["packages"]["rejected"]) == (6, 4, 2)
    assert totals["packages"]["read"] == 20 == totals["packages"]["stored"] + totals["packages"]["left_out"]
    assert (totals["resources"]["read"], totals["resources"]["stored"], totals["resources"]["left_out"]) == (4, 4, 0)


def test_totals_that_do_not_come_out_raise(table):
    from portalmeter.sources.report_rows import report_totals

    rows = table("year_month string, views bigint, reason string", [("2024-01", 5, None)])
    part = lambda n: table("year_month string, views bigint", [("2024-01", n)])
    assert report_totals(rows, part(2), part(3), "packages", "views").first()["stored"] == 3
    with pytest.raises(Exception, match="of 5 read, 4 are stored"):
        report_totals(rows, part(2), part(4), "packages", "views").collect()


def test_a_range_of_months_is_as_months_in_turn(spark, table, catalogue, tmp_path):
    at = lambda i, month, path, **more: (lambda h: (h[0], h[1].replace(month=month, year=2024), *h[2:]))(hit(i, path, **more))
    hits = [at(1, 1, "/catalogo/fuel"), at(2, 1, "/catalogo/gone"), at(3, 2, "/catalogo/gone"), at(4, 3, "/catalogo/gone"), at(5, 3, "/catalogo/old"), at(6, 4, "/catalogo/fuel")]
    hits += [at(10 + m, m, "/catalogo/gone", event=None, category="Resource", label="http://f/1") for m in (1, 2, 3)]
    df = table("hits", hits)
    old = [("2023-11", 30, 7, "/catalogo/gone", "g0", "o1", "o1"), ("2024-02", 29, 1, "/catalogo/gone", "g2", "o1", "o1"), ("2024-09", 30, 2, "/catalogo/old", "late", "o1", "o1"), ("2024-04", 1, 1, "/catalogo/x", "x", "o1", "o1")]
    files = [("2023-11", 30, 7, "http://f/1", "CSV", "/catalogo/gone", "r0", "g0", "o1", "o1"), ("2024-03", 29, 1, "http://f/1", "XML", "/catalogo/gone", "r3", "g3", "o1", "o1")]
    stores = [load.FactStore(str(tmp_path / name)) for name in ("turn", "range")]
    for made in stores:
        load.init_store(spark, made)
        for name, rows in (("packages_fact", old), ("resources_fact", files)):
            table(name, rows).write.mode("append").partitionBy("year_month").parquet(made.path(name))
    for month in ("2024-01", "2024-02", "2024-03", "2024-04"):
        load.load_pages(spark, df, catalogue, stores[0], CFG, month, "2024-06-01")
    load.load_range(spark, df, catalogue, stores[1], CFG, "2024-01", "2024-04", "2024-06-01")
    for name in ("packages_fact", "resources_fact"):
        one, other = (sorted_rows(made.read(spark, name)) for made in stores)
        assert one == other and len(one) > 5
    gone = {r["year_month"]: r["package_name"] for r in stores[1].read(spark, "packages_fact").where("url = '/catalogo/gone'").collect()}
    # January still saw the old February; later months see what the ones before them were given.
    assert gone == {"2023-11": "g0", "2024-01": "g2", "2024-02": "g2", "2024-03": "g2"}
    stored = stores[1].read(spark, "packages_fact")
    whole = facts.package_all_time(stored)
    assert sorted_rows(whole) == sorted_rows(stored.where("year_month = 'All'").select(*whole.columns))


def test_feeds_of_a_range_meet_at_the_cutover(table):
    cfg = replace(CFG, cutover_month="2024-02")
    days = [dt.datetime(2024, 1, 31, 23, 59), dt.datetime(2024, 2, 29, 23, 59, 59), dt.datetime(2024, 3, 1), dt.datetime(2024, 4, 30, 23)]
    hits = table("ts timestamp_ntz", [(d,) for d in [*days, dt.datetime(2024, 5, 1)]])
    count = lambda part, feed: part.select("ts", F.lit(feed).alias("feed"))
    months = {m: choose_period(m, "2025-01-01") for m in ("2024-01", "2024-02", "2024-03", "2024-04")}
    got = load._of_feeds(hits, months["2024-01"], months["2024-04"], cfg, count)
    assert rows_of(got.orderBy("ts")) == [(d, "legacy" if i < 2 else "current") for i, d in enumerate(days)]
    assert load._of_feeds(hits, months["2024-03"], months["2024-04"], cfg, count).count() == 2
    assert load._of_feeds(hits, months["2024-01"], months["2024-02"], cfg, count).count() == 2


@pytest.mark.parametrize("stop", range(1, 6))
def test_a_crash_between_steps_leaves_the_old_month_or_the_new(spark, table, store, monkeypatch, stop):
    old, new = [("2024-01", 31, 1, "all", "")], [("2024-01", 31, 2, "all", "")]
    store.replace(spark, table("visits_fact", old), "visits_fact", "2024-01")
    steps = 0

    def counted(step):
        def run(*args):
            nonlocal steps
            steps += 1
            if steps == stop:
                raise RuntimeError("stopped")
            return step(*args)

        return run

    with monkeypatch.context() as patch:
        patch.setattr(staging, "rename", counted(staging.rename))
        patch.setattr(staging, "delete", counted(staging.delete))
        try:
            store.replace(spark, table("visits_fact", new), "visits_fact", "2024-01")
        except RuntimeError:
            pass
    store.recover(spark, "2024-01")
    left = [r["sessions"] for r in store.read(spark, "visits_fact").collect()]
    assert left in ([1], [2])
    store.replace(spark, table("visits_fact", new), "visits_fact", "2024-01")
    assert [r["sessions"] for r in store.read(spark, "visits_fact").collect()] == [2]


def test_loads_read_only_the_days_they_need(spark, table, tmp_path):
    path = str(tmp_path / "hits")
    load.write_hits(table("hits", [hit(1, "/catalogo/fuel"), hit(2, "/catalogo/rain")]), path)
    chosen = choose_period("2024-01", "2024-01-20")
    month = load.hits_between(spark.read.parquet(path), chosen.start, chosen.end)
    plan = month._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "day#" in filters[: filters.index("PushedFilters")] and month.count() == 2
    assert load.hits_between(spark.read.parquet(path), dt.date(2024, 3, 1), dt.date(2024, 3, 31)).count() == 0


def test_sections_and_sessions_take_one_scan(spark, table, tmp_path):
    table("hits", [hit(1, "/catalogo/fuel", session="a"), hit(2, "/catalogo/x/", session="a"), hit(3, "/x", session=None)]).write.parquet(str(tmp_path / "hits"))
    hits = spark.read.parquet(str(tmp_path / "hits"))
    counted = visits.section_visits(hits, CFG.current_sections, "2024-01-20")
    assert counted._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    rules = [SectionRule("all", "", None, "", "sessions"), SectionRule("s", "kept", None, "", "eventCount", ("/CATALOGO/.*/",)), SectionRule("s", "few", None, "", "sessions", (".*",))]
    got = visits.section_visits(hits, rules, "2024-01-20")
    assert {r["key_value"]: r["sessions"] for r in got.collect()} == {"": 1, "kept": 2, "few": 0}


def test_identities_follow_a_replaced_month_and_are_not_moved(spark, table, tmp_path):
    row = lambda month, url, name: (month, 30, 1, url, name, "o", "p")
    rows = [row("2024-01", "/a", "a1"), row("2024-02", "/a", "a2"), row("2024-03", "/a", "a3"), row("2024-03", "/b", "b3"), row("2024-01", "/c", "c1")]
    known = identity.package_identities(table("packages_fact", rows))
    after = [r for r in rows if r[0] != "2024-03"] + [row("2024-03", "/c", "c3"), row("2024-03", "/d", "d0")]
    now = identity.package_identities_changed(known, table("packages_fact", after), "2024-03")
    assert sorted_rows(now) == sorted_rows(identity.package_identities(table("packages_fact", after)))
    identity.store_identities(now, "known_pages", str(tmp_path / "known"), 4)
    lost = table("year_month string, end_day int, url string, pageviews bigint, package_name string, organization_id string, publisher_id string", [("2024-03", 1, u, 1, None, None, None) for u in ("/a", "/b", "/c", "/d")])
    stored = spark.table("known_pages")
    filled = identity.backfill_package_known(lost, stored, "2024-03")
    expected = identity.backfill_package(lost, table("packages_fact", after), "2024-03")
    assert sorted_rows(filled) == sorted_rows(expected) and {r["package_name"] for r in filled.collect()} == {"a2", "c1", ""}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = identity.backfill_package_known(lost, stored, "2024-03")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Only what is looked up is moved: the table's side of the join has no exchange.
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1
    spark.sql("drop table known_pages")


def test_parts_of_a_report_are_one_file(spark, table, tmp_path):
    rows = [(f"k{i:05d}", i, None if i % 7 else 'a "quoted", value') for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, n long, v string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = csv_report_parts(df, str(tmp_path), "2024-01-20", "big", ["k"])
        empty = csv_report_parts(df.limit(0), str(tmp_path), "2024-01-20", "none", ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    import glob

    parts = sorted(glob.glob(f"{path}/part-*"))
    text = "".join(open(p, newline="").read() for p in parts)
    quoted = lambda v: '"' + ("" if v is None else str(v).replace('"', '""')) + '"'
    assert len(parts) > 2 and text == "".join(",".join(map(quoted, r)) + "\r\n" for r in [("k", "n", "v"), *rows])
    assert "".join(open(p, newline="").read() for p in sorted(glob.glob(f"{empty}/part-*"))) == '"k","n","v"\r\n'


def test_only_touched_datasets_are_added_up_again(spark, table):
    row = lambda month, name, views, org="o": (month, 30, views, f"/catalogo/{name}", name, org, "p")
    rows = [row("2024-01", f"d{i}", i + 1) for i in range(50)] + [row("2024-02", "d1", 5), row("2024-02", "d2", 5, "o2")]
    fact = table("packages_fact", rows)
    for new in ([row("2024-02", "d1", 9), row("2024-02", "new", 3)], []):
        after = facts.replace_period(fact, table("packages_fact", new), "2024-02")
        old, now, parts = facts.package_parts(fact.where("year_month = '2024-02'")), facts.package_parts(table("packages_fact", new)), facts.package_parts(after)
        changed = facts.package_all_time_changed(facts.package_all_time(fact), old, now, parts)
        assert sorted_rows(changed) == sorted_rows(facts.package_all_time(after))
        touched = parts.join(old.select("package_name").union(now.select("package_name")).distinct(), "package_name", "left_semi")
        assert touched.count() <= 5
