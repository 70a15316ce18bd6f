from __future__ import annotations

import pytest

from helpers import rows_of, sorted_rows
from portalmeter.operators import facts
from portalmeter.plans.monthly_load import FactStore
from portalmeter.schemas import ALL_TIME


def view(month, name, org, pub, views, url=None):
    return (month, 30, views, url or f"/catalogo/{name}", name, org, pub)


def totals(table, rows):
    df = facts.package_all_time(table("packages_fact", rows))
    return {r["package_name"]: (r["pageviews"], r["organization_id"], r["publisher_id"]) for r in df.collect()}


def test_package_all_time_of_one_pair(table):
    rows = [
        view("2023-01", "a", "o", "p", 3),
        view("2023-02", "a", "o", "p", 4),
        view("2023-03", "a", None, "p", 100),
        view("2023-03", "a", "o", "", 100),
        view("All", "a", "o", "p", 1000),
        view("all", "a", "o", "p", 1000),
        view("2023-01", "", "o", "p", 9),
        view("2023-01", "unknown", None, None, 9),
    ]
    assert totals(table, rows) == {"a": (7, "o", "p")}
    row = facts.package_all_time(table("packages_fact", rows)).first()
    assert (row["year_month"], row["end_day"], row["url"]) == ("All", 0, "")


def test_package_all_time_of_several_pairs_is_labelled_by_the_newest_month(table):
    rows = [view("2023-01", "a", "o1", "p", 3), view("2023-03", "a", "o2", "p", 4), view("2023-02", "a", "o3", "p", 5)]
    assert totals(table, rows) == {"a": (12, "o2", "p")}
    # The newest row gives the label even if its organisation is not known; its views still do not count.
    assert totals(table, rows + [view("2023-04", "a", None, "p9", 50)]) == {"a": (12, None, "p9")}
    # Within one month the smallest path decides.
    tie = rows + [view("2023-03", "a", "o0", "p", 1, "/catalogo/aa"), view("2023-03", "a", "o9", "p", 1, "/catalogo/A")]
    assert totals(table, tie) == {"a": (14, "o9", "p")}


def test_package_total_is_the_sum_of_its_counted_rows(table):
    rows = [view(f"2023-{m:02d}", f"d{d}", f"o{(m * d) % 3}", "p", m * d + 1) for m in range(1, 13) for d in range(5)]
    expected = {f"d{d}": sum(m * d + 1 for m in range(1, 13)) for d in range(5)}
    assert {name: got[0] for name, got in totals(table, rows).items()} == expected


def file_row(month, events, format, resource="r", name="a", org="o", pub="p", url="http://f/x", page="/catalogo/a"):
    return (month, 30, events, url, format, page, resource, name, org, pub)


def file_totals(table, rows):
    df = facts.resource_all_time(table("resources_fact", rows))
    return sorted(
        (r["resource_id"], r["url"], r["package_url"], r["total_events"], r["format"], r["organization_id"]) for r in df.collect()
    )


def test_resource_all_time_adds_formats_up(table):
    rows = [
        file_row("2023-01", 4, "A"),
        file_row("2023-02", 6, "A"),
        file_row("2023-03", 4, "B"),
        file_row("2023-03", 9, "B", resource=""),
        file_row("2023-03", 9, "B", name=None),
        file_row("All", 99, "A"),
        file_row("2023-01", 1, None, resource="s", url="http://f/y"),
    ]
    assert file_totals(table, rows) == [
        ("r", "http://f/x", "/catalogo/a", 14, "A", "o"),
        ("s", "http://f/y", "/catalogo/a", 1, None, "o"),
    ]


def test_resource_all_time_of_several_pairs(table):
    rows = [
        file_row("2023-01", 40, "A"),
        file_row("2023-02", 3, "B", org="o2"),
        file_row("2023-03", 5, "C", org=None),
        # Another address of the same file is a row of its own.
        file_row("2023-01", 2, "A", url="http://f/z"),
    ]
    assert file_totals(table, rows) == [
        ("r", "http://f/x", "/catalogo/a", 43, "C", None),
        ("r", "http://f/z", "/catalogo/a", 2, "A", "o"),
    ]


def visit(month, n, name="a"):
    return (month, 30, n, "section", name)


def test_replace_period_in_memory(table):
    fact = table("visits_fact", [visit("2023-01", 1), visit("2023-02", 2)])
    assert sorted_rows(facts.replace_period(fact, table("visits_fact", [visit("2023-02", 5)]), "2023-02")) == [
        visit("2023-01", 1),
        visit("2023-02", 5),
    ]
    assert rows_of(facts.replace_period(fact, table("visits_fact", []), "2023-02")) == [visit("2023-01", 1)]
    once = facts.replace_period(fact, table("visits_fact", [visit("2023-03", 7)]), "2023-03")
    assert sorted_rows(facts.replace_period(once, table("visits_fact", [visit("2023-03", 7)]), "2023-03")) == sorted_rows(once)


@pytest.fixture
def store(spark, table, tmp_path):
    built = FactStore(str(tmp_path))
    rows = [visit("2023-01", 1), visit("2023-02", 2), visit(ALL_TIME, 3)]
    table("visits_fact", rows).write.partitionBy("year_month").parquet(built.path("visits_fact"))
    return built


def stored(spark, store):
    return [r for r in sorted_rows(store.read(spark, "visits_fact").select("year_month", "end_day", "sessions", "key", "key_value"))]


def test_write_period_replaces_only_its_month(spark, table, store):
    store.replace(spark, table("visits_fact", [visit("2023-02", 8), visit("2023-02", 9, "b")]), "visits_fact", "2023-02")
    assert stored(spark, store) == [visit("2023-01", 1), visit("2023-02", 8), visit("2023-02", 9, "b"), visit(ALL_TIME, 3)]


def test_write_period_by_nothing_empties_the_month(spark, table, store):
    store.replace(spark, table("visits_fact", []), "visits_fact", "2023-02")
    assert stored(spark, store) == [visit("2023-01", 1), visit(ALL_TIME, 3)]
    store.replace(spark, table("visits_fact", [visit("2023-02", 4)]), "visits_fact", "2023-02")
    assert stored(spark, store) == [visit("2023-01", 1), visit("2023-02", 4), visit(ALL_TIME, 3)]


def test_write_period_may_read_the_table_it_changes(spark, store):
    rows = store.read(spark, "visits_fact").where("year_month = '2023-02'").selectExpr(
        "year_month", "end_day", "sessions * 10 as sessions", "key", "key_value"
    )
    store.replace(spark, rows, "visits_fact", "2023-02")
    assert stored(spark, store) == [visit("2023-01", 1), visit("2023-02", 20), visit(ALL_TIME, 3)]


def test_delete_period(spark, store):
    roots = {"visits_fact": store.path("visits_fact")}
    facts.delete_period(spark, roots, "2023-01")
    assert stored(spark, store) == [visit("2023-02", 2), visit(ALL_TIME, 3)]
    facts.delete_period(spark, roots, ALL_TIME)
    assert stored(spark, store) == []


def test_rows_of_another_month_raise(spark, table, store):
    rows = table("visits_fact", [("2024-01", 31, 5, "all", ""), ("2024-02", 29, 6, "all", "")])
    with pytest.raises(Exception, match="a row of 2024-01 was expected"):
        facts.replace_period(rows.limit(0), rows, "2024-01").collect()
    with pytest.raises(Exception, match="a row of 2024-01 was expected"):
        store.replace(spark, rows, "visits_fact", "2024-01")
