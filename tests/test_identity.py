from __future__ import annotations

import pytest

from portalmeter.config import PortalConfig
from portalmeter.operators import identity

CFG = PortalConfig()


def package(id, name, owner="o1", state="active"):
    return (id, name, "T " + name, "dataset", state, False, owner)


@pytest.fixture
def catalogue(table):
    return {
        "package": table(
            "package",
            [package("1", "fuel"), package("2", "rain", "gone"), package("3", "snow", None), package("fuel", "wind")],
        ),
        "package_extra": table(
            "package_extra",
            [
                ("1", "publisher", "o2", "active"),
                ("2", "publisher", "o1", "active"),
                ("3", "publisher", "nowhere", "active"),
                ("3", "guid", "o1", "active"),
            ],
        ),
        "group": table("group", [("o1", "Org 1", "organization", "active"), ("o2", "Org 2", "organization", "deleted")]),
    }


def resolve(table, catalogue, urls):
    hits = table("year_month string, end_day int, url string, pageviews bigint", [("2024-01", 31, u, 1) for u in urls])
    df = identity.resolve_package(hits, catalogue["package"], catalogue["package_extra"], catalogue["group"], CFG)
    return {r["url"]: (r["package_name"], r["organization_id"], r["publisher_id"]) for r in df.collect()}


def test_resolve_package_by_id_or_name(table, catalogue):
    got = resolve(
        table,
        catalogue,
        ["/catalogo/1", "/catalogo/fuel", "/catalogo/rain/", "/es/catalogo/snow", "/catalogo/none", "/otro/rain"],
    )
    assert got == {
        "/catalogo/1": ("fuel", "o1", "o2"),
        # An id goes before an equal name.
        "/catalogo/fuel": ("wind", "o1", None),
        "/catalogo/rain/": ("rain", None, "o1"),
        "/es/catalogo/snow": ("snow", None, None),
        "/catalogo/none": (None, None, None),
        "/otro/rain": (None, None, None),
    }


def fact(month, url, name, org, pub):
    return (month, 30, 1, url, name, org, pub)


def test_backfill_package(table):
    past = table(
        "packages_fact",
        [
            fact("2023-10", "/catalogo/a", "old", "o1", "p1"),
            fact("2023-11", "/catalogo/a", "a", "o1", "p1"),
            fact("2023-12", "/catalogo/a", "later-but-unknown", None, "p1"),
            fact("2024-01", "/catalogo/a", "of-the-month-itself", "o9", "p9"),
            fact("All", "/catalogo/a", "total", "o1", "p1"),
            fact("2023-11", "/catalogo/tie", "b", "o2", "p1"),
            fact("2023-11", "/catalogo/tie", "a", "o3", "p1"),
            fact("2023-11", "/catalogo/empty", "", "o1", "p1"),
            fact("2023-11", "/catalogo/found", "other", "o1", "p1"),
            fact("2023-11", "/catalogo/a_b", "axb", "o1", "p1"),
        ],
    )
    ddl = (
        "year_month string, end_day int, url string, pageviews bigint, package_name string, organization_id string, "
        "publisher_id string"
    )
    urls = ["/catalogo/a", "/catalogo/tie", "/catalogo/empty", "/catalogo/axb"]
    resolved = table(
        ddl,
        [("2024-01", 31, u, 1, None, None, None) for u in urls] + [("2024-01", 31, "/catalogo/found", 1, "f", None, None)],
    )
    got = {r["url"]: tuple(r)[4:] for r in identity.backfill_package(resolved, past, "2024-01").collect()}
    assert got == {
        "/catalogo/a": ("a", "o1", "p1"),
        "/catalogo/tie": ("a", "o3", "p1"),
        "/catalogo/empty": ("", None, None),
        # Addresses are compared as they are; an underscore stands for itself.
        "/catalogo/axb": ("", None, None),
        "/catalogo/found": ("f", None, None),
    }


FILE_HITS = "year_month string, end_day int, url string, package_url string, total_events bigint"


def resolve_files(table, catalogue, files, pairs):
    resource = table("resource", files)
    hits = table(FILE_HITS, [("2024-01", 31, url, page, 1) for url, page in pairs])
    return identity.resolve_resource(
        hits, catalogue["package"], resource, catalogue["package_extra"], catalogue["group"], CFG
    )


def test_resolve_resource_tries_all_spellings(table, catalogue):
    files = [
        ("r1", "1", "http://f/a b", "CSV", "active", 0),
        ("r2", "1", "http://f/ñ", "XML", "active", 1),
        ("r3", "1", "http://f/z", None, "active", 2),
        ("r4", "2", "http://f/z", "PDF", "active", 0),
    ]
    urls = ["http://f/a b", "http://f/a+b", "http://f/a%20b/", "http://f/Ã±", "http://f/%C3%B1", "http://f/z/", "http://f/zz"]
    got = {r["url"]: (r["resource_id"], r["format"]) for r in
           resolve_files(table, catalogue, files, [(u, "/catalogo/1") for u in urls]).collect()}
    assert got == {
        "http://f/a b": ("r1", "CSV"),
        "http://f/a+b": ("r1", "CSV"),
        "http://f/a%20b/": ("r1", "CSV"),
        "http://f/Ã±": ("r2", "XML"),
        "http://f/%C3%B1": ("r2", "XML"),
        "http://f/z/": ("r3", None),
        "http://f/zz": (None, None),
    }


def test_resolve_resource_takes_the_first_file_by_position(table, catalogue):
    files = [
        ("late", "1", "http://f/a+b", "A", "active", 5),
        ("early", "1", "http://f/a b", "B", "active", 2),
        ("twin", "1", "http://f/a b", "C", "active", 9),
        ("deleted", "1", "http://f/a b", "D", "deleted", 0),
    ]
    df = resolve_files(table, catalogue, files, [("http://f/a+b", "/catalogo/1")])
    assert [(r["resource_id"], r["format"], r["package_name"]) for r in df.collect()] == [("early", "B", "fuel")]


def test_backfill_resource_keeps_nothing_of_a_file_not_found(table, catalogue):
    files = [("r1", "1", "http://f/a", "CSV", "active", 0)]
    pairs = [
        ("http://f/a", "/catalogo/1"),
        ("http://f/lost", "/catalogo/1"),
        ("http://f/lost", "/catalogo/rain"),
        ("http://f/lost", "/catalogo/none"),
    ]
    resolved = resolve_files(table, catalogue, files, pairs)
    past = table(
        "resources_fact",
        [
            ("2023-11", 30, 1, "http://f/lost", "PDF", "/catalogo/none", "r9", "none", "o1", "p1"),
            ("2023-12", 31, 1, "http://f/lost", None, "/catalogo/none", "r8", "none", "o1", "p1"),
            ("2023-12", 31, 1, "http://f/a", "ZIP", "/catalogo/1", "r7", "other", "o1", "p1"),
        ],
    )
    got = {
        (r["url"], r["package_url"]): (r["resource_id"], r["package_name"], r["organization_id"], r["publisher_id"], r["format"])
        for r in identity.backfill_resource(resolved, past, "2024-01").collect()
    }
    assert got == {
        ("http://f/a", "/catalogo/1"): ("r1", "fuel", "o1", "o2", "CSV"),
        ("http://f/lost", "/catalogo/1"): ("", None, None, None, None),
        ("http://f/lost", "/catalogo/rain"): ("", None, None, None, None),
        ("http://f/lost", "/catalogo/none"): ("r9", "none", "o1", "p1", "PDF"),
    }


def test_datasets_of_pages_are_all_that_a_page_may_mean(table, catalogue):
    pages = ["/catalogo/fuel", "/catalogo/2", "/catalogo/2", "/catalogo/none", "/otro/snow", None]
    hits = table(FILE_HITS, [("2024-01", 31, "http://f/a", page, 1) for page in pages])
    got = [r["package_id"] for r in identity.datasets_of_pages(hits, catalogue["package"], CFG).collect()]
    # The dataset named fuel and the one whose id that is.
    assert sorted(got) == ["1", "2", "fuel"]
