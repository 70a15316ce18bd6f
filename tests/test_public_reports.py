from __future__ import annotations

from helpers import rows_of, sorted_rows
from portalmeter.config import PortalConfig
from portalmeter.plans import public_reports as public

DAY = "2024-01-20"
CFG = PortalConfig()
BASE = "http://portal.example.org/kos/sector-publico/sector/"


def dataset(id, title="T", type="dataset", state="active", private=False, owner="o1"):
    return (id, f"n{id}", title, type, state, private, owner)


def test_datasets_evolution(table):
    df = table("published_datasets", [("2024-02", "total", "", 2), ("2024-01", "total", "", 1), ("2024-01", "Total", "", 9)])
    assert rows_of(public.datasets_evolution({"published_datasets": df})) == [("2024-01", 1), ("2024-02", 2)]


def test_datasets_by_admin_level(table):
    packages = [dataset(str(i)) for i in range(9)] + [
        dataset("no-title", None),
        dataset("private", private=True),
        dataset("deleted", state="deleted"),
        dataset("harvest", type="harvest"),
        dataset("no-publisher"),
    ]
    publishers = {
        "0": "a", "1": "g", "2": "i", "3": "x", "4": "nocode", "5": "missing", "6": "u", "7": "a", "8": "twice",
        "no-title": "l", "private": "a", "deleted": "a", "harvest": "a",
    }
    extras = [(p, "publisher", g, "active") for p, g in publishers.items()] + [("no-publisher", "guid", "a", "active")]
    codes = {"a": "A1", "g": "G1", "i": "I1", "x": "X1", "u": "U1", "l": "L1"}
    tables = {
        "package": table("package", packages),
        "package_extra": table("package_extra", extras),
        "group": table("group", [(g, g, "organization", "active") for g in [*codes, "nocode", "twice"]]),
        "group_extra": table(
            "group_extra",
            [(g, "C_ID_UD_ORGANICA", c, "active") for g, c in codes.items()]
            + [("a", "other", "P1", "active"), ("twice", "C_ID_UD_ORGANICA", "P1", "active"),
               ("twice", "C_ID_UD_ORGANICA", "E1", "active"), ("missing", "C_ID_UD_ORGANICA", "P1", "active")],
        ),
    }
    assert rows_of(public.datasets_by_admin_level(tables, DAY)) == [
        (DAY, "Administración Autonómica", 2),
        (DAY, "Administración del Estado", 1),
        (DAY, "Otras instituciones", 2),
        (DAY, "Administración Local", 0),
        (DAY, "Entidad Privada", 1),
        (DAY, "Universidades", 1),
        # An unknown letter and no code at all are two rows without a label.
        (DAY, None, 1),
        (DAY, None, 2),
    ]


def theme_tables(table):
    values = {
        "1": f'["{BASE}turismo", "{BASE}salud"]',
        "2": f'["{BASE}turismo"]',
        "3": "[]",
        "4": None,
        "5": '["broken',
        "6": '["http://elsewhere.example.com/kos/x"]',
        "7": '["http://portal.example.org/kos/other", "http://portal.example.org/kos/more"]',
    }
    return {
        "package": table("package", [dataset(i) for i in values]),
        "package_extra": table("package_extra", [(i, "theme", v, "active") for i, v in values.items()]),
    }


def test_datasets_by_theme(table):
    tables = theme_tables(table)
    assert rows_of(public.datasets_by_theme(tables, DAY, CFG)) == [
        (DAY, "Turismo", 2),
        # Two addresses without a label stay two rows.
        (DAY, "Otro", 1),
        (DAY, "Otro", 1),
        (DAY, "Salud", 1),
    ]
    assert rows_of(public.unreadable_themes(tables)) == [(1,)]


def test_datasets_by_format(table):
    files = [
        ("text/xml", "1", "active"), ("application/xml", "1", "active"), ("application/xml", "2", "active"),
        ("weird", "1", "active"), (None, "1", "active"), ("text/csv", "1", "deleted"), ("text/csv", "3", "active"),
        ("text/csv", "4", "active"),
    ]
    tables = {
        "package": table("package", [dataset("1"), dataset("2"), dataset("3", None), dataset("4", private=True)]),
        "resource": table("resource", [(str(i), p, "u", f, s, i) for i, (f, p, s) in enumerate(files)]),
    }
    assert rows_of(public.datasets_by_format(tables, DAY)) == [
        (DAY, "XML", 2),
        (DAY, None, 1),
        (DAY, "XML", 1),
        (DAY, "weird", 1),
        (DAY, "CSV", 0),
    ]


def test_contents_by_type_leaves_absent_types_empty(table):
    rows = [
        ("2024-01", "total", "app", 1), ("2024-01", "other", "app", 2), ("2024-01", "total", "success", 5),
        ("2024-02", "total", "request", 3), ("2024-03", "total", "content_comments", 9),
    ]
    got = public.contents_by_type({"content_counts": table("content_counts", rows)})
    assert got.columns == ["date", "app", "initiative", "request", "success"]
    assert rows_of(got) == [("2024-01", 3, None, None, 5), ("2024-02", None, None, 3, None)]


def visits(table):
    return {
        "visits_fact": table(
            "visits_fact",
            [
                ("2024-02", 29, 7, "all", ""), ("2024-01", 31, 5, "all", ""), ("2024-01", 31, 3, "section", "catalogo"),
                ("2024-01", 31, 2, "section", "eventos"), ("2024-01", 31, 4, "section", "turismo"),
            ],
        )
    }


def test_visit_reports(table):
    tables = visits(table)
    assert rows_of(public.visits_evolution(tables)) == [("2024-01", 5), ("2024-02", 7)]
    assert rows_of(public.catalogue_visits_evolution(tables)) == [("2024-01", 3)]
    contents = public.content_section_visits(tables)
    assert contents.columns[:4] == ["date", "aplicaciones", "documentacion", "empresas-reutilizadoras"]
    assert rows_of(contents) == [("2024-01", 0, 0, 0, 0, 2, 0, 0, 0, 0)]
    sectors = public.sector_visits(tables)
    assert sectors.columns[-1] == "justicia-sociedad"
    assert rows_of(sectors) == [("2024-01", 0, 0, 0, 0, 0, 4, 0)]


def test_top_datasets_per_month(table):
    many = [("2024-01", 31, 100 - i, f"/u{i}", f"n{i}", "o", "g") for i in range(12)]
    more = [
        ("2024-02", 15, 5, "/b", "n1", None, "g"),
        ("2024-02", 15, 5, "/a", "n1", None, "g"),
        ("2024-02", 15, 5, "/z", "n0", None, "g"),
        ("2024-02", 15, 9, "/p", "n2", "o", None),
        ("2024-02", 15, 9, "/p", "n50", "o", "g"),
        ("2024-02", 15, 9, "/p", "hidden", "o", "g"),
        ("All", 0, 77, "", "n3", "o", "g"),
    ]
    packages = [(str(i), f"n{i}", f"Title {i}", "dataset", "deleted", False, "o") for i in range(12)]
    packages.append(("h", "hidden", "H", "dataset", "active", True, "o"))
    tables = {
        "packages_fact": table("packages_fact", many + more),
        "package": table("package", packages),
        "group": table("group", [("g", "Publisher", "organization", "active")]),
    }
    got = public.top_datasets_per_month(tables, DAY, CFG)
    assert got.columns == ["Mes", "Url", "Conjunto de datos", "Publicador", "Visitas"]
    rows = rows_of(got)
    assert rows[0] == ("Total acumulado", "https://portal.example.org/es/catalogo/n3", "Title 3", "Publisher", 77)
    assert [(r[0], r[1][-2:], r[4]) for r in rows[1:4]] == [
        ("Febrero 2024 (hasta el 15)", "n0", 5),
        ("Febrero 2024 (hasta el 15)", "n1", 5),
        ("Febrero 2024 (hasta el 15)", "n1", 5),
    ]
    assert [(r[0], r[4]) for r in rows[4:]] == [("Enero 2024", 100 - i) for i in range(10)]
    assert sorted_rows(got) == sorted(rows, key=repr)
