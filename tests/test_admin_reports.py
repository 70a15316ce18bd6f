from __future__ import annotations

from helpers import rows_of, sorted_rows
from portalmeter.config import PortalConfig
from portalmeter.plans import admin_reports as admin

DAY = "2024-01-20"


def test_datasets_evolution_by_admin_level(table):
    rows = [("2024-01", "administration_level", k, n) for k, n in zip("AEIGXZ", (1, 2, 3, 4, 5, 6))]
    rows += [("2024-02", "administration_level", "Z", 1), ("2024-01", "total", "A", 9)]
    got = admin.datasets_evolution_by_admin_level({"published_datasets": table("published_datasets", rows)})
    assert got.columns == ["year", "A", "E", "L", "U", "I", "P"]
    assert rows_of(got) == [("2024-01", 1, 2, None, None, 12, None), ("2024-02", None, None, None, None, None, None)]


def test_datasets_by_org_monthly(table):
    tables = {
        "published_datasets": table(
            "published_datasets",
            [
                ("2016-11", "organization_id", "a", 1), ("2016-12", "organization_id", "b", 2),
                ("2016-12", "organization_id", "c", 3), ("2017-02", "organization_id", "c", 4),
                ("2016-12", "organization_id", "none", 5), ("2016-12", "total", "a", 6),
            ],
        ),
        "group": table("group", [(i, t, "organization", "active") for i, t in (("a", "Same"), ("b", "Same"), ("c", "Alone"))]),
    }
    got = admin.datasets_by_org_monthly(tables, "2017-02-10")
    assert got.columns == ["Organismo", "2016-11", "2016-12", "2017-01"]
    assert rows_of(got) == [("Alone", None, 3, None), ("Same", 1, 2, None)]


def test_distributions_histogram_sorts_as_text(table):
    rows = [("2024-02", "num_resources", "2", 5), ("2024-01", "num_resources", "10", 6), ("2024-01", "num_resources", "2", 7)]
    got = admin.distributions_histogram({"published_datasets": table("published_datasets", rows)}, DAY, PortalConfig())
    assert rows_of(got) == [("Enero 2024", "10", 6), ("Enero 2024", "2", 7), ("Febrero 2024", "2", 5)]


def test_dataset_visits_detail_repeats_rows_per_theme(table):
    facts = [
        ("2024-01", 31, 5, "/1", "n1", "o", "g"),
        ("All", 0, 6, "", "n2", "o", "g"),
        ("2024-01", 31, 7, "/1", "n1", None, "g"),
        ("2024-01", 31, 8, "/3", "n3", "o", "g"),
        ("2024-01", 31, 9, "/4", "n1", "o", "unknown"),
    ]
    tables = {
        "packages_fact": table("packages_fact", facts),
        "package": table(
            "package",
            [("1", "n1", "T1", "dataset", "deleted", False, "o"), ("2", "n2", "T2", "harvest", "active", False, "o"),
             ("3", "n3", "T3", "dataset", "active", True, "o")],
        ),
        "package_extra": table("package_extra", [("1", "theme", "x", "active"), ("1", "theme", "y", "active"), ("2", "guid", "z", "active")]),
        "group": table("group", [("g", "G", "organization", "active")]),
    }
    got = admin.dataset_visits_detail(tables)
    assert got.columns == ["fecha", "conjunto_datos", "publicador", "visitas"]
    assert sorted_rows(got) == [("2024-01", "T1", "G", 5), ("2024-01", "T1", "G", 5), ("All", "T2", "G", 6)]


def test_comments_received(table):
    rows = [
        ("2024-01", "total", "content_comments", 1), ("2024-01", "status", "dataset_comments", 2),
        ("2024-02", "total", "dataset_comments", 3), ("2024-03", "total", "app", 4),
    ]
    got = admin.comments_received({"content_counts": table("content_counts", rows)})
    assert rows_of(got) == [("2024-01", 1, 0), ("2024-02", 0, 3)]


def test_publishers_evolution(table):
    got = admin.publishers_evolution({"publisher_counts": table("publisher_counts", [("2024-02", 1, 2, 3), ("2024-01", 4, 5, 6)])})
    assert rows_of(got) == [("2024-01", 4, 5, 6), ("2024-02", 1, 2, 3)]


def publisher_tables(table):
    def dataset(id, owner, type="dataset", state="active", private=False):
        return (id, id, id, type, state, private, owner)

    packages = [
        dataset("d1", "h"), dataset("d2", "h"), dataset("d3", "h"), dataset("d4", "m"), dataset("d5", "m"),
        dataset("d6", "h"), dataset("d7", None), dataset("d8", "h", private=True), dataset("d9", "h"),
        dataset("source", "h", "harvest"), dataset("off", "m", "harvest", "deleted"),
    ]
    extras = [
        # One publisher with a guid on one dataset and none on another.
        ("d1", "publisher", "both", "active"), ("d1", "guid", "1", "active"), ("d2", "publisher", "both", "active"),
        ("d3", "publisher", "harvested", "active"), ("d3", "guid", "3", "active"),
        # A guid without a harvest source, and a harvest source with a guid that is not active.
        ("d4", "publisher", "manual", "active"), ("d4", "guid", "4", "active"),
        ("d6", "publisher", "manual", "active"), ("d6", "guid", "6", "deleted"),
        ("d5", "publisher", "inactive", "deleted"),
        ("d7", "publisher", "nocode", "active"), ("d7", "guid", "7", "active"),
        ("d8", "publisher", "hidden", "active"),
        ("d9", "publisher", "unlisted", "active"), ("d9", "guid", "9", "active"),
    ]
    groups = [
        ("both", "b title", "organization", "active"), ("harvested", "Z title", "organization", "active"),
        ("manual", "a title", "organization", "active"), ("nocode", "É title", "organization", "active"),
    ]
    codes = [
        ("both", "C_ID_UD_ORGANICA", "E1", "active"), ("harvested", "C_ID_UD_ORGANICA", "E2", "active"),
        ("manual", "C_ID_UD_ORGANICA", "X1", "active"), ("nocode", "C_ID_UD_ORGANICA", "A1", "deleted"),
    ]
    return {
        "package": table("package", packages),
        "package_extra": table("package_extra", extras),
        "group": table("group", groups),
        "group_extra": table("group_extra", codes),
    }


def test_publishers_by_level_and_mode(table):
    got = admin.publishers_by_level_and_mode(publisher_tables(table), DAY)
    assert got.columns == ["date", "category", "harvester_publishers", "manual_loading_publishers", "both"]
    assert rows_of(got) == [
        (DAY, "Administración del Estado", 1, 0, 1),
        (DAY, "No clasificado", 0, 1, 0),
        (DAY, None, 1, 1, 0),
    ]


def test_publisher_update_mode_sorts_by_bytes(table):
    got = admin.publisher_update_mode(publisher_tables(table), DAY)
    assert got.columns == ["Fecha de actualización de los datos", "Organismo", "Nivel de administración", "Tipo de actualización"]
    assert [r[1:] for r in rows_of(got)] == [
        ("Z title", "Administración del Estado", "federacion"),
        ("a title", "No clasificado", "manual"),
        ("b title", "Administración del Estado", "ambas"),
        ("É title", None, "manual"),
        (None, None, "federacion"),
    ]


def test_contents_by_type_admin(table):
    fields = [
        (1, "blog", "One", "es", 1), (2, "blog", "One", "es", 1), (3, "blog", "ONE", "es", 1), (4, "blog", "Two", "en", 1),
        (5, "blog", "Three", "es", 0), (6, "aplicacion", "App", "es", 1), (7, "zeta", "Z", "es", 1), (8, "orphan", "O", "es", 1),
    ]
    tables = {
        "node": table("node", [("blog",), ("blog",), ("aplicacion",), ("zeta",)]),
        "node_field_data": table("node_field_data", fields),
    }
    assert rows_of(admin.contents_by_type_admin(tables, DAY)) == [
        ("20/01/2024", "Aplicación", 1),
        ("20/01/2024", "Blog", 2),
        ("20/01/2024", "zeta", 1),
    ]
    loose = admin.contents_by_type_admin(tables, DAY, collation="UNICODE_CI_AI")
    assert [r[2] for r in rows_of(loose)] == [1, 1, 1]


def test_data_requests_by_state(table):
    fields = [(i, "peticion_de_datos", "t", "es", 1) for i in range(4)]
    fields += [(8, "peticion_de_datos", "t", "en", 1), (9, "peticion_de_datos", "t", "es", 0), (10, "blog", "t", "es", 1)]
    tables = {
        "node_field_data": table("node_field_data", fields),
        "node__field_estado": table("node__field_estado", [(0, 1), (1, 1), (2, 2), (8, 1), (9, 1), (10, 1)]),
        "taxonomy_term_field_data": table("taxonomy_term_field_data", [(1, "Abierta", "es"), (1, "Open", "en"), (2, "Abierta", "es")]),
    }
    assert rows_of(admin.data_requests_by_state(tables, DAY)) == [(DAY, "Abierta", 3)]


def user_tables(table):
    return {
        "users_field_data": table("users_field_data", [(1, 1), (2, 1), (3, 0), (4, 1), (5, 1)]),
        "user__field_organizacion": table("user__field_organizacion", [(1, 10), (2, 10), (3, 10), (4, 20), (1, 20), (5, 30)]),
        "taxonomy_term__field_ckan_organization_name": table("taxonomy_term__field_ckan_organization_name", [(10,), (20,), (20,)]),
        "taxonomy_term_field_data": table("taxonomy_term_field_data", [(10, "B", "es"), (20, "A", "es"), (20, "A", "en"), (30, "C", "es")]),
        "taxonomy_term__field_c_id_ud_organica": table(
            "taxonomy_term__field_c_id_ud_organica", [(10, "E1"), (20, None), (30, "X")]
        ),
    }


def test_users_by_org_counts_joined_rows(table):
    assert rows_of(admin.users_by_org(user_tables(table), DAY)) == [(DAY, "A", 8), (DAY, "B", 2)]


def test_users_by_admin_level(table):
    assert rows_of(admin.users_by_admin_level(user_tables(table), DAY)) == [
        (DAY, "Desconocido", 3),
        (DAY, "Administración del Estado", 2),
    ]
