from __future__ import annotations

import csv
import glob

import pytest

from helpers import rows_of, sorted_rows
from portalmeter.plans.catalogue import REPORTS, write_reports
from portalmeter.sinks.csv_report import csv_report_sink, report_path
from portalmeter.sources.report_rows import NESTED, POSITIONAL, flatten_report_rows, read_report_rows
from portalmeter.sources.tables import portal_tables, table_source


def test_nested_report_rows(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text(
        '{"dimensionValues": [{"value": "label"}, {"value": "/p"}], "metricValues": [{"value": "12"}]}\n'
        '{"dimensionValues": [{"value": "x"}, {"value": "/q"}], "metricValues": [{"value": "3000000000"}]}\n'
    )
    rows = read_report_rows(spark, str(path), NESTED)
    got = flatten_report_rows(rows, ["event_label", "page_path"], "total_events", NESTED)
    assert got.dtypes[-1] == ("total_events", "bigint")
    assert rows_of(got) == [("label", "/p", 12), ("x", "/q", 3000000000)]


def test_report_rows_without_dimensions(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('["7"]\n')
    rows = read_report_rows(spark, str(path), POSITIONAL)
    assert rows_of(flatten_report_rows(rows, [], "sessions", POSITIONAL)) == [(7,)]


def test_positional_report_rows(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('["/p", "5"]\n["/q", "6"]\n')
    rows = read_report_rows(spark, str(path), POSITIONAL)
    assert rows_of(flatten_report_rows(rows, ["page_path"], "pageviews", POSITIONAL)) == [("/p", 5), ("/q", 6)]
    with pytest.raises(ValueError):
        flatten_report_rows(rows, ["page_path"], "pageviews", "other")


def test_parquet_tables_come_with_their_schema(spark, table, tmp_path):
    table("group", [("o1", "Org", "organization", "active")]).write.parquet(str(tmp_path / "group"))
    assert rows_of(table_source(spark, "group", portal_tables(str(tmp_path)))) == [("o1", "Org", "organization", "active", None)]


def read_csv(path):
    text = "".join(open(p, newline="", encoding="utf-8").read() for p in sorted(glob.glob(f"{path}/part-*")))
    return text, list(csv.reader(text.splitlines(keepends=True)))


def test_csv_quotes_every_field(spark, tmp_path):
    rows = [("a", 'say "hi"', 1), ("b", " padded, ñ ", None), ("", None, 3), ("back\\slash", "x", 4)]
    df = spark.createDataFrame(rows, "`Número` string, text string, n bigint").orderBy("n")
    path = csv_report_sink(df, str(tmp_path), "2024-01-20", "my_report", single_file=True)
    assert path == f"{tmp_path}/2024-01-20/my_report.csv"
    text, parsed = read_csv(path)
    assert text.startswith('"Número","text","n"\r\n')
    assert parsed == [
        ["Número", "text", "n"],
        ["b", " padded, ñ ", ""],
        ["a", 'say "hi"', "1"],
        ["", "", "3"],
        ["back\\slash", "x", "4"],
    ]
    assert all(line.startswith('"') and line.endswith('"') for line in text.split("\r\n") if line)


def test_csv_of_no_rows_has_its_header(spark, tmp_path):
    df = spark.createDataFrame([], "a string, b int")
    assert read_csv(csv_report_sink(df, str(tmp_path), "2024-01-20", "none", single_file=True))[1] == [["a", "b"]]


def test_csv_is_written_over(spark, tmp_path):
    for n in (1, 2):
        path = csv_report_sink(spark.range(n), str(tmp_path), "2024-01-20", "again", single_file=True)
    assert len(read_csv(path)[1]) == 3


def test_report_paths_use_the_dashboard_names():
    assert report_path("/out", "2024-01-20", "sector_visits") == "/out/2024-01-20/visitas_publico_sectores.csv"


def test_write_reports(spark, table, tmp_path):
    table("visits_fact", [("2024-01", 31, 5, "all", ""), ("2023-12", 31, 4, "all", "")]).write.parquet(
        str(tmp_path / "in" / "visits_fact")
    )
    paths = write_reports(spark, portal_tables(str(tmp_path / "in")), str(tmp_path / "out"), "2024-01-20", names=["visits_evolution"])
    assert read_csv(paths[0])[1] == [["date", "value"], ["2023-12", "4"], ["2024-01", "5"]]


def test_every_report_has_a_file_name():
    from portalmeter.fixed_values import REPORT_FILES

    assert list(REPORTS) == list(REPORT_FILES)
    assert len(REPORTS) == 22


def test_wide_report_keeps_its_order_over_parts(spark, tmp_path):
    df = spark.range(1000).orderBy("id")
    path = csv_report_sink(df, str(tmp_path), "2024-01-20", "wide")
    values = [int(r[0]) for r in read_csv(path)[1] if r[0] != "id"]
    assert values == sorted(values) and len(values) == 1000
    assert sorted_rows(spark.read.option("header", True).csv(path))


def test_jdbc_reads_are_divided(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameReader

    from portalmeter.sources.tables import JdbcTables

    calls = []
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, *args, **kwargs: calls.append((args, kwargs)))
    cfg = JdbcTables(
        "jdbc:somewhere",
        {"user": "reader"},
        split={"node_field_data": ("nid", 0, 1000, 4)},
        predicates={"package": ["id < 'm'", "id >= 'm'"]},
        small=["node"],
    )
    for name in ("node_field_data", "package", "node"):
        table_source(spark, name, cfg)
    properties = {"fetchsize": "10000", "user": "reader"}
    assert calls == [
        (
            ("jdbc:somewhere", "node_field_data"),
            {"column": "nid", "lowerBound": 0, "upperBound": 1000, "numPartitions": 4, "properties": properties},
        ),
        (("jdbc:somewhere", "package"), {"predicates": ["id < 'm'", "id >= 'm'"], "properties": properties}),
        (("jdbc:somewhere", "node"), {"properties": properties}),
    ]
    with pytest.raises(ValueError, match="resource"):
        table_source(spark, "resource", cfg)
