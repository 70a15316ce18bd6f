"""The registered queries: same rows as their SQL, and plans fit for large tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as registry
from tools.compare import compare
from workload.oracle import ORACLE_SQL
from workload.queries import QUERIES
from workload.standins import GIVEN

FOLDER = "/root/testdata/sf0.001"
NAMES = list(QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(NAMES)
    assert set(NAMES) <= set(registry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_rows_equal_those_of_the_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name).startswith("ok")


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_pair_join_and_no_python(spark, name):
    plan = plan_of(registry.queries()[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def test_flagship(spark):
    df = registry.entry(spark)
    assert df.columns == ["Mes", "Url", "Conjunto de datos", "Publicador", "Visitas"]
    assert df.count() > 0


def test_top_rows_are_limited_before_the_shuffle(spark):
    plan = plan_of(registry.queries()["top_datasets_per_month"](spark, FOLDER))
    window, shuffle = plan.index("WindowGroupLimit"), plan.index("hashpartitioning(year_month")
    assert plan.index("WindowGroupLimit", window + 1) > shuffle > window


def test_period_and_columns_reach_the_scan(spark):
    scans = [line for line in plan_of(registry.queries()["with_period_last_month"](spark, FOLDER)).split("\n") if "FileScan" in line]
    assert len(scans) == 1
    assert "GreaterThanOrEqual(o_orderdate,1998-12-01T00:00)" in scans[0]
    assert "LessThan(o_orderdate,1" in scans[0]
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in scans[0]


def test_months_not_asked_for_are_not_read(spark, table, tmp_path):
    from portalmeter.sources.tables import portal_tables, table_source

    rows = [(f"2023-{m:02d}", 30, m, "all", "") for m in range(1, 13)]
    table("visits_fact", rows).write.partitionBy("year_month").parquet(str(tmp_path / "visits_fact"))
    fact = table_source(spark, "visits_fact", portal_tables(str(tmp_path)))
    plan = plan_of(fact.where("year_month = '2023-05'"))
    assert "PartitionFilters: [isnotnull(year_month" in plan
