from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from portalmeter import schemas  # noqa: E402
from portalmeter.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Rows as a DataFrame with the schema of a named table, or with a schema given as DDL."""

    def build(name_or_ddl, rows):
        # Nullability is left out: fixtures may hold what a stored table would refuse.
        ddl = schemas.TABLES.get(name_or_ddl, name_or_ddl).replace(" not null", "")
        # Columns left out at the end of a row are null.
        width = len(T.StructType.fromDDL(ddl).fields)
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], ddl)

    return build
