from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from llm_data import DOCS, corpus  # noqa: E402
from portalmeter.llm.words import Scratch  # noqa: E402


@pytest.fixture
def scratch(spark):
    return Scratch(spark)


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)
