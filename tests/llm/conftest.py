import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import edge_rows, frame  # noqa: E402


@pytest.fixture(scope="session")
def edges(spark):
    return frame(spark, edge_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
