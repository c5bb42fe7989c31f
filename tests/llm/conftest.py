import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_cases import CLASH, KIND, edge_rows  # noqa: E402


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows(), KIND)
    return df.withColumns({c: F.lit("clash") for c in CLASH})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (5, None, None), (99, 1, 1), (3, 0, 1), (4, 1, 0)], "doc_id bigint, quality int, toxic int")
