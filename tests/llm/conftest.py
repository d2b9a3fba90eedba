import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, blanks, long texts, repeated rows and columns of clashing names."""
    df = spark.createDataFrame(brute.messy_rows(), brute.DOCS)
    for name in brute.CLASHING:
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], brute.DOCS)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_labels(spark):
    return spark.read.parquet(f"{SF_SMALL}/labels.parquet")
