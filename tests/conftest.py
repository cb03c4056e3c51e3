from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfmark.session import get_spark, scratch_path  # noqa: E402

TESTDATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = get_spark(
        "tests", "local[4]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def folder(spark):
    """Fresh paths under the shared scratch folder."""
    return lambda label: scratch_path(spark, f"test-{label}")


@pytest.fixture
def table(spark, folder):
    """Fresh table names with a path for their files."""
    made = []

    def make(name: str):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        made.append(name)
        return name, folder(name)

    yield make
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
