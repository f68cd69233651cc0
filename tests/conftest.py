import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from smeltwork.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def many_slices(spark):
    """Keep shuffle partitions apart, so range slices stay several on small data."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def rows_of(frame) -> list[tuple]:
    return sorted((tuple(row) for row in frame.collect()), key=repr)
