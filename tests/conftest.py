import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from verdigrid.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "verdigrid-tests",
        master="local[8]",
        shuffle_partitions=8,
        checkpoint_dir=tempfile.mkdtemp(prefix="verdigrid-tests-"),
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="verdigrid-warehouse-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from verdigrid.plans.registry import Tables

    return Tables(spark, SMALL)


@pytest.fixture
def rows():
    """Rows of a table as a sorted list of plain tuples."""

    def collected(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collected
