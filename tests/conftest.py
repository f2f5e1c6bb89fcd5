import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(frame):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="session")
def as_rows():
    return rows


@pytest.fixture(scope="session")
def physical():
    """The physical plan of a DataFrame as text."""
    return lambda frame: frame._jdf.queryExecution().executedPlan().toString()
