import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "local[4]", "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    """Sorted rows of a DataFrame as tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def plan():
    """The physical plan of a DataFrame as text."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
