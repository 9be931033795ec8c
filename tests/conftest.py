import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from regispark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(scratch / "checkpoints"),
            "spark.sql.warehouse.dir": str(scratch / "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan(df):
    """Final physical plan as text."""
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def explain():
    return lambda df: df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def optimized():
    return lambda df: df._jdf.queryExecution().optimizedPlan().toString()
