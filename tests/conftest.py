import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tableferry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        shuffle_partitions=8,
        extra={
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    saved = {}

    def set_all(settings):
        for name, value in settings.items():
            saved.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_all
    for name, value in saved.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def final_plan():
    """Run a query and give the plan adaptive execution ended with."""

    def run(df):
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        return text.split("== Initial Plan ==")[0]

    return run


@pytest.fixture
def first_plan():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
