import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaugewright.session import build_session, clean_work  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "3g",
        "spark.checkpoint.dir": str(base / "shared"),
        "spark.sql.warehouse.dir": str(base / "warehouse"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clean_work(session)
    session.stop()


def plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
