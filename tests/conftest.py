import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rillhouse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", "tests", extra={
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def no_views_left():
    """Temporary views of one file's tests show up in the table lists of the next one."""
    yield
    if session := SparkSession.getActiveSession():
        for table in session.catalog.listTables():
            if table.isTemporary:
                session.catalog.dropTempView(table.name)
