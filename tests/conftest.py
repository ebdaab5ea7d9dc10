import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from curbair.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", shuffle_partitions=4, settings={
            "spark.ui.enabled": "false",
            "spark.sql.maxMetadataStringLength": "5000",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        })
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in selected.collect()),
                  key=lambda r: tuple((v is None, str(v)) for v in r))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
