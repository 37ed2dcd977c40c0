from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from starpipe.session import build_session  # noqa: E402
from starpipe.sources.readers import frame_source  # noqa: E402
from starpipe.workspace import materialise  # noqa: E402
from tests.world import WORLD, frames  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def world(spark):
    """The hand-written source relations, as files."""
    return frame_source({n: materialise(df, n) for n, df in frames(spark, WORLD).items()})


@pytest.fixture
def make(spark):
    """DataFrame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
