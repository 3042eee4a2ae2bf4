from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session("tests", checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    yield spark
    spark.stop()


@pytest.fixture
def plan():
    """The formatted physical plan of a frame as text."""

    def text(df) -> str:
        return df._jdf.queryExecution().explainString(
            df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )

    return text
