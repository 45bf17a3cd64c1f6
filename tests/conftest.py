from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import spark_session  # noqa: E402


def make_spark():
    spark = spark_session(
        "tidemark-tests",
        **{
            "spark.master": f"local[{os.environ.get('TEST_CPUS', '8')}]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.sql.ui.retainedExecutions": "10000",  # tests count executions from a session's start
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_spark()
