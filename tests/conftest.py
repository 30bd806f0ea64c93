"""One local session for all tests; workers find the package on PYTHONPATH."""

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lakewright.session import session

    shared = tmp_path_factory.mktemp("shared")
    spark = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": f"file://{shared}", "spark.sql.warehouse.dir": f"file://{shared}/warehouse",
    })
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
