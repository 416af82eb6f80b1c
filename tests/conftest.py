import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("linkrank-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def split_hubs(monkeypatch):
    """Treat small groups as hot: every join and adjacency row splits as it would at scale."""
    monkeypatch.setattr("linkrank.plans.skew.HOT_ROWS", 5)
    monkeypatch.setattr("linkrank.functions.columns.LINKS_PER_PART", 4)


@pytest.fixture(scope="session")
def tables():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
