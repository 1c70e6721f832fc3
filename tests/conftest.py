import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from shipreport.session import apply_settings

    session = (
        SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g").config("spark.sql.maxMetadataStringLength", "5000").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_settings(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
