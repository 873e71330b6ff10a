import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from postsieve.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        configure(SparkSession.builder.master("local[4]").appName("postsieve-tests"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
