import pathlib
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from quirefold.session import ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Values of an expression over one string column ``x``."""
    def run(values, expression):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
        return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]
    return run
