import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sheetloom.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
    }
    session = get_spark("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def evaluate(spark):
    """Apply a column expression to a list of texts."""
    from pyspark.sql import functions as F

    def run(expression, values, type_="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {type_}")
        result = rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
        return [r["r"] for r in result]

    return run
