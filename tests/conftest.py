import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from touchline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "touchline-tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Evaluate a Column function over a list of texts."""
    from pyspark.sql import functions as F

    def run(function, texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
        rows = rows.select("i", function(F.col("text")).alias("value")).orderBy("i")
        return [row.value for row in rows.collect()]

    return run
