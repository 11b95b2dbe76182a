import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bookbase.session import get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": 4, "spark.ui.enabled": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def one(spark):
    """Value of a Column expression for one string."""
    from pyspark.sql import functions as F

    def run(make, *texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        out = [r["v"] for r in df.select("i", make(F.col("t")).alias("v")).orderBy("i").collect()]
        return out if len(texts) > 1 else out[0]

    return run
