import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from placeweave.session import configure

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture(params=["broadcast", "shuffle"])
def limit(request, spark):
    """Both join forms: hinted within the limit, and fully shuffled with Spark's own broadcast switched off."""
    from placeweave.operators.sizing import NEVER, BroadcastLimit

    if request.param == "broadcast":
        yield BroadcastLimit()
        return
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in thresholds:
        spark.conf.set(name, "-1")
    yield NEVER
    for name in thresholds:
        spark.conf.unset(name)
