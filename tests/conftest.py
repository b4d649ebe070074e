import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from abstractmill.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Apply a column function to values of one input column, in order."""

    def run(fn, values, kind="string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, x {kind}")
        return [r["y"] for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]

    return run


@pytest.fixture(scope="session")
def python_bytes():
    """Bytes that the Python steps of a plan without shuffles are sent, by a run of it."""

    def sent(node):
        own, below = node.metrics().get("pythonDataSent"), node.children()
        return (own.get().value() if own.isDefined() else 0) + sum(sent(below.apply(i)) for i in range(below.size()))

    def run(df):
        df._jdf.collectToPython()
        return sent(df._jdf.queryExecution().executedPlan())

    return run
