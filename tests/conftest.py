import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from crawlspark.session import build_session  # noqa: E402


# column expressions at module level need a running session
SPARK = build_session(
    "tests",
    "local[8]",
    **{
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
    },
)
SPARK.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SPARK
    SPARK.stop()


@pytest.fixture(scope="session")
def ask(spark):
    """Values of column expressions over rows of one string column ``x`` (or given columns)."""

    def run(rows, expr, schema="x string"):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
        return [r[0] for r in df.select(expr.alias("y"), "i").orderBy("i").select("y").collect()]

    return run
