import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

# Started before test modules are read, as they build columns at module level.
SESSION = (
    SparkSession.builder.master("local[4]")
    .appName("tests")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.driver.memory", "6g")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="turnmill-tests-"))
    .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    .getOrCreate()
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def values(spark):
    """Evaluate a column expression over a list of single values."""
    def run(inputs, expression, schema="x string"):
        numbered = [(i, x) for i, x in enumerate(inputs)]
        df = spark.createDataFrame(numbered, f"i long, {schema}")
        return [r[1] for r in df.select("i", expression.alias("y")).orderBy("i").collect()]
    return run
