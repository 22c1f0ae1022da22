import os
import sys

import pytest
from pyspark.sql import SparkSession

HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HOME)
# Python workers start elsewhere.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, (HOME, os.environ.get("PYTHONPATH"))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("triprollup-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(home / "checkpoints"))
    yield session
    session.stop()


@pytest.fixture
def lines_of(spark):
    """A frame of messages from texts."""

    def build(*texts):
        return spark.createDataFrame([(t,) for t in texts], "value string").coalesce(2)

    return build


# Sample values of one trip line.
FIELDS = [
    "2", "2019-07-04 09:15:30", "2019-07-04 09:41:05", "2", "6.5",
    "-71.05", "42.36", "5", "Y", "-71.12", "42.38", "2",
    "21.0", "1.5", "0.25", "4.0", "2.0", "0.75", "29.5",
]


def line(**changed):
    from triprollup.schemas import TRIP_COLUMNS

    return ",".join(changed.get(n, v) for n, v in zip(TRIP_COLUMNS, FIELDS))
