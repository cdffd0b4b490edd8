import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

DATA = Path("/root/testdata")
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from cartwheel.plans.session import prepare_streaming

    session = (
        SparkSession.builder.master("local[8]")
        .appName("cartwheel-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare_streaming(session)
    session.stop()


def at(minutes: float) -> datetime:
    return START + timedelta(minutes=minutes)


def minutes(ts: datetime) -> float:
    """Minutes since START of a collected (naive UTC) or aware timestamp."""
    aware = ts if ts.tzinfo else ts.replace(tzinfo=timezone.utc)
    return (aware - START).total_seconds() / 60
