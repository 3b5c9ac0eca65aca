import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from talkloom import prepare_session  # noqa: E402
from talkloom.plans.store import Store  # noqa: E402

RUN_TS = "2026-01-02T03:04:05Z"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("talkloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    prepare_session(session)
    yield session
    session.stop()


@pytest.fixture
def store(tmp_path):
    return Store(str(tmp_path / "store"))


def rows_of(df, *columns):
    """Rows as tuples, sorted, for comparing whole results."""
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())


def metrics_of(df):
    return {(r.metric, r.key): r.value for r in df.collect()}
