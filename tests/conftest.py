import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    checkpoints = tmp_path_factory.mktemp("checkpoints")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(warehouse))
        .config("spark.checkpoint.dir", str(checkpoints))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def workspace(spark):
    from stratiscore.sources.staging import Workspace

    return Workspace(spark)


@pytest.fixture()
def table(spark):
    """A frame from rows and a schema text."""
    from stratiscore.sources.staging import local_rows

    return lambda schema, *rows: local_rows(spark, schema, list(rows))


@pytest.fixture()
def plan_of():
    """Physical plan of a frame as text, before adaptive execution changes it."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
