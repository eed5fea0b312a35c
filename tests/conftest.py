import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortkit.plans.store import CohortStore
from cohortkit.session import build_session, scratch_path


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(root / "scratch"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def new_store(spark) -> CohortStore:
    """An empty cohort store in its own database."""
    database, folder = f"db_{uuid.uuid4().hex[:12]}", scratch_path(spark, "store")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    return CohortStore(database, folder)


@pytest.fixture()
def store(spark):
    return new_store(spark)
