import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from compare import database, session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from drayage.scratch import release

    spark = session(4)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    release(spark)
    spark.stop()


@pytest.fixture(scope="session")
def connection():
    return database(SF_DIR)


@pytest.fixture
def landed(spark):
    """A landed table from bodies, given as text or as (key, page, status, body)."""
    from drayage.landed import LANDED_SCHEMA

    def build(*answers):
        rows = []
        for number, answer in enumerate(answers):
            key, page, status, body = answer if isinstance(answer, tuple) else ("k", number, 200, answer)
            rows.append(("s", key, page, None, status, body))
        return spark.createDataFrame(rows, LANDED_SCHEMA)

    return build
