import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fieldnotes.session import build_session  # noqa: E402
from tests.support import SMOKE_DIR  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[4]", app="fieldnotes-tests", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_DIR


@pytest.fixture
def raw_df(spark):
    from fieldnotes.functions import row_id
    from fieldnotes.schemas import RAW_OBSERVATION, conform

    def make(rows):
        df = spark.createDataFrame([tuple(r[f.name] for f in RAW_OBSERVATION) for r in rows], RAW_OBSERVATION)
        return conform(df.withColumn("id", row_id()), RAW_OBSERVATION)
    return make
