import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemart import schemas
from tidemart.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session("tests", 8, **{"spark.checkpoint.dir": str(shared)})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Rows given as dicts, in the columns and types of a schema; absent fields are null."""

    def make(schema, rows):
        names = schema.names
        return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)

    return make


@pytest.fixture(scope="session")
def base(frame):
    """Base posting rows with defaults for everything not named."""
    defaults = {
        "geo_id": "G",
        "geo_name": "G",
        "industry_id": "I",
        "industry_name": "I",
        "role_id": "R",
        "role_name": "r",
        "skill_id": "UNK",
        "skill_name": "Unknown",
        "posting_count": 1,
    }

    def make(rows):
        return frame(schemas.BASE_POSTINGS, [{**defaults, **row} for row in rows])

    return make


@pytest.fixture(scope="session")
def raw_source(frame):
    def make(rows):
        from pyspark.sql import types as T

        schema = T.StructType([*schemas.POSTINGS, *schemas.SKILL_COLUMNS])
        return frame(schema, rows)

    return make
