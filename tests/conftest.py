import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sightline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "tests", "8", 4, "4g", **{"spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"}
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def frame(spark):
    """DataFrame from rows and a schema string."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def pairs(df, key, value):
    return {row[key]: row[value] for row in df.collect()}
