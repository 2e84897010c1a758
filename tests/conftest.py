import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pulsegrid.sources.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def minutes(spark):
    """Builds a minute table from tuples (subject_id, date, time, hr), ordered as given."""

    def build(*rows):
        numbered = [(at, *row) for at, row in enumerate(rows)]
        schema = "src_order long, subject_id string, date string, time string, hr string"
        return spark.createDataFrame(numbered, schema)

    return build


def rows(df, *order):
    """The rows as tuples, in the order of the named columns or of all."""
    found = [tuple(r) for r in df.select(*order).collect()] if order else [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))
