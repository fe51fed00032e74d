import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from changeflow.session import local_session  # noqa: E402
from changeflow.sources.changes import MESSAGE_SCHEMA  # noqa: E402
from changeflow.sources.decode import decode_json_rows, ingest_project  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        8, shuffle_partitions=4, **{"spark.checkpoint.dir": shared, "spark.driver.memory": "4g"}
    )
    yield session
    session.stop()


@pytest.fixture
def messages(spark):
    """JSON objects (or raw text, or None) -> messages; the position is the order."""

    def build(events, start=0):
        rows = [
            (e if e is None or isinstance(e, str) else json.dumps(e), start + i)
            for i, e in enumerate(events)
        ]
        return spark.createDataFrame(rows, MESSAGE_SCHEMA)

    return build


@pytest.fixture
def history(messages):
    def build(spec, events):
        return ingest_project(decode_json_rows(messages(events), spec), spec)

    return build


def rows(df):
    return [tuple(r) for r in df.collect()]
