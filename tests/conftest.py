import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def event_log_dir(tmp_path_factory):
    return str(tmp_path_factory.mktemp("event-log"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory, event_log_dir):
    session = build_session(
        "tests", 8, 4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__eventLog__enabled="true", spark__eventLog__dir=f"file://{event_log_dir}",
        spark__eventLog__compress="false", spark__eventLog__rolling__enabled="false")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as a sorted list of tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))

    return collect
