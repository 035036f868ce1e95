import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from starledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def large(monkeypatch):
    """Makes every side too large to broadcast, so that the shuffled plans run."""
    import starledger.operators.skew as skew

    monkeypatch.setattr(skew, "measured_small", lambda df, *bounds: False)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
