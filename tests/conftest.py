import datetime as dt
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tidewindow.contract import EVENT_SCHEMA  # noqa: E402
from tidewindow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


@pytest.fixture(scope="session")
def spark():
    os.environ["TZ"] = "UTC"
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def event(event_id, seconds, arrives=None, **changes):
    """An event ``seconds`` after the start; it arrives then, or at ``arrives``."""
    row = {
        "event_id": str(event_id),
        "user_id": "user_1",
        "session_id": "sess_user_1_1",
        "event_type": "view",
        "event_ts": None if seconds is None else at(seconds),
        "ingest_ts": at(seconds if arrives is None else arrives),
        "source": "test",
        "campaign_id": "camp_1",
        "device": "mobile",
        "geo": "US",
        "schema_version": "v1",
    }
    return {**row, **changes}


@pytest.fixture(scope="session")
def events_of(spark):
    def build(rows):
        names = EVENT_SCHEMA.names
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], EVENT_SCHEMA)

    return build


def offset(value):
    """Seconds after the start of a collected timestamp."""
    if value is None:
        return None
    return (value.replace(tzinfo=dt.timezone.utc) - START).total_seconds()
