"""Every registered query against its SQL on the smallest tables."""

import pytest
from conftest import SF_SMALL
from oracle_check import database, oracle_rows, spark_rows

import __spark_entry__ as entry_point
from tidewindow.plans.catalog import QUERIES
from tidewindow.plans.oracle import ORACLE

KINDS = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def db():
    return database(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF_SMALL)
    described = db.execute(f"DESCRIBE {ORACLE[name]}").fetchall()
    assert {c: KINDS[k] for c, k in df.dtypes} == {d[0]: d[1] for d in described}
    found = spark_rows(df)
    assert found == oracle_rows(db, ORACLE[name])
    assert found[1], "two empty results say nothing"


def test_known_counts(spark):
    """Row counts stated in FIXTURES.md."""
    counts = {n: QUERIES[n](spark, SF_SMALL).count() for n in ("scan_events", "metrics_1m", "late_events")}
    assert counts == {"scan_events": 1000, "metrics_1m": 1000, "late_events": 5}


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    assert QUERIES.items() <= entry_point.queries().items()
    assert ORACLE.items() <= entry_point.oracle_sql().items()


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == [
        "window_start", "window_end", "campaign_id", "geo", "device", "event_count", "revenue",
    ]
    assert df.count() == 1000
