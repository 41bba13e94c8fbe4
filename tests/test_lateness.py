"""Late events against a plain loop in arrival order."""

import functools
import random

import pytest
from conftest import at, event, offset
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewindow.operators import lateness, ordered
from tidewindow.operators.lateness import LatePolicy


def by_loop(rows, bound=5, width=60):
    """``{event_id: watermark}`` and the ids of late events."""
    seen, marks, late = None, {}, set()
    for r in sorted(rows, key=lambda r: (r["ingest_ts"], r["event_id"], r["event_ts"])):
        ts = offset(r["event_ts"].replace(tzinfo=None))
        marks[r["event_id"]] = None if seen is None else round(seen - bound, 6)
        if seen is not None and (ts // width) * width + width <= seen - bound:
            late.add(r["event_id"])
        seen = ts if seen is None else max(seen, ts)
    return marks, late


def check(events_of, rows, policy=LatePolicy()):
    df = events_of(rows)
    marks, late = by_loop(rows, policy.bound_seconds, policy.width_seconds)
    tagged = {r.event_id: r.is_late for r in lateness.tag_late(df, policy).collect()}
    assert len(tagged) == len(rows)
    assert {i for i, flag in tagged.items() if flag} == late
    trace = lateness.watermark_trace(df, policy).collect()
    assert {r.event_id: offset(r.watermark) for r in trace} == marks
    assert {r.event_id for r in trace if r.is_late} == late
    full = {r.event_id: r for r in lateness.late_events(df, policy).collect()}
    assert set(full) == late
    for r in full.values():
        assert offset(r.watermark) == marks[r.event_id]
        assert r.late_by_ms == round((offset(r.watermark) - offset(r.window_end)) * 1000)
    return late


def test_window_end_equal_to_watermark_is_late(events_of):
    rows = [event("a", 65.0, 0), event("b", 59.999, 1)]
    assert check(events_of, rows) == {"b"}
    rows = [event("a", 64.999, 0), event("b", 59.999, 1)]
    assert check(events_of, rows) == set()


def test_first_event_is_never_late(events_of):
    assert check(events_of, [event("a", -5000, 0)]) == set()


def test_order_within_one_millisecond_is_by_id(events_of):
    rows = [event("b", 300, 0), event("a", 0, 0), event("c", 0, 0)]
    assert check(events_of, rows) == {"c"}


def test_one_arrival_time_for_everything(events_of):
    """A bulk load: one hot instant, ordered by id alone."""
    rng = random.Random(3)
    rows = [event(f"{i:04d}", rng.randrange(0, 900), 0) for i in range(400)]
    assert check(events_of, rows)


def test_one_early_jump_makes_the_rest_late(events_of):
    rows = [event("000", 100_000, 0), *[event(f"{i:03d}", i, i) for i in range(1, 200)]]
    assert len(check(events_of, rows)) == 199


def test_copies_do_not_close_windows_for_each_other(events_of):
    rows = [event("a", 10, 0), event("b", 70, 1)]
    df = events_of(rows + [rows[1]] * 50)
    assert lateness.tag_late(df).where("is_late").count() == 0
    assert lateness.tag_late(df).count() == 52


def test_other_bound_and_width(events_of):
    rng = random.Random(5)
    rows = [event(f"{i:03d}", max(0, i * 7 - rng.randrange(0, 400)), i * 7) for i in range(200)]
    for policy in (LatePolicy(0, 60), LatePolicy(90, 300), LatePolicy(70, 10)):
        check(events_of, rows, policy)
    assert not check(events_of, rows, LatePolicy(bound_seconds=10_000))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(0, 1200), st.integers(0, 40)), min_size=1, max_size=60
    )
)
def test_any_arrival_order(events_of, pairs):
    rows = [event(f"{i:03d}", s / 2, a) for i, (s, a) in enumerate(pairs)]
    check(events_of, rows)


def test_on_time_and_late_are_everything(events_of):
    rng = random.Random(1)
    rows = [event(i, rng.randrange(0, 3000), rng.randrange(0, 3000)) for i in range(300)]
    df = events_of(rows)
    kept = {r.event_id for r in lateness.on_time(df).collect()}
    late = {r.event_id for r in lateness.late_only(df).collect()}
    assert kept | late == {r["event_id"] for r in rows} and not kept & late


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_sized_join_is_the_same_either_way(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000).selectExpr("id % 7 AS k", "id")
        small = spark.range(5).selectExpr("id AS k", "id * 10 AS v")
        joined = ordered.join_sized(big, small, ["k"], limit=limit)
        found = sorted(map(tuple, joined.collect()), key=repr)
        plan = joined._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == sorted(
        [(i % 7, i, i % 7 * 10 if i % 7 < 5 else None) for i in range(1000)], key=repr
    )
    assert ("BroadcastHashJoin" in plan) == (limit > 0)


def test_late_flag_beyond_the_broadcast_limit(spark, events_of, monkeypatch):
    """Most events in one minute, the table of closers joined by shuffling."""
    rng = random.Random(12)
    rows = [event(f"{i:03d}", rng.randrange(0, 60), rng.randrange(0, 400)) for i in range(200)]
    rows += [event(f"x{i:02d}", i * 20, i * 20) for i in range(20)]
    monkeypatch.setattr(lateness, "join_sized", functools.partial(ordered.join_sized, limit=0))
    monkeypatch.setattr(lateness, "measured", functools.partial(ordered.measured, limit=0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert len(check(events_of, rows)) > 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("crowded", [0, 1_000_000])
def test_one_arrival_time_for_all(spark, monkeypatch, crowded):
    """A load that gives all events one arrival time, in the order of a number or not."""
    monkeypatch.setattr(lateness, "CROWDED_ROWS", crowded)
    rng = random.Random(4)
    rows = [(f"{i:03d}", at(rng.randrange(0, 900)), at(1000), i) for i in range(200)]
    events = spark.createDataFrame(rows, "event_id string, event_ts timestamp, ingest_ts timestamp, seq long")
    policy = lateness.LatePolicy(arrival=("ingest_ts", "seq"))
    seen, late = None, set()
    for name, ts, _, _ in rows:
        end = (offset(ts.replace(tzinfo=None)) // 60 + 1) * 60
        if seen is not None and end <= seen - 5:
            late.add(name)
        value = offset(ts.replace(tzinfo=None))
        seen = value if seen is None else max(seen, value)
    assert late and {r.event_id for r in lateness.late_only(events, policy).collect()} == late
