import math
import random

import numpy as np
import pytest
from conftest import at, event, offset
from pyspark.sql import functions as F

from tidewindow.contract import METRIC_SCHEMA
from tidewindow.operators import health, metrics, ordered, repair, serving, sessions
from tidewindow.operators.lateness import LatePolicy


def as_counts(df):
    return {
        (offset(r.window_start), r.campaign_id, r.geo, r.device): r.event_count
        for r in df.collect()
    }


def test_nulls_are_counted_under_their_names(events_of):
    rows = [event(1, 0, campaign_id=None, geo=None, device=None), event(2, 59.999), event(3, 60)]
    assert as_counts(metrics.windowed_counts(events_of(rows))) == {
        (0, "organic", "unknown", "unknown"): 1,
        (0, "camp_1", "US", "mobile"): 1,
        (60, "camp_1", "US", "mobile"): 1,
    }


def test_separator_inside_a_value(events_of):
    rows = [event(1, 0, campaign_id="a|b", geo="c"), event(2, 0, campaign_id="a", geo="b|c")]
    assert len(as_counts(metrics.windowed_counts(events_of(rows)))) == 2


def test_windows_before_the_epoch(events_of):
    seconds = -1_704_067_200 - 30  # half a minute before 1970
    counts = as_counts(metrics.windowed_counts(events_of([event(1, seconds)])))
    assert list(counts)[0][0] == -1_704_067_200 - 60


def test_schema_and_forms_agree(events_of):
    rng = random.Random(2)
    rows = [
        event(i, rng.randrange(0, 2000), campaign_id="hot" if i % 3 else f"camp_{i % 5}")
        for i in range(600)
    ]
    df = events_of(rows)
    plain = metrics.windowed_counts(df)
    assert [(f.name, f.dataType) for f in plain.schema] == [
        (f.name, f.dataType) for f in METRIC_SCHEMA
    ]
    assert as_counts(metrics.salted_counts(df)) == as_counts(plain)
    five = metrics.windowed_counts(df, 300)
    assert as_counts(metrics.roll_up(plain, 300)) == as_counts(five)
    half = metrics.windowed_counts(df.where("event_id % 2 = 0"))
    rest = metrics.windowed_counts(df.where("event_id % 2 = 1"))
    assert as_counts(metrics.merge_by_sum(half, rest)) == as_counts(plain)


def test_session_gap_boundary(events_of):
    rows = [event(1, 0), event(2, 1800), event(3, 3600.001), event(4, 9000, event_type="purchase")]
    found = sorted(
        (offset(r.session_start), offset(r.session_end), r.events, r.purchases, r.duration_ms)
        for r in sessions.session_summary(events_of(rows)).collect()
    )
    assert found == [
        (0, 1800, 2, 0, 1_800_000),
        (3600.001, 3600.001, 1, 0, 0),
        (9000, 9000, 1, 1, 0),
    ]


def test_sessions_against_a_loop(events_of):
    rng = random.Random(9)
    rows, expected = [], []
    for user in ("hot", "cold"):
        times = sorted(rng.randrange(0, 400_000) / 4 for _ in range(500 if user == "hot" else 40))
        rows += [event(f"{user}{i}", t, user_id=user) for i, t in enumerate(times)]
        current = []
        for t in times:
            if current and t - current[-1] > 100:
                expected.append((user, current[0], current[-1], len(current)))
                current = []
            current.append(t)
        expected.append((user, current[0], current[-1], len(current)))
    found = [
        (r.user_id, offset(r.session_start), offset(r.session_end), r.events)
        for r in sessions.session_summary(events_of(rows), gap_seconds=100).collect()
    ]
    assert sorted(found) == sorted(expected)


def test_exact_quantiles(spark):
    rng = random.Random(4)
    values = [("a", rng.choice([0, 0, 0, 5, 70_000, 200_000, -3, rng.randrange(0, 10**6)])) for _ in range(501)]
    values += [("b", 42)]
    df = spark.createDataFrame(values, "g string, v long")
    rows = ordered.exact_quantiles(df, "v", ["g"], {"p50": 0.5, "p95": 0.95, "p99": 0.99}).collect()
    for r in rows:
        own = [v for g, v in values if g == r.g]
        assert (r.events, r.max_v) == (len(own), max(own))
        for name, q in (("p50_v", 50), ("p95_v", 95), ("p99_v", 99)):
            assert math.isclose(r[name], np.percentile(own, q), abs_tol=1e-6)


def test_running_max_before(spark):
    rng = random.Random(8)
    rows = [(rng.choice([0, 0, 0, rng.randrange(50)]), i, rng.randrange(1000)) for i in range(2000)]
    df = spark.createDataFrame(rows, "t int, i int, v int").repartition(5)
    best, expected = None, {}
    for _, i, v in sorted(rows):
        expected[i] = best
        best = v if best is None else max(best, v)
    found = ordered.running_max_before(df, ["t", "i"], "v", "m").collect()
    assert {r.i: r.m for r in found} == expected


def test_slices_stay_even_with_copies(spark):
    """Half of all rows are one exact copy; no slice gets much more than its share."""
    df = spark.range(20_000, numPartitions=6).selectExpr("if(id % 2 = 0, 7, id) AS t", "1L AS v")
    ranged = ordered.even_ranges(df, ["t"])
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / 8
    seen = ordered.running_max_before(df, ["t"], "t", "m")
    assert seen.count() == 20_000
    assert seen.where("t = 7 AND m = 7").count() == 10_000  # one odd id is 7 too


def test_latest_by_key(spark):
    rows = [(1, "c", "g", "d", n, b) for n, b in ((5, 3), (9, 7), (1, 4))] + [(2, "c", "g", "d", 2, 1)]
    df = spark.createDataFrame(
        rows, "window_start int, campaign_id string, geo string, device string, n int, batch_id long"
    )
    assert sorted((r.window_start, r.n, r.batch_id) for r in serving.latest_by_key(df).collect()) == [
        (1, 9, 7), (2, 2, 1),
    ]


def test_latest_by_key_takes_whole_rows(spark):
    """Two rows of one version: all columns come from the same one."""
    rows = [(1, "c", "g", "d", n, -n, 7) for n in range(20)]
    df = spark.createDataFrame(
        rows, "window_start int, campaign_id string, geo string, device string, n int, m int, batch_id long"
    ).repartition(5)
    row = serving.latest_by_key(df).first()
    assert row.n == -row.m


def test_late_rate_alert(events_of):
    slow = [event(f"s{i}", -4000 + i, 10 + i) for i in range(7)]
    df = events_of([event("a", 0, 0), *slow])
    rows = health.late_rate(df).collect()
    assert [(offset(r.arrival_minute), r.late_out, r.alert) for r in rows] == [(0, 7, True)]
    few = health.late_rate(events_of([event("a", 0, 0), *slow[:6]])).collect()
    assert [(r.late_out, r.alert) for r in few] == [(6, False)]


def test_watermark_lag_averages_recent_samples(events_of):
    rows = [event(0, 0, 0), event(1, 30, 60), event(2, 60, 420), event(3, 1000, 1000)]
    found = {offset(r.arrival_minute): r for r in health.watermark_lag(events_of(rows)).collect()}
    assert found[0].lag_ms == 65_000
    assert found[60].lag_ms == 95_000 and found[60].avg_lag_5m_ms == 80_000
    assert found[420].lag_ms == 425_000 == found[420].avg_lag_5m_ms
    assert found[960].lag_ms == 25_000 and not found[960].alert


def test_reconcile_lists_only_differences(events_of):
    rows = [event(1, 0), event(2, 1), event(3, 60), event(4, 120)]
    cold = events_of(rows)
    late = events_of(rows[1:2])
    lost = metrics.windowed_counts(events_of([rows[0], rows[2]]))
    found = {
        offset(r.window_start): (r.hot_count, r.cold_count, r.late_count, r.unexplained)
        for r in repair.reconcile(lost, cold, late).collect()
    }
    assert found == {0: (1, 2, 1, 0), 120: (0, 1, 0, 1)}


def test_replay_applies_once(events_of):
    counted = [event(1, 0), event(2, 1)]
    late = [event(3, 2), event(3, 2, arrives=9), event(2, 1, arrives=8)]
    merged = repair.replay_late(
        metrics.windowed_counts(events_of(counted)), events_of(late), events_of(counted)
    )
    assert as_counts(merged) == {(0, "camp_1", "US", "mobile"): 3}


def test_policy_key_ends_with_event_time():
    assert LatePolicy(arrival=("a", "b")).key_columns == ["a", "b", "event_ts"]
    assert at(0).year == 2024


# ---- running maximum by slices


def plain_running_max(rows):
    """``rows``: order columns, then the value; ties go by a number, so any of them comes first."""
    best, out = None, []
    for *order, value in sorted(rows, key=lambda r: [(x is not None, x) for x in r[:-1]]):
        out.append((*order, value, best))
        if value is not None and (best is None or value > best):
            best = value
    return out


@pytest.mark.parametrize("fan", [2, 32])
@pytest.mark.parametrize("size", [5, 40, 10_000])
def test_running_max_by_slices(spark, monkeypatch, size, fan):
    """Hot instants, nulls and groups of exact copies over slices of a few rows each."""
    monkeypatch.setattr(ordered, "SLICE_ROWS", size)
    monkeypatch.setattr(ordered, "SAMPLES", 2)
    monkeypatch.setattr(ordered, "FAN", fan)
    rng = random.Random(size)
    rows = [(rng.choice([None, *range(40), 7, 7, 7]), f"s{rng.randrange(500)}", i) for i in range(600)]
    rows = [(t, s, (hash((t, s)) % 1000) if t != 3 else None) for t, s, _ in rows]  # copies are equal as a whole
    rows += [(7, "hot", 990)] * 300
    df = spark.createDataFrame(rows, "t int, s string, v int").repartition(4)
    found = ordered.running_max_before(df, ["t", "s"], "v", "m").collect()

    def sort_key(r):
        return [(x is not None, x) for x in r]

    got = sorted((tuple(r) for r in found), key=lambda r: (sort_key(r[:2]), sort_key(r[3:])))
    want = sorted(plain_running_max(rows), key=lambda r: (sort_key(r[:2]), sort_key(r[3:])))
    assert got == want


def test_slices_are_even(spark, monkeypatch):
    """Neither a hot instant nor a third of all rows in exact copies makes a large slice."""
    monkeypatch.setattr(ordered, "SLICE_ROWS", 500)
    rows = [(1, f"{i:05d}") for i in range(3000)] + [(2, "copy")] * 3000 + [(3 + i, "x") for i in range(3000)]
    df = spark.createDataFrame(rows, "t int, s string").withColumn("_number", F.monotonically_increasing_id())
    sizes = [r["count"] for r in df.groupBy(ordered.slice_of(df, ["t", "s"], "_number", 9000)).count().collect()]
    assert sum(sizes) == 9000 and len(sizes) >= 14 and max(sizes) <= 3 * 500


def test_running_max_moves_rows_once(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SLICE_ROWS", 100)
    df = spark.range(1000).selectExpr("id AS t", "id % 7 AS v")
    out = ordered.running_max_before(df, ["t"], "v", "m")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan
    whole = out._jdf.queryExecution().sparkPlan().toString()
    assert whole.count("Window [max(v") == 1 and whole.count("Scan ExistingRDD") == 2
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in final.split("Initial Plan")[0].splitlines() if "Exchange hashpartitioning(_slice" in x]
    # the rows themselves, and the maxima of the slices
    assert len(moved) == 2, final


def test_merged_sketches_keep_their_rank_error(spark, tmp_path):
    """Many batches of skewed values against exact ranks and exact quantiles."""
    from tidewindow.operators import sketches

    rows = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 'a', 'b') AS g", "cast(pow(id % 9973, 2) AS long) AS delay_ms", "id % 12 AS batch"
    )
    path = str(tmp_path / "s")
    for batch in range(12):
        sketches.write_sketches(rows.where(F.col("batch") == batch), ["g"], path, batch)
    sketches.write_sketches(rows.where("batch = 0"), ["g"], path, 0)  # a repeated batch
    found = sketches.merged_quantiles(sketches.read_sketches(spark, path), ["g"])
    exact = {r.g: r for r in ordered.exact_quantiles(rows, "delay_ms", ["g"], sketches.PROBABILITIES).collect()}
    for r in found.collect():
        assert (r.events, r.max_delay_ms) == (exact[r.g].events, exact[r.g].max_delay_ms)
    errors = sketches.rank_errors(rows, found, ["g"]).collect()
    assert len(errors) == 2 and all(0 <= e <= sketches.RANK_ERROR for r in errors for e in tuple(r)[2:])
