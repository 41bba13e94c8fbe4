import dataclasses
import json

import pytest
from conftest import event
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewindow import contract as C
from tidewindow.functions import envelope
from tidewindow.operators import quality


def test_conform_fills_defaults_and_casts(spark):
    old = spark.sql(
        "SELECT 7L AS event_id, 'u' AS user_id, 's' AS session_id, 'view' AS event_type, "
        "timestamp'2024-01-01' AS event_ts, timestamp'2024-01-01' AS ingest_ts, 1 AS other"
    )
    row = C.conform(old).first()
    assert C.conform(old).columns == C.EVENT_COLUMNS
    assert (row.event_id, row.source, row.device, row.geo) == ("7", "unknown", "unknown", "unknown")
    assert row.schema_version == "v1" and row.campaign_id is None


def test_compatible_changes_pass():
    optional = C.Field("referrer", T.StringType(), required=False)
    without_campaign = tuple(f for f in C.CLICK_EVENT if f.name != "campaign_id")
    assert C.breaking_changes(C.CLICK_EVENT, (*C.CLICK_EVENT, optional)) == []
    assert C.breaking_changes(C.CLICK_EVENT, without_campaign) == []


def test_breaking_changes_are_named():
    price = C.Field("price", T.DoubleType())
    changed = tuple(
        dataclasses.replace(f, dtype=T.IntegerType()) if f.name == "geo" else f
        for f in C.CLICK_EVENT
        if f.name != "user_id"
    )
    assert C.breaking_changes(C.CLICK_EVENT, (*changed, price)) == [
        ("geo", "changed_type"),
        ("price", "added_required"),
        ("user_id", "dropped_required"),
    ]


def test_widened_type_passes():
    old = (C.Field("n", T.IntegerType()),)
    assert C.breaking_changes(old, (C.Field("n", T.LongType()),)) == []
    assert C.breaking_changes((C.Field("n", T.LongType()),), old) == [("n", "changed_type")]


def test_reader_schema():
    schema = json.loads(C.avro_schema())
    fields = {f["name"]: f for f in schema["fields"]}
    assert list(fields) == C.EVENT_COLUMNS
    assert fields["event_ts"] == {"name": "event_ts", "type": "long"}
    assert fields["campaign_id"] == {"name": "campaign_id", "type": ["null", "string"], "default": None}
    assert fields["geo"]["default"] == "unknown" and "default" not in fields["user_id"]


def test_violations_count_rows(events_of):
    good = events_of([event(1, 0), event(2, 1)])
    assert C.contract_violations(good).collect() == []
    bad = events_of([event(1, 0, user_id=None), event(2, 1, user_id=None), event(3, 2, geo=None)])
    found = {(r.column_name, r.rule): r.rows for r in C.contract_violations(bad).collect()}
    assert found == {("user_id", "null_in_required"): 2, ("geo", "null_in_required"): 1}


def test_poison_names_the_first_null(events_of):
    rows = events_of([
        event(1, 0),
        event(2, 0, user_id=None),
        event(3, None, 5),
        event(4, 0, campaign_id=None, geo=None, device=None),
    ])
    reasons = dict(rows.select("event_id", C.poison_reason()).collect())
    assert reasons == {"1": None, "2": "null_user_id", "3": "null_event_ts", "4": None}


def test_envelope_fixtures(spark):
    texts = ["000000002A0203", "010000002A0203", "0000", None, "00FFFFFFFF"]
    raw = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", F.unhex("t").alias("value")
    )
    rows = {r.t: r for r in envelope.unwrap(raw).collect()}
    good = rows["000000002A0203"]
    assert (good.envelope_status, good.schema_id, bytes(good.body)) == ("ok", 42, b"\x02\x03")
    assert rows["010000002A0203"].envelope_status == "bad_magic"
    assert rows["0000"].envelope_status == "too_short"
    assert rows[None].envelope_status == "missing"
    # the id is unsigned, the body may be empty
    assert (rows["00FFFFFFFF"].schema_id, bytes(rows["00FFFFFFFF"].body)) == (4294967295, b"")
    assert all(r.schema_id is None for t, r in rows.items() if r.envelope_status != "ok")


def test_envelope_round_trip(spark):
    raw = spark.range(1).select(envelope.wrap(F.lit(b"abc"), 258).alias("value"))
    row = envelope.unwrap(raw).first()
    assert bytes(row.value) == b"\x00\x00\x00\x01\x02abc"
    assert (row.schema_id, bytes(row.body)) == (258, b"abc")


def test_json_messages_round_trip(events_of, spark):
    sent = events_of([event(1, 0.25), event(2, 1, campaign_id=None)])
    text = sent.select(quality.json_value(C.EVENT_COLUMNS).alias("value"))
    back, poison = quality.split_poison(quality.parse_json_events(text))
    assert sorted(back.select(*C.EVENT_COLUMNS).collect()) == sorted(sent.collect())
    assert poison.count() == 0
    broken = spark.createDataFrame([("{\"event_id\": ",), (None,), ("{}",)], "value string")
    reasons = quality.split_poison(quality.parse_json_events(broken))[1]
    assert sorted(r.reason for r in reasons.collect()) == ["malformed", "missing", "null_event_id"]


def test_dedup_keeps_earliest_arrival(events_of):
    copies = [event(1, 0, arrives=n, device=d) for n, d in ((9, "tablet"), (3, "mobile"), (7, "desktop"))]
    rows = quality.dedup_events(events_of([*copies, event(2, 5)])).collect()
    assert sorted((r.event_id, r.device) for r in rows) == [("1", "mobile"), ("2", "mobile")]


def test_dedup_keeps_rows_without_a_key(events_of):
    rows = [
        {**event(1, 0), "event_id": None}, {**event(2, 0), "event_id": None},
        event("a", 5, 9), event("a", 5, 7), event("a", 5, 7), event("b", 1, geo=None), event("b", 1, geo=None),
    ]
    kept = quality.dedup_events(events_of(rows)).collect()
    assert sorted((r.event_id or "") for r in kept) == ["", "", "a", "b"]
    first = next(r for r in kept if r.event_id == "a")
    assert first.ingest_ts.second == 7


def test_dedup_picks_one_of_a_tie(events_of):
    rows = [event("a", 5, 7, geo=g) for g in ("US", "EU", None)]
    assert quality.dedup_events(events_of(rows)).count() == 1


def test_writer_schema_is_chosen_by_id(spark):
    """Each id is decoded by its own writer schema; other ids are poison."""
    from tidewindow.sources.topics import decode_avro_topic

    def decoder(body, writer, reader):
        assert reader == "reader"
        kind = "event_id string, user_id string, event_ts long, ingest_ts long"
        parsed = F.from_json(body.cast("string"), kind)
        return parsed if writer == "new" else parsed.withField("user_id", F.lit("unknown"))

    text = '{"event_id": "e", "user_id": "u", "event_ts": 1000, "ingest_ts": 2000}'
    cases = [(1, text), (2, text), (3, text), (2, "no json")]
    raw = None
    for number, body in cases:
        row = spark.range(1).select(envelope.wrap(F.lit(body.encode()), number).alias("value"))
        raw = row if raw is None else raw.unionByName(row)
    raw = raw.unionByName(spark.range(1).select(F.lit(b"x").alias("value")))
    out = decode_avro_topic(raw, "reader", {1: "old", 2: "new"}, decoder).collect()
    reasons = [r[C.DECODED].reason for r in out]
    assert [(r.user_id, why) for r, why in zip(out, reasons)][:4] == [
        ("unknown", None), ("u", None), (None, "unknown_schema"), (None, "malformed"),
    ]
    assert reasons[4] not in (None, "unknown_schema") and out[0].event_ts is not None
    assert bytes(out[4][C.DECODED].raw) == b"x"


def test_json_beside_columns_of_the_same_names(spark):
    """Columns of a table of messages stay, also those a decoder has a word for."""
    raw = spark.createDataFrame(
        [('{"event_id": ', "paid", "r1", "x")], "value string, reason string, body string, event_id string"
    )
    out = quality.parse_json_events(raw).first()
    assert (out.reason, out.body, out.event_id) == ("paid", "r1", None)
    assert out[C.DECODED].reason == "malformed" and bytes(out[C.DECODED].raw) == b'{"event_id": '


def test_iceberg_batches_replace_themselves():
    from unittest.mock import MagicMock

    from tidewindow.sinks import external

    df = MagicMock()
    writer = df.withColumn.return_value.writeTo.return_value
    external.F, held = MagicMock(), external.F
    try:
        external.write_iceberg(df, "c.t", 3)
        external.write_iceberg(df, "c.t", 0, create=True)
    finally:
        external.F = held
    writer.overwrite.assert_called_once()
    writer.append.assert_not_called()
    writer.using.assert_called_once_with("iceberg")


# ---- versions


def test_every_earlier_version_is_checked(spark, tmp_path):
    """What the last version allows may break the first one."""
    from pyspark.sql import types as T

    from tidewindow.sinks import versions

    a = C.Field("a", T.StringType())
    n = {kind: C.Field("n", kind(), required=False) for kind in (T.IntegerType, T.LongType, T.DoubleType)}
    path = f"{tmp_path}/versions"
    assert versions.begin_version(spark, path, 0, (a, n[T.IntegerType]))
    assert not versions.begin_version(spark, path, 3, (a, n[T.IntegerType]))
    assert versions.begin_version(spark, path, 5, (a,))  # an optional column may go
    with pytest.raises(ValueError, match="n: changed_type since batch 0"):
        versions.begin_version(spark, path, 7, (a, C.Field("n", T.StringType(), required=False)))
    with pytest.raises(ValueError, match="a: dropped_required since batch 0; a: dropped_required since batch 5"):
        versions.begin_version(spark, path, 7, (n[T.LongType],))
    assert versions.begin_version(spark, path, 7, (a, n[T.LongType]))
    assert [b for b, _ in versions.versions(spark, path)] == [0, 5, 7]
    for batch, rows, kind in ((0, [("x", 1)], "a string, n int"), (5, [("y",)], "a string"), (8, [("z", 1 << 40)], "a string, n long")):
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/t/batch_id={batch}")
    rows = versions.read_versions(spark, f"{tmp_path}/t", path).collect()
    assert sorted(map(tuple, rows)) == [("x", 1, 0), ("y", None, 5), ("z", 1 << 40, 8)]
    with pytest.raises(ValueError, match="no versions"):
        versions.read_versions(spark, f"{tmp_path}/t", f"{tmp_path}/none")
