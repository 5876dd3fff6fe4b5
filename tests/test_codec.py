from datetime import datetime

import pytest
from conftest import action, interaction, system_event

from tidewire import schemas
from tidewire.functions import codec

GOOD = (
    '{"eventId":"00000000-0000-4000-8000-000000000001","occurredAt":%s,"userId":"u","contentId":"p",'
    '"interactionType":"CONTENT_LIKED"}'
)


def decode_values(spark, *values, category=schemas.CONTENT_INTERACTION):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    return codec.decode(rows, category).orderBy("i").collect()


@pytest.mark.parametrize("written, expected", [
    ('"2024-01-01T00:00:07.179575Z"', datetime(2024, 1, 1, 0, 0, 7, 179575)),
    ('"2024-01-01T00:00:07Z"', datetime(2024, 1, 1, 0, 0, 7)),
    ('"2024-01-01T02:00:07+02:00"', datetime(2024, 1, 1, 0, 0, 7)),
    ("1704067207.179575", datetime(2024, 1, 1, 0, 0, 7, 179575)),
    ("1704067207.179575999", datetime(2024, 1, 1, 0, 0, 7, 179575)),
    ("1704067207", datetime(2024, 1, 1, 0, 0, 7)),
])
def test_both_forms_of_a_time_are_read(spark, written, expected):
    row, = decode_values(spark, GOOD % written)
    assert row.decode_error is None and row.occurred_at == expected


def test_what_cannot_be_read_keeps_its_row_and_says_why(spark):
    fine = GOOD % '"2024-01-01T00:00:00Z"'
    rows = decode_values(
        spark, fine, None, "raw-producer-demo-event", fine.replace("CONTENT_LIKED", "MISC"),
        fine.replace("00000000-0000-4000-8000-000000000001", "17"), GOOD % '"yesterday"', "",
    )
    bad = codec.UNDECODABLE
    assert [r.decode_error for r in rows] == [None, codec.NULL_PAYLOAD, bad, bad, bad, bad, bad]


def test_objects_and_lists_are_no_text(spark):
    fine = GOOD % '"2024-01-01T00:00:00Z"'
    values = ['{"a":1}', "[1]", " { }", '"{\\"a\\":1}"', '"[x"', "17", "true", "null"]
    rows = decode_values(spark, *(fine.replace('"u"', v) for v in values))
    bad = codec.UNDECODABLE
    assert [r.decode_error for r in rows] == [bad, bad, bad, None, None, None, None, None]
    assert [r.user_id for r in rows[3:]] == ['{"a":1}', "[x", "17", "true", None]
    system = ('{"eventId":"00000000-0000-4000-8000-000000000001","occurredAt":"2024-01-01T00:00:00Z",'
              '"systemEventType":"RECOMMENDATION_MODEL_UPDATED","subjectId":"s","metadata":%s}')
    rows = decode_values(
        spark, *(system % m for m in ('{"k":"[v"}', '{"k":{"a":1}}', '{"k":[1]}', '{"k":null}', "null", "[]")),
        category=schemas.SYSTEM)
    assert [r.decode_error for r in rows] == [None, bad, bad, None, None, bad]


def test_missing_and_unknown_fields(spark):
    row, = decode_values(spark, '{"userId":"u","later":{"a":1}}')
    assert row.decode_error is None and row.user_id == "u" and row.event_id is None


@pytest.mark.parametrize("row", [
    action(), action(action_type="PROFILE_UPDATED", target_id=None), interaction(user_id='quo"te\né😀'),
    system_event(metadata={"reason": "spam"}), system_event(metadata=None),
])
def test_decode_undoes_encode(events, row):
    sent = events(row)
    wire = sent.selectExpr(f"struct({', '.join(sent.columns)}) AS sent", f"{codec.encode_any()} AS value")
    got = codec.decode(wire, row["category"]).first()
    assert got.decode_error is None
    for column in schemas.WIRE_FIELDS[row["category"]].values():
        assert got[column] == got.sent[column]


def test_absent_values_are_written_as_null_and_no_type_is_sent(events):
    text = events(action(target_id=None)).selectExpr(f"{codec.encode(schemas.USER_ACTION)} AS v").first().v
    assert '"targetId":null' in text and "UserActionEvent" not in text and "eventType" not in text


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, events, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The first is skipped by the New York clock, the second happens there twice.
        for moment in (datetime(2024, 3, 10, 2, 30), datetime(2024, 11, 3, 1, 30)):
            sent = events(interaction(occurred_at=moment)).selectExpr(
                f"{codec.encode(schemas.CONTENT_INTERACTION)} AS value")
            assert codec.decode(sent, schemas.CONTENT_INTERACTION).first().occurred_at == moment
        row, = decode_values(spark, GOOD % "1704067207.5")
        assert row.occurred_at == datetime(2024, 1, 1, 0, 0, 7, 500000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
