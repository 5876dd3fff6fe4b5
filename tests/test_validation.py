from datetime import timedelta

import pytest
from conftest import NOW, action, interaction, system_event
from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.functions import constraints as c
from tidewire.operators import validation
from tidewire.operators.catalog import topic_catalog


def paths(df):
    return [[v.path for v in r.violations] for r in df.orderBy("event_id").collect()]


def test_valid_events_have_no_violations(events, now):
    checked = validation.with_violations(events(action(), interaction(), system_event()), now)
    assert paths(checked) == [[], [], []]


@pytest.mark.parametrize("row, path", [
    (action(user_id=" "), "userId"),
    (action(occurred_at=NOW + timedelta(days=1)), "occurredAt"),
    (action(occurred_at=None), "occurredAt"),
    (action(event_id=None), "eventId"),
    (action(action_type=None), "actionType"),
    (interaction(content_id=""), "contentId"),
    (interaction(user_id="\t"), "userId"),
    (interaction(interaction_type=None), "interactionType"),
    (system_event(subject_id=None), "subjectId"),
    (system_event(system_event_type=None), "systemEventType"),
])
def test_each_bad_field_is_named_once(events, now, row, path):
    assert paths(validation.with_violations(events(row), now)) == [[path]]


def test_a_time_equal_to_the_clock_is_present_not_future(events, now):
    assert paths(validation.with_violations(events(action(occurred_at=NOW)), now)) == [[]]


def test_all_violations_are_kept_in_path_order(events, now):
    bad = interaction(user_id="", content_id=None, occurred_at=NOW + timedelta(seconds=1), interaction_type=None)
    assert paths(validation.with_violations(events(bad), now)) == [
        ["contentId", "interactionType", "occurredAt", "userId"]
    ]


def test_optional_fields_may_be_null(events, now):
    rows = events(action(action_type="PROFILE_UPDATED", target_id=None), system_event(metadata=None))
    assert paths(validation.with_violations(rows, now)) == [[], []]


def test_action_requests(spark):
    requests = spark.createDataFrame(
        [("1", "user-42", "POST_CREATED", "post-1"), ("2", "", "POST_CREATED", "post-1"),
         ("3", "user-42", None, "post-1"), ("4", "user-42", "PROFILE_UPDATED", None), ("5", " ", None, None)],
        "event_id string, user_id string, action_type string, target_id string",
    )
    checked = validation.with_request_violations(requests)
    assert paths(checked) == [[], ["userId"], ["actionType"], [], ["actionType", "userId"]]
    assert [r.status for r in validation.response_status(checked).orderBy("event_id").collect()] == [
        202, 400, 400, 202, 400
    ]
    assert {r.event_id for r in validation.accepted(checked).collect()} == {"1", "4"}
    errors = {r.event_id: r.errors for r in validation.rejected(checked).collect()}
    assert errors["5"] == {"actionType": "must not be null", "userId": "must not be blank"}


def test_post_requests(spark):
    requests = spark.createDataFrame(
        [("1", "u", "hello"), ("2", "u", "   "), ("3", None, "hello"), ("4", "u", "x" * 2000), ("5", "u", "x" * 2001),
         ("6", "u", "😀" * 1000), ("7", "u", "😀" * 1001)],
        "event_id string, user_id string, content string",
    )
    assert paths(validation.with_post_request_violations(requests)) == [
        [], ["content"], ["userId"], [], ["content"], [], ["content"]
    ]


def test_last_message_of_a_field_wins(spark):
    rows = spark.createDataFrame([("1", "u", " " * 2001)], "event_id string, user_id string, content string")
    rejected = validation.rejected(validation.with_post_request_violations(rows)).first()
    assert len(rejected.violations) == 2
    assert rejected.errors == {"content": rejected.violations[-1].message}


def leaf(spark, **row):
    base = dict.fromkeys(schemas.LEAF_EVENT.fieldNames())
    base |= {"event_id": "e", "occurred_at": NOW, "user_id": "u", "post_id": "p"}
    return spark.createDataFrame([{**base, **row}], schemas.LEAF_EVENT)


@pytest.mark.parametrize("row, expected", [
    ({"event_type": "PostCreated", "content": "hi"}, []),
    ({"event_type": "PostCreated", "content": "  "}, ["content"]),
    ({"event_type": "PostCreated", "content": "x" * 2001}, ["content"]),
    ({"event_type": "PostDeleted", "reason": "r"}, []),
    ({"event_type": "ProfileUpdated", "field_changed": "bio", "new_value": "v"}, []),
    ({"event_type": "PostLiked"}, []),
    ({"event_type": "PostShared", "shared_to_user_id": "u2"}, []),
    ({"event_type": "PostShared"}, ["sharedToUserId"]),
    ({"event_type": "PostCommented", "comment_text": "x" * 501}, ["commentText"]),
    ({"event_type": "ServiceHealthChanged", "service_name": "s", "status": "UP"}, []),
    ({"event_type": "RebalanceTriggered", "consumer_group_id": "g", "partitions_reassigned": 0}, []),
    ({"event_type": "RebalanceTriggered", "consumer_group_id": "g", "partitions_reassigned": -1},
     ["partitionsReassigned"]),
])
def test_leaf_events(spark, row, expected):
    assert paths(validation.with_leaf_violations(leaf(spark, **row))) == [expected]


def test_leaf_events_may_lie_in_the_future(spark):
    rows = leaf(spark, event_type="PostLiked", occurred_at=NOW + timedelta(days=9999))
    assert paths(validation.with_leaf_violations(rows)) == [[]]


def test_topic_specs(spark):
    assert all(not r.violations for r in validation.with_spec_violations(topic_catalog(spark)).collect())
    bad = spark.createDataFrame([("", 10, 3, {}), ("t", 0, 3, {}), ("t", 1, 0, {})], schemas.TOPIC_SPEC)
    found = validation.with_spec_violations(bad).select(F.col("violations.path").alias("p")).collect()
    assert [r.p for r in found] == [["name"], ["partitions"], ["replicationFactor"]]


def test_poison_is_tested_after_validation(events, now):
    rows = events(interaction(), interaction(content_id="post-BOOM"), interaction(content_id="post-BOOM", user_id=" "))
    split = validation.poison_split(validation.with_violations(rows, now), ["post-BOOM"])
    assert [r.outcome for r in split.orderBy("event_id").collect()] == ["ok", "poison", "invalid"]


def test_violations_are_counted_per_field(events, now):
    rows = events(action(user_id=" "), interaction(user_id="", content_id=" "), action())
    counted = validation.violations_by_field(validation.with_violations(rows, now))
    assert {r.path: r.n for r in counted.collect()} == {"userId": 2, "contentId": 1}


def test_enum_domain(spark):
    rows = spark.createDataFrame([("CONTENT_LIKED",), ("MISC",), (None,)], "t string")
    got = [r.bad for r in rows.selectExpr(f"{c.outside_domain('t', schemas.INTERACTION_TYPES)} AS bad").collect()]
    assert got == [False, True, False]


def test_enrichment(spark, now):
    requests = spark.createDataFrame(
        [("1", "u", "POST_CREATED", None), ("2", "u", "POST_CREATED", None)],
        "request_id string, user_id string, action_type string, target_id string",
    )
    fixed = validation.enrich_actions(requests, now).collect()
    assert fixed == validation.enrich_actions(requests, now).collect()
    assert fixed[0].event_id != fixed[1].event_id and fixed[0].occurred_at == NOW
    live = validation.enrich_actions(requests).collect()
    assert len({r.event_id for r in live}) == 2 and all(len(r.event_id) == 36 for r in live)
    assert all(r.occurred_at > NOW for r in live)
    posts = spark.createDataFrame([("1", "u", "text")], "request_id string, user_id string, content string")
    post = validation.enrich_posts(posts, now).first()
    assert post.event_id != post.post_id


def test_unknown_and_null_categories_are_rejected(events, now):
    rows = events(action(category="GOSSIP"), action(category=None), action())
    checked = validation.with_violations(rows, now)
    assert validation.accepted(checked).count() == 1
    assert validation.rejected(checked).count() == 2
    assert {r.outcome for r in validation.poison_split(checked, []).collect()} == {"invalid", "ok"}
