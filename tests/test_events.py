import pytest
from conftest import action, interaction, system_event
from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.functions import events as ev
from tidewire.operators import catalog


def test_catalog_has_ten_types_in_three_categories(spark):
    rows = catalog.taxonomy(spark).collect()
    assert len(rows) == 10
    counts = [sum(r.category == name for r in rows) for name in schemas.CATEGORIES]
    assert counts == [5, 3, 2]


def test_dispatch_covers_every_category_and_rejects_others(spark, events):
    rows = events(action(), interaction(), system_event())
    named = rows.orderBy("event_id").selectExpr(f"{ev.category_name()} AS c").collect()
    assert [r.c for r in named] == ["user-action", "content-interaction", "system"]
    stray = events(action(category="Misc"))
    with pytest.raises(Exception, match="unknown event: Misc"):
        stray.selectExpr(ev.category_name()).collect()
    assert stray.selectExpr(f"{ev.category_name(strict=False)} AS c").first().c is None


def test_route_key_and_type(events):
    rows = events(action(), interaction(), system_event()).orderBy("event_id").selectExpr(
        f"{ev.topic_of()} AS topic", f"{ev.key_of()} AS key", f"{ev.EVENT_TYPE} AS type"
    ).collect()
    assert [(r.topic, r.key, r.type) for r in rows] == [
        ("user-actions", "user-42", "POST_CREATED"),
        ("content-interactions", "post-normal", "CONTENT_LIKED"),
        (None, None, "RECOMMENDATION_MODEL_UPDATED"),
    ]


@pytest.mark.parametrize("row, sentence", [
    ({"event_type": "PostCreated"}, "user u created post p"),
    ({"event_type": "PostDeleted"}, "user u deleted post p"),
    ({"event_type": "ProfileUpdated", "field_changed": "bio"}, "user u updated bio"),
    ({"event_type": "PostLiked"}, "user u liked post p"),
    ({"event_type": "PostShared", "shared_to_user_id": "w"}, "user u shared post p to w"),
    ({"event_type": "PostCommented"}, "user u commented on post p"),
    ({"event_type": "ServiceHealthChanged", "service_name": "s", "status": "UP"}, "service s is now UP"),
    ({"event_type": "RebalanceTriggered", "consumer_group_id": "g", "partitions_reassigned": 4},
     "consumer group g reassigned 4 partitions"),
])
def test_leaf_sentences(spark, row, sentence):
    base = {**dict.fromkeys(schemas.LEAF_EVENT.fieldNames()), "user_id": "u", "post_id": "p", **row}
    leaf = spark.createDataFrame([base], schemas.LEAF_EVENT)
    assert leaf.selectExpr(f"{ev.describe_leaf()} AS d").first().d == sentence


def test_unknown_leaf_is_an_error(spark):
    leaf = spark.createDataFrame([{"event_type": "PostPinned"}], schemas.LEAF_EVENT)
    with pytest.raises(Exception, match="PostPinned"):
        leaf.selectExpr(ev.describe_leaf()).collect()


def test_event_sentence(events):
    text = events(action()).selectExpr(f"{ev.describe_event()} AS d").first().d
    assert text == "UserActionEvent [POST_CREATED] eventId=00000000-0000-4000-8000-000000000000"


def test_equality_looks_at_every_column(events):
    columns = schemas.EVENT.fieldNames()

    def same(left, right):
        pair = events(left).select(F.struct(*columns).alias("before")).crossJoin(events(right))
        return pair.selectExpr(f"{ev.same_event('before', columns)} AS same").first().same

    flag = system_event(metadata={"a": "1", "b": "2"})
    assert same(action(), action()) and same(flag, system_event(metadata={"b": "2", "a": "1"}))
    assert not same(action(), action(user_id="other"))
    assert not same(action(), action(target_id=None))
    assert not same(flag, system_event(metadata={"a": "1"})) and not same(flag, system_event(metadata=None))


def test_catalog_lookup_usage_and_report(events):
    rows = events(action(), action(), interaction(), action(event_type="MISC"))
    looked = {r.event_type: r.description for r in catalog.lookup(rows).collect()}
    assert looked["POST_CREATED"] == "A user published a new post." and looked["MISC"] is None
    assert [r.event_type for r in catalog.unknown_types(rows).collect()] == ["MISC"]
    used = catalog.usage(rows)
    assert {r.event_type: r.n for r in used.collect() if r.n} == {"POST_CREATED": 2, "CONTENT_LIKED": 1}
    report = catalog.report(used).collect()
    assert [r.ordinal for r in report] == list(range(1, 11))
    assert [r.header for r in report if r.header] == list(schemas.CATEGORIES)
    assert {r.category: (r.types, r.n) for r in catalog.by_category(rows).collect()} == {
        schemas.USER_ACTION: (5, 2), schemas.CONTENT_INTERACTION: (3, 1), schemas.SYSTEM: (2, 0)
    }


def test_topic_catalog(spark):
    topics = {r.name: r for r in catalog.topic_catalog(spark).collect()}
    assert {n: t.partitions for n, t in topics.items()} == {"user-actions": 1000, "content-interactions": 500}
    assert all(t.replication_factor == 3 and t.configs["retention.ms"] == "604800000" for t in topics.values())
    assert catalog.at_local_scale(catalog.LOCAL_PARTITIONS)
    assert not catalog.at_local_scale({})
    local = {r.name: r.partitions for r in catalog.topic_catalog(spark, catalog.LOCAL_PARTITIONS).collect()}
    assert local == {"user-actions": 12, "content-interactions": 6}
