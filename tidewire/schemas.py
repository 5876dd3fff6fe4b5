"""Explicit schemas of every row shape the package reads or writes.

Event times are ``timestamp_ntz`` holding UTC, so no result depends on the
session time zone. Identifiers are UUID-shaped strings.
"""

from pyspark.sql import types as T

USER_ACTION = "UserActionEvent"
CONTENT_INTERACTION = "ContentInteractionEvent"
SYSTEM = "SystemEvent"
CATEGORIES = (USER_ACTION, CONTENT_INTERACTION, SYSTEM)

# The enum constants of each category, in declared order.
USER_ACTION_TYPES = (
    "POST_CREATED",
    "POST_DELETED",
    "USER_FOLLOWED",
    "USER_UNFOLLOWED",
    "PROFILE_UPDATED",
)
INTERACTION_TYPES = ("CONTENT_LIKED", "CONTENT_COMMENTED", "CONTENT_SHARED")
SYSTEM_EVENT_TYPES = ("CONTENT_MODERATION_FLAGGED", "RECOMMENDATION_MODEL_UPDATED")

# Topic names.
USER_ACTIONS_TOPIC = "user-actions"
CONTENT_INTERACTIONS_TOPIC = "content-interactions"

# Names of the JSON fields, per category, next to our columns.
WIRE_FIELDS = {
    USER_ACTION: {
        "eventId": "event_id",
        "occurredAt": "occurred_at",
        "userId": "user_id",
        "actionType": "action_type",
        "targetId": "target_id",
    },
    CONTENT_INTERACTION: {
        "eventId": "event_id",
        "occurredAt": "occurred_at",
        "userId": "user_id",
        "contentId": "content_id",
        "interactionType": "interaction_type",
    },
    SYSTEM: {
        "eventId": "event_id",
        "occurredAt": "occurred_at",
        "systemEventType": "system_event_type",
        "subjectId": "subject_id",
        "metadata": "metadata",
    },
}

# Enum-typed column of each category and the constants it may hold.
ENUM_DOMAINS = {
    "action_type": USER_ACTION_TYPES,
    "interaction_type": INTERACTION_TYPES,
    "system_event_type": SYSTEM_EVENT_TYPES,
}


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_text = T.StringType()
_time = T.TimestampNTZType()
_tags = T.MapType(_text, _text)

#: All three event categories in one wide row, told apart by ``category``.
EVENT = _struct(
    event_id=_text,
    occurred_at=_time,
    category=_text,
    event_type=_text,
    user_id=_text,
    action_type=_text,
    target_id=_text,
    content_id=_text,
    interaction_type=_text,
    system_event_type=_text,
    subject_id=_text,
    metadata=_tags,
)

#: The first-generation event model: eight leaf types in one wide row.
LEAF_EVENT = _struct(
    event_id=_text,
    occurred_at=_time,
    category=_text,
    event_type=_text,
    user_id=_text,
    post_id=_text,
    content=_text,
    reason=_text,
    field_changed=_text,
    new_value=_text,
    shared_to_user_id=_text,
    comment_text=_text,
    service_name=_text,
    status=_text,
    consumer_group_id=_text,
    partitions_reassigned=T.IntegerType(),
)

#: One topic record, in the column shape of Spark's Kafka source.
TOPIC_RECORD = _struct(
    topic=_text,
    partition=T.IntegerType(),
    offset=T.LongType(),
    key=_text,
    value=_text,
    timestamp=T.TimestampType(),
)

FEED_ITEM = _struct(
    topic=_text,
    event_type=_text,
    primary_key=_text,
    detail=_text,
    partition=T.IntegerType(),
    offset=T.LongType(),
    occurred_at=_time,
)

TOPIC_SPEC = _struct(
    name=_text,
    partitions=T.IntegerType(),
    replication_factor=T.ShortType(),
    configs=_tags,
)

CATALOG_ENTRY = _struct(
    ordinal=T.IntegerType(),
    category=_text,
    event_type=_text,
    description=_text,
)

VIOLATION = _struct(path=_text, message=_text)
