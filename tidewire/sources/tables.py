"""Adapters from the given tables to the event model.

Each raw event carries an integer ``k`` in its ``props``; type, ids and the
planted defects (blank users, poison content, future times) follow from the
raw type, ``user_id`` and ``k``. Every adapter is a narrow projection of one
table, so filters and column pruning reach the parquet scan.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.functions.events import EVENT_TYPE
from tidewire.functions.sql import literals
from tidewire.functions.text import numbered_uuid

#: The fixed clock the planted future events are measured against, as SQL text.
NOW = "TIMESTAMP_NTZ '2024-01-30 00:00:00'"

#: The record key that makes an interaction fail after validation.
POISON_CONTENT_ID = "post-BOOM"

#: Raw types behind each category.
RAW_TYPES = {
    schemas.USER_ACTION: ("purchase", "signup"),
    schemas.CONTENT_INTERACTION: ("click", "view"),
    schemas.SYSTEM: ("error",),
}
_ACTS = f"raw_type IN ({literals(RAW_TYPES[schemas.USER_ACTION])})"
_REACTS = f"raw_type IN ({literals(RAW_TYPES[schemas.CONTENT_INTERACTION])})"
_FAILS = f"raw_type IN ({literals(RAW_TYPES[schemas.SYSTEM])})"


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "events").selectExpr(
        "event_id",
        "ts",
        "user_id",
        "event_type AS raw_type",
        # The one number of a flat object; several times faster than a JSON parser per row.
        r"""try_cast(regexp_extract(props, r'"k"\s*:\s*(-?\d+)', 1) AS INT) AS k""",
    )


def social_events(spark: SparkSession, folder: str, *categories: str) -> DataFrame:
    """The raw events as typed events; ``k`` stays for the queries that plant defects by it.

    With categories given, the matching raw types become a filter of the parquet scan.
    """
    raw = raw_events(spark, folder)
    if categories:
        raw = raw.where(F.col("raw_type").isin(*(kind for name in categories for kind in RAW_TYPES[name])))
    return as_social_events(raw)


def as_social_events(raw: DataFrame) -> DataFrame:
    typed = raw.selectExpr(
        f"{numbered_uuid('event_id')} AS event_id",
        "ts AS occurred_at",
        f"""CASE WHEN {_ACTS} THEN '{schemas.USER_ACTION}'
                 WHEN {_REACTS} THEN '{schemas.CONTENT_INTERACTION}'
                 WHEN {_FAILS} THEN '{schemas.SYSTEM}' END AS category""",
        f"""CASE WHEN {_ACTS} OR {_REACTS}
                 THEN CASE WHEN user_id % 50 = 0 THEN ' ' ELSE concat('user-', user_id) END END AS user_id""",
        """CASE WHEN raw_type = 'purchase' AND k % 3 = 0 THEN 'POST_CREATED'
                WHEN raw_type = 'purchase' AND k % 3 = 1 THEN 'POST_DELETED'
                WHEN raw_type = 'purchase' AND k % 3 = 2 THEN 'USER_FOLLOWED'
                WHEN raw_type = 'signup' AND k % 2 = 0 THEN 'PROFILE_UPDATED'
                WHEN raw_type = 'signup' AND k % 2 = 1 THEN 'USER_UNFOLLOWED' END AS action_type""",
        """CASE WHEN raw_type = 'purchase' AND k % 3 < 2 THEN concat('post-', k)
                WHEN raw_type = 'purchase' OR (raw_type = 'signup' AND k % 2 = 1) THEN concat('user-', k)
           END AS target_id""",
        f"""CASE WHEN {_REACTS} AND k = 13 THEN '{POISON_CONTENT_ID}'
                 WHEN {_REACTS} THEN concat('post-', k) END AS content_id""",
        """CASE WHEN raw_type = 'click' THEN 'CONTENT_LIKED'
                WHEN raw_type = 'view' AND k % 2 = 0 THEN 'CONTENT_COMMENTED'
                WHEN raw_type = 'view' AND k % 2 = 1 THEN 'CONTENT_SHARED' END AS interaction_type""",
        f"""CASE WHEN {_FAILS} AND k % 2 = 0 THEN 'CONTENT_MODERATION_FLAGGED'
                 WHEN {_FAILS} AND k % 2 = 1 THEN 'RECOMMENDATION_MODEL_UPDATED' END AS system_event_type""",
        f"""CASE WHEN {_FAILS} AND k % 2 = 0 THEN concat('post-', k)
                 WHEN {_FAILS} AND k % 2 = 1 THEN concat('model-v', k) END AS subject_id""",
        f"CASE WHEN {_FAILS} AND k % 3 = 0 THEN map('reason', 'spam') END AS metadata",
        "k",
    )
    return typed.selectExpr(
        *(f"{EVENT_TYPE} AS event_type" if name == "event_type" else name for name in schemas.EVENT.fieldNames()), "k"
    )


def action_requests(spark: SparkSession, folder: str) -> DataFrame:
    """User actions as requests: the server has not yet given them an id or a time.

    ``request_id`` identifies the request itself. An action type is missing where k is divisible by 11.
    """
    return social_events(spark, folder, schemas.USER_ACTION).selectExpr(
        "event_id AS request_id",
        "user_id",
        "CASE WHEN k % 11 <> 0 THEN action_type END AS action_type",
        "target_id",
    )


def post_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as requests to create a post; the user is missing where the id is divisible by 25."""
    return _read(spark, folder, "documents").selectExpr(
        f"{numbered_uuid('doc_id')} AS request_id",
        "CASE WHEN doc_id % 25 <> 0 THEN concat('user-', doc_id % 150) END AS user_id",
        "text AS content",
    )


def topic_specs(spark: SparkSession, folder: str) -> DataFrame:
    """One requested topic layout per raw event, some with a zero partition or replica count."""
    return raw_events(spark, folder).selectExpr(
        f"{numbered_uuid('event_id')} AS event_id",
        "CASE WHEN user_id % 50 = 0 THEN '' ELSE concat('topic-', user_id) END AS name",
        "k % 12 AS partitions",
        "CAST(k % 4 AS SMALLINT) AS replication_factor",
    )


def leaf_events(spark: SparkSession, folder: str) -> DataFrame:
    """First-generation events: posts from documents, comments from conversations, the rest from events."""
    return (
        _leaf_from_events(spark, folder)
        .unionByName(_leaf_from_documents(spark, folder))
        .unionByName(_leaf_from_conversations(spark, folder))
    )


def _wide(df: DataFrame, **columns: str) -> DataFrame:
    return df.selectExpr(
        *(f"CAST({columns.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in schemas.LEAF_EVENT)
    )


def _leaf_from_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _wide(
        _read(spark, folder, "documents"),
        event_id="concat('doc-', doc_id)",
        occurred_at="TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, doc_id)",
        category=f"'{schemas.USER_ACTION}'",
        event_type="'PostCreated'",
        user_id="doc_id % 150",
        post_id="doc_id",
        content="text",
    )


def _leaf_from_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return _wide(
        _read(spark, folder, "conversations"),
        event_id="concat('conv-', conv_id, '-', turn)",
        occurred_at="TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, turn)",
        category=f"'{schemas.CONTENT_INTERACTION}'",
        event_type="'PostCommented'",
        user_id="conv_id % 150",
        post_id="conv_id",
        comment_text="text",
    )


def _leaf_from_events(spark: SparkSession, folder: str) -> DataFrame:
    healthy, moved = f"{_FAILS} AND k % 2 = 0", f"{_FAILS} AND k % 2 = 1"
    return _wide(
        raw_events(spark, folder),
        event_id="concat('ev-', event_id)",
        occurred_at="ts",
        category=f"""CASE WHEN {_ACTS} THEN '{schemas.USER_ACTION}'
                          WHEN {_REACTS} THEN '{schemas.CONTENT_INTERACTION}' ELSE '{schemas.SYSTEM}' END""",
        event_type=f"""CASE WHEN raw_type = 'click' THEN 'PostLiked' WHEN raw_type = 'view' THEN 'PostShared'
                            WHEN raw_type = 'purchase' THEN 'PostDeleted' WHEN raw_type = 'signup' THEN 'ProfileUpdated'
                            WHEN {healthy} THEN 'ServiceHealthChanged' WHEN {moved} THEN 'RebalanceTriggered' END""",
        user_id=f"CASE WHEN NOT {_FAILS} THEN user_id END",
        post_id=f"CASE WHEN {_REACTS} OR raw_type = 'purchase' THEN k END",
        reason="""CASE WHEN raw_type = 'purchase' AND k % 20 = 0 THEN ' '
                       WHEN raw_type = 'purchase' THEN concat('reason-', k) END""",
        field_changed="CASE WHEN raw_type = 'signup' THEN array('displayName', 'bio', 'avatar')[k % 3] END",
        new_value=r"""CASE WHEN raw_type = 'signup' AND k % 25 = 0 THEN '\t\n'
                           WHEN raw_type = 'signup' THEN concat('value-', k) END""",
        shared_to_user_id="CASE WHEN raw_type = 'view' THEN (user_id + k) % 150 END",
        service_name=f"CASE WHEN {healthy} THEN concat('service-', k) END",
        status=f"CASE WHEN {healthy} AND k % 4 = 0 THEN 'UP' WHEN {healthy} THEN 'DOWN' END",
        consumer_group_id=f"CASE WHEN {moved} THEN concat('group-', k) END",
        partitions_reassigned=f"CASE WHEN {moved} THEN k - 5 END",
    )
