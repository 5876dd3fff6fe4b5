"""SQL building blocks of the oracles: the event model over the raw tables.

``model(query)`` prefixes a query with these relations:

* ``raw``  raw events with ``k``
* ``ev``   typed events
* ``pub``  published events with topic, key and partition
* ``env``  ``pub`` with offsets
* ``act`` / ``req``  user actions as requests
* ``leaf`` first-generation events
* ``judged`` outcomes of the interactions topic
* ``ticks``, ``filled`` rates per minute, without and with zero ticks
"""

NOW = "TIMESTAMP '2024-01-30 00:00:00'"

RAW = """
raw AS (
  SELECT event_id AS eid, ts, user_id AS uid, event_type AS rt,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

EV = """
ev AS (
  SELECT
    printf('00000000-0000-4000-8000-%012x', eid) AS event_id,
    ts AS occurred_at,
    CASE WHEN rt IN ('purchase', 'signup') THEN 'UserActionEvent'
         WHEN rt IN ('click', 'view') THEN 'ContentInteractionEvent'
         WHEN rt = 'error' THEN 'SystemEvent' END AS category,
    CASE WHEN rt <> 'error' THEN CASE WHEN uid % 50 = 0 THEN ' ' ELSE 'user-' || uid END END AS user_id,
    CASE WHEN rt = 'purchase' THEN ['POST_CREATED', 'POST_DELETED', 'USER_FOLLOWED'][k % 3 + 1]
         WHEN rt = 'signup' THEN ['PROFILE_UPDATED', 'USER_UNFOLLOWED'][k % 2 + 1] END AS action_type,
    CASE WHEN rt = 'purchase' AND k % 3 < 2 THEN 'post-' || k
         WHEN rt = 'purchase' OR (rt = 'signup' AND k % 2 = 1) THEN 'user-' || k END AS target_id,
    CASE WHEN rt IN ('click', 'view') THEN CASE WHEN k = 13 THEN 'post-BOOM' ELSE 'post-' || k END END AS content_id,
    CASE WHEN rt = 'click' THEN 'CONTENT_LIKED'
         WHEN rt = 'view' THEN ['CONTENT_COMMENTED', 'CONTENT_SHARED'][k % 2 + 1] END AS interaction_type,
    CASE WHEN rt = 'error' THEN
      CASE WHEN k % 2 = 0 THEN 'CONTENT_MODERATION_FLAGGED' ELSE 'RECOMMENDATION_MODEL_UPDATED' END
    END AS system_event_type,
    CASE WHEN rt = 'error' THEN CASE WHEN k % 2 = 0 THEN 'post-' || k ELSE 'model-v' || k END END AS subject_id,
    k, uid, eid
  FROM raw
),
typed AS (
  SELECT *, coalesce(action_type, interaction_type, system_event_type) AS event_type FROM ev
)"""

PUB = """
keyed AS (
  SELECT *,
    CASE category WHEN 'UserActionEvent' THEN 'user-actions'
                  WHEN 'ContentInteractionEvent' THEN 'content-interactions' END AS topic,
    CASE category WHEN 'UserActionEvent' THEN user_id
                  WHEN 'ContentInteractionEvent' THEN content_id END AS key
  FROM typed
),
pub AS (
  SELECT *,
    CAST(CAST('0x' || substr(md5(key), 1, 8) AS BIGINT)
         % CASE topic WHEN 'user-actions' THEN 12 ELSE 6 END AS INTEGER) AS partition
  FROM keyed
  WHERE topic IS NOT NULL AND NOT (topic = 'user-actions' AND user_id = ' ')
)"""

ENV = """
env AS (
  SELECT *, row_number() OVER (PARTITION BY topic, partition ORDER BY occurred_at, event_id) - 1 AS "offset"
  FROM pub
)"""

REQ = """
req AS (
  SELECT event_id AS request_id, user_id,
         CASE WHEN k % 11 <> 0 THEN action_type END AS action_type, target_id, k
  FROM typed WHERE category = 'UserActionEvent'
)"""

LEAF = r"""
leaf AS (
  SELECT 'ev-' || eid AS event_id, ts AS occurred_at,
    CASE rt WHEN 'click' THEN 'PostLiked' WHEN 'view' THEN 'PostShared' WHEN 'purchase' THEN 'PostDeleted'
            WHEN 'signup' THEN 'ProfileUpdated'
            ELSE CASE WHEN k % 2 = 0 THEN 'ServiceHealthChanged' ELSE 'RebalanceTriggered' END END AS event_type,
    CASE WHEN rt <> 'error' THEN CAST(uid AS VARCHAR) END AS user_id,
    CASE WHEN rt IN ('click', 'view', 'purchase') THEN CAST(k AS VARCHAR) END AS post_id,
    NULL AS content,
    CASE WHEN rt = 'purchase' THEN CASE WHEN k % 20 = 0 THEN ' ' ELSE 'reason-' || k END END AS reason,
    CASE WHEN rt = 'signup' THEN ['displayName', 'bio', 'avatar'][k % 3 + 1] END AS field_changed,
    CASE WHEN rt = 'signup' THEN CASE WHEN k % 25 = 0 THEN chr(9) || chr(10) ELSE 'value-' || k END END AS new_value,
    CASE WHEN rt = 'view' THEN CAST((uid + k) % 150 AS VARCHAR) END AS shared_to_user_id,
    NULL AS comment_text,
    CASE WHEN rt = 'error' AND k % 2 = 0 THEN 'service-' || k END AS service_name,
    CASE WHEN rt = 'error' AND k % 2 = 0 THEN CASE WHEN k % 4 = 0 THEN 'UP' ELSE 'DOWN' END END AS status,
    CASE WHEN rt = 'error' AND k % 2 = 1 THEN 'group-' || k END AS consumer_group_id,
    CASE WHEN rt = 'error' AND k % 2 = 1 THEN k - 5 END AS partitions_reassigned
  FROM raw
  UNION ALL
  SELECT 'doc-' || doc_id, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id), 'PostCreated',
         CAST(doc_id % 150 AS VARCHAR), CAST(doc_id AS VARCHAR), text,
         NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
  FROM documents
  UNION ALL
  SELECT 'conv-' || conv_id || '-' || turn, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(turn), 'PostCommented',
         CAST(conv_id % 150 AS VARCHAR), CAST(conv_id AS VARCHAR), NULL,
         NULL, NULL, NULL, NULL, text, NULL, NULL, NULL, NULL
  FROM conversations
)"""


def blank(column: str) -> str:
    return rf"({column} IS NULL OR NOT regexp_matches({column}, '[^\x00-\x20]'))"


def utf16(column: str) -> str:
    return rf"(length({column}) + length(regexp_replace({column}, '[^\x{{10000}}-\x{{10FFFF}}]', '', 'g')))"


def joined(*pairs: tuple[str, str]) -> str:
    """``path=message`` for each condition that holds, in the given order, joined by ``;``."""
    cases = ", ".join(f"CASE WHEN {condition} THEN '{entry}' END" for condition, entry in pairs)
    return f"concat_ws(';', {cases})"


FUTURE = f"occurred_at > {NOW}"
FUTURE_TEXT = "occurredAt=must be a date in the past or in the present"

INTERACTION_VIOLATIONS = joined(
    (blank("content_id"), "contentId=must not be blank"),
    ("interaction_type IS NULL", "interactionType=must not be null"),
    (FUTURE, FUTURE_TEXT),
    (blank("user_id"), "userId=must not be blank"),
)
ACTION_VIOLATIONS = joined(
    ("action_type IS NULL", "actionType=must not be null"),
    (FUTURE, FUTURE_TEXT),
    (blank("user_id"), "userId=must not be blank"),
)
SYSTEM_VIOLATIONS = joined(
    (FUTURE, FUTURE_TEXT),
    (blank("subject_id"), "subjectId=must not be blank"),
    ("system_event_type IS NULL", "systemEventType=must not be null"),
)
VIOLATIONS = (
    f"CASE category WHEN 'UserActionEvent' THEN {ACTION_VIOLATIONS}"
    f" WHEN 'ContentInteractionEvent' THEN {INTERACTION_VIOLATIONS} ELSE {SYSTEM_VIOLATIONS} END"
)
REQUEST_VIOLATIONS = joined(
    ("action_type IS NULL", "actionType=must not be null"),
    (blank("user_id"), "userId=must not be blank"),
)
LEAF_VIOLATIONS = joined(
    (f"event_type = 'PostCommented' AND {blank('comment_text')}", "commentText=must not be blank"),
    (f"{utf16('comment_text')} > 500", "commentText=size must be between 0 and 500"),
    (f"event_type = 'RebalanceTriggered' AND {blank('consumer_group_id')}", "consumerGroupId=must not be blank"),
    (f"event_type = 'PostCreated' AND {blank('content')}", "content=must not be blank"),
    (f"{utf16('content')} > 2000", "content=size must be between 0 and 2000"),
    (f"event_type = 'ProfileUpdated' AND {blank('field_changed')}", "fieldChanged=must not be blank"),
    (f"event_type = 'ProfileUpdated' AND {blank('new_value')}", "newValue=must not be blank"),
    ("partitions_reassigned < 0", "partitionsReassigned=must be greater than or equal to 0"),
    (f"event_type = 'PostDeleted' AND {blank('reason')}", "reason=must not be blank"),
    (f"event_type = 'ServiceHealthChanged' AND {blank('service_name')}", "serviceName=must not be blank"),
    (f"event_type = 'ServiceHealthChanged' AND {blank('status')}", "status=must not be blank"),
)

JUDGED = f"""
checked AS (
  SELECT *, {INTERACTION_VIOLATIONS} AS found FROM env WHERE topic = 'content-interactions'
),
reasons AS (
  SELECT *,
    CASE WHEN found <> '' THEN 'invalid ContentInteractionEvent at offset ' || "offset" || ': ' || found
         WHEN content_id = 'post-BOOM' THEN 'simulated processing failure for post-BOOM' END AS reason
  FROM checked
),
judged AS (
  SELECT *, CASE WHEN reason IS NULL THEN 'processed' ELSE 'recovered' END AS status,
         CAST(CASE WHEN reason IS NULL THEN 1 ELSE 3 END AS INTEGER) AS attempts
  FROM reasons
)"""

TICKS = """
ticks AS (
  SELECT topic, date_trunc('minute', occurred_at) AS tick, count(*) AS rate FROM pub GROUP BY ALL
),
filled AS (
  SELECT s.topic, s.tick, coalesce(t.rate, 0) AS rate
  FROM (
    SELECT topic, unnest(generate_series(min(tick), max(tick), INTERVAL 1 MINUTE)) AS tick
    FROM ticks GROUP BY topic
  ) s LEFT JOIN ticks t ON s.topic = t.topic AND s.tick = t.tick
)"""

FEED = """
feed AS (
  SELECT topic, event_type, user_id AS primary_key,
         CASE topic WHEN 'user-actions' THEN coalesce(target_id, '-') ELSE content_id END AS detail,
         partition, "offset", occurred_at, event_id
  FROM env
)"""

_DEPENDS = {
    "raw": (RAW, ()),
    "typed": (EV, ("raw",)),
    "pub": (PUB, ("typed",)),
    "env": (ENV, ("pub",)),
    "req": (REQ, ("typed",)),
    "leaf": (LEAF, ("raw",)),
    "judged": (JUDGED, ("env",)),
    "filled": (TICKS, ("pub",)),
    "feed": (FEED, ("env",)),
}


def model(relation: str, query: str) -> str:
    """``query`` with ``relation``, and all that it is built on, in front."""
    parts: list[str] = []

    def add(name: str) -> None:
        text, needs = _DEPENDS[name]
        for need in needs:
            add(need)
        if text not in parts:
            parts.append(text)

    add(relation)
    return "WITH" + ",".join(parts) + "\n" + query


def values(alias: str, columns: str, rows: list[tuple]) -> str:
    """A literal relation, for the fixed dimension tables."""
    body = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in row) + ")"
                     for row in rows)
    return f"(VALUES {body}) AS {alias}({columns})"
