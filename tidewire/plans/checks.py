"""Queries over constraints, violations and request splits."""

from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.functions import constraints as c
from tidewire.functions import events as ev
from tidewire.functions.sql import cases
from tidewire.functions.text import is_blank, longer_than
from tidewire.operators import envelope, validation
from tidewire.plans.oracle import (
    LEAF_VIOLATIONS,
    NOW,
    REQUEST_VIOLATIONS,
    VIOLATIONS,
    blank,
    joined,
    model,
    utf16,
)
from tidewire.plans.registry import register
from tidewire.sources import tables


def checked_events(spark, folder, *categories):
    return validation.with_violations(tables.social_events(spark, folder, *categories), tables.NOW)


def _as_text(checked):
    return checked.selectExpr("event_id", f"{c.violations_text('violations')} AS violations")


@register("val_not_null", model("req", "SELECT request_id AS event_id, action_type IS NULL AS failed FROM req"))
def val_not_null(spark, folder):
    rule = c.not_null("actionType")
    return tables.action_requests(spark, folder).selectExpr("request_id AS event_id", f"{rule.broken} AS failed")


@register("val_not_blank", model("typed", f"""
SELECT event_id, {blank('user_id')} AS failed FROM typed WHERE category <> 'SystemEvent'"""))
def val_not_blank(spark, folder):
    events = tables.social_events(spark, folder, *ev.ROUTES)
    return events.selectExpr("event_id", f"{is_blank('user_id')} AS failed")


@register("val_size", model("leaf", f"""
SELECT event_id, CASE event_type WHEN 'PostCreated' THEN {utf16('content')} > 2000
                                 ELSE {utf16('comment_text')} > 500 END AS failed
FROM leaf WHERE event_type IN ('PostCreated', 'PostCommented')"""))
def val_size(spark, folder):
    leaf = tables.leaf_events(spark, folder).where(F.col("event_type").isin("PostCreated", "PostCommented"))
    failed = cases(
        {"event_type = 'PostCreated'": longer_than("content", c.MAX_POST_LENGTH)},
        longer_than("comment_text", c.MAX_COMMENT_LENGTH),
    )
    return leaf.selectExpr("event_id", f"{failed} AS failed")


@register("val_past_or_present", model("typed", f"SELECT event_id, occurred_at > {NOW} AS failed FROM typed"))
def val_past_or_present(spark, folder):
    rule = c.past_or_present("occurredAt", tables.NOW)
    return tables.social_events(spark, folder).selectExpr("event_id", f"{rule.broken} AS failed")


@register("val_positive_or_zero", model("leaf", """
SELECT event_id, partitions_reassigned < 0 AS failed FROM leaf WHERE event_type = 'RebalanceTriggered'"""))
def val_positive_or_zero(spark, folder):
    leaf = tables.leaf_events(spark, folder).where(F.col("event_type") == "RebalanceTriggered")
    rule = c.at_least("partitionsReassigned", 0)
    return leaf.selectExpr("event_id", f"{rule.broken} AS failed")


@register("val_min", model("raw", """
SELECT printf('00000000-0000-4000-8000-%012x', eid) AS event_id, k % 12 < 1 OR k % 4 < 1 AS failed FROM raw"""))
def val_min(spark, folder):
    specs = tables.topic_specs(spark, folder)
    rules = (c.at_least("partitions", 1), c.at_least("replicationFactor", 1))
    return specs.selectExpr("event_id", f"{' OR '.join(rule.broken for rule in rules)} AS failed")


@register("val_enum_domain", model("typed", "SELECT event_id, k = 99 AS failed FROM typed"))
def val_enum_domain(spark, folder):
    known = schemas.USER_ACTION_TYPES + schemas.INTERACTION_TYPES + schemas.SYSTEM_EVENT_TYPES
    failed = c.outside_domain("if(k = 99, 'MISC', event_type)", known)
    return tables.social_events(spark, folder).selectExpr("event_id", f"{failed} AS failed")


@register("violations", model("typed", f"SELECT event_id, {VIOLATIONS} AS violations FROM typed"))
def violations(spark, folder):
    return _as_text(checked_events(spark, folder))


@register("violations_v1", model("leaf", f"SELECT event_id, {LEAF_VIOLATIONS} AS violations FROM leaf"))
def violations_v1(spark, folder):
    return _as_text(validation.with_leaf_violations(tables.leaf_events(spark, folder)))


_SPEC_VIOLATIONS = joined(
    ("uid % 50 = 0", "name=must not be blank"),
    ("k % 12 < 1", "partitions=must be greater than or equal to 1"),
    ("k % 4 < 1", "replicationFactor=must be greater than or equal to 1"),
)


@register("spec_violations", model("raw", f"""
SELECT printf('00000000-0000-4000-8000-%012x', eid) AS event_id, {_SPEC_VIOLATIONS} AS violations FROM raw"""))
def spec_violations(spark, folder):
    return _as_text(validation.with_spec_violations(tables.topic_specs(spark, folder)))


@register("violations_by_field", model("typed", f"""
SELECT split_part(entry, '=', 1) AS path, count(*) AS n
FROM (SELECT unnest(string_split({VIOLATIONS}, ';')) AS entry FROM typed)
WHERE entry <> '' GROUP BY 1"""))
def violations_by_field(spark, folder):
    return validation.violations_by_field(checked_events(spark, folder))


@register("field_errors", model("typed", f"""
SELECT event_id, {VIOLATIONS} AS errors FROM typed WHERE {VIOLATIONS} <> ''"""))
def field_errors(spark, folder):
    text = "array_join(transform(map_entries(errors), e -> concat(e.key, '=', e.value)), ';')"
    return validation.rejected(checked_events(spark, folder)).selectExpr("event_id", f"{text} AS errors")


@register("request_accept_reject", model("req", f"""
SELECT CAST(CASE WHEN {REQUEST_VIOLATIONS} = '' THEN 202 ELSE 400 END AS INTEGER) AS status, count(*) AS n
FROM req GROUP BY 1"""))
def request_accept_reject(spark, folder):
    requests = validation.with_request_violations(tables.action_requests(spark, folder))
    return validation.response_status(requests).groupBy("status").agg(F.count("*").alias("n"))


@register("post_accept_reject", rf"""
SELECT CAST(CASE WHEN doc_id % 25 = 0 OR {blank('text')} OR {utf16('text')} > 2000 THEN 400 ELSE 202 END AS INTEGER)
       AS status, count(*) AS n
FROM documents GROUP BY 1""")
def post_accept_reject(spark, folder):
    requests = validation.with_post_request_violations(tables.post_requests(spark, folder))
    return validation.response_status(requests).groupBy("status").agg(F.count("*").alias("n"))


@register("poison_split", model("typed", f"""
SELECT CASE WHEN {VIOLATIONS} <> '' THEN 'invalid' WHEN content_id = 'post-BOOM' THEN 'poison' ELSE 'ok' END AS outcome,
       count(*) AS n
FROM typed WHERE category = 'ContentInteractionEvent' GROUP BY 1"""))
def poison_split(spark, folder):
    interactions = checked_events(spark, folder, schemas.CONTENT_INTERACTION)
    split = validation.poison_split(interactions, [tables.POISON_CONTENT_ID])
    return split.groupBy("outcome").agg(F.count("*").alias("n"))


@register("null_payload_guard", model("pub", "SELECT event_id, 'null payload' AS reason FROM pub WHERE k = 7"))
def null_payload_guard(spark, folder):
    events = envelope.publishable(tables.social_events(spark, folder, *ev.ROUTES))
    nulled = F.when(F.col("k") != 7, F.col("event_type"))
    return validation.null_payloads(events.select("event_id", nulled.alias("value"))).select("event_id", "reason")
