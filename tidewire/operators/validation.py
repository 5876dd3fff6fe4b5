"""Validation of events and requests: violations, error maps and splits."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions import constraints as c
from tidewire.functions.codec import NULL_PAYLOAD
from tidewire.functions.sql import computed_once
from tidewire.functions.text import hashed_uuid

# Outcome of a publish request.
ACCEPTED = 202
REJECTED = 400


def with_violations(events: DataFrame, now: str) -> DataFrame:
    """Typed events with all their violations; the rule set follows the category.

    ``now`` is the clock as SQL text: a literal, or ``localtimestamp()`` in a UTC session.
    """
    return _checked(events, c.violations_by("category", c.rules_by_category(now)))


def with_leaf_violations(events: DataFrame) -> DataFrame:
    """First-generation events with all their violations."""
    return _checked(events, c.violations_by("event_type", c.leaf_rules()))


def with_request_violations(requests: DataFrame) -> DataFrame:
    return _checked(requests, c.violations(c.action_request_rules()))


def with_post_request_violations(requests: DataFrame) -> DataFrame:
    return _checked(requests, c.violations(c.post_request_rules()))


def with_spec_violations(specs: DataFrame) -> DataFrame:
    return _checked(specs, c.violations(c.topic_spec_rules()))


def _checked(rows: DataFrame, found: str) -> DataFrame:
    # Every split below filters on the result, so the rules must not move into those filters.
    return computed_once(rows, found, "violations")


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("violations") == 0).drop("violations")


def rejected(validated: DataFrame) -> DataFrame:
    """Rows with at least one violation and the field -> message map sent back."""
    return validated.where(F.size("violations") > 0).withColumn("errors", F.expr(c.field_errors("violations")))


def response_status(validated: DataFrame) -> DataFrame:
    return validated.withColumn(
        "status", F.when(F.size("violations") == 0, F.lit(ACCEPTED)).otherwise(F.lit(REJECTED))
    )


def violations_by_field(validated: DataFrame) -> DataFrame:
    """Number of violations per field; partial counts keep the shuffle to a few rows per task."""
    return (
        validated.select(F.explode("violations").alias("v"))
        .groupBy(F.col("v.path").alias("path"))
        .agg(F.count("*").alias("n"))
    )


def poison_split(validated: DataFrame, poison_ids: list[str]) -> DataFrame:
    """Outcome per interaction: ``invalid``, ``poison`` or ``ok``.

    The poison test comes after validation, so an invalid poison record counts as invalid.
    """
    return validated.withColumn(
        "outcome",
        F.when(F.size("violations") > 0, F.lit("invalid"))
        .when(F.col("content_id").isin(*poison_ids), F.lit("poison"))
        .otherwise(F.lit("ok")),
    )


def null_payloads(records: DataFrame) -> DataFrame:
    """Records without a payload, which nothing downstream could validate."""
    return records.where(F.col("value").isNull()).withColumn("reason", F.lit(NULL_PAYLOAD))


# The current UTC time as a ``timestamp_ntz``, whatever the session zone is.
_UTC_NOW = "convert_timezone(current_timezone(), 'UTC', localtimestamp())"


def enrich_actions(requests: DataFrame, now: str | None = None) -> DataFrame:
    """Accepted action requests as user actions, stamped with an id and a time.

    With ``now`` given the result is reproducible: the time is ``now`` and the
    id is a hash of the request. Otherwise the id is random and the time is the
    current time in UTC.
    """
    event_id = "uuid()" if now is None else hashed_uuid(*requests.columns)
    return requests.selectExpr(
        f"{event_id} AS event_id", f"{now or _UTC_NOW} AS occurred_at", "user_id", "action_type", "target_id"
    )


def enrich_posts(requests: DataFrame, now: str | None = None) -> DataFrame:
    """Accepted post requests as ``PostCreated`` events; the server also names the post."""
    event_id, post_id = (
        "uuid()" if now is None else hashed_uuid(f"'{kind}'", "request_id") for kind in ("event", "post")
    )
    return requests.selectExpr(
        f"{event_id} AS event_id",
        f"{now or _UTC_NOW} AS occurred_at",
        "user_id",
        f"{post_id} AS post_id",
        "content",
    )
