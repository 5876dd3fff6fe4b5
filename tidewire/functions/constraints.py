"""Declarative field constraints turned into violation columns.

A rule names a property path, a message and the condition that breaks it, as
SQL text. ``violations`` evaluates a rule list on one row and keeps every
broken rule, so an event reports all its problems at once.
"""

from collections.abc import Iterable
from dataclasses import dataclass

from tidewire import schemas
from tidewire.functions.sql import cases, literal, literals
from tidewire.functions.text import is_blank, longer_than

# Messages of the standard bean constraints.
MUST_NOT_BE_NULL = "must not be null"
MUST_NOT_BE_BLANK = "must not be blank"
SIZE_BETWEEN = "size must be between 0 and %d"
MUST_BE_PAST_OR_PRESENT = "must be a date in the past or in the present"
MUST_BE_AT_LEAST = "must be greater than or equal to %d"

# Longest post and comment, in UTF-16 units.
MAX_POST_LENGTH = 2000
MAX_COMMENT_LENGTH = 500


@dataclass(frozen=True)
class Rule:
    path: str
    message: str
    broken: str


def _column_of(path: str) -> str:
    """The snake_case column behind a camelCase property path."""
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in path)


def not_null(path: str) -> Rule:
    return Rule(path, MUST_NOT_BE_NULL, f"{_column_of(path)} IS NULL")


def not_blank(path: str) -> Rule:
    return Rule(path, MUST_NOT_BE_BLANK, is_blank(_column_of(path)))


def max_size(path: str, limit: int) -> Rule:
    return Rule(path, SIZE_BETWEEN % limit, longer_than(_column_of(path), limit))


def past_or_present(path: str, now: str) -> Rule:
    """``now`` is SQL text for the clock: a literal where results must repeat."""
    return Rule(path, MUST_BE_PAST_OR_PRESENT, f"coalesce({_column_of(path)} > {now}, false)")


def at_least(path: str, least: int) -> Rule:
    return Rule(path, MUST_BE_AT_LEAST % least, f"coalesce({_column_of(path)} < {least}, false)")


def outside_domain(value: str, domain: Iterable[str]) -> str:
    """True for a non-null value that is no constant of the enum; it cannot decode."""
    return f"coalesce({value} NOT IN ({literals(domain)}), false)"


def user_action_rules(now: str) -> list[Rule]:
    return [
        not_null("eventId"),
        not_null("occurredAt"),
        past_or_present("occurredAt", now),
        not_blank("userId"),
        not_null("actionType"),
    ]


def interaction_rules(now: str) -> list[Rule]:
    return [
        not_null("eventId"),
        not_null("occurredAt"),
        past_or_present("occurredAt", now),
        not_blank("userId"),
        not_blank("contentId"),
        not_null("interactionType"),
    ]


def system_rules(now: str) -> list[Rule]:
    return [
        not_null("eventId"),
        not_null("occurredAt"),
        past_or_present("occurredAt", now),
        not_null("systemEventType"),
        not_blank("subjectId"),
    ]


def action_request_rules() -> list[Rule]:
    return [not_blank("userId"), not_null("actionType")]


def post_request_rules() -> list[Rule]:
    return [not_null("userId"), not_blank("content"), max_size("content", MAX_POST_LENGTH)]


def topic_spec_rules() -> list[Rule]:
    return [not_blank("name"), at_least("partitions", 1), at_least("replicationFactor", 1)]


def leaf_rules() -> dict[str, list[Rule]]:
    """Constraints of the eight first-generation leaf types; none checks the clock."""
    stamped = [not_null("eventId"), not_null("occurredAt")]
    on_post = [*stamped, not_null("userId"), not_null("postId")]
    return {
        "PostCreated": [*on_post, not_blank("content"), max_size("content", MAX_POST_LENGTH)],
        "PostDeleted": [*on_post, not_blank("reason")],
        "ProfileUpdated": [*stamped, not_null("userId"), not_blank("fieldChanged"), not_blank("newValue")],
        "PostLiked": on_post,
        "PostShared": [*on_post, not_null("sharedToUserId")],
        "PostCommented": [*on_post, not_blank("commentText"), max_size("commentText", MAX_COMMENT_LENGTH)],
        "ServiceHealthChanged": [*stamped, not_blank("serviceName"), not_blank("status")],
        "RebalanceTriggered": [
            *stamped,
            not_blank("consumerGroupId"),
            at_least("partitionsReassigned", 0),
        ],
    }


def rules_by_category(now: str) -> dict[str, list[Rule]]:
    return {
        schemas.USER_ACTION: user_action_rules(now),
        schemas.CONTENT_INTERACTION: interaction_rules(now),
        schemas.SYSTEM: system_rules(now),
    }


#: What a row is told whose kind has no rules.
UNKNOWN = "names no known kind"


def violations(rules: Iterable[Rule]) -> str:
    """Array of ``(path, message)`` for every broken rule, ordered by path and message.

    The order is fixed while the plan is built, so rows need no sort.
    """
    ordered = sorted(rules, key=lambda rule: (rule.path, rule.message))
    found = ", ".join(
        f"CASE WHEN {rule.broken} THEN"
        f" named_struct('path', {literal(rule.path)}, 'message', {literal(rule.message)}) END"
        for rule in ordered
    )
    return f"array_compact(array({found}))"


def violations_by(discriminator: str, rule_sets: dict[str, list[Rule]]) -> str:
    """Violations of each row under the rule set its discriminator names; a null or unknown name is one itself."""
    unknown = f"array(named_struct('path', {literal(discriminator)}, 'message', {literal(UNKNOWN)}))"
    return cases(
        {f"{discriminator} = {literal(name)}": violations(rules) for name, rules in rule_sets.items()}, unknown)


def violations_text(found: str) -> str:
    """``path=message`` pairs joined by ``;``."""
    return f"array_join(transform({found}, v -> concat(v.path, '=', v.message)), ';')"


def field_errors(found: str) -> str:
    """Map from field to message; of several messages for a field the last one stays.

    Equal paths are neighbours, so an entry stays if the next one has another path.
    """
    last_of_path = f"filter({found}, (v, i) -> NOT (get({found}, i + 1).path <=> v.path))"
    return f"map_from_entries(transform({last_of_path}, v -> struct(v.path, v.message)))"
