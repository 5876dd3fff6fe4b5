"""Expressions over typed events, as SQL text: derived type, dispatch, route and sentences."""

from collections.abc import Iterable

from pyspark.sql.types import MapType

from tidewire import schemas
from tidewire.functions.sql import cases, fill, literal

# Short category names used when dispatching.
CATEGORY_NAMES = {
    schemas.USER_ACTION: "user-action",
    schemas.CONTENT_INTERACTION: "content-interaction",
    schemas.SYSTEM: "system",
}

# Topic and record key of each published category. System events have no topic.
ROUTES = {
    schemas.USER_ACTION: (schemas.USER_ACTIONS_TOPIC, "user_id"),
    schemas.CONTENT_INTERACTION: (schemas.CONTENT_INTERACTIONS_TOPIC, "content_id"),
}

# One sentence per first-generation leaf type, with the columns that fill it.
LEAF_SENTENCES = {
    "PostCreated": ("user %s created post %s", ("user_id", "post_id")),
    "PostDeleted": ("user %s deleted post %s", ("user_id", "post_id")),
    "ProfileUpdated": ("user %s updated %s", ("user_id", "field_changed")),
    "PostLiked": ("user %s liked post %s", ("user_id", "post_id")),
    "PostShared": ("user %s shared post %s to %s", ("user_id", "post_id", "shared_to_user_id")),
    "PostCommented": ("user %s commented on post %s", ("user_id", "post_id")),
    "ServiceHealthChanged": ("service %s is now %s", ("service_name", "status")),
    "RebalanceTriggered": (
        "consumer group %s reassigned %s partitions",
        ("consumer_group_id", "partitions_reassigned"),
    ),
}


#: The constant of whichever enum the event's category carries.
EVENT_TYPE = "coalesce(action_type, interaction_type, system_event_type)"


def dispatch(value: str, results: dict[str, str], strict: bool = True) -> str:
    """Pick a result per value; an unknown value fails the query, or is null if not ``strict``.

    Results are SQL text. Null results keep such rows for a quarantine.
    """
    unknown = f"raise_error(concat('unknown event: ', coalesce({value}, 'null')))" if strict else None
    return cases({f"{value} = {literal(name)}": result for name, result in results.items()}, unknown)


def category_name(strict: bool = True) -> str:
    return dispatch("category", {name: literal(short) for name, short in CATEGORY_NAMES.items()}, strict)


def topic_of() -> str:
    """Topic an event is published to, null where its category has none."""
    routes = {name: literal(topic) for name, (topic, _) in ROUTES.items()}
    return dispatch("category", {**routes, schemas.SYSTEM: "NULL"})


def key_of() -> str:
    return dispatch("category", {**{name: column for name, (_, column) in ROUTES.items()}, schemas.SYSTEM: "NULL"})


def describe_leaf(strict: bool = True) -> str:
    """Sentence for a first-generation event; an unknown leaf type is an error."""
    sentences = {leaf: fill(template, *columns) for leaf, (template, columns) in LEAF_SENTENCES.items()}
    return dispatch("event_type", sentences, strict)


def describe_event() -> str:
    """``Category [EVENT_TYPE] eventId=...``."""
    return fill("%s [%s] eventId=%s", "category", "event_type", "event_id")


def same_event(before: str, columns: Iterable[str]) -> str:
    """True if every column equals the one of that name in the struct ``before``; nulls are equal.

    Maps have no equality of their own and are compared by their sorted entries.
    """
    tests = []
    for name in columns:
        sides = (f"{before}.{name}", name)
        if isinstance(schemas.EVENT[name].dataType, MapType):
            sides = tuple(f"sort_array(map_entries({side}))" for side in sides)
        tests.append(" <=> ".join(sides))
    return " AND ".join(tests)
