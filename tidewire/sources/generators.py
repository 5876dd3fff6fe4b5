"""Test traffic, as expressions over a frame of numbers.

Any frame with a ``bigint`` column ``i`` drives them: ``spark.range`` for a
small run, a table's ids for a large one.
"""

from pyspark.sql import DataFrame

from tidewire import schemas
from tidewire.functions.sql import literals
from tidewire.sources.tables import POISON_CONTENT_ID

# The interaction feed cycles over 5 users, 4 posts and the three types,
# and ends with one poison record.
ENGAGEMENT_USERS = 5
ENGAGEMENT_POSTS = 4
POISON_USER = "user-0"

# The keyed load has 8 senders of 500 records with a constant value that is not JSON.
LOAD_SENDERS = 8
LOAD_RECORDS_PER_SENDER = 500
LOAD_KEY = "raw-demo-user-%d-%d"
LOAD_VALUE = "raw-producer-demo-event"


def engagement_feed(numbers: DataFrame) -> DataFrame:
    """One interaction per number, then one poison record numbered after the last."""
    normal = numbers.selectExpr(
        "i",
        f"concat('user-', i % {ENGAGEMENT_USERS}) AS user_id",
        f"concat('post-', i % {ENGAGEMENT_POSTS}) AS content_id",
        f"array({literals(schemas.INTERACTION_TYPES)})[i % {len(schemas.INTERACTION_TYPES)}] AS interaction_type",
    )
    poison = numbers.selectExpr(
        "max(i) + 1 AS i",
        f"'{POISON_USER}' AS user_id",
        f"'{POISON_CONTENT_ID}' AS content_id",
        f"'{schemas.INTERACTION_TYPES[0]}' AS interaction_type",
    )
    return normal.unionByName(poison)


def keyed_load(numbers: DataFrame, senders: int = LOAD_SENDERS) -> DataFrame:
    """One keyed record per number, dealt out to the senders in turn."""
    prefix, between, _ = LOAD_KEY.split("%d")
    return numbers.selectExpr(
        f"concat('{prefix}', i % {senders}, '{between}', i DIV {senders}) AS key", f"'{LOAD_VALUE}' AS value"
    )
