import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidewire import schemas  # noqa: E402
from tidewire.session import build_session  # noqa: E402

NOW = datetime(2024, 1, 30)
UUID = "00000000-0000-4000-8000-%012x"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.ui.showConsoleProgress": "false",
        }
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def now():
    return f"TIMESTAMP_NTZ '{NOW}'"


@pytest.fixture
def events(spark):
    """Build wide event rows from keyword dicts; ids and times are filled in."""

    def build(*rows):
        full = []
        for at, row in enumerate(rows):
            base = {"event_id": UUID % at, "occurred_at": NOW - timedelta(hours=1)}
            full.append({**dict.fromkeys(schemas.EVENT.fieldNames()), **base, **row})
        return spark.createDataFrame(full, schemas.EVENT)

    return build


def action(**overrides):
    kind = overrides.get("action_type", "POST_CREATED")
    return {
        "category": schemas.USER_ACTION, "event_type": kind, "user_id": "user-42",
        "action_type": kind, "target_id": "post-1", **overrides,
    }


def interaction(**overrides):
    kind = overrides.get("interaction_type", "CONTENT_LIKED")
    return {
        "category": schemas.CONTENT_INTERACTION, "event_type": kind, "user_id": "user-7",
        "content_id": "post-normal", "interaction_type": kind, **overrides,
    }


def system_event(**overrides):
    kind = overrides.get("system_event_type", "RECOMMENDATION_MODEL_UPDATED")
    return {
        "category": schemas.SYSTEM, "event_type": kind, "system_event_type": kind,
        "subject_id": "model-v7", **overrides,
    }
