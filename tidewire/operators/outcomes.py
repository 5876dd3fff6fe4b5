"""What became of each consumed interaction: processed, or recovered with a reason."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.functions import constraints as c
from tidewire.functions.codec import decode
from tidewire.functions.sql import cases, computed_once, fill, literal, literals

# A failing record is retried twice, one second apart, then recovered.
RETRIES = 2
BACK_OFF_SECONDS = 1.0

# Reasons and log lines.
INVALID_REASON = "invalid ContentInteractionEvent at offset %s: %s"
POISON_REASON = "simulated processing failure for %s"
PROCESSED_LINE = (
    "STRUCTURED_EVENT event=engagement-processed interactionType=%s userId=%s contentId=%s partition=%s offset=%s"
)
RECOVERED_LINE = (
    "STRUCTURED_ERROR event=engagement-processing-recovered topic=%s partition=%s offset=%s key=%s reason=%s"
)

PROCESSED = "processed"
RECOVERED = "recovered"


def engagement_outcomes(
    interactions: DataFrame, now: str, poison_ids: list[str], retries: int = RETRIES
) -> DataFrame:
    """Judge each interaction: decode error, then violations, then poison, else processed.

    A failure of this kind fails again on every attempt, so the row goes
    straight to its end: ``1 + retries`` attempts and a reason. Nothing waits;
    partition and offset keep the order for whoever needs it. No shuffle.
    """
    kept = [f"`{name}`" for name in interactions.columns]
    reason = cases({
        "decode_error IS NOT NULL": "decode_error",
        "size(_found) > 0": fill(INVALID_REASON, "offset", c.violations_text("_found")),
        f"content_id IN ({literals(poison_ids)})" if poison_ids else "false": fill(POISON_REASON, "content_id"),
    })
    checked = computed_once(interactions, c.violations(c.interaction_rules(now)), "_found")
    return checked.selectExpr(*kept, f"{reason} AS reason").selectExpr(
        "*",
        f"if(reason IS NULL, {literal(PROCESSED)}, {literal(RECOVERED)}) AS status",
        f"if(reason IS NULL, 1, {1 + retries}) AS attempts",
    )


def consume_engagement(
    records: DataFrame, now: str, poison_ids: list[str], retries: int = RETRIES
) -> DataFrame:
    """Outcomes of the interactions topic, from raw topic records; works on batches and streams."""
    interactions = decode(
        records.where(F.col("topic") == schemas.CONTENT_INTERACTIONS_TOPIC), schemas.CONTENT_INTERACTION
    )
    return engagement_outcomes(interactions, now, poison_ids, retries)


def processed_lines(outcomes: DataFrame) -> DataFrame:
    values = ("interaction_type", "user_id", "content_id", "partition", "offset")
    return outcomes.where(F.col("status") == PROCESSED).selectExpr(f"{fill(PROCESSED_LINE, *values)} AS line")


def recovered_lines(outcomes: DataFrame) -> DataFrame:
    values = ("topic", "partition", "offset", "key", "reason")
    return outcomes.where(F.col("status") == RECOVERED).selectExpr(f"{fill(RECOVERED_LINE, *values)} AS line")


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(F.count("*").alias("n"))


def delivery_summary(deliveries: DataFrame) -> DataFrame:
    """Totals over sent records: acknowledged, failed, elapsed seconds and records per second.

    ``status`` is ``ok`` or ``failed``; ``occurred_at`` spans the run.
    """
    summed = deliveries.selectExpr(
        "count(*) AS total",
        "count_if(status = 'ok') AS acknowledged",
        "count_if(status = 'failed') AS failed",
        "max(occurred_at) - min(occurred_at) AS _elapsed",
    )
    parts = {"DAY": 86_400, "HOUR": 3_600, "MINUTE": 60, "SECOND": 1}
    seconds = " + ".join(f"extract({part} FROM _elapsed) * {factor}" for part, factor in parts.items())
    return summed.selectExpr(
        "total",
        "acknowledged",
        "failed",
        f"round(CAST({seconds} AS DOUBLE), 6) AS elapsed_s",
        f"round(try_divide(total, CAST({seconds} AS DOUBLE)), 6) AS per_s",
    )
