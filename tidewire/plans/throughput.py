"""Queries over event rates. Ticks are one minute."""

from pyspark.sql import functions as F

from tidewire import schemas
from tidewire.operators import rates
from tidewire.plans.oracle import model
from tidewire.plans.records import published
from tidewire.plans.registry import register

TICK_SECONDS = 60

# Sizing inputs: events per partition and minute, and the most partitions a topic may get.
BUDGET = 1
CAPS = {schemas.USER_ACTIONS_TOPIC: 10, schemas.CONTENT_INTERACTIONS_TOPIC: 2}

_HISTORY = """
SELECT topic, tick, rate,
       CAST(sum(rate) OVER (PARTITION BY topic ORDER BY tick ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total,
       list(rate) OVER (PARTITION BY topic ORDER BY tick ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS h,
       max(rate) OVER (PARTITION BY topic ORDER BY tick ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS top
FROM filled"""


def _rates(spark, folder):
    return rates.rate_per_tick(published(spark, folder), TICK_SECONDS)


def flat_history(snapshot):
    return snapshot.withColumn("history", F.array_join(F.col("history").cast("array<string>"), ","))


@register("rate_per_tick", model("filled", "SELECT topic, tick, rate FROM ticks"))
def rate_per_tick(spark, folder):
    return _rates(spark, folder)


@register("rate_gap_filled", model("filled", "SELECT topic, tick, rate FROM filled"))
def rate_gap_filled(spark, folder):
    return rates.gap_filled(_rates(spark, folder), TICK_SECONDS)


@register("running_total", model("filled", f"SELECT topic, tick, total FROM ({_HISTORY})"))
def running_total(spark, folder):
    return rates.running_total(_rates(spark, folder), TICK_SECONDS)


@register("rate_history_30", model("filled", f"""
SELECT topic, tick, array_to_string(h, ',') AS history FROM ({_HISTORY})"""))
def rate_history_30(spark, folder):
    return flat_history(rates.snapshots(_rates(spark, folder), TICK_SECONDS)).select("topic", "tick", "history")


@register("history_peak", model("filled", f"""
SELECT topic, tick, greatest(1, top) AS peak, round(rate / greatest(1, top), 6) AS scaled FROM ({_HISTORY})"""))
def history_peak(spark, folder):
    peaks = rates.with_peak(rates.snapshots(_rates(spark, folder), TICK_SECONDS))
    return peaks.select("topic", "tick", "peak", F.round(F.element_at("scaled", -1), 6).alias("scaled"))


@register("partition_sizing", model("filled", """
SELECT topic, max(rate) AS peak,
       CAST(least(ceil(max(rate) / 1.0), CASE topic WHEN 'user-actions' THEN 10 ELSE 2 END) AS INTEGER) AS partitions
FROM ticks GROUP BY topic"""))
def partition_sizing(spark, folder):
    return rates.partition_sizing(_rates(spark, folder), BUDGET, CAPS)
