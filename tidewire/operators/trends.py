"""Most active items in sliding windows of event time."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def pane_counts(events: DataFrame, pane_seconds: int, item: str, time: str = "occurred_at") -> DataFrame:
    """Events per item and pane, a span of ``pane_seconds``; counted per task before the shuffle."""
    return events.where(F.col(item).isNotNull() & F.col(time).isNotNull()).groupBy(
        F.col(item).alias("item"), F.window(time, f"{pane_seconds} seconds")["start"].alias("pane")).agg(F.count("*").alias("n"))


def windows(panes: DataFrame, window_seconds: int, slide_seconds: int) -> DataFrame:
    """Counts per item and window from counts per pane; a pane lies in ``window / slide`` windows, its events are not copied."""
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    back = [F.make_dt_interval(secs=F.lit(k * slide_seconds)) for k in range(window_seconds // slide_seconds)]
    return panes.select("item", "n", F.explode(F.array(*(F.col("pane") - b for b in back))).alias("start")).groupBy(
        "start", "item").agg(F.sum("n").alias("n"))


def trending(events: DataFrame, item: str, top: int, window_seconds: int, slide_seconds: int, time: str = "occurred_at") -> DataFrame:
    """``start, rank, item, n``: the ``top`` items of every window; ties go to the lesser item.

    Each task first keeps its own best of each window (the limit on the rank is pushed below the shuffle), so a
    window's final ranking sees at most ``top`` rows a task.
    """
    counts = windows(pane_counts(events, slide_seconds, item, time), window_seconds, slide_seconds)
    best = W.partitionBy("start").orderBy(F.desc("n"), F.asc("item"))
    return counts.withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= top).select("start", "rank", "item", "n")
