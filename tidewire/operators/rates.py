"""Events per tick: rates, zero ticks, rolling history and running totals.

A tick is a fixed span of event time. The wall-clock version of the same
numbers is a streaming job (``tidewire.streaming.meter``).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidewire.session import write_through

# Fixed value: ticks the rolling history keeps.
HISTORY = 30

#: Ticks handled by one task. The rows of a block are bounded by it, however many events a tick holds.
BLOCK_TICKS = 3600


def _seconds(count: int) -> str:
    return f"{count} seconds"


def _interval(seconds: int) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))


def rate_per_tick(events: DataFrame, tick_seconds: int = 1, time: str = "occurred_at", by: str = "topic") -> DataFrame:
    """Events per ``by`` and tick, for ticks that have any. Counted per task before the shuffle.

    An event without a time belongs to no tick.
    """
    tick = F.window(time, _seconds(tick_seconds))["start"]
    return events.groupBy(by, tick.alias("tick")).agg(F.count("*").alias("rate"))


def _spine(rates: DataFrame, tick_seconds: int, block_ticks: int, lead_in: int, by: str) -> DataFrame:
    """Every tick from the first to the last of each series, cut into blocks.

    Each block also carries the ``lead_in`` ticks before it (``own`` is false
    there) and ``before``, the sum of all earlier blocks. Only the block
    summary, one row per non-empty block, is ordered per series; the ticks
    themselves are generated in parallel, block by block.
    """
    tick, block = _interval(tick_seconds), _interval(tick_seconds * block_ticks)
    blocks = (
        rates.groupBy(by, F.window("tick", _seconds(tick_seconds * block_ticks))["start"].alias("block"))
        .agg(F.sum("rate").alias("size"), F.min("tick").alias("first"), F.max("tick").alias("last"))
    )
    series = W.partitionBy(by).orderBy("block")
    whole = W.partitionBy(by)
    spans = blocks.select(
        by,
        "block",
        "size",
        F.coalesce(F.sum("size").over(series.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.lead("block").over(series).alias("next"),
        F.min("first").over(whole).alias("start"),
        F.max("last").over(whole).alias("end"),
    )
    # A block with events also stands for the empty blocks up to the next one.
    last_covered = F.coalesce(F.col("next") - block, F.col("block"))
    covered = spans.select(
        by, "size", "before", "start", "end", F.col("block").alias("source"),
        F.explode(F.sequence(F.col("block"), last_covered, block)).alias("block"),
    ).select(
        by, "block", "start", "end",
        (F.col("before") + F.when(F.col("block") == F.col("source"), F.lit(0)).otherwise(F.col("size")))
        .alias("before"),
    )
    from_tick = F.greatest(F.col("start"), F.col("block") - _interval(tick_seconds * lead_in))
    to_tick = F.least(F.col("end"), F.col("block") + block - tick)
    # A block row is tiny and its ticks are not, so the number of partitions is given:
    # left to itself, adaptive execution would merge the blocks into one task.
    width = int(rates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        covered.repartition(width, by, "block")
        .select(by, "block", "before", F.explode(F.sequence(from_tick, to_tick, tick)).alias("tick"))
        .withColumn("own", F.col("tick") >= F.col("block"))
    )


def _filled(rates: DataFrame, tick_seconds: int, block_ticks: int, lead_in: int, by: str) -> DataFrame:
    if block_ticks < lead_in:
        raise ValueError("a block must hold at least as many ticks as it looks back")
    # Both the spine and the join read the rates. Stored once, they cost one scan of the
    # events; a tick table is small beside them. Spark picks the join by the table's size.
    stored = write_through(rates.select(by, "tick", "rate"), "rates")
    spine = _spine(stored, tick_seconds, block_ticks, lead_in, by)
    return spine.join(stored, [by, "tick"], "left").withColumn("rate", F.coalesce("rate", F.lit(0)))


def gap_filled(rates: DataFrame, tick_seconds: int = 1, by: str = "topic", block_ticks: int = BLOCK_TICKS) -> DataFrame:
    """Rates with a zero row for every tick without events between the first and last tick."""
    return _filled(rates, tick_seconds, block_ticks, 0, by).select(by, "tick", "rate")


def running_total(rates: DataFrame, tick_seconds: int = 1, by: str = "topic", block_ticks: int = BLOCK_TICKS) -> DataFrame:
    """Events since the start, at every tick."""
    so_far = W.partitionBy(by, "block").orderBy("tick").rowsBetween(W.unboundedPreceding, 0)
    filled = _filled(rates, tick_seconds, block_ticks, 0, by)
    return filled.select(by, "tick", (F.col("before") + F.sum("rate").over(so_far)).alias("total"))


def snapshots(
    rates: DataFrame,
    tick_seconds: int = 1,
    by: str = "topic",
    history: int = HISTORY,
    block_ticks: int = BLOCK_TICKS,
) -> DataFrame:
    """Per tick: rate, total since the start, and the last ``history`` rates, oldest first.

    A block repeats the ticks just before it, so the look-back never leaves
    the block and no window spans a whole series.
    """
    in_block = W.partitionBy(by, "block").orderBy("tick")
    own_rate = F.when(F.col("own"), F.col("rate")).otherwise(F.lit(0))
    filled = _filled(rates, tick_seconds, block_ticks, history - 1, by)
    return (
        filled.select(
            by,
            "tick",
            "rate",
            "own",
            (F.col("before") + F.sum(own_rate).over(in_block.rowsBetween(W.unboundedPreceding, 0))).alias("total"),
            F.collect_list("rate").over(in_block.rowsBetween(1 - history, 0)).alias("history"),
        )
        .where("own")
        .drop("own")
    )


def with_peak(snapshot: DataFrame) -> DataFrame:
    """Chart scale: the history's peak, at least 1, and the history as shares of it."""
    return snapshot.withColumn("peak", F.greatest(F.lit(1), F.array_max("history"))).withColumn(
        "scaled", F.transform("history", lambda rate: rate / F.col("peak"))
    )


def partition_sizing(rates: DataFrame, budget: int, caps: dict[str, int], by: str = "topic") -> DataFrame:
    """Partitions each series needs at its peak rate: peak over budget, rounded up, up to its cap."""
    needed = F.ceil(F.col("peak") / F.lit(budget))
    limit = F.lit(None).cast("int")
    for name, cap in caps.items():
        limit = F.when(F.col(by) == name, F.lit(cap)).otherwise(limit)
    return (
        rates.groupBy(by)
        .agg(F.max("rate").alias("peak"))
        .select(by, "peak", F.least(needed, limit).cast("int").alias("partitions"))
    )
