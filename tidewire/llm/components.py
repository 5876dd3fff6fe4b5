"""Connected components by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import stored


def _stars(edges: DataFrame, both: bool) -> DataFrame:
    """One star step: every node links its neighbours to the least of them and itself.

    Large (``both``): all neighbours are seen, the greater ones are linked. Small: only lesser ones are seen. The
    least neighbour is an aggregate joined back, so a node with very many neighbours is no single group.
    """
    seen = edges.unionByName(edges.select(F.col("a").alias("b"), F.col("b").alias("a"))) if both else edges
    least = seen.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("least", "a"))
    linked = seen.join(least, "a").where(F.col("b") > F.col("a") if both else F.lit(True))
    made = linked.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not both:
        made = made.unionByName(least.select("a", F.col("least").alias("b")))
    return made.where("a != b").distinct()


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node, component`` of every node of ``edges`` (columns ``a``, ``b``); the component is its least node.

    Each round is stored, so lineage stays short and lost executors cost one round. Rounds grow with the logarithm
    of the nodes. Nodes must not be null; loops and repeated edges are ignored.
    """
    current = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), label)
    state = None
    while True:
        measured = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if measured == state:
            break
        state = measured
        current = stored(_stars(_stars(current, True), False), label)
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
