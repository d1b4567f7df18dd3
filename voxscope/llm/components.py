"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stages import Rounds, few_tasks


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches; ``links`` has columns ``a`` and ``b``.

    Alternating stars: first every larger neighbour of a node is linked to the node's smallest neighbour, then every
    smaller one, until the links no longer change.  The rounds grow with the logarithm of the longest chain.  Minima are
    combined before the shuffle and joined back as a table of their own, so that adaptive execution can split a hot node.
    The number of links is known in each round, and tasks follow it.
    Nulls and loops are ignored; a node without links is not in the result.
    """
    spark = links.sparkSession
    rounds, lows = Rounds(spark, "links"), Rounds(spark, "lows")
    edges = rounds.put(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38)"))).first()
        if state == before or state[0] == 0:
            found = edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
            return few_tasks(found, 2 * state[0])
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        most = 2 * state[0]
        low = lows.put(few_tasks(both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low")), most))
        large = rounds.put(few_tasks(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), most))
        low = lows.put(few_tasks(large.groupBy("a").agg(F.min("b").alias("low")), most))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
        edges = rounds.put(few_tasks(small.select("e.*").where("a > b").distinct(), 2 * most))
