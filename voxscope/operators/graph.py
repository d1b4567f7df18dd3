"""Reply and follower graphs: weighted edges, degrees, PageRank."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import mention_target, normalise_mention
from ..session import stage, stage_path


def build_reply_edges(df: DataFrame, author: str = "nickname", text: str = "content",
                      normalise: bool = False) -> DataFrame:
    """(src, dst) pairs: who answers or mentions whom, from the raw text."""
    target = mention_target(F.col(text))
    if normalise:
        target = normalise_mention(target)
    return (df.select(F.trim(author).alias("src"), F.trim(target).alias("dst"))
            .filter(F.col("src").isNotNull() & (F.length("dst") > 0)))


def edge_weights(pairs: DataFrame) -> DataFrame:
    """Occurrences per pair."""
    return pairs.groupBy("src", "dst").agg(F.count("*").alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """In- and out-degree and weights per node, from one aggregation."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("user"), F.lit(1).alias("o"), F.lit(0).alias("i"),
                 F.col("weight").alias("wo"), (F.col("weight") * 0).alias("wi")),
        F.struct(F.col("dst").alias("user"), F.lit(0).alias("o"), F.lit(1).alias("i"),
                 (F.col("weight") * 0).alias("wo"), F.col("weight").alias("wi")))).alias("e")).select("e.*")
    return ends.groupBy("user").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"),
                                    F.sum("wo").alias("out_weight"), F.sum("wi").alias("in_weight"))


def pagerank(edges: DataFrame, alpha: float = 0.85, tolerance: float = 1e-6, max_rounds: int = 100,
             rounds: int | None = None, piece: int = 100_000) -> DataFrame:
    """(user, pagerank) of a weighted directed graph; the ranks add up to 1.

    Nodes without outgoing edges spread their rank evenly.  Iteration stops when the summed
    change falls below nodes * tolerance, or after exactly ``rounds`` rounds when given.  If that does not
    happen within ``max_rounds`` rounds, an ArithmeticError is raised.

    One round is one job: a join, an aggregation, and a table write that also measures the rank
    of nodes without links and the change.  The links stay in memory, partitioned by (node,
    piece); a node with more than ``piece`` links is cut into pieces and its rank is copied once
    per piece, so that no task gets all links of a popular node.  Reading each round from a
    table keeps plans short, and a lost executor costs one round at most.
    """
    spark = edges.sparkSession
    edges = stage(edges.select("src", "dst", F.col("weight").cast("double").alias("weight")), "pagerank-edges")
    nodes = stage(degrees(edges)
                  .select("user", F.col("out_weight").alias("_out"), F.col("out_degree").alias("_links"),
                          F.greatest(F.lit(1), F.ceil(F.col("out_degree") / piece)).cast("int").alias("_pieces")),
                  "pagerank-nodes")
    n = nodes.count()
    if n == 0:
        return nodes.select("user", F.lit(0.0).alias("pagerank"))
    links = stage(
        edges.join(nodes.select(F.col("user").alias("src"), "_out", "_pieces"), "src")
        .select("src", F.pmod(F.hash("dst"), "_pieces").alias("piece"), "dst",
                (F.col("weight") / F.col("_out")).alias("share")), "pagerank-links")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = links.repartition(parts, "src", "piece").persist(StorageLevel.MEMORY_AND_DISK)
    ranks = nodes.select("user", F.lit(1.0 / n).alias("rank"), F.lit(0.0).alias("previous"),
                         (F.col("_links") == 0).alias("dangling"), "_pieces")
    lost = ranks.filter("dangling").count() / n
    try:
        # A round reads the table of the round before and replaces the one before that.
        tables = [stage_path(spark, "pagerank-ranks") for _ in range(2)]
        for done in range(rounds if rounds is not None else max_rounds):
            spread = ranks.select(F.col("user").alias("src"), "rank", F.explode(
                F.sequence(F.lit(0), F.col("_pieces") - 1)).alias("piece"))
            received = links.join(spread, ["src", "piece"]).select(
                F.col("dst").alias("user"), (F.col("rank") * F.col("share")).alias("gain"),
                F.lit(None).cast("double").alias("previous"), F.lit(None).cast("boolean").alias("dangling"),
                F.lit(None).cast("int").alias("_pieces"))
            kept = ranks.select("user", F.lit(0.0).alias("gain"), F.col("rank").alias("previous"),
                                "dangling", "_pieces")
            base = alpha * lost / n + (1.0 - alpha) / n
            after = received.union(kept).groupBy("user").agg(
                (F.sum("gain") * alpha + F.lit(base)).alias("rank"), F.max("previous").alias("previous"),
                F.max("dangling").alias("dangling"), F.max("_pieces").alias("_pieces"))
            seen = Observation()
            ranks = stage(after.observe(
                seen, F.coalesce(F.sum(F.when(F.col("dangling"), F.col("rank"))), F.lit(0.0)).alias("lost"),
                F.sum(F.abs(F.col("rank") - F.col("previous"))).alias("change")), "", tables[done % 2])
            lost = seen.get["lost"]
            if rounds is None and seen.get["change"] < n * tolerance:
                break
        else:
            if rounds is None:
                raise ArithmeticError(f"no PageRank within {tolerance} after {max_rounds} rounds")
    finally:
        links.unpersist()
    return ranks.select("user", F.col("rank").alias("pagerank"))
