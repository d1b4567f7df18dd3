"""Joins between users, posts, comments and graph nodes.

All are equi-joins with one unique side.  A hot key then sits on the other side only, where the
adaptive skew join splits it; the unique side is broadcast when Spark finds it small enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import is_reply
from ..session import stage
from .aggregates import exact_quantile, user_activity
from .topk import top_nodes


def attach_user_stats(df: DataFrame, stats: DataFrame | None = None, user: str = "user_id") -> DataFrame:
    """Add each user's totals to the user's rows.

    Totals are pre-aggregated and staged, so the join sees one row per user and can split a hot one.
    ``df`` is read twice unless ``stats`` is given; stage it first when it is expensive.
    """
    stats = stage(user_activity(df, user), "user-stats") if stats is None else stats
    return df.join(stats.drop("user_rows"), user, "left")


def flag_kol(df: DataFrame, threshold: float | Column | None, score: str = "user_activity_score") -> DataFrame:
    """Opinion leaders: rows whose user scores at least the threshold."""
    limit = F.lit(threshold) if not isinstance(threshold, Column) else threshold
    return df.withColumn("is_kol", F.col(score) >= limit)


def activity_threshold(stats: DataFrame, q: float = 0.9) -> float | None:
    """Quantile of the activity score over comment rows, from the per-user totals."""
    return exact_quantile(stats, "user_activity_score", q, weight="user_rows")


def edges_touching_top_nodes(edges: DataFrame, ranks: DataFrame, nodes: int = 50, limit: int = 100) -> DataFrame:
    """The heaviest edges that start or end at one of the best nodes."""
    best = top_nodes(ranks, nodes).select("user")
    from_best = best.select(F.col("user").alias("src"), F.lit(True).alias("_s"))
    to_best = best.select(F.col("user").alias("dst"), F.lit(True).alias("_d"))
    return (edges.join(from_best, "src", "left").join(to_best, "dst", "left")
            .filter(F.col("_s") | F.col("_d")).select("src", "dst", "weight")
            .orderBy(F.desc("weight"), "src", "dst").limit(limit))


def node_scores(nodes: DataFrame, ranks: DataFrame, default: float = 0.001) -> DataFrame:
    """Rank per node, with a default for nodes that have none."""
    return nodes.join(ranks, "user", "left").withColumn("pagerank", F.coalesce("pagerank", F.lit(default)))


def inherit_parent(comments: DataFrame, columns: list[str], key: str = "comment_id",
                   parent: str = "parent_comment_id") -> DataFrame:
    """Replies take the given columns from their parent; without a parent they keep their own."""
    parents = comments.select(F.col(key).alias(parent), *[F.col(c).alias(f"_parent_{c}") for c in columns])
    # Comments without a parent share one key, mostly the hottest of all; they skip the join.
    has_parent = is_reply(F.col(parent))
    joined = comments.filter(has_parent).join(parents, parent, "left")
    replies = joined.withColumns({c: F.coalesce(f"_parent_{c}", c) for c in columns}).select(*comments.columns)
    return comments.filter(~has_parent).unionByName(replies)


def comment_to_post(comments: DataFrame, posts: DataFrame, how: str = "inner", key: str = "note_id") -> DataFrame:
    """Comments with their post (inner, left) or comments without one (left_anti)."""
    return comments.join(posts, key, how)


def label_lookup(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Attach display columns from a lookup table with one row per key."""
    return df.join(labels, key, "left")
