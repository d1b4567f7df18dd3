"""Regional heat and daily trend, merge of batches, reply network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.sentiment import sentiment_net
from ..operators import aggregates, filters, graph, merge, topk
from ..session import stage


def scored(df: DataFrame, positive=fv.TREND_POSITIVE, negative=fv.TREND_NEGATIVE, text: str = "content") -> DataFrame:
    return df.withColumn("sentiment_score", sentiment_net(F.col(text), positive, negative))


def heat_and_trend(df: DataFrame, positive=fv.TREND_POSITIVE, negative=fv.TREND_NEGATIVE
                   ) -> tuple[DataFrame, DataFrame]:
    """(busiest provinces, daily trend).

    Texts are scored once; both results read a stored table of place, time and score.
    """
    rows = stage(scored(df, positive, negative).select("location_province", "create_time", "sentiment_score"), "scored")
    return topk.top_provinces(aggregates.province_heat(rows)), aggregates.daily_trend(rows).orderBy("date")


def merge_update(old: DataFrame | None, new: DataFrame | None, order: list[str]) -> DataFrame:
    """Union two cleaned batches by name and keep one row per content, the first by ``order``; either may be missing."""
    frames = [f for f in (old, new) if f is not None]
    if not frames:
        raise ValueError("no input to merge")
    if len(frames) == 1:
        only = frames[0]
        return merge.merge_batches(only, only.limit(0), order=order)
    return merge.merge_batches(*frames, order=order)


def opinion_leaders(df: DataFrame, author: str = "nickname", text: str = "content",
                    rounds: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(all nodes with PageRank, the 500 heaviest edges) of the reply network."""
    edges = stage(filters.drop_null_edges(graph.edge_weights(graph.build_reply_edges(df, author, text))), "edges")
    return graph.pagerank(edges, rounds=rounds), topk.top_edges(edges)


def display_network(ranks: DataFrame, edges: DataFrame, nodes: int = 50, limit: int = 100) -> DataFrame:
    """Edges around the best nodes, both ends with usable names, as a drawing needs them."""
    from ..operators.joins import edges_touching_top_nodes

    named = filters.valid_name(ranks, "user")
    return edges_touching_top_nodes(filters.valid_name(filters.drop_null_edges(edges), "src", "dst"),
                                    named, nodes, limit)
