"""Top-k, caps per group, latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str] | str, order: list[str]) -> DataFrame:
    """The last written row per key."""
    keys = [keys] if isinstance(keys, str) else keys
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def _rank(df: DataFrame, keys: list[str], order: list[str | Column], n: int, pieces: int = 64) -> DataFrame:
    """Rows with ``_rn`` from 1 to ``n`` per group.

    Spark limits groups inside the map tasks by itself up to a length that the session sets.  Beyond it a hot group is
    first cut into pieces of which each keeps its own first ``n``; the rows are the same either way.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        piece = F.pmod(F.xxhash64(*order), F.lit(pieces))
        inside = Window.partitionBy(*keys, "_piece").orderBy(*order)
        df = (df.withColumn("_piece", piece).withColumn("_rn", F.row_number().over(inside))
              .filter(F.col("_rn") <= n).drop("_piece", "_rn"))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)


def cap_per_group(df: DataFrame, keys: list[str] | str, order: list[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows per group, e.g. 20 comments per post."""
    return _rank(df, [keys] if isinstance(keys, str) else keys, order, n).drop("_rn")


def cap_per_day_and_total(df: DataFrame, keyword: str, ts: str, order: list[str], per_day: int,
                          total: int) -> DataFrame:
    """At most ``per_day`` rows per (keyword, day) and ``total`` per keyword, early days first.

    Days are counted first (one small row per keyword and day); their running total tells how
    many rows of each day still fit, so no keyword is ever ranked as a whole.
    """
    days = df.withColumn("_day", F.to_date(ts))
    running = Window.partitionBy(keyword).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    room = (days.groupBy(keyword, "_day").agg(F.least(F.count("*"), F.lit(per_day)).alias("_n"))
            .withColumn("_room", F.lit(total) - F.coalesce(F.sum("_n").over(running), F.lit(0)))
            .filter("_room > 0").select(keyword, "_day", "_room"))
    ranked = _rank(days, [keyword, "_day"], order, per_day)
    return (ranked.join(room, [keyword, "_day"]).filter(F.col("_rn") <= F.col("_room"))
            .select(*df.columns))


def top_provinces(heat: DataFrame, n: int = 34) -> DataFrame:
    """The busiest places; ties by name."""
    return heat.orderBy(F.desc("count"), "location_province").limit(n)


def top15_reversed(heat: DataFrame, n: int = 15) -> DataFrame:
    """The busiest ``n`` places in ascending order, as a bar chart shows them."""
    return top_provinces(heat, n).orderBy("count", F.desc("location_province"))


def top_edges(edges: DataFrame, n: int = 500) -> DataFrame:
    return edges.orderBy(F.desc("weight"), "src", "dst").limit(n)


def top_nodes(ranks: DataFrame, n: int = 10) -> DataFrame:
    return ranks.orderBy(F.desc("pagerank"), "user").limit(n)


def node_tiers(ranks: DataFrame, shown: int = 50, labelled: int = 10, highlighted: int = 5) -> DataFrame:
    """The ``shown`` best nodes with their position and display tier."""
    position = F.row_number().over(Window.orderBy(F.desc("pagerank"), "user"))
    # The window sees no more than ``shown`` rows.
    return (top_nodes(ranks, shown).withColumn("position", position)
            .withColumn("tier", F.when(F.col("position") <= highlighted, "highlighted")
                        .when(F.col("position") <= labelled, "labelled").otherwise("shown")))


# Sort orders of the search pages: name -> (column, descending).  FIXED VALUES.
SORTS = {
    "popular": ("like_count", True), "most_liked": ("like_count", True),
    "most_replied": ("sub_comment_count", True), "latest": ("create_time", True),
    "oldest": ("create_time", False), "most_clicked": ("view_count", True), "most_marked": ("collect_count", True),
    "most_bullet_comments": ("bullet_count", True),
}


def ranked_search(df: DataFrame, sort: str, n: int, key: str = "comment_id") -> DataFrame:
    """The first ``n`` rows of a search in one of the known sort orders; ties by key."""
    column, descending = SORTS[sort]
    return df.orderBy(F.desc(column) if descending else F.asc(column), key).limit(n)


def most_frequent_terms(frequency: DataFrame, n: int = 150) -> DataFrame:
    return frequency.orderBy(F.desc("count"), "term").limit(n)
