"""Aggregations: heat, trend, activity, quantiles, profiles, distributions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.numbers import activity_score, bin_right_closed
from .filters import plausible_timestamp, valid_location


def province_heat(df: DataFrame, place: str = "location_province", score: str = "sentiment_score") -> DataFrame:
    """Rows and mean sentiment per known place."""
    return (valid_location(df, place).groupBy(place)
            .agg(F.count("*").alias("count"), F.round(F.avg(score), 2).alias("avg_sentiment")))


def daily_trend(df: DataFrame, ts: str = "create_time", score: str = "sentiment_score") -> DataFrame:
    """Rows and mean sentiment per day."""
    return (plausible_timestamp(df, ts).groupBy("date")
            .agg(F.count("*").alias("daily_count"), F.round(F.avg(score), 2).alias("daily_sentiment")))


def user_activity(df: DataFrame, user: str = "user_id", comment: str = "comment_id",
                  likes: str = "like_count", replies: str = "sub_comment_count") -> DataFrame:
    """Comments, likes and replies per user, with the activity score."""
    stats = df.filter(F.col(user).isNotNull()).groupBy(user).agg(
        F.count(comment).alias("user_comment_count"),
        F.coalesce(F.sum(likes), F.lit(0)).alias("user_total_likes"),
        F.coalesce(F.sum(replies), F.lit(0)).alias("user_total_replies"),
        F.count("*").alias("user_rows"))
    return stats.withColumn("user_activity_score", activity_score(
        F.col("user_comment_count"), F.col("user_total_likes"), F.col("user_total_replies")))


def exact_quantile(df: DataFrame, value: str, q: float, weight: str | None = None,
                   slots: int = 4096) -> float | None:
    """Exact quantile with linear interpolation over rows, or over ``weight`` rows per row.

    Each pass counts the values of the current bracket in ``slots`` equal slots (partial counts
    in the map tasks, at most ``slots`` rows to the driver) and narrows the bracket to the slot
    that holds the wanted rank.  No task ever holds all values, as an exact percentile would.
    ``df`` is read about three times; stage it first when it is expensive.
    """
    rows = df.select(F.col(value).cast("double").alias("v"),
                     (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("w")
                     ).filter(F.col("v").isNotNull() & ~F.isnan("v") & (F.col("w") > 0))
    total, low, high = rows.agg(F.sum("w"), F.min("v"), F.max("v")).first()
    if not total:
        return None
    position = q * (total - 1)
    rank = math.floor(position)
    fraction = position - rank
    before = 0
    while True:
        if low == high:
            return low
        width = (high - low) / slots
        slot = F.least(F.lit(slots - 1), F.floor((F.col("v") - F.lit(low)) / F.lit(width))) if width > 0 \
            else F.when(F.col("v") == F.lit(low), 0).otherwise(1)
        # The top value gets a slot of its own, so that every pass separates low from high.
        slot = F.when(F.col("v") == F.lit(high), slots).otherwise(slot)
        counts = sorted(
            (r["s"], r["n"], r["lo"], r["hi"]) for r in
            rows.filter(F.col("v").between(low, high)).groupBy(slot.alias("s"))
            .agg(F.sum("w").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        for i, (_, n, lo, hi) in enumerate(counts):
            if before + n > rank:
                break
            before += n
        if fraction and before + n == rank + 1 and i + 1 < len(counts):
            # The wanted value is this slot's largest and its successor opens the next slot.
            return hi + (counts[i + 1][2] - hi) * fraction
        if lo == hi and (not fraction or before + n > rank + 1):
            return lo
        low, high = lo, hi


@dataclass
class _Bracket:
    """Where one quantile of one group lies: ``before`` rows below ``low``, the wanted rank up to ``high``."""

    low: float
    high: float
    rank: int
    fraction: float
    before: int = 0
    found: float | None = None

    def narrow(self, counts: list[tuple]) -> None:
        """(slot, rows, smallest, largest) of the bracket's slots, in order."""
        for i, (_, n, low, high) in enumerate(counts):
            if self.before + n > self.rank:
                break
            self.before += n
        last = self.before + n == self.rank + 1
        if self.fraction and last and i + 1 < len(counts):
            # The wanted value is this slot's largest and its successor opens the next slot.
            self.found = high + (counts[i + 1][2] - high) * self.fraction
        elif low == high and not (self.fraction and last):
            self.found = low
        self.low, self.high = low, high


def grouped_quantiles(df: DataFrame, group: str, value: str, qs: Sequence[float], slots: int = 512) -> dict:
    """Group -> (rows, exact quantiles with linear interpolation), for all groups in the same passes.

    As :func:`exact_quantile`, each pass counts ``slots`` equal slots of every open bracket, so neither a task nor the driver
    holds a group's values: it gets groups x quantiles x slots counters at most.  Groups must be few, such as bins.
    """
    rows = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).filter("g IS NOT NULL AND v IS NOT NULL AND NOT isnan(v)")
    spark, sizes, brackets = df.sparkSession, {}, {}
    for r in rows.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect():
        sizes[r.g] = r.n
        for i, q in enumerate(qs):
            rank = math.floor(q * (r.n - 1))
            brackets[r.g, i] = _Bracket(r.lo, r.hi, rank, q * (r.n - 1) - rank, found=r.lo if r.lo == r.hi else None)
    kind = rows.schema["g"].dataType.simpleString()
    while open_ := {k: b for k, b in brackets.items() if b.found is None}:
        table = spark.createDataFrame([(g, i, b.low, b.high, (b.high - b.low) / slots) for (g, i), b in open_.items()],
                                      f"g {kind}, i int, lo double, hi double, width double")
        slot = F.when(F.col("v") == F.col("hi"), slots).when(F.col("width") > 0, F.least(F.lit(slots - 1), F.floor(
            (F.col("v") - F.col("lo")) / F.col("width")))).otherwise(F.when(F.col("v") == F.col("lo"), 0).otherwise(1))
        inside = rows.join(F.broadcast(table), "g").filter("v BETWEEN lo AND hi")  # at most a row per group and quantile
        counts: dict = {}
        for r in inside.groupBy("g", "i", slot.alias("s")).agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b")).collect():
            counts.setdefault((r.g, r.i), []).append((r.s, r.n, r.a, r.b))
        for key, b in open_.items():
            b.narrow(sorted(counts[key]))
    return {g: (n, [brackets[g, i].found for i in range(len(qs))]) for g, n in sizes.items()}


def boxplot_stats(df: DataFrame, length: str = "content_len", value: str = "norm_score") -> DataFrame:
    """Quartiles and 1.5-IQR whiskers of the value per length group; outliers are left out.

    Groups are bins of the length, a few.  Values may be any numbers; no task holds those of a group.  ``df`` is read several
    times; stage it first when it is expensive.
    """
    rows = df.select(bin_right_closed(F.col(length)).alias("len_group"), F.col(value).alias("_v")).filter("len_group IS NOT NULL")
    found = grouped_quantiles(rows, "len_group", "_v", (0.25, 0.5, 0.75))
    kind = rows.schema["len_group"].dataType.simpleString()
    fences = df.sparkSession.createDataFrame([(g, n, *map(float, q)) for g, (n, q) in found.items()],
                                             f"len_group {kind}, n long, q1 double, median double, q3 double")
    low, high = (F.col("q1") - (F.col("q3") - F.col("q1")) * 1.5, F.col("q3") + (F.col("q3") - F.col("q1")) * 1.5)
    inside = rows.join(F.broadcast(fences), "len_group")  # a row per bin
    return (inside.groupBy("len_group", "n", "q1", "median", "q3")
            .agg(F.least(F.min(F.when(F.col("_v") >= low, F.col("_v"))), F.col("q1")).alias("whisker_low"),
                 F.greatest(F.max(F.when(F.col("_v") <= high, F.col("_v"))), F.col("q3")).alias("whisker_high")))


def minmax_normalise(df: DataFrame, column: str, out: str) -> DataFrame:
    """(x - min) / (max - min) over the rows given; 0 when all are equal."""
    low, high = df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()
    span = high - low
    return df.withColumn(out, F.when(span == 0, F.lit(0.0)).otherwise((F.col(column) - low) / span))


def word_frequency(df: DataFrame, tokens: str = "words", stop_words: DataFrame | None = None) -> DataFrame:
    """Occurrences per token; rows of the ``term`` column of ``stop_words`` are left out."""
    # A plain explode makes Spark filter out empty arrays first, which repeats the tokenizing.
    terms = df.select(F.explode_outer(tokens).alias("term")).filter("term IS NOT NULL")
    counts = terms.groupBy("term").agg(F.count("*").alias("count"))
    # Few distinct terms are left after counting, so the anti join moves little data.
    return counts.join(stop_words.select("term"), "term", "left_anti") if stop_words is not None else counts


def cluster_share(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Rows and percentage per cluster."""
    counts = df.groupBy(cluster).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percent", F.round(F.col("count") * 100.0 / total, 1))


def null_profile(df: DataFrame) -> DataFrame:
    """Column name, type and number of nulls, from one pass."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    types = dict(df.dtypes)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"),
                              F.col(c).alias("missing")) for c in df.columns])
    return counts.select(F.inline(rows))


def retention(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows before and after cleaning, removed rows, and the share kept as text."""
    both = raw.select(F.lit(1).alias("r"), F.lit(0).alias("c")).union(clean.select(F.lit(0), F.lit(1)))
    sums = both.agg(F.coalesce(F.sum("r"), F.lit(0)).alias("raw_records"),
                    F.coalesce(F.sum("c"), F.lit(0)).alias("cleaned_records"))
    return sums.select("*", (F.col("raw_records") - F.col("cleaned_records")).alias("records_removed"),
                       retention_rate(F.col("raw_records"), F.col("cleaned_records")).alias("retention_rate"))


def retention_rate(raw: Column, clean: Column) -> Column:
    return F.when(raw > 0, F.format_string("%.2f%%", clean * 100.0 / F.nullif(raw, F.lit(0)))).otherwise("N/A")


def quality_metrics(clean: DataFrame) -> DataFrame:
    """Missing content, mean length, shares of pictures and replies, mean sentiment, leaders."""
    def mean(name: str) -> Column:
        return F.coalesce(F.avg(F.col(name).cast("double")), F.lit(0.0)) if name in clean.columns else F.lit(0.0)

    missing = F.count(F.when(F.col("content").isNull(), 1)) if "content" in clean.columns else F.lit(0)
    leaders = F.count(F.when(F.col("is_kol"), 1)) if "is_kol" in clean.columns else F.lit(0)
    return clean.agg(missing.alias("missing_content"), mean("content_length").alias("avg_content_length"),
                     mean("has_picture").alias("has_picture_ratio"), mean("is_reply").alias("reply_ratio"),
                     mean("sentiment_score").alias("avg_sentiment_score"), leaders.alias("kol_count"))


def time_range(df: DataFrame, ts: str = "create_time") -> DataFrame:
    pattern = "yyyy-MM-dd HH:mm:ss"
    return df.agg(F.date_format(F.min(ts), pattern).alias("start"), F.date_format(F.max(ts), pattern).alias("end"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))


def keyword_yield(df: DataFrame, keyword: str = "source_keyword") -> DataFrame:
    """Posts found per search keyword."""
    return df.groupBy(keyword).agg(F.count("*").alias("posts"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def topic_label(cluster: Column, names: dict[int, str] = fv.TOPIC_NAMES, fallback: bool = True) -> Column:
    """Display name of a cluster; ``Cluster i`` or null for an unknown one."""
    label = F.concat(F.lit("Cluster "), cluster.cast("string")) if fallback else F.lit(None).cast("string")
    for number, name in names.items():
        label = F.when(cluster == number, name).otherwise(label)
    return label
