"""Operator 1: mixing sources to target weights by entropy balancing.  DataFrame functions only.

Of all rates for the documents that give every source its target number of tokens, those closest to one copy each in
relative entropy are ``min(cap, exp(lambda * size))`` with one multiplier per source.  The multipliers solve a convex
dual; Newton steps, guarded by a bracket, find all of them at once.  A step is one aggregation of a histogram of
(source, size), in which a source that holds a third of all rows is no longer than any other.

Rates become copies by a dither per document, the same on every run.  The dither of a source is shifted until its copies
hold the target number of tokens; the shift is a quantile found by counting, so nothing is sorted or collected.  A gap
that is smaller than the next document is filled with smaller ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .stages import Rounds
from .words import WORD

WEIGHTS, CAP = (1.0, 2.0, 3.0), 3
BROADCAST_SOURCES = 100_000
_BINS, _ROUNDS, _PICKS, _NEWTON, _CLOSE = 1024, 3, 3, 80, 1e-9


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A hint where the per-source table is known to be small; else Spark picks a join that can split a hot source."""
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def _numbered(sources: DataFrame) -> DataFrame:
    """``rank`` of each source from 0 by code point, null last, without one task that sees all of them."""
    parts = stage(sources.withColumn("__last", F.col("source").isNull()).repartitionByRange("__last", "source").sortWithinPartitions(
        "__last", "source").withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()), "mix-order")
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__from"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)))  # a row per partition, not per source
    return parts.join(F.broadcast(before.select("__part", "__before", "__from")), "__part").select(
        "source", "source_size", "n_docs", (F.col("__before") + F.col("__at") - F.col("__from")).alias("rank"))


def source_targets(histogram: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, n_docs, weight, target): the weighted shares of all tokens, none above ``cap`` times its source.

    What a share exceeds is dealt out again by weight among the others until none is above.
    """
    sources = stage(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs")), "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    ranked = stage(_numbered(sources).withColumn("weight", weight), "mix-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * cap
    level = 0.0
    while True:
        full = limit <= F.col("weight") * level
        state = ranked.agg(F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        free = state[1] or 0.0
        risen = (total - (state[0] or 0)) / free if free else level
        if risen <= level:
            return ranked.withColumn("target", F.least(limit.cast("double"), F.col("weight") * level))
        level = risen


def _rate(multiplier: Column, capped: Column, x: Column, cap: int) -> Column:
    return F.when(capped, F.lit(float(cap))).otherwise(F.least(F.lit(float(cap)), F.exp(F.least(multiplier * x, F.lit(50.0)))))


def balance(histogram: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """``targets`` with ``multiplier``, ``unit`` and ``full``: the rate of a document is
    ``cap`` if ``full``, else ``min(cap, exp(multiplier * size / unit))``.
    """
    spark = histogram.sparkSession
    rounds = Rounds(spark, "mix-newton")
    sources = targets.count()
    units = histogram.where("size > 0").groupBy(F.col("source").alias("__s")).agg((F.sum(
        F.col("n") * F.col("size") * F.col("size")) / F.sum(F.col("n") * F.col("size"))).alias("unit"))
    state = rounds.put(targets.join(_small(units, sources), F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s").select(
        "*", (F.col("target") >= cap * F.col("source_size")).alias("full"), F.lit(0.0).alias("multiplier"),
        F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), (F.col("target") >= cap * F.col("source_size")).alias("done")))
    for _ in range(_NEWTON):
        if state.where("NOT done").isEmpty():
            return state.drop("low", "high", "done")
        now = state.select(F.col("source").alias("__s"), "multiplier", "unit", "target").where("NOT done")
        x = F.col("size") / F.col("unit")
        raw = F.exp(F.least(F.col("multiplier") * x, F.lit(50.0)))
        slope = F.when(raw < cap, raw * x * F.col("size")).otherwise(0.0)
        sums = histogram.where("size > 0").join(_small(now, sources), F.col("source").eqNullSafe(F.col("__s"))).groupBy("__s").agg(
            F.sum(F.col("n") * F.col("size") * F.least(raw, F.lit(float(cap)))).alias("tokens"), F.sum(F.col("n") * slope).alias("slope"))
        over = F.col("tokens") - F.col("target")
        close = F.abs(over) <= _CLOSE * F.col("target")
        low, high = F.when(over < 0, F.col("multiplier")).otherwise(F.col("low")), F.when(over > 0, F.col("multiplier")).otherwise(F.col("high"))
        moved = state.join(_small(sums, sources), F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s")
        step = moved.withColumns({"low": F.coalesce(low, "low"), "high": F.coalesce(high, "high")}).withColumn(
            "__next", F.col("multiplier") - F.try_divide(over, F.col("slope")))
        # Outside the bracket, halve it; while an end is still open, go twice as far from zero.
        middle = F.when(F.col("high") >= 1e6, F.greatest(F.lit(1.0), 2 * F.col("low"))).when(
            F.col("low") <= -1e6, F.least(F.lit(-1.0), 2 * F.col("high"))).otherwise((F.col("low") + F.col("high")) / 2)
        inside = (F.col("slope") > 0) & (F.col("__next") > F.col("low")) & (F.col("__next") < F.col("high"))
        narrow = F.col("high") - F.col("low") <= 1e-15 * F.greatest(F.abs("high"), F.abs("low"))
        done = F.col("done") | F.coalesce(close | narrow, F.col("tokens").isNull())
        state = rounds.put(step.withColumn("__done", done).withColumn("multiplier", F.when(F.col("__done"), F.col("multiplier")).when(
            inside, F.col("__next")).otherwise(middle)).withColumn("done", F.col("__done")).drop("__next", "__done", "tokens", "slope"))
    raise ArithmeticError(f"no balance after {_NEWTON} rounds")


def _picks(rated: DataFrame, solved: DataFrame, cap: int) -> DataFrame:
    """(__s, picks): per source an array of (gap, shift); a copy is taken if one of them has its size within the gap and
    its begin within the shift.

    Copy k of a document of rate r and dither u begins at the shift ``k - r - u``, so how far to shift is a weighted
    quantile of the begins; each round counts them in finer bins of the bin found.  The first pick is open to all sizes
    and stops before the copy that would exceed the target; the later ones go on with what fits into the gap left.
    """
    sources = solved.count()
    rounds = Rounds(rated.sparkSession, "mix-shift")
    begins = stage(rated.where("size > 0").select("source", "size", F.explode(F.transform(
        F.sequence(F.lit(1), F.lit(cap)), lambda k: k - F.col("rate") - F.col("dither"))).alias("begin")), "mix-begins")
    top, none = float(cap), F.array().cast("array<struct<gap:double,shift:double>>")
    state = solved.select(F.col("source").alias("__s"), F.col("target").alias("wanted"), F.lit(-top).alias("shift"),
                          F.lit(float("inf")).alias("gap"), none.alias("picks"))
    for _ in range(_PICKS):
        state = rounds.put(state.withColumns({"low": F.col("shift"), "width": top - F.col("shift")}))
        for _ in range(_ROUNDS):
            bins = _open(begins, state, sources).where("begin <= low + width").groupBy(
                "source", F.ceil((F.col("begin") - F.col("low")) / F.col("width") * _BINS).cast("int").alias("bin")).agg(F.sum("size").alias("tokens"))
            upto = bins.withColumn("upto", F.sum("tokens").over(Window.partitionBy("source").orderBy("bin")))
            under = upto.join(_small(state, sources), F.col("source").eqNullSafe(F.col("__s"))).where("upto <= wanted").groupBy(
                F.col("source").alias("__of")).agg(F.max("bin").alias("bin"), F.max("upto").alias("tokens"))
            state = rounds.put(state.join(_small(under, sources), F.col("__s").eqNullSafe(F.col("__of")), "left").withColumns({
                "wanted": F.col("wanted") - F.coalesce("tokens", F.lit(0)), "low": F.col("low") + F.coalesce(
                    "bin", F.lit(0)) * F.col("width") / _BINS, "width": F.col("width") / _BINS}).drop("__of", "bin", "tokens"))
        state = rounds.put(state.select("__s", "wanted", F.col("low").alias("shift"), F.col("wanted").alias("gap"), F.concat(
            "picks", F.array(F.struct("gap", F.col("low").alias("shift")))).alias("picks")))
    # One copy more if that comes nearer: of those small enough the first to begin.
    more = begins.join(_small(state, sources), F.col("source").eqNullSafe(F.col("__s"))).where(F.col("size") < 2 * F.col("wanted")).where(
        ~_taken(F.col("size"), F.col("begin"))).groupBy(F.col("source").alias("__of")).agg(F.min(F.struct("begin", "size")).alias("m"))
    last = F.when(F.col("m").isNull(), F.col("picks")).otherwise(F.concat("picks", F.array(F.struct(
        F.col("m.size").cast("double").alias("gap"), F.col("m.begin").alias("shift")))))
    return stage(state.join(_small(more, sources), F.col("__s").eqNullSafe(F.col("__of")), "left").select("__s", last.alias("picks")), "mix-picks")


def _taken(size: Column, begin: Column) -> Column:
    return F.exists("picks", lambda p: (size <= p["gap"]) & (begin <= p["shift"]))


def _open(begins: DataFrame, state: DataFrame, sources: int) -> DataFrame:
    """The copies that a pick can still take."""
    return begins.join(_small(state, sources), F.col("source").eqNullSafe(F.col("__s"))).where("size <= gap AND begin > low")


def mix_sources(docs: DataFrame, text: str = "text", source: str = "source", weights: tuple[float, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per input row: struct ``row`` (its columns), ``size``, ``source_size``, ``target``, ``rate``, ``copies``, ``taken``.

    ``size`` counts words (null: 0).  Sources by code point, null last, weigh ``weights`` in turn and share all tokens.
    ``copies`` is how often the mix takes the document, at most ``cap``; ``taken`` is ``copies * size``.  A source's taken
    tokens stay nearer to its target than a small document's size, unless it has too few.  A document without words has one
    copy.  The dither depends on ``doc_id`` and the text, so reruns agree; repeated rows are dithered alike.  An empty
    table gives an empty table.
    """
    counted = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    dither = F.pmod(F.xxhash64("doc_id", F.col(text)), F.lit(1 << 40)) / float(1 << 40)
    names = [F.col(f"`{c}`") for c in docs.columns]
    sized = docs.select(F.struct(*names).alias("row"), F.col(source).alias("source"), counted.alias("size"), dither.alias("dither"))
    slim = stage(sized.select("source", "size", "dither"), "mix-sizes")
    histogram = stage(slim.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-histogram")
    targets = stage(source_targets(histogram, weights, cap), "mix-targets")
    solved = stage(balance(histogram, targets, cap), "mix-multipliers")
    sources = solved.count()
    known = _small(solved.withColumnRenamed("source", "__s"), sources)
    rate = _rate(F.col("multiplier"), F.col("full"), F.col("size") / F.col("unit"), cap)
    rate = F.when(F.col("size") > 0, rate).otherwise(F.lit(1.0))

    def rated(rows: DataFrame) -> DataFrame:
        return rows.join(known, F.col("source").eqNullSafe(F.col("__s"))).withColumn("rate", rate)

    picks = _picks(rated(slim).select("source", "size", "rate", "dither"), solved, cap)
    out = rated(sized).drop("__s").join(_small(picks, sources), F.col("source").eqNullSafe(F.col("__s")))
    taken = F.filter(F.sequence(F.lit(1), F.lit(cap)), lambda k: _taken(F.col("size"), k - F.col("rate") - F.col("dither")))
    copies = F.when(F.col("size") > 0, F.size(taken)).otherwise(1).cast("long")
    return out.select("row", "size", "source_size", "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
