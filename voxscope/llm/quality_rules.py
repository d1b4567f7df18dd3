"""Operator 3: quality rules, of which the last is cross-document line frequency.  DataFrame functions only.

Lines are normalised and hashed; the distinct documents of a host that hold a line are counted; lines above the host's
limit are removed, and documents that lose most of their words are rejected.  At most 1 / ``max_share`` times the mean
number of lines of a document can be above a host's limit, so a host's list is small whatever its size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import BLANKS, WORD

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
MAX_SHARE, MIN_DOCS, MIN_LEFT = 0.05, 3, 0.3
BROADCAST_HOSTS = 100_000
_BLANK_CHARS = "\t\n\x0b\x0c\r "
_POSITION = (1 << 30) - 1


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` names it, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """The words of a text in order; null gives none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANK_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, BLANKS))


def repeated_words(w: Column) -> Column:
    """How many words stand in a 3-word window that the text holds twice or more.

    Windows are sorted by 34 bits of their hash with their position in the same long; only those that share these bits
    are then compared as texts.
    """
    at = lambda a, i: F.get(a, i)
    packed = lambda a: F.transform(
        F.sequence(F.lit(0), F.size(a) - 3),
        lambda i: F.xxhash64(at(a, i), at(a, i + 1), at(a, i + 2)).bitwiseAND(F.lit(~_POSITION)).bitwiseOR(i.cast("long")))
    high = lambda x: F.shiftright(x, 30)
    beside = lambda s, part: F.filter(s, lambda x, i: F.coalesce(
        part(x) == part(at(s, i + 1)), F.lit(False)) | ((i > 0) & F.coalesce(part(x) == part(at(s, i - 1)), F.lit(False))))
    texts = lambda a, s: F.transform(s, lambda x: bound(
        x.bitwiseAND(F.lit(_POSITION)).cast("int"),
        lambda p: F.struct(F.concat_ws(" ", at(a, p), at(a, p + 1), at(a, p + 2)).alias("t"), p.alias("p"))))
    gaps = lambda q: F.aggregate(F.transform(q, lambda p, j: F.least(F.lit(3), at(q, j + 1) - p)), F.lit(0), lambda t, g: t + g)
    places = lambda s: F.sort_array(F.transform(beside(s, lambda x: x["t"]), lambda x: x["p"]))

    def count(a: Column) -> Column:
        alike = bound(F.sort_array(packed(a)), lambda s: beside(s, high))
        return bound(alike, lambda s: F.when(F.size(s) == 0, F.lit(0)).otherwise(
            bound(F.sort_array(texts(a, s)), lambda t: bound(places(t), gaps))))

    return bound(w, lambda a: F.when(F.size(a) < 3, F.lit(0)).otherwise(count(a)))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(WORD))


def line_key(line: Column) -> Column:
    """Hash of a line without case and outer or repeated blanks."""
    return F.xxhash64(F.lower(F.btrim(F.regexp_replace(line, BLANKS, " "))))


def frequent_lines(docs: DataFrame, text: str = "text", host: str = "source", max_share: float = MAX_SHARE,
                   min_docs: int = MIN_DOCS) -> DataFrame:
    """(__host, __bad): per host the hashes of lines that stand in more than ``max_share`` of its distinct texts.

    A line needs ``min_docs`` texts at least, the least that is more than a pair.  Exact copies are one text: they are for
    deduplication to judge.
    """
    base = docs.select(F.col(host).alias("__host"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__doc"), F.array_distinct(
        F.transform(lines_with_words(F.col(text)), line_key)).alias("__lines"))
    sizes = base.groupBy("__host").agg(F.countDistinct("__doc").alias("__docs"))
    counts = base.select("__host", "__doc", F.explode("__lines").alias("__line")).groupBy("__host", "__line").agg(
        F.countDistinct("__doc").alias("__n")).where(F.col("__n") >= min_docs)
    sizes = sizes.withColumnRenamed("__host", "__of")
    bad = counts.join(sizes, F.col("__host").eqNullSafe(F.col("__of"))).where(F.col("__n") > F.col("__docs") * max_share)
    return bad.groupBy("__host").agg(F.sort_array(F.collect_set("__line")).alias("__bad"))


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source", max_share: float = MAX_SHARE,
                  min_docs: int = MIN_DOCS, min_left: float = MIN_LEFT) -> DataFrame:
    """One row per input row: struct ``row`` (its columns), the counts, ``base_failed``, ``kept`` and ``kept_text``.

    ``kept`` is false if a base rule fails, or if less than ``min_left`` of the words are left once the host's frequent
    lines are gone; ``kept_text`` is the text without those lines.  A null or blank text has no words and fails.  A null
    host is a host of its own.  Repeated rows get the same verdict; an empty table gives an empty table.
    """
    from ..session import stage

    bad = stage(frequent_lines(docs, text, host, max_share, min_docs), "frequent-lines")
    if bad.count() <= BROADCAST_HOSTS:  # beyond, a sort-merge join whose hot hosts adaptive execution splits
        bad = F.broadcast(bad)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("__text"),
                       F.col(host).alias("__of"))
    rows = rows.join(bad, F.col("__of").eqNullSafe(F.col("__host")), "left")
    found = words(F.col("__text"))
    counted = bound(found, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words")))
    lost = F.when(F.col("__bad").isNull(), F.lit(0)).otherwise(F.aggregate(
        F.filter(lines_with_words(F.col("__text")), lambda x: F.array_contains(F.col("__bad"), line_key(x))),
        F.lit(0), lambda t, x: t + F.size(words(x))))
    left = F.when(F.col("__bad").isNull(), F.col("__text")).otherwise(F.array_join(F.filter(
        F.split("__text", "\n"), lambda x: ~(x.rlike(WORD) & F.array_contains(F.col("__bad"), line_key(x)))), "\n"))
    symbols = F.length("__text") - F.length(F.regexp_replace("__text", r"[#*$%&|<>]", ""))
    doubles = bound(lines_with_words(F.col("__text")), lambda x: F.size(x) - F.size(F.array_distinct(x)))
    rows = rows.select("row", counted.alias("c"), symbols.cast("long").alias("n_symbols"), doubles.cast("long").alias("n_dup_lines"),
                       lost.cast("long").alias("n_frequent_line_words"), left.alias("kept_text"))
    failed = (F.col("c.n_words") < MIN_WORDS) | (100 * F.col("c.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("c.n_words"))
    enough = F.col("c.n_words") - F.col("n_frequent_line_words") >= F.col("c.n_words") * min_left
    return rows.select("row", "c.n_words", "c.word_chars", "n_symbols", "n_dup_lines", "c.n_repeat_words", failed.alias("base_failed"),
                       "n_frequent_line_words", (~failed & enough).alias("kept"), "kept_text")
