"""Operator 5: near-duplicate documents by SimHash, found with covering locality-sensitive hashing.

Each bit position gets one of the non-zero vectors of ``max_bits + 1`` binary digits.  Each such vector ``v`` gives a
table whose mask keeps the positions with an odd product with ``v``.  The vectors of the at most ``max_bits`` positions
where two fingerprints differ span too little to leave no ``v`` orthogonal to all of them, so every pair within the
radius agrees on all bits of some mask: none is missed.

A bucket is never expanded into pairs.  Two members are compared directly.  In larger buckets each member names the
points reached by flipping up to half the radius of the bits its mask drops; members that name one point are within the
radius of each other, and every pair within the radius names a common point.  So the work is linear in the bucket.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .components import connected_components
from .words import fresh

SHINGLE, MAX_BITS, SEED = 3, 2, 42
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a whole text; no words give zero.  Bit k is set if over half the shingles' hashes have it."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    first, last = starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    votes, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(first), _BLOCK):
        part = np.array([digest(line[a:b], SEED) for a, b in zip(first[at:at + _BLOCK], last[at:at + _BLOCK])], dtype="<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * votes > len(first)).tolist())


def simhash(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint of a text column as a signed long."""

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(x, shingle) for x in texts], dtype=np.uint64).view(np.int64))

    return F.pandas_udf(run, "long")(text)


def covering_masks(max_bits: int) -> list[int]:
    """Masks of which at least one drops any given ``max_bits`` positions; bit k has the vector k mod n + 1."""
    n = (1 << (max_bits + 1)) - 1
    return [sum(1 << k for k in range(64) if ((k % n + 1) & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``max_bits`` of each other; ``classes`` has distinct ``fp``.

    Every link joins two fingerprints within the radius, and any two within it are joined directly or through others
    that are within it of both.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    if max_bits == 0:
        return classes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    masks = covering_masks(max_bits)
    tables = classes.select("fp", F.posexplode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("no", "mask")).select(
        "fp", "no", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    buckets = tables.groupBy("no", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    pairs = buckets.where(F.col("n") == 2).where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits).select("a", "b")
    # What to flip: all sets of up to half the radius of the bits that a mask drops.
    flips = [[_signed(sum(1 << k for k in bits)) for size in range(max_bits // 2 + 1)
              for bits in combinations([k for k in range(64) if not m >> k & 1], size)] for m in masks]
    options = F.array(*[F.array(*[F.lit(x) for x in f]) for f in flips])
    members = tables.join(buckets.where("n > 2").select("no", "key"), ["no", "key"])
    points = members.select("fp", F.explode(F.element_at(options, F.col("no") + 1)).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    # A point has no more members than there are flips, so its set is bounded.
    stars = points.groupBy("point").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    return pairs.unionByName(stars.select("a", F.explode("all").alias("b")).where("a != b")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id, fp, head), a row per input row.

    Rows whose fingerprints differ in at most ``max_bits`` bits are linked; ``component_id`` is the smallest ``doc_id``
    that links reach.  A-Z are lower-cased; null and blank texts have fingerprint zero and are linked like any other;
    texts of fewer words than a shingle are one shingle.  Repeated rows are returned each.  A null ``doc_id`` counts only
    if its component has no other (then ``component_id`` is null).  An empty table gives an empty table.
    """
    rows = stage(docs.select("doc_id", simhash(F.col(text), shingle).alias("fp")), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    roots = connected_components(near_links(classes.select("fp"), max_bits))
    labelled = stage(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "fingerprint-roots")
    names = labelled.groupBy("root").agg(F.min("least").alias("component_id"), F.min("fp").alias("head"))
    members = stage(labelled.join(names, "root").select("fp", "component_id", "head"), "fingerprint-components")
    return rows.join(members, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp", "head")


def keep_one_per_group(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The document with the smallest ``doc_id`` of each group, one row of it if it is repeated, with all its columns.

    A document is named by its ``doc_id`` and its fingerprint, so rows that share an id but are in different groups stay, one
    for each.  Of several fingerprints with the smallest id the smallest counts.  A group without any ``doc_id`` keeps one row
    with its smallest fingerprint.
    """
    found = near_duplicates(docs, text, shingle, max_bits)
    fp = fresh("fp", docs.columns)
    # Per group, told apart by its smallest fingerprint, the row that names it; nameless ones come last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp"))
    kept = stage(found.groupBy("head").agg(first.alias("f")).select(F.col("f.doc_id").alias("__doc"), F.col("f.fp").alias("__fp")), "one-per-group")
    # Only ids with several fingerprints, and rows without an id, are told apart by their fingerprint once more.
    several = stage(found.groupBy("doc_id").agg((F.min("fp") != F.max("fp")).alias("several")).where(
        "several AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__doc")), "ids-of-several")
    plain = docs.join(kept.where("__doc IS NOT NULL").join(several, "__doc", "left_anti").select("__doc").distinct(),
                      docs["doc_id"] == F.col("__doc"), "left_semi").dropDuplicates(["doc_id"])
    rest = docs.join(several, docs["doc_id"] == several["__doc"], "left_semi").unionByName(docs.where("doc_id IS NULL")).withColumn(
        fp, simhash(F.col(text), shingle))
    named = rest.join(kept, F.col(fp).eqNullSafe(F.col("__fp")) & F.col("doc_id").eqNullSafe(F.col("__doc")), "left_semi")
    return plain.unionByName(named.dropDuplicates(["doc_id", fp]).select(docs.columns))
