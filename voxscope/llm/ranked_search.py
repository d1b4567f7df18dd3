"""Operator 13: ranked lexical search by scanning whole texts with an automaton of all item terms.

No index of the documents is built.  The terms of the items, each between two guards, form an Aho-Corasick automaton that is
broadcast; a text is folded byte by byte so that every separator becomes a guard, and one pass over it yields the occurrences
of all terms.  Each term leads to the items that hold it.

1. *Counting scan*: documents with terms, all their terms, and for each item term the documents that hold it.
2. *Scoring scan*: a document's occurrences give its score for every item it shares a term with; a task keeps the best
   documents of each item and hands on no more.

The items are searched for in blocks, so what is broadcast has a bound: ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` of text (one
item of more is a block of its own).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .words import PUNCTUATION

BEST, BLOCK_ITEMS, BLOCK_BYTES = 20, 5_000, 4 << 20
_GUARD = 32
#: Separators become the guard, A-Z become a-z, other bytes (all of those beyond ASCII) stay.
_FOLD = bytes(_GUARD if PUNCTUATION[c] else c + 32 if 65 <= c <= 90 else c for c in range(256))
_DOCUMENTS, _TERMS = -1, -2  # instead of a term, in the counts
_KEPT_MARGIN = 4


def folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").translate(_FOLD)


def number_of_terms(line: bytes) -> int:
    inside = np.frombuffer(line, dtype=np.uint8) != _GUARD
    return int(inside[0]) + int((inside[1:] & ~inside[:-1]).sum()) if len(inside) else 0


class Items:
    """A block of items: its terms, and for each term the items that hold it with how often.

    ``names`` number the items; ``first`` says where the items of each term begin in ``holders`` and ``times``.
    """

    def __init__(self, names: list[int], texts: list[str | None]):
        held: dict[bytes, Counter] = {}
        for at, text in enumerate(texts):
            for term in folded(text).split():
                held.setdefault(term, Counter())[at] += 1
        self.names = np.array(names, dtype=np.int64)
        self.terms = sorted(held)
        pairs = [sorted(held[t].items()) for t in self.terms]
        self.first = np.cumsum([0, *map(len, pairs)])
        self.holders = np.array([i for p in pairs for i, _ in p], dtype=np.int64)
        self.times = np.array([n for p in pairs for _, n in p], dtype=np.int64)

    def automaton(self) -> ahocorasick.Automaton:
        """Matches are numbers of terms.  Bytes are read as characters, one each."""
        found = ahocorasick.Automaton()
        for number, term in enumerate(self.terms):
            found.add_word(f" {term.decode('latin-1')} ", number)
        if self.terms:
            found.make_automaton()
        return found


def occurrences(automaton: ahocorasick.Automaton, line: bytes) -> Counter:
    """How often each term stands in a folded text."""
    if not len(automaton):
        return Counter()
    return Counter(map(itemgetter(1), automaton.iter(f" {line.decode('latin-1')} ")))


def weights(documents: int, holding: Iterable[int]) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in holding], dtype=np.int64)


class Scores:
    """The best documents of each item so far, as parallel arrays; without an id they come after all others."""

    def __init__(self, items: Items, weight: np.ndarray, documents: int, all_terms: int, best: int):
        self.items, self.weight, self.documents, self.all_terms, self.best = items, weight, documents, all_terms, best
        n = len(items.names)
        self.floor = np.ones(n, dtype=np.int64)  # below it a document has no place
        self.kept = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)]
        self.new: list[tuple] = []
        self.waiting = 0

    def add(self, doc_id: int | None, found: Counter, n: int) -> None:
        if not found:
            return
        items = self.items
        term = np.fromiter(found.keys(), dtype=np.int64, count=len(found))
        tf = np.fromiter(found.values(), dtype=np.int64, count=len(found))
        length = 100 - 25 + (25 * n * self.documents) // self.all_terms
        part = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * length))
        first, many = items.first[term], np.diff(items.first)[term]
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        score = np.zeros(len(items.names), dtype=np.int64)
        np.add.at(score, items.holders[at], items.times[at] * np.repeat(part, many))
        good = np.flatnonzero(score >= self.floor)
        if len(good):
            self.new.append((good, score[good], doc_id))
            self.waiting += len(good)
            if self.waiting > max(1000, _KEPT_MARGIN * self.best * len(items.names)):
                self.settle()

    def settle(self) -> None:
        """Keep the best of each item: highest score, then smallest id."""
        if not self.new:
            return
        sizes = [len(g) for g, _, _ in self.new]
        item = np.concatenate([self.kept[0], *[g for g, _, _ in self.new]])
        score = np.concatenate([self.kept[1], *[s for _, s, _ in self.new]])
        null = np.concatenate([self.kept[2], np.repeat([d is None for _, _, d in self.new], sizes)])
        doc = np.concatenate([self.kept[3], np.repeat(np.array([d or 0 for _, _, d in self.new], dtype=np.int64), sizes)])
        order = np.lexsort((doc, null, -score, item))
        item, score, null, doc = item[order], score[order], null[order], doc[order]
        begin = np.searchsorted(item, item, side="left")
        place = np.arange(len(item)) - begin
        last = place == self.best - 1
        self.floor[item[last]] = score[last]
        keep = place < self.best
        self.kept, self.new, self.waiting = [x[keep] for x in (item, score, null, doc)], [], 0

    def batch(self) -> pa.RecordBatch:
        self.settle()
        item, score, null, doc = self.kept
        return pa.RecordBatch.from_arrays([pa.array(self.items.names[item]), pa.array(doc, mask=null), pa.array(score)], names=["no", "doc_id", "score"])


_LAST: list = [None, None]  # per worker process: a block and its automaton


def _automaton(items: Items) -> ahocorasick.Automaton:
    if _LAST[0] is not items:
        _LAST[:] = items, items.automaton()
    return _LAST[1]


def _search_block(rows: DataFrame, items: Items, best: int) -> DataFrame:
    """(no, doc_id, score): each task's best documents of each item of the block."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(items)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(shared.value)
        holding, documents, terms = np.zeros(len(shared.value.terms), dtype=np.int64), 0, 0
        for batch in batches:
            for text in batch.column(1):
                line = folded(text.as_py())
                n = number_of_terms(line)
                documents, terms = documents + (n > 0), terms + n
                holding[list(occurrences(automaton, line))] += 1
        seen = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[_DOCUMENTS, _TERMS, seen], pa.int32()), pa.array(
            np.r_[documents, terms, holding[seen]], pa.int64())], names=["term", "n"])

    counted = {r.term: r.n for r in rows.mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    documents, all_terms = counted.get(_DOCUMENTS, 0), counted.get(_TERMS, 0)
    table = spark.sparkContext.broadcast(weights(documents, [counted.get(k, 0) for k in range(len(items.terms))]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, scores = _automaton(shared.value), Scores(shared.value, table.value, documents, all_terms, best)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                line = folded(text.as_py())
                scores.add(doc_id, occurrences(automaton, line), number_of_terms(line))
        yield scores.batch()

    return rows.mapInArrow(score, "no long, doc_id long, score long")


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", best: int = BEST, block_items: int = BLOCK_ITEMS,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``benchmark`` its ``best`` documents with a score above 0.

    Equal scores are ranked by ascending ``doc_id``, those without one last.  Every row of either table counts: repeated
    documents are ranked each, and rows of ``benchmark`` that repeat an ``item_id``, or have none, are items of their own.
    Null texts, and texts without a term, match nothing and count as no document; an item without terms, empty tables and
    items that no document shares a term with give no rows.  Columns beyond ``doc_id``, ``item_id`` and the texts are not read.
    """
    spark = docs.sparkSession
    wanted = stage(benchmark.where("text IS NOT NULL").select(
        F.monotonically_increasing_id().alias("no"), F.col("item_id").cast("long").alias("item_id"), F.col("text")), "search-items")
    size = wanted.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size.n // block_items), -(-size.bytes // block_bytes))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = []
    for block in range(blocks):
        # Numbers begin anew in each file, so a hash deals them out.
        taken = wanted.where(F.pmod(F.xxhash64("no"), F.lit(blocks)) == block).select("no", "text").collect()
        if taken:
            found.append(_search_block(rows, Items([r[0] for r in taken], [r[1] for r in taken]), best))
    if not found:
        return wanted.where("false").select("item_id", F.lit(0).alias("rank"), F.col("no").alias("doc_id"), F.col("no").alias("score"))
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.join(wanted.select("no", "item_id"), "no").select("item_id", "rank", "doc_id", "score")
