"""Operator 9: benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit verification.

Texts are words in lower case without punctuation; a document leaks an item if a passage of it has an edit distance of
at most ``1 - similarity`` of the item's words.

1. *Windows*.  So many edits leave some run of an item's words whole.  Windows of the item's size are therefore laid
   where a document holds such a run of one of the items, aligned with it; no leak lies elsewhere.
2. *Embedding*.  The CGK walk writes a window's words one by one and moves on, or stays, by a random function of step and
   word that all walks share, so a small edit distance becomes a small Hamming distance.
3. *LSH*.  Every table samples a few steps of a walk.  Windows and items that agree on them are candidates.  For each size of
   item there are as many walks as simulated leaks at the limit need to be met with ``TARGET`` recall (substitutions,
   insertions and deletions apart).
4. *Verification*.  The exact distance of the whole item to the best passage within the window's surroundings decides.  Items of
   more than ``LONGEST_ITEM`` words are looked for by stretches of that size, one of which has no more than its share of the edits.

The benchmark is searched for in blocks of items; a block is broadcast, whose size is bounded by ``BLOCK_ITEMS``.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .words import PUNCTUATION, Words, joined, mixed, window_hashes

SIMILARITY, TABLES, SAMPLED, LONGEST_RUN, BLOCK_ITEMS = 0.8, 16, 2, 3, 20_000
LONGEST_ITEM = 128
TARGET, TRIALS, LEAST_WALKS, MOST_WALKS, SIZE_STEP = 0.98, 60, 4, 64, 8
_END = np.uint64(0)  # beyond a text's last word
_BATCH, _CELLS = 50_000, 400_000
_SCHEMA = "doc_id long, item_id long, start_word long, n_item_words long, distance long"


def edit_words(texts: pa.ChunkedArray | pa.Array) -> Words:
    return Words.of(pc.utf8_lower(texts), PUNCTUATION)


def allowed(n: int, similarity: float) -> int:
    return int(n * (1 - similarity) + 1e-9)


def cgk(words: np.ndarray, steps: int, seed: int) -> np.ndarray:
    """Random-walk embeddings of the rows of a matrix of word hashes."""
    rows, n = words.shape
    padded = np.concatenate([words, np.zeros((rows, 1), dtype=np.uint64)], axis=1)
    at, out = np.zeros(rows, dtype=np.int64), np.zeros((rows, steps), dtype=np.uint64)
    every = np.arange(rows)
    for step in range(steps):
        out[:, step] = word = padded[every, at]
        move = mixed(word ^ np.uint64((seed * 1_000_003 + step * 7919 + 1) % (1 << 63))) & np.uint64(1)
        at = np.minimum(at + move.astype(np.int64), n)
    return out


def table_keys(words: np.ndarray, walks: int, seed: int = 17) -> Iterator[np.ndarray]:
    """A key per row for each table."""
    n = words.shape[1]
    rng = np.random.default_rng(seed * 1000 + n)
    for walk in range(walks):
        steps = 2 * n  # a walk moves on every other step
        embedded = cgk(words, steps, seed + walk)
        for _ in range(TABLES):
            key = np.zeros(len(words), dtype=np.uint64)
            for step in sorted(rng.choice(steps, size=min(SAMPLED, steps), replace=False)):
                key = joined(key, embedded[:, step])
            yield key


def best_distance(items: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """Per row the edit distance of the whole item to the nearest stretch of the passage."""
    rows, n = items.shape
    at = np.arange(passages.shape[1] + 1, dtype=np.int32)
    above = np.zeros((rows, len(at)), dtype=np.int32)  # a stretch may begin anywhere
    for i in range(n):
        free = np.empty_like(above)
        free[:, 0] = i + 1
        np.minimum(above[:, :-1] + (passages != items[:, i:i + 1]), above[:, 1:] + 1, out=free[:, 1:])
        above = np.minimum.accumulate(free - at, axis=1) + at  # words of the passage that the item lacks cost one each
    return above.min(axis=1)  # and end anywhere


@lru_cache(maxsize=None)
def walks_for(size: int, similarity: float) -> int:
    """How many walks find ``TARGET`` of simulated leaks with as many edits as are allowed in an item of ``size`` words.

    Sizes are rounded up to steps of ``SIZE_STEP``: a larger item needs no fewer.
    """
    size = min(-(-size // SIZE_STEP) * SIZE_STEP, LONGEST_ITEM)
    rng = random.Random(size)
    item = [f"w{rng.randrange(10 ** 6)}" for _ in range(size)]
    k = allowed(size, similarity)
    texts = []
    for kind in range(3):
        for _ in range(TRIALS):
            words = list(item)
            for place in sorted(rng.sample(range(size), k), reverse=True):
                words[place:place + (kind != 1)] = [] if kind == 2 else [f"z{rng.randrange(10 ** 6)}"]
            texts.append(" ".join([*(f"c{rng.randrange(10 ** 6)}" for _ in range(12)), *words, *(f"c{rng.randrange(10 ** 6)}" for _ in range(12))]))
    walks = LEAST_WALKS
    while walks < MOST_WALKS:
        block = Items.of([0], [" ".join(item)], similarity, walks)
        met = {row // TRIALS: 0 for row in range(len(texts))}
        for row, *_ in leaks(pa.array(texts), block, similarity):
            met[row // TRIALS] += 1
        if min(met.values()) >= TARGET * TRIALS:
            break
        walks *= 2
    return walks


@dataclass
class Items:
    """A block of items.  Searched for are their stretches, by number of words, with the runs that lead to them and their keys.

    ``owner`` and ``offset`` say which item a stretch belongs to and where it begins; ``whole`` has the words of each item.
    """

    ids: list[int | None]
    whole: list[np.ndarray]
    owner: np.ndarray
    offset: np.ndarray
    walks: dict[int, int]
    members: dict[int, np.ndarray]
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # by run length: sorted hashes, stretch sizes, offsets
    keys: dict[int, list[tuple[np.ndarray, np.ndarray]]]

    @staticmethod
    def of(ids: list[int | None], texts: list[str | None], similarity: float, walks: int | None = None) -> Items:
        found = edit_words(pa.array(texts, pa.string()))
        hashes = found.hashes()
        whole = found.counts()
        # A long item is searched for by stretches, as even as can be.
        parts = np.maximum(1, -(-whole // LONGEST_ITEM))
        owner = np.repeat(np.arange(len(whole)), parts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        sizes = whole[owner] // parts[owner] + (number < whole[owner] % parts[owner])
        first = np.concatenate([[0], np.cumsum(sizes)])
        begin = np.concatenate([[0], np.cumsum(whole)])
        members = {int(n): np.flatnonzero(sizes == n) for n in np.unique(sizes[sizes > 0])}
        words = {n: np.stack([hashes[first[i]:first[i] + n] for i in rows]) for n, rows in members.items()}
        runs: dict[int, list] = {}
        for n, matrix in words.items():
            k = allowed(n, similarity)
            run = min(LONGEST_RUN, -(-(n - k) // (k + 1)))
            for row in matrix:
                h = window_hashes(row, run)
                runs.setdefault(run, []).append((h, np.full(len(h), n), np.arange(len(h))))
        sorted_runs = {}
        for run, parts in runs.items():
            h, n, o = (np.concatenate(x) for x in zip(*parts))
            h, at = np.unique(np.stack([h, n.astype(np.uint64), o.astype(np.uint64)]), axis=1, return_index=True)
            sorted_runs[run] = (h[0], h[1].astype(np.int64), h[2].astype(np.int64))
        walks_of = {n: walks or walks_for(n, similarity) for n in words}
        keys = {n: [(np.sort(k), np.argsort(k, kind="stable")) for k in table_keys(m, walks_of[n])] for n, m in words.items()}
        return Items(list(ids), [hashes[begin[i]:begin[i + 1]] for i in range(len(whole))], owner, first[:-1] - begin[owner], walks_of,
                     members, sorted_runs, keys)


def _windows(hashes: np.ndarray, row: np.ndarray, begin: np.ndarray, items: Items) -> dict[int, np.ndarray]:
    """By item size, the distinct places where a window of that size is to be looked at."""
    found: dict[int, list] = {}
    for run, (keys, sizes, offsets) in items.runs.items():
        h = window_hashes(hashes, run)
        place = np.flatnonzero(row[run - 1:] == row[:len(h)]) if len(h) else np.zeros(0, dtype=np.int64)
        low, high = np.searchsorted(keys, h[place], side="left"), np.searchsorted(keys, h[place], side="right")
        hit = high > low
        place, low, many = place[hit], low[hit], (high - low)[hit]
        entry = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        start = np.repeat(place, many) - offsets[entry]
        # A window may begin before its text does; the missing words are then none.
        number = np.repeat(row[place], many)
        start = np.maximum(start, begin[number] - sizes[entry] + 1)
        for n in np.unique(sizes[entry]):
            own = sizes[entry] == n
            found.setdefault(int(n), []).append(np.stack([number[own], start[own]], axis=1))
    return {n: np.unique(np.concatenate(x), axis=0) for n, x in found.items()}


def _gather(hashes: np.ndarray, begin: np.ndarray, number: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    at = start[:, None] + np.arange(width)
    inside = (at >= begin[number][:, None]) & (at < begin[number + 1][:, None])
    return np.where(inside, hashes[np.clip(at, 0, max(len(hashes) - 1, 0))], _END)


def _candidates(windows: np.ndarray, n: int, hashes: np.ndarray, begin: np.ndarray, items: Items) -> np.ndarray:
    """(text, item, where the item would begin) of the windows of ``n`` words that agree with a stretch in some table."""
    number, start = windows.T
    own = _gather(hashes, begin, number, start, n)
    pairs = []
    for (keys, order), key in zip(items.keys[n], table_keys(own, items.walks[n])):
        low, high = np.searchsorted(keys, key, side="left"), np.searchsorted(keys, key, side="right")
        many = high - low
        entry = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
        pairs.append(np.stack([np.repeat(np.arange(len(own)), many), order[entry]], axis=1))
    window, found = np.unique(np.concatenate(pairs), axis=0).T
    stretch = items.members[n][found]
    return np.stack([number[window], items.owner[stretch], start[window] - items.offset[stretch]], axis=1)


def leaks(texts: pa.ChunkedArray | pa.Array, items: Items, similarity: float) -> Iterator[tuple[int, int | None, int, int, int]]:
    """(row, item, first word, item's words, distance) of the best passage for each leaked item of each text."""
    words = edit_words(texts)
    hashes = words.hashes()
    begin = np.concatenate([[0], np.cumsum(words.counts())])
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for n, windows in _windows(hashes, words.row, begin, items).items():
        for at in range(0, len(windows), _BATCH):
            found = _candidates(windows[at:at + _BATCH], n, hashes, begin, items)
            sizes = np.array([len(items.whole[i]) for i in found[:, 1]], dtype=np.int64)
            for size in np.unique(sizes):
                k = allowed(int(size), similarity)
                same, slack = found[sizes == size], 0
                if size > LONGEST_ITEM:  # many stretches lead to one place; one look serves all that are near
                    slack = max(k, 1)
                    same = np.unique(np.stack([same[:, 0], same[:, 1], same[:, 2] // slack * slack], axis=1), axis=0)
                step = max(1, _CELLS // int(size + 2 * k + slack))
                for part in range(0, len(same), step):
                    number, item, start = same[part:part + step].T
                    around = _gather(hashes, begin, number, start - k, int(size + 2 * k + slack))
                    distance = best_distance(np.stack([items.whole[i] for i in item]), around)
                    for r, i, s, d in zip(*(x[distance <= k] for x in (number, item, start, distance))):
                        place = (int(d), max(0, int(s - begin[r])))
                        best[int(r), int(i)] = min(best.get((int(r), int(i)), place), place)
    for (number, item), (distance, start) in best.items():
        yield number, items.ids[item], start, len(items.whole[item]), distance


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", similarity: float = SIMILARITY,
               block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, item_id, start_word, n_item_words, distance): every document that holds an item, with its best passage.

    An item leaks as a whole, however long it is: a part of it is none.  Items without a word, and null texts, match nothing;
    documents shorter than an item match if they are near enough to it.  A repeated row gives its leaks again; a row without
    ``doc_id`` gives them with null, and so does an item without ``item_id``.  Rows of the benchmark that repeat an ``item_id``
    are items of their own.  Empty tables give an empty table.
    """
    spark = docs.sparkSession
    wanted = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    blocks = max(1, -(-wanted.count() // block_items))
    out = None
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        shared = spark.sparkContext.broadcast(Items.of([r[0] for r in rows], [r[1] for r in rows], similarity))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_pylist()
                found = [(ids[r], *rest) for r, *rest in leaks(batch.column(1), shared.value, similarity)]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], pa.int64()) for c in range(5)], names=[
                    "doc_id", "item_id", "start_word", "n_item_words", "distance"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text).mapInArrow(run, _SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns.  Rows without ``doc_id`` are numbered for this.

    The ids of leaking documents are staged, so Spark knows their size and leaves the texts where they are if it is small.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.col(text)))
    marked = docs.select(key.alias("doc_id"), F.col(text).alias("__text"))
    found = stage(find_leaks(marked, benchmark, "__text", similarity).select(F.col("doc_id").alias("__id")).distinct(), "leaking")
    return docs.join(found, F.coalesce(docs["doc_id"].cast("long"), F.xxhash64(docs[text])) == found["__id"], "left_anti")
