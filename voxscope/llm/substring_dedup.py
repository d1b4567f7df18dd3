"""Operator 8: removal of word windows that repeat anywhere in the corpus, by level-wise doubling.

A window of ``length`` words is looked for in levels of about a quarter, a half and the whole of that length.  Only
what repeats at one level is extended to twice its length.

1. *Quarter*.  In each window the quarter with the smallest hash is its anchor (equal windows have equal anchors).
   Anchors, a few hundredths of all positions, are the only quarters that are counted.
2. *Half*.  Around a repeated anchor the two halves that start or end with it are counted.  Each window holds at least
   one of them.
3. *Whole*.  Windows whose anchor and halves all repeat are counted; those found twice are removed.

Every level is exact: a window that repeats passes each of them.  Documents are dealt once into chunks by hash; a chunk
hands each level's hashes, each once, to shards by range of the hash, and gets back one bit per hash.  A window that
stands in a third of all documents is therefore one entry per chunk, never a large group.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, chunk_number, joined, shard_parts, window_hashes

WINDOW = 35
CHUNK_ROWS = 2000
_BLOBS = "shard int, chunk int, level int, hashes binary, twice binary"
_BITS = "chunk int, shard int, level int, n int, bits binary"


def _levels(length: int) -> tuple[int, int]:
    half = -(-length // 2)
    return -(-half // 2), half


def _anchors(quarters: np.ndarray, span: int) -> np.ndarray:
    """For each position, where the smallest of the next ``span`` quarters stands; of equal ones the first."""
    low, at, have = quarters, np.arange(len(quarters)), 1
    while have < span:
        step = min(have, span - have)
        if len(low) <= step:
            return at[:0]
        right = low[step:] < low[:-step]
        at = np.where(right, at[step:], at[:-step])
        low = np.where(right, low[step:], low[:-step])
        have += step
    return at


class _Chunk:
    """The candidates of one chunk, level by level."""

    def __init__(self, texts: pa.ChunkedArray, length: int):
        self.length = length
        self.quarter, self.half = _levels(length)
        self.words = words = Words.of(texts)
        base = words.hashes()
        self.quarters = window_hashes(base, self.quarter)
        self.halves = window_hashes(base, self.half)
        n = len(base) - length + 1
        inside = np.flatnonzero(words.row[length - 1:] == words.row[:n]) if n > 0 else np.zeros(0, dtype=np.int64)
        self.start = inside
        self.anchor = _anchors(self.quarters, length - self.quarter + 1)[inside] if n > 0 else inside

    def candidates(self, level: int, bits: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes of a level, how often each stands here, and the hash number of each position."""
        places = self._places(level, bits)
        if level == 3:
            found = joined(self.halves[places], self.halves[places + self.length - self.half])
        else:
            found = (self.quarters if level == 1 else self.halves)[places]
        hashes, number, counts = np.unique(found, return_inverse=True, return_counts=True)
        return hashes, counts, number

    def _places(self, level: int, bits: dict[int, np.ndarray]) -> np.ndarray:
        if level == 1:
            return np.unique(self.anchor)
        back = self.half - self.quarter  # from an anchor to the half that ends with it
        good = self._repeated(1, bits, np.unique(self.anchor))
        keep = good[self.anchor]
        start, anchor = self.start[keep], self.anchor[keep]
        right = anchor[anchor + self.half <= start + self.length]
        left = anchor[anchor - back >= start] - back
        if level == 2:
            return np.unique(np.concatenate([right, left]))
        good = self._repeated(2, bits, np.unique(np.concatenate([right, left])))
        has_right, has_left = anchor + self.half <= start + self.length, anchor - back >= start
        ok = np.ones(len(start), dtype=bool)
        ok[has_right] &= good[anchor[has_right]]
        ok[has_left] &= good[anchor[has_left] - back]
        return start[ok]

    def _repeated(self, level: int, bits: dict[int, np.ndarray], places: np.ndarray) -> np.ndarray:
        found = (self.quarters if level == 1 else self.halves)[places]
        _, number = np.unique(found, return_inverse=True)
        marks = np.zeros(len(self.words.starts) + 1, dtype=bool)
        if len(places):
            marks[places] = bits[level][number]
        return marks

    def covered(self, bits: dict[int, np.ndarray]) -> np.ndarray:
        """Which words stand in a repeated window."""
        places = self._places(3, bits)
        _, _, number = self.candidates(3, bits)
        begins = places[bits[3][number]] if len(places) else places
        delta = np.zeros(len(self.words.starts) + 1, dtype=np.int64)
        np.add.at(delta, begins, 1)
        np.add.at(delta, begins + self.length, -1)
        return np.cumsum(delta[:-1]) > 0


def _read_bits(table: pa.Table) -> dict[int, np.ndarray]:
    out: dict[int, list] = {1: [], 2: [], 3: []}
    rows = sorted(zip(*(table[c].to_pylist() for c in ("level", "shard", "n", "bits"))))
    for level, _, n, bits in rows:
        out[level].append(np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n).astype(bool))
    return {level: np.concatenate(x) if x else np.zeros(0, dtype=bool) for level, x in out.items()}


def _emit(texts, chunk: int, level: int, bits: dict, length: int, shards: int) -> pa.Table:
    hashes, counts, _ = _Chunk(texts, length).candidates(level, bits)
    shard, cut = shard_parts(hashes, shards)
    parts, twice = (np.split(x, cut) if len(hashes) else [] for x in (hashes, counts > 1))
    return pa.table({
        "shard": pa.array(shard, pa.int32()),
        "chunk": pa.array([chunk] * len(parts), pa.int32()), "level": pa.array([level] * len(parts), pa.int32()),
        "hashes": pa.array([p.tobytes() for p in parts], pa.binary()),
        "twice": pa.array([np.packbits(t).tobytes() for t in twice], pa.binary())})


def _judge(table: pa.Table) -> pa.Table:
    """One bit per hash of each chunk: whether it stands at two positions or more."""
    parts = [np.frombuffer(x, dtype=np.uint64) for x in table["hashes"].to_pylist()]
    twice = [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(p)) for x, p in zip(table["twice"].to_pylist(), parts)]
    _, number, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    many = counts > 1
    many[number[np.concatenate(twice) == 1]] = True
    cut = np.cumsum([len(p) for p in parts])[:-1]
    return pa.table({"chunk": table["chunk"], "shard": table["shard"], "level": table["level"],
                     "n": pa.array([len(p) for p in parts], pa.int32()),
                     "bits": pa.array([np.packbits(b).tobytes() for b in np.split(many[number], cut)], pa.binary())})


def _cut(docs: pa.Table, bits: pa.Table, length: int) -> pa.Table:
    """Kept text, its digest, and counts per row."""
    chunk = _Chunk(docs["__text"], length)
    gone = chunk.covered(_read_bits(bits))
    n_words = chunk.words.counts()
    first = np.concatenate([[0], np.cumsum(n_words)])
    removed = np.bincount(chunk.words.row[gone], minlength=chunk.words.rows)
    texts, digests = docs["__text"].to_pylist(), []
    for i, text in enumerate(texts):
        words = (text or "").encode().split()
        if removed[i]:
            keep = ~gone[first[i]:first[i + 1]]
            texts[i] = _without(text.encode(), words, keep).decode()
            words = list(compress(words, keep))
        digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
    return docs.drop_columns(["__chunk", "__text"]).append_column("__kept", pa.array(texts, pa.string())).append_column(
        "__n_words", pa.array(n_words, pa.int64())).append_column("__n_removed", pa.array(removed, pa.int64())).append_column(
        "__sha", pa.array(digests, pa.string()))


def _without(text: bytes, words: list[bytes], keep: np.ndarray) -> bytes:
    """The text without its dropped words; kept words keep the blanks before them."""
    out, at = [], 0
    for word, kept in zip(words, keep):
        begin = text.index(word, at)
        if kept:
            out.append(text[at:begin + len(word)])
        at = begin + len(word)
    return b"".join(out) + (text[at:] if len(keep) and keep[-1] else b"")


def remove_repeats(docs: DataFrame, length: int = WINDOW, text: str = "text", rows_per_chunk: int = CHUNK_ROWS) -> DataFrame:
    """Cut every word that a window of ``length`` words covers whose words also start anywhere else in the corpus.

    Windows never cross documents and are judged on the input.  Returns one row per input row, with struct ``row`` (the
    input's other columns), ``kept_text``, ``n_words``, ``n_removed`` and ``kept_sha256`` (of the kept words, joined by one
    space).  A text that loses nothing is kept as it is; null stays null and counts as no words.  Repeated rows are
    documents of their own, so both lose what they share; texts of fewer than ``length`` words lose nothing.  Words are
    compared by 64-bit hashes of windows.  An empty table gives an empty table.
    """
    number, chunks = chunk_number(docs, F.struct("doc_id", text), rows_per_chunk)
    shards = max(1, -(-chunks // 4))
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("__row")
    texts = docs.select(number.alias("__chunk"), F.col(text).alias("__text"), rest)

    def first(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _emit(table["__text"], key[0].as_py(), 1, {}, length, shards)

    def later(level: int):
        def emit(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
            return _emit(left["__text"], key[0].as_py(), level, _read_bits(right), length, shards)
        return emit

    bits = texts.groupBy("__chunk").applyInArrow(first, _BLOBS).groupBy("shard").applyInArrow(_judge, _BITS)
    for level in (2, 3):
        blobs = texts.groupBy("__chunk").cogroup(bits.groupBy("chunk")).applyInArrow(later(level), _BLOBS)
        bits = bits.unionByName(blobs.groupBy("shard").applyInArrow(_judge, _BITS))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        return _cut(left, right, length)

    row = texts.schema["__row"].dataType.simpleString()
    out = texts.groupBy("__chunk").cogroup(bits.groupBy("chunk")).applyInArrow(
        cut, f"__row {row}, __kept string, __n_words long, __n_removed long, __sha string")
    return out.toDF("row", "kept_text", "n_words", "n_removed", "kept_sha256")
