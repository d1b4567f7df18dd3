"""Words, word hashes and chunks of documents, for operators that work on Arrow batches.

A word is a run of characters outside ``[\\x20\\x09-\\x0D]``.  Texts are handled as UTF-8 bytes, where these
characters are single bytes, so the byte view gives exactly the same words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Only letters, digits and what is beyond ASCII belong to words.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_PRIME, _A, _B = (np.uint64(x) for x in (0x100000001B3, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))
_LONG_WORD = 64


def text_bytes(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins and the last one ends; null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):  # several chunks stay apart beyond 2 GB of strings
        texts = pa.concat_arrays([c.cast(pa.large_string()) for c in texts.chunks])
    flat = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(flat.buffers()[1], dtype=np.int64)[flat.offset:flat.offset + len(flat) + 1]
    if flat.buffers()[2] is None or not len(flat):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(flat) + 1, dtype=np.int64)
    data = np.frombuffer(flat.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


@dataclass
class Words:
    """The words of a text column: byte positions, row of the column, and how many each row has."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    rows: int

    @staticmethod
    def of(texts: pa.ChunkedArray | pa.Array, between: np.ndarray = _BLANK) -> Words:
        """``between`` marks the bytes that part words."""
        data, offsets = text_bytes(texts)
        rows = len(offsets) - 1
        if not len(data):
            none = np.zeros(0, dtype=np.int64)
            return Words(data, none, none, none, rows)
        blank = between[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        first, last = ~blank, ~blank
        first[1:] &= blank[:-1] | edge[1:-1]
        last[:-1] &= blank[1:] | edge[1:-1]
        starts = np.flatnonzero(first)
        return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1, rows)

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash per word; ``lower`` reads A-Z as a-z."""
        data = self.data
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        out = np.full(len(self.starts), _A, dtype=np.uint64)
        size = self.ends - self.starts
        left = np.flatnonzero(size <= _LONG_WORD)
        for k in range(_LONG_WORD):
            left = left[size[left] > k]
            if not len(left):
                break
            out[left] = (out[left] ^ data[self.starts[left] + k]) * _PRIME
        for i in np.flatnonzero(size > _LONG_WORD):
            out[i] = xxhash.xxh64_intdigest(data[self.starts[i]:self.ends[i]].tobytes())
        return mixed(out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    x = (x ^ (x >> np.uint64(29))) * _A
    return x ^ (x >> np.uint64(32))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a window from those of its two parts, in order."""
    return mixed(left * _B + (right ^ (right >> np.uint64(31))) * _PRIME + _A)


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` items from each position on, by doubling; empty if there are too few."""
    out, have = hashes, 1
    while have < length:
        step = min(have, length - have)
        if len(out) <= step:
            return out[:0]
        out = joined(out[:-step], out[step:])
        have += step
    return out


def chunk_number(docs: DataFrame, key: Column, rows_per_chunk: int) -> tuple[Column, int]:
    """A chunk for each row, by hash, and how many chunks there are.

    Chunks hold about ``rows_per_chunk`` rows, so a task's memory does not grow with the corpus.
    """
    chunks = max(1, -(-docs.count() // rows_per_chunk))
    return F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int"), chunks


def shard_parts(hashes: np.ndarray, shards: int) -> tuple[list[int], np.ndarray]:
    """The shards, by range, that sorted hashes fall into, and where each next one begins."""
    shard = ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    cut = np.flatnonzero(np.diff(shard)) + 1
    return [int(s) for s in (shard[np.r_[0, cut]] if len(hashes) else [])], cut


def fresh(name: str, columns: list[str]) -> str:
    """``name`` with as many underscores as keep it apart from ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
