"""Operator 2: token counts of a unigram tokenizer, without building the tokens.

An Aho-Corasick automaton names every vocabulary piece that ends at a position; dynamic programming carries the best
score up to each position and the number of pieces on that path.  Rules of the tokenizer that is matched:

* spaces become ``▁``, one is put in front unless the text begins with it, and each ``▁`` begins a new unit;
* of the paths to a position the one with the highest score wins, of equal ones that whose last piece is longest;
* a character without a piece of its own scores ten less than the worst piece; runs of such characters become one
  unknown token, or with byte pieces one token per UTF-8 byte.

A piece cannot cross a unit's start, so a text's count is the sum of its units' counts, and those of short units are
remembered.  The remembered units are dropped when there are too many; that costs time, never a count.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE, UNKNOWN_PENALTY = "▁", 10.0
_REMEMBERED, _SHORT = 150_000, 48
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def read_pieces(path: str = DEFAULT_MODEL) -> tuple[list[tuple[str, float]], bool]:
    """Pieces with their scores from a sentencepiece file on the driver, and whether it has byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in plain], any(model.is_byte(i) for i in range(model.get_piece_size()))


def units(text: str) -> list[str]:
    """The pre-tokenizer's units; an empty text has none."""
    if not text:
        return []
    marked = text.replace(" ", SPACE)
    parts = (marked if marked[0] == SPACE else SPACE + marked).split(SPACE)
    return [SPACE + x for x in parts[1:]]


@dataclass
class UnigramCounter:
    pieces: Iterable[tuple[str, float]]
    byte_pieces: bool = True
    remembered: dict[str, tuple[int, int]] = field(default_factory=dict)

    def __post_init__(self):
        self.automaton = ahocorasick.Automaton()
        lowest = 0.0
        for piece, score in self.pieces:
            self.automaton.add_word(piece, (len(piece), score))
            lowest = min(lowest, score)
        self.unknown_score = lowest - UNKNOWN_PENALTY
        if len(self.automaton):
            self.automaton.make_automaton()

    def unit(self, text: str) -> tuple[int, int]:
        """(tokens, unknown characters) of one unit."""
        n = len(text)
        ending: list[list] = [[] for _ in range(n)]
        if len(self.automaton):
            for end, match in self.automaton.iter(text):
                ending[end].append(match)
        best, count, unknown, open_run = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(n):
            matches = ending[end]
            matches.sort(reverse=True)  # the earliest start first; only a strictly better path replaces it
            top, begin, single = None, 0, False
            for length, score in matches:
                start = end + 1 - length
                path = best[start] + score
                if top is None or path > top:
                    top, begin = path, start
                single |= length == 1
            if not single and (top is None or best[end] + self.unknown_score > top):
                best[end + 1] = best[end] + self.unknown_score
                size = len(text[end].encode()) if self.byte_pieces else 0 if open_run[end] else 1
                count[end + 1], unknown[end + 1], open_run[end + 1] = count[end] + size, unknown[end] + 1, True
            else:
                best[end + 1], count[end + 1], unknown[end + 1] = top, count[begin] + 1, unknown[begin]
        return count[n], unknown[n]

    def known(self, text: str) -> tuple[int, int]:
        found = self.remembered.get(text)
        if found is None:
            found = self.unit(text)
            if len(text) <= _SHORT:
                if len(self.remembered) >= _REMEMBERED:
                    self.remembered.clear()
                self.remembered[text] = found
        return found

    def count(self, text: str | None) -> tuple[int, int]:
        """(tokens, unknown characters) of a text; null has none."""
        tokens = unknown = 0
        for unit in units(text or ""):
            more, odd = self.known(unit)
            tokens += more
            unknown += odd
        return tokens, unknown


_LAST: list = [None, None]  # per worker process: the vocabulary and its counter


def _counter(vocabulary: tuple) -> UnigramCounter:
    if _LAST[0] is not vocabulary:
        _LAST[:] = vocabulary, UnigramCounter(*vocabulary)
    return _LAST[1]


def token_counts(spark: SparkSession, text: Column, pieces: list[tuple[str, float]], byte_pieces: bool) -> Column:
    """Struct (n_tokens, n_unknown) for a text column.  The vocabulary, a fixed file, is broadcast."""
    shared = spark.sparkContext.broadcast((pieces, byte_pieces))

    def run(texts: pd.Series) -> pd.DataFrame:
        counter = _counter(shared.value)
        return pd.DataFrame([counter.count(x) for x in texts], columns=["n_tokens", "n_unknown"])

    return F.pandas_udf(run, "n_tokens long, n_unknown long")(text)


def count_tokens(docs: DataFrame, text: str = "text", model: str = DEFAULT_MODEL) -> DataFrame:
    """One row per input row: struct ``row`` (its columns), ``n_chars``, ``n_tokens``, ``n_unknown``.

    Null and empty texts have no tokens.  Rows are counted one by one, so repeated rows agree, other columns do not matter
    and an empty table gives an empty table.  ``n_unknown`` counts characters without a piece.
    """
    pieces, byte_pieces = read_pieces(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("__text"))
    found = rows.select("row", F.coalesce(F.length("__text"), F.lit(0)).cast("long").alias("n_chars"), token_counts(
        docs.sparkSession, F.col("__text"), pieces, byte_pieces).alias("t"))
    return found.select("row", "n_chars", "t.n_tokens", "t.n_unknown")
