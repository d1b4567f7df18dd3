"""Operator 4: language identification by error-correcting output codes.

Each language has a codeword.  For each bit a binary n-gram classifier tells languages with the bit from those without:
its weights are log odds of hashed byte n-grams, every language counting alike on its side.  A text's bits are not
rounded: decoding takes the language whose codeword has the least exponential loss over the margins, each bit weighted
by how well it parts the training languages.  Texts whose two best codewords are near are flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, SMOOTH, AMBIGUOUS, MAX_LANGUAGES = 16, 0.5, 0.2, 256
_SIZE = 1 << BITS
_KEEP = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))
_SCALE = 4.0


def grams(text: str) -> list[np.ndarray]:
    """Hashed n-grams of 1, 2 and 3 bytes of a text's letters in lower case, each with its own share of the table."""
    letters = b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_KEEP).split()) + b" "
    b = np.frombuffer(letters, dtype=np.uint8).astype(np.uint32)
    two = b[:-1] << 8 | b[1:]
    three = (two[:-1] * np.uint32(0x9E3779B1) + b[2:] * np.uint32(0x85EBCA6B))
    three ^= three >> np.uint32(15)
    return [b, (two * np.uint32(0x9E3779B1) >> np.uint32(17)) + np.uint32(256), three % np.uint32(_SIZE - 33024) + np.uint32(33024)]


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages: all ways to part up to seven, else the best of seeded random codes."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        return np.array([[1.0 if bit == 0 or not number >> (bit - 1) & 1 else -1.0 for number in range(1, 1 << (n - 1))] for bit in range(n)])
    best, width, wide = None, -1, 10 * int(np.ceil(np.log2(n)))
    for seed in range(50):
        code = np.random.default_rng(seed).choice([-1.0, 1.0], size=(n, wide))
        near = (wide - (code @ code.T) + 2 * wide * np.eye(n)).min()
        if near > width and (abs(code.sum(axis=0)) < n).all():
            best, width = code, near
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # n-gram x bit
    importance: np.ndarray

    @staticmethod
    def fit(languages: list[str], counts: np.ndarray) -> LanguageModel:
        """``counts`` has a row of n-gram counts per language."""
        code = codewords(len(languages))
        share = (counts + SMOOTH) / (counts.sum(axis=1, keepdims=True) + SMOOTH * counts.shape[1])
        weights, importance = np.zeros((counts.shape[1], code.shape[1]), dtype=np.float32), np.ones(code.shape[1])
        for bit in range(code.shape[1]):
            yes, no = code[:, bit] > 0, code[:, bit] < 0
            if yes.any() and no.any():
                weights[:, bit] = np.log(share[yes].mean(axis=0)) - np.log(share[no].mean(axis=0))
                # How far apart the mean margins of the two sides lie, at the nearest.
                mean = share @ weights[:, bit]
                importance[bit] = max(mean[yes].min() - mean[no].max(), 1e-3)
        return LanguageModel(languages, code, weights, importance / importance.sum())

    def margins(self, text: str) -> np.ndarray:
        """Mean log odds per n-gram for each bit, more certain the longer the text."""
        found = np.concatenate(grams(text))
        total = np.zeros(self.weights.shape[1])
        for at in range(0, len(found), 1 << 16):
            total += self.weights[found[at:at + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return total / len(found) * _SCALE

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, ambiguous); ``und`` without letters or languages."""
        if text is None or not self.languages or not any(c.isalpha() for c in text):
            return "und", 0.0, True
        loss = np.exp(np.clip(-self.code * self.margins(text), -30, 30)) @ self.importance
        order = np.argsort(loss, kind="stable")
        odds = np.exp(-(loss - loss[order[0]]) * 2)
        near = len(order) > 1 and (loss[order[1]] - loss[order[0]]) < AMBIGUOUS * loss[order[0]]
        return self.languages[order[0]], float(1 / odds.sum()), bool(near)


def gram_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n) over all rows with a text and a language; each task sends each count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for language, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                total = held.setdefault(language, np.zeros(_SIZE, dtype=np.int64))
                for part in grams(body.as_py()):
                    found, n = np.unique(part, return_counts=True) if len(part) < 4096 else (slice(None), np.bincount(part, minlength=_SIZE))
                    total[found] += n
        for language, total in held.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(
                total[at], pa.int64())], names=["lang", "gram", "n"])

    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("__text")).dropna()
    return rows.mapInArrow(run, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_languages(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """The model of all labelled rows.  The driver gets at most 65,536 counts for each of at most 256 languages."""
    counts = gram_counts(docs, text, lang)
    found = counts.toPandas()
    languages = sorted(found["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    table = np.zeros((len(languages), _SIZE))
    table[np.searchsorted(languages, found["lang"].to_numpy(dtype=str)) if len(found) else [], found["gram"].to_numpy(dtype=np.int64)] = found["n"]
    return LanguageModel.fit(languages, table)


def predict_language(docs: DataFrame, model: LanguageModel, text: Column) -> Column:
    """Struct (lang_pred, score, ambiguous).  The model's size is fixed by its table and the number of languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(x) for x in texts], columns=["lang_pred", "score", "ambiguous"])

    return F.pandas_udf(run, "lang_pred string, score double, ambiguous boolean")(text)


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether CRC-32 of the key as text leaves ``fold``; a null key does not."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == fold, F.lit(False))


def identify_languages(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per input row: struct ``row`` (its columns), ``held_out``, ``lang_pred``, ``score``, ``ambiguous``.

    Rows whose ``doc_id`` falls into the held-out third, and rows without text or language, teach nothing.  Texts that are
    null or have no letter, and all texts if nothing was learned, are ``und`` with score 0.  Repeated rows count as often as
    they occur; ties go to the first language by code point; an empty table gives an empty table.
    """
    model = fit_languages(docs.where(~held_out(F.col("doc_id"), 3, 1)), text, lang)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("__text"), held_out(
        F.col("doc_id"), 3, 1).alias("held_out"))
    return rows.select("row", "held_out", predict_language(docs, model, F.col("__text")).alias("p")).select("row", "held_out", "p.*")
