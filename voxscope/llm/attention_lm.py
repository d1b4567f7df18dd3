"""Operator 10: scores of a causal self-attention language model over subword ids, trained and run in numpy.

Subwords are those of a public byte-level BPE cut to its first merges.  The model is one attention layer; an id is
predicted as two digits, the second given the first, so no row is as wide as the vocabulary.  Texts are scored in
overlapping windows of two blocks: a position sees its own block up to itself and the block before, and every token is
scored once.  All blocks of many texts are one batched, masked attention.

Every training document teaches, in fixed rounds: chunks step on their own texts from the same parameters, and a weighted
mean of what they arrive at is where the next round begins.

Beside it stands the base score: add-one unigram word probabilities over all training documents.  Documents are dealt
once into chunks; a chunk hands the counts of its distinct words, by range of their hash, to shards that add them up over
the corpus and hand back one total per word.  A word that stands in every text is one entry per chunk.
"""

from __future__ import annotations

import base64
import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language_id import held_out
from .words import Words, chunk_number, shard_parts

DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BASE, WIDTH, BLOCK = 32, 16, 16  # ids have two digits of this base; numbers per vector; scored tokens per window
EDGE = BASE * BASE - 1  # the id before and after every text
STEPS, RATE, CHUNK_ROWS = 2000, 0.01, 2000
ROUNDS, TRAIN_ROWS, SHARE_ROWS, WINDOWS = 8, 1000, 400, 256  # training: rounds, rows of a chunk, least rows of a round, windows of a step
_FAN, _TEXT_AT_ONCE, _MODEL = 64, 4 << 20, "chunk int, model binary, squares binary, tokens binary"
_TOKENS_AT_ONCE = 1 << 13  # what the processor caches hold
_LIMIT = np.float32(60)  # no score or logit is beyond; so exponentials need no shift by the maximum


def read_ranks(path: str = DEFAULT_RANKS) -> dict[bytes, int]:
    """The first merges of a public vocabulary, read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if int(b) < EDGE}


_ENCODERS: dict[int, tiktoken.Encoding] = {}


def encoder(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    """One per worker process and vocabulary size."""
    if len(ranks) not in _ENCODERS:
        _ENCODERS[len(ranks)] = tiktoken.Encoding("cut", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[len(ranks)]


def _keep_freed_memory() -> None:
    """Let this process reuse the arrays of a step in the next one; by default each of them is new pages from the system."""
    try:
        tune = ctypes.CDLL(None).mallopt
    except (AttributeError, OSError, TypeError):  # another C library; it only takes longer
        return
    tune(-3, 16 << 20)  # M_MMAP_THRESHOLD
    tune(-1, 64 << 20)  # M_TRIM_THRESHOLD


def _sum_by(number: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """Sums of the rows that share a number."""
    order = np.argsort(number.astype(np.int16), kind="stable")
    ordered = number.take(order)
    at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out = np.zeros((size, rows.shape[1]), dtype=rows.dtype)
    out[ordered[at]] = np.add.reduceat(rows.take(order, axis=0), at, axis=0)
    return out


def _before(blocks: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The block before each, of the same text."""
    return np.where(first[:, None], EDGE, np.roll(blocks, 1, axis=0))


_EARLIER = np.tril(np.ones((BLOCK, BLOCK), dtype=np.float32))  # within a block no position sees a later one


@dataclass
class AttentionModel:
    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 1) -> AttentionModel:
        rng = np.random.default_rng(seed)
        def make(*shape):
            return (rng.standard_normal(shape) * shape[0] ** -0.5).astype(np.float32)
        return AttentionModel({
            "e": make(EDGE + 1, WIDTH) * 8, "pos": make(2 * BLOCK, WIDTH), "q": make(WIDTH, WIDTH), "k": make(WIDTH, WIDTH),
            "v": make(WIDTH, WIDTH), "o": make(WIDTH, WIDTH), "u": make(WIDTH, BASE), "ub": np.zeros(BASE, dtype=np.float32),
            "d": make(BASE, WIDTH), "w": make(WIDTH, BASE), "wb": np.zeros((BASE, BASE), dtype=np.float32)})

    def train(self, sequences: list[np.ndarray], steps: int = STEPS, windows: int = 128, seed: int = 1) -> AttentionModel:
        """Adam on windows drawn at random from the sequences; the same on every run."""
        rng = np.random.default_rng(seed)
        blocks, targets, first = _blocks(sequences)
        if not len(blocks):
            return self
        before, adam = _before(blocks, first), _Adam(self)
        for step in range(steps):
            pick = rng.integers(0, len(blocks), windows)
            adam.step((before[pick], blocks[pick], targets[pick], first[pick]), RATE * (1 - 0.9 * (step + 1) / steps))
        return self

    def _gradients(self, before: np.ndarray, block: np.ndarray, target: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, w = self.p, WIDTH
        scale = p["e"].dtype.type(w ** -0.5)
        ids, flat = np.concatenate([before, block], axis=1), lambda t: t.reshape(-1, t.shape[-1])
        # What depends on an id alone is looked up, and gradients are added up by id before they meet a matrix.
        qkv = np.concatenate([p["q"] * scale, p["k"], p["v"]], axis=1)
        by_id, by_place = p["e"] @ qkv, p["pos"] @ qkv
        k, v = (np.ascontiguousarray(by_id[:, at:at + w]).take(ids, axis=0) for at in (w, 2 * w))
        k += by_place[:, w:2 * w]
        v += by_place[:, 2 * w:]
        q = by_id[:, :w].take(block, axis=0)
        q += by_place[BLOCK:, :w]
        own = p["e"].take(block, axis=0)
        own += p["pos"][BLOCK:]
        a = q @ k.swapaxes(1, 2)
        np.exp(np.clip(a, -_LIMIT, _LIMIT, out=a), out=a)
        a[:, :, BLOCK:] *= _EARLIER
        a[first, :, :BLOCK] = 0
        a /= (a @ np.ones(2 * BLOCK, dtype=a.dtype))[..., None]
        mixed = a @ v
        h = flat(own + mixed @ p["o"])
        valid = target.ravel() >= 0
        high, low = np.divmod(np.where(valid, target.ravel(), 0), BASE)
        share = (valid / max(1, valid.sum())).astype(a.dtype)[:, None]
        inner = h + p["d"].take(high, axis=0)
        z = np.maximum(inner, 0)
        dh_logits, dl_logits = h @ p["u"] + p["ub"], z @ p["w"] + p["wb"].take(high, axis=0)
        rows = np.arange(len(h))
        for logits, digit in ((dh_logits, high), (dl_logits, low)):
            np.exp(np.clip(logits, -_LIMIT, _LIMIT, out=logits), out=logits)
            logits /= (logits @ np.ones(BASE, dtype=a.dtype))[:, None]
            logits[rows, digit] -= 1
            logits *= share
        g = {"u": h.T @ dh_logits, "ub": dh_logits.sum(axis=0), "w": z.T @ dl_logits}
        dz = dl_logits @ p["w"].T
        dz *= inner > 0
        g["wb"], g["d"] = np.split(_sum_by(high, np.concatenate([dl_logits, dz], axis=1), BASE), [BASE], axis=1)
        dh = dh_logits @ p["u"].T + dz
        g["o"] = flat(mixed).T @ dh
        dmixed = (dh @ p["o"].T).reshape(own.shape)
        da = dmixed @ v.swapaxes(1, 2)
        da -= (dmixed * mixed).sum(axis=-1, keepdims=True)
        da *= a
        dkv = np.concatenate([da.swapaxes(1, 2) @ q, a.swapaxes(1, 2) @ dmixed], axis=2)
        dq = np.concatenate([dh.reshape(own.shape), da @ k], axis=2)
        kv_id, kv_at = _sum_by(ids.ravel(), flat(dkv), EDGE + 1), dkv.sum(axis=0)
        q_id, q_at = _sum_by(block.ravel(), flat(dq), EDGE + 1), dq.sum(axis=0)
        sums_id = np.concatenate([q_id[:, w:], kv_id], axis=1)
        sums_at = np.concatenate([np.concatenate([np.zeros_like(q_at[:, w:]), q_at[:, w:]]), kv_at], axis=1)
        g["q"], g["k"], g["v"] = np.split(p["e"].T @ sums_id + p["pos"].T @ sums_at, 3, axis=1)
        g["q"] = g["q"] * scale
        g["e"], g["pos"] = sums_id @ qkv.T, sums_at @ qkv.T
        g["e"] += q_id[:, :w]
        g["pos"][BLOCK:] += q_at[:, :w]
        return g

    def learn(self, texts: Iterator[list[np.ndarray]], share: list[float], rates: tuple[float, float], windows: int, seed: int,
              squares: dict[str, np.ndarray] | None = None) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
        """Adam on every window of the parts of a chunk, once each; ``share`` is how much of the chunk lies up to each part's end.

        Returns how many tokens moved the rows of each id and of each digit, and all; and the mean squares of gradients.
        """
        rng, adam, done = np.random.default_rng(seed), _Adam(self, squares), 0.0
        moved = {"e": np.zeros(EDGE + 1), "d": np.zeros(BASE), "all": np.zeros(1)}
        for sequences, upto in zip(texts, share):
            blocks, targets, first = _blocks(sequences)
            before, order = _before(blocks, first), rng.permutation(len(blocks))
            for at in range(0, len(order), windows):
                pick = order[at:at + windows]
                now = done + (upto - done) * at / len(order)
                adam.step((before[pick], blocks[pick], targets[pick], first[pick]), rates[0] + (rates[1] - rates[0]) * now)
            real = targets[targets >= 0]
            moved["e"] += np.bincount(blocks[targets >= 0], minlength=EDGE + 1)
            moved["d"] += np.bincount(real // BASE, minlength=BASE)
            moved["all"] += len(real)
            done = upto
        return moved, {n: x / (1 if adam.known else 1 - 0.99 ** adam.t) for n, x in adam.s.items()}

    def scorer(self) -> Scorer:
        return Scorer(self.p)


class _Adam:
    """``squares`` are mean squares of gradients that an earlier round has left."""

    def __init__(self, model: AttentionModel, squares: dict[str, np.ndarray] | None = None):
        self.model, self.t, self.known = model, 0, squares is not None
        self.m = {n: np.zeros_like(x) for n, x in model.p.items()}
        self.s = {n: x.copy() for n, x in squares.items()} if squares else {n: np.zeros_like(x) for n, x in model.p.items()}

    def step(self, windows: tuple[np.ndarray, ...], rate: float) -> None:
        self.t += 1
        for n, g in self.model._gradients(*windows).items():
            m = self.m[n] = 0.9 * self.m[n] + 0.1 * g
            s = self.s[n] = 0.99 * self.s[n] + 0.01 * g * g
            self.model.p[n] -= (rate * (m / (1 - 0.9 ** self.t)) / (np.sqrt(s if self.known else s / (1 - 0.99 ** self.t)) + 1e-8)).astype(np.float32)


class Scorer:
    """Batched scoring; what depends on an id alone is looked up."""

    def __init__(self, p: dict[str, np.ndarray]):
        scale = np.float32(WIDTH ** -0.5)
        self.p = p
        self.x, self.q, self.k, self.v = (p["e"], p["e"] @ p["q"] * scale, p["e"] @ p["k"], p["e"] @ p["v"])
        self.x_at, self.q_at, self.k_at, self.v_at = (p["pos"], p["pos"] @ p["q"] * scale, p["pos"] @ p["k"], p["pos"] @ p["v"])

    @staticmethod
    def _windows(table: np.ndarray, places: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """What a table holds for each block and the one before it; ``blocks`` begins with the block ahead of the first."""
        found = table.take(blocks, axis=0)
        out = np.empty((len(blocks) - 1, 2 * BLOCK, table.shape[1]), dtype=found.dtype)
        np.add(found[:-1], places[:BLOCK], out=out[:, :BLOCK])
        np.add(found[1:], places[BLOCK:], out=out[:, BLOCK:])
        return out

    def blocks(self, blocks: np.ndarray, targets: np.ndarray, first: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Natural log probabilities of the targets of each block; ``before`` is the block ahead of the first one."""
        p, w = self.p, WIDTH
        both = np.concatenate([before[None], blocks])
        k, v = self._windows(self.k, self.k_at, both), self._windows(self.v, self.v_at, both)
        q = self.q.take(blocks, axis=0)
        q += self.q_at[BLOCK:]
        a = q @ k.swapaxes(1, 2)
        np.exp(np.clip(a, -_LIMIT, _LIMIT, out=a), out=a)
        a[:, :, BLOCK:] *= _EARLIER
        a[first, :, :BLOCK] = 0
        mixed = (a @ v).reshape(-1, w)
        mixed /= (a.reshape(-1, 2 * BLOCK) @ np.ones(2 * BLOCK, dtype=a.dtype))[:, None]
        h = self.x.take(blocks, axis=0)
        h += self.x_at[BLOCK:]
        h = h.reshape(-1, w)
        h += mixed @ p["o"]
        target = np.maximum(targets.ravel(), 0)
        high, low = target // BASE, target % BASE
        total = _log_of(h @ p["u"] + p["ub"], high)
        h += p["d"].take(high, axis=0)
        logits = np.maximum(h, 0, out=h) @ p["w"]
        logits += p["wb"].take(high, axis=0)
        total += _log_of(logits, low)
        return np.where(targets.ravel() >= 0, total, 0).reshape(targets.shape)

    def score(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Log10 probability of each sequence of ids, ends included."""
        out = np.zeros(len(sequences))
        blocks, targets, first = _blocks(sequences)
        owner = np.repeat(np.arange(len(sequences)), [-(-(len(s) + 1) // BLOCK) for s in sequences])
        step, before = max(1, _TOKENS_AT_ONCE // BLOCK), np.full(BLOCK, EDGE, dtype=np.int64)
        for at in range(0, len(blocks), step):
            part = slice(at, at + step)
            found = self.blocks(blocks[part], targets[part], first[part], before)
            out += np.bincount(owner[part], weights=found.sum(axis=1, dtype=np.float64), minlength=len(out))
            before = blocks[part][-1]
        return out / np.log(10)


def _log_of(logits: np.ndarray, digit: np.ndarray) -> np.ndarray:
    np.clip(logits, -_LIMIT, _LIMIT, out=logits)
    picked = logits[np.arange(len(logits)), digit]
    np.exp(logits, out=logits)
    return picked - np.log(logits @ np.ones(BASE, dtype=logits.dtype))


def _blocks(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs and targets in blocks, -1 where a text has ended, and whether a block is the first of its text."""
    sizes = np.array([len(s) + 1 for s in sequences], dtype=np.int64)
    many = -(-sizes // BLOCK)
    begin = np.concatenate([[0], np.cumsum(many)]) * BLOCK
    ids, targets = np.full(begin[-1], EDGE, dtype=np.int64), np.full(begin[-1], -1, dtype=np.int64)
    if sequences:
        flat = np.concatenate([np.append(s, EDGE) for s in sequences])
        place = np.arange(len(flat)) + np.repeat(begin[:-1] - np.cumsum(sizes) + sizes, sizes)
        targets[place] = flat
        inner = flat != EDGE  # an input is the target before
        ids[place[inner] + 1] = flat[inner]
    first = np.zeros(len(ids) // BLOCK, dtype=bool)
    first[begin[:-1] // BLOCK] = True
    return ids.reshape(-1, BLOCK), targets.reshape(-1, BLOCK), first


_PARTS = {"e": slice(0, EDGE + 1), "d": slice(EDGE + 1, EDGE + 1 + BASE), "all": slice(EDGE + 1 + BASE, EDGE + 2 + BASE)}


def _weights(moved: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """For each parameter, how many tokens moved it: those of its id, of its digit, or all."""
    rows = {"e": "e", "d": "d", "wb": "d"}
    return np.concatenate([np.broadcast_to(moved[_PARTS[rows.get(n, "all")]].reshape(-1, *[1] * (x.ndim - 1)), x.shape).ravel() for n, x in p.items()])


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([x.ravel() for x in p.values()]).astype(np.float64)


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    parts = np.split(flat.astype(np.float32), np.cumsum([x.size for x in like.values()])[:-1])
    return {n: x.reshape(like[n].shape) for n, x in zip(like, parts)}


def _slabs(texts: pa.ChunkedArray, encode: Callable[[str], list[int]], size: int) -> tuple[Iterator[list[np.ndarray]], list[float]]:
    """Texts as ids, some megabytes at a time, and how much of all lies up to the end of each part."""
    length = np.cumsum(pc.add(pc.binary_length(texts), 1).to_numpy())
    cut = np.unique(np.append(np.flatnonzero(np.diff(length // size)) + 1, len(length)))
    parts = (texts.slice(a, b - a) for a, b in zip(np.append(0, cut), cut))
    return ([np.array(encode(x), dtype=np.int64) for x in part.to_pylist()] for part in parts), [float(x) for x in length[cut - 1] / length[-1]]


def _add_models(table: pa.Table) -> pa.Table:
    """The sums of the models of some chunks, in order of the chunks."""
    table = table.sort_by("chunk")
    total = {c: sum(np.frombuffer(x, dtype=np.float64) for x in table[c].to_pylist()) for c in ("model", "squares", "tokens")}
    return pa.table({"chunk": pa.array([table["chunk"][0].as_py() // _FAN], pa.int32()), **{
        c: pa.array([x.tobytes()], pa.binary()) for c, x in total.items()}})


def _learner(shared: Broadcast, rates: tuple[float, float], windows: int, turn: int) -> Callable[[tuple[pa.Scalar, ...], pa.Table], pa.Table]:
    """What a chunk does in a round: its parameters, each times the tokens that moved it."""
    def learn(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _keep_freed_memory()
        known, p, squares = shared.value
        own = AttentionModel({n: x.copy() for n, x in p.items()})
        parts, share = _slabs(table.sort_by("key")["text"], encoder(known).encode_ordinary, _TEXT_AT_ONCE)
        moved, squares = own.learn(parts, share, rates, windows, turn * 1_000_003 + key[0].as_py(), squares)
        tokens = np.concatenate([moved[n] for n in _PARTS])
        weights = _weights(tokens, p)
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), **{n: pa.array([x.tobytes()], pa.binary()) for n, x in (
            ("model", _flat(own.p) * weights), ("squares", _flat(squares) * weights), ("tokens", tokens))}})
    return learn


def fit_model(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", rounds: int = ROUNDS, rows_per_chunk: int = TRAIN_ROWS,
              windows: int = WINDOWS) -> AttentionModel:
    """Train on every training row with a text, in a fixed number of rounds.

    Rows are dealt into as many shares as there are rounds, or fewer if a share would be small; a round takes
    the next share, so each row teaches in one round at least and as often as any other, give or take one round.  A chunk
    of a share starts from the parameters of the round before and makes steps on all its own windows; its parameters are
    averaged with those of the others, a row of a table by how many tokens moved it, so what is rare is not
    thinned out by the chunks that lack it.  The driver holds one model; texts stay in their tasks.
    """
    spark, model, key = docs.sparkSession, AttentionModel.fresh(), F.xxhash64("doc_id", text)
    rows = docs.where(~held_out(F.col("doc_id"), 7, 2) & F.col(text).isNotNull()).select(key.alias("key"), F.col(text).alias("text"))
    many = rows.count()
    shares = max(1, min(rounds, many // SHARE_ROWS))
    chunks = max(1, -(-many // (shares * rows_per_chunk)))
    dealt = F.pmod(F.xxhash64("key"), F.lit(shares * chunks)).cast("int")
    squares = None
    for turn in range(rounds if many else 0):
        shared = spark.sparkContext.broadcast((ranks, model.p, squares))
        rates = tuple(RATE * (1 - 0.9 * (turn + k) / rounds) for k in (0, 1))
        own = rows.select(dealt.alias("dealt"), "key", "text").where(F.col("dealt") % shares == turn % shares)
        own = own.select(F.floor(F.col("dealt") / shares).cast("int").alias("chunk"), "key", "text")
        found = own.repartition(chunks, "chunk").groupBy("chunk").applyInArrow(_learner(shared, rates, windows, turn), _MODEL)
        left = chunks
        while left > 1:
            found, left = found.groupBy(F.floor(F.col("chunk") / _FAN).alias("group")).applyInArrow(_add_models, _MODEL), -(-left // _FAN)
        for r in found.collect():  # one row, or none if the share is empty
            sums, sums_of_squares, tokens = (np.frombuffer(r[c], dtype=np.float64) for c in ("model", "squares", "tokens"))
            weights = _weights(tokens, model.p)
            mean = lambda x, old: _shaped(np.where(weights > 0, x / np.maximum(weights, 1), old), model.p)  # noqa: B023, E731
            squares = mean(sums_of_squares, 0.0 if squares is None else _flat(squares))
            model = AttentionModel(mean(sums, _flat(model.p)))
        shared.unpersist()
    return model


def _word_counts(texts: pa.ChunkedArray, trained: np.ndarray) -> tuple[np.ndarray, np.ndarray, Words, np.ndarray]:
    words = Words.of(texts)
    hashes, number = np.unique(words.hashes(lower=True), return_inverse=True)
    return hashes, np.bincount(number, weights=trained[words.row], minlength=len(hashes)).astype(np.int64), words, number


def _add_up(table: pa.Table) -> pa.Table:
    """For each chunk the corpus totals of its words, and in a row without chunk the sum and number of those that occur."""
    hashes = [np.frombuffer(x, dtype=np.uint64) for x in table["hashes"].to_pylist()]
    counts = [np.frombuffer(x, dtype=np.int64) for x in table["counts"].to_pylist()]
    _, number = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = np.bincount(number, weights=np.concatenate(counts)).astype(np.int64)
    parts = np.split(totals[number], np.cumsum([len(h) for h in hashes])[:-1])
    n = len(hashes)
    return pa.table({"chunk": pa.array(table["chunk"].to_pylist() + [None], pa.int32()), "shard": pa.array(
        table["shard"].to_pylist() + [None], pa.int32()), "totals": pa.array([t.tobytes() for t in parts] + [None], pa.binary()),
        "w": pa.array([None] * n + [int(totals.sum())], pa.int64()), "v": pa.array([None] * n + [int((totals > 0).sum())], pa.int64())})


def score_texts(docs: DataFrame, text: str = "text", ranks_path: str = DEFAULT_RANKS, model: AttentionModel | None = None,
                rows_per_chunk: int = CHUNK_ROWS) -> DataFrame:
    """One row per input row: struct ``row`` (its columns but the text), ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score``, ``score``.

    Rows whose ``doc_id`` falls into the held-out seventh teach nothing; a null ``doc_id`` is not held out.  Null and
    empty texts are one end token.  Repeated rows teach as often as they occur and score alike.  Without a training row
    every count is zero.  An empty table gives an empty table.  Words are counted by 64-bit hashes.
    """
    spark = docs.sparkSession
    ranks = read_ranks(ranks_path)
    shared = spark.sparkContext.broadcast((ranks, (model or fit_model(docs, ranks, text)).p))
    number, chunks = chunk_number(docs, F.struct("doc_id", text), rows_per_chunk)
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("__row")
    texts = docs.select(number.alias("__chunk"), F.col(text).alias("__text"), held_out(F.col("doc_id"), 7, 2).alias("__out"), rest)

    shards = max(1, -(-chunks // 4))

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hashes, n, _, _ = _word_counts(table["__text"], ~table["__out"].to_numpy())
        shard, cut = shard_parts(hashes, shards)
        parts, counts = (np.split(x, cut) if len(hashes) else [] for x in (hashes, n))
        return pa.table({"shard": pa.array(shard, pa.int32()), "chunk": pa.array([key[0].as_py()] * len(parts), pa.int32()), "hashes": pa.array(
            [x.tobytes() for x in parts], pa.binary()), "counts": pa.array([x.tobytes() for x in counts], pa.binary())})

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        _keep_freed_memory()
        out = left["__out"].to_numpy()
        _, counts, words, number = _word_counts(left["__text"], ~out)
        if len(right):
            parts = sorted(zip(right["shard"].to_pylist(), right["totals"].to_pylist()))
            counts = np.concatenate([np.frombuffer(x, dtype=np.int64) for _, x in parts])
        rows = words.rows
        sums = np.bincount(words.row, weights=np.log10(counts[number] + 1), minlength=rows)
        known = np.bincount(words.row[counts[number] > 0], minlength=rows)
        table, parameters = shared.value
        encode = encoder(table).encode_ordinary
        ids = [np.array(encode(x or ""), dtype=np.int64) for x in left["__text"].to_pylist()]
        scores = Scorer(parameters).score(ids)
        return pa.table({"__row": left["__row"], "held_out": left["__out"], "words": pa.array(words.counts(), pa.int64()), "known": pa.array(
            known, pa.int64()), "sums": sums, "score": scores})

    added = texts.groupBy("__chunk").applyInArrow(count, "shard int, chunk int, hashes binary, counts binary").groupBy("shard").applyInArrow(
        _add_up, "chunk int, shard int, totals binary, w long, v long")
    wanted = added.where("chunk IS NOT NULL").select("chunk", "shard", "totals")
    row = texts.schema["__row"].dataType.simpleString()
    found = texts.groupBy("__chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(
        score, f"__row {row}, held_out boolean, words long, known long, sums double, score double")
    sizes = added.where("chunk IS NULL").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("w", "v")])
    ends = docs.where(~held_out(F.col("doc_id"), 7, 2)).agg(F.count("*").alias("ends"))
    all_ = sizes.join(ends, F.lit(True)).select((F.col("w") + F.col("ends")).alias("train_tokens"), (F.col("v") + F.when(
        F.col("ends") > 0, 1).otherwise(0)).alias("v"), "ends")
    base = F.col("sums") + F.log10(F.col("ends") + F.lit(1.0)) - (F.col("words") + 1) * F.log10(F.col("train_tokens") + F.col("v") + F.lit(1.0))
    return found.join(F.broadcast(all_), F.lit(True)).select(  # one row
        F.col("__row").alias("row"), "held_out", (F.col("words") + 1).alias("n_tokens"), (F.col("known") + F.when(
            F.col("ends") > 0, 1).otherwise(0)).alias("n_known"), "train_tokens", base.alias("base_score"), "score")
