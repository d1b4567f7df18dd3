"""Operator 7: quality classifier by the perplexity of an interpolated modified Kneser-Ney model of bytes.

1. Trusted texts are counted: n-grams of four bytes, of every training row.  Lower orders, continuation counts, context
   totals and the discounts follow by aggregation.
2. Documents are dealt once into chunks.  A chunk names its distinct n-grams; these meet the model's tables in joins by
   n-gram and by context, which shard the model whatever its size; the probabilities go back to the chunk.
3. A text's perplexity is judged by quantiles, for its language, of trusted texts that the model was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import stage
from .words import chunk_number, text_bytes

ORDER, CHUNK_ROWS, FEW_IDS = 4, 4000, 2_000_000
LOW, HIGH, MARGIN, LEAST_CALIBRATION, LEAST_POOLED = 0.001, 0.995, 2, 50, 20
CLASSES, STRETCH = range(4, 13), 64  # lengths of 16 to 4,096 bytes; bytes of a stretch
_BLOCK, _STEP = 1 << 20, 1e-4


class _Grams:
    """The four-byte n-grams of a batch of texts, each text after three line ends."""

    def __init__(self, texts: pa.ChunkedArray | pa.Array):
        self.data, self.offsets = text_bytes(texts)
        alphabet = np.flatnonzero(np.bincount(self.data, minlength=256) + np.bincount([10], minlength=256))
        self.alphabet = alphabet.astype(np.int64)
        self.letter = np.zeros(256, dtype=np.int32)  # three letters fit into 24 bits
        self.letter[alphabet] = np.arange(len(alphabet))
        self.a = len(alphabet)

    def blocks(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row, three bytes before each byte as one number, the byte), some megabytes at a time."""
        rows, at = len(self.offsets) - 1, 0
        while at < rows:
            end = max(at + 1, int(np.searchsorted(self.offsets, self.offsets[at] + _BLOCK, side="right")) - 1)
            end = min(end, rows)
            lines = self.letter[self.data[self.offsets[at]:self.offsets[end]]]
            starts = (self.offsets[at:end + 1] - self.offsets[at])
            first, context, shifted = starts[:-1][np.diff(starts) > 0], 0, lines
            for power in range(3):  # the letters one, two and three places before
                shifted = np.concatenate([self.letter[10:11], shifted[:-1]])[:len(lines)]
                shifted[first] = self.letter[10]
                context = context + shifted * np.int32(self.a ** power)
            yield at, end, context, lines
            at = end

    def index(self) -> None:
        """Number the distinct n-grams by two tables instead of by sorting."""
        seen = np.zeros(self.a ** 3, dtype=bool)
        for _, _, context, _ in self.blocks():
            seen[context] = True
        self.contexts = np.flatnonzero(seen)
        self.context_no = (np.cumsum(seen) - 1).astype(np.int32)
        hit = np.zeros(len(self.contexts) * self.a, dtype=bool)
        for _, _, context, byte in self.blocks():
            hit[self.context_no[context] * self.a + byte] = True
        self.hits = np.flatnonzero(hit)
        self.number = (np.cumsum(hit) - 1).astype(np.int32)

    def codes(self) -> np.ndarray:
        """The distinct n-grams as numbers of four bytes, in the order of their numbering."""
        context, byte = self.contexts[self.hits // self.a], self.hits % self.a
        parts = [self.alphabet[context // self.a ** 2], self.alphabet[context // self.a % self.a], self.alphabet[context % self.a], self.alphabet[byte]]
        return parts[0] << 24 | parts[1] << 16 | parts[2] << 8 | parts[3]

    def of(self, context: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return self.number[self.context_no[context] * self.a + byte]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        self.index()
        total = np.zeros(len(self.hits), dtype=np.int64)
        for _, _, context, byte in self.blocks():
            total += np.bincount(self.of(context, byte), minlength=len(total))
        return self.codes(), total

    def sums(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the sum of ``value`` over its n-grams, over its first bytes of each class, and over its lowest stretch."""
        rows = len(self.offsets) - 1
        out, heads, lowest = np.zeros(rows), np.full((rows, len(CLASSES)), np.nan), np.full(rows, np.nan)
        for first, last, context, byte in self.blocks():
            upto = np.concatenate([[0.0], np.cumsum(value[self.of(context, byte)])])
            at = self.offsets[first:last + 1] - self.offsets[first]
            out[first:last] = np.diff(upto[at])
            begin, size = at[:-1], np.diff(at)
            for k, power in enumerate(CLASSES):
                long = np.flatnonzero(size >= 1 << power)
                heads[first + long, k] = upto[begin[long] + (1 << power)] - upto[begin[long]]
            long = np.flatnonzero(size >= STRETCH)
            if len(long):
                many = size[long] // STRETCH
                group = np.cumsum(many) - many
                start = np.repeat(begin[long] - group * STRETCH, many) + np.arange(many.sum()) * STRETCH
                lowest[first + long] = np.minimum.reduceat(upto[start + STRETCH] - upto[start], group)
        return out, heads, lowest


def trusted_ids(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(training, calibration) ids of labelled rows of quality that are not toxic: four fifths by hash, and the other fifth."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    fifth = F.pmod(F.xxhash64("doc_id"), F.lit(5))
    return good.where(fifth != 0), good.where(fifth == 0)


def count_trusted(docs: DataFrame, ids: DataFrame, text: str = "text") -> DataFrame:
    """(gram, c): four-byte n-grams of the texts with these ids, however many; each row counts as often as it occurs.

    Up to ``FEW_IDS`` ids go to the texts; only more than that, at eight bytes each, are worth shuffling the texts for.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col(text).alias("__text"))
    wanted = stage(ids.select(F.col("doc_id").cast("long").alias("__id")), "kn-trusted")
    few = wanted.count() <= FEW_IDS
    trusted = texts.join(F.broadcast(wanted) if few else wanted, "__id", "left_semi").select("__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = _Grams(batch.column(0))
            if len(grams.data):
                codes, n = grams.counts()
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], names=["gram", "c"])

    return trusted.mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


class KneserNey:
    """Tables of each order: n-grams with their counts, and contexts with totals and numbers of rare followers."""

    def __init__(self, counts: DataFrame):
        self.grams, self.contexts, self.discounts = {}, {}, {}
        table = stage(counts, "kn-grams")
        for n in range(ORDER, 0, -1):
            self.grams[n] = table
            self.contexts[n] = stage(table.groupBy(F.shiftright("gram", 8).alias("context")).agg(F.sum("c").alias("total"), *[
                F.sum(F.when(F.least("c", F.lit(3)) == k, 1).otherwise(0)).alias(f"n{k}") for k in (1, 2, 3)]), "kn-contexts")
            self.discounts[n] = self._discounts(table)
            if n > 1:  # how many different bytes come before
                table = stage(table.groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1)).alias("gram")).agg(
                    F.count("*").alias("c")), "kn-grams")

    @staticmethod
    def _discounts(table: DataFrame) -> list[float]:
        n = [0, *(x or 0 for x in table.agg(*[F.sum((F.col("c") == k).cast("long")) for k in (1, 2, 3, 4)]).first())]
        if not all(n[1:]):
            return [0.5, 0.5, 0.5]  # too few n-grams to tell
        y = n[1] / (n[1] + 2 * n[2])
        return [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k) for k in (1, 2, 3)]

    def log2(self, grams: DataFrame) -> DataFrame:
        """(gram, log2) for distinct n-grams of the highest order, seen or not."""
        out = grams.select("gram").withColumn("p", F.lit(1 / 256))
        for n in range(1, ORDER + 1):
            d = self.discounts[n]
            known = self.grams[n].select(F.col("gram").alias("__gram"), "c")
            context = self.contexts[n].withColumnRenamed("context", "__context")
            if n <= 2:  # at most 65,536 n-grams of two bytes
                known, context = F.broadcast(known), F.broadcast(context)
            part = F.col("gram").bitwiseAND(F.lit((1 << 8 * n) - 1))
            out = out.join(known, part == F.col("__gram"), "left").join(context, F.shiftright(part, 8) == F.col("__context"), "left")
            off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
            left = (d[0] * F.col("n1") + d[1] * F.col("n2") + d[2] * F.col("n3")) / F.col("total")
            p = F.coalesce((F.col("c") - off) / F.col("total"), F.lit(0.0)) + F.coalesce(left, F.lit(1.0)) * F.col("p")
            out = out.select("gram", p.alias("p"))
        return out.select("gram", F.log2("p").alias("log2"))


def perplexities(docs: DataFrame, model: KneserNey, text: str = "text", rows_per_chunk: int = CHUNK_ROWS) -> DataFrame:
    """(doc_id, lang, text_key, n_bytes, log2, heads, worst) of every row: of the first bytes of each class, and of the worst stretch."""
    number, _ = chunk_number(docs, F.struct("doc_id", text), rows_per_chunk)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select(number.alias("__chunk"), F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), F.xxhash64(
        F.coalesce(F.col(text), F.lit(""))).alias("text_key"), F.col(text).alias("__text"))

    def distinct(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        grams = _Grams(table["__text"])
        grams.index()
        codes = grams.codes()
        return pa.table({"chunk": pa.array(np.full(len(codes), key[0].as_py()), pa.int32()), "gram": codes})

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        grams = _Grams(left["__text"])
        grams.index()
        found = right["gram"].to_numpy()
        value = right["log2"].to_numpy()[np.argsort(found)][np.searchsorted(np.sort(found), grams.codes())] if len(found) else np.zeros(0)
        size = np.diff(grams.offsets)
        sums, heads, worst = grams.sums(value)
        heads = pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1) * len(CLASSES), pa.int32()), pa.array(heads.ravel(), from_pandas=True))
        return left.drop_columns(["__chunk", "__text"]).append_column("n_bytes", pa.array(size, pa.int64())).append_column("log2", pa.array(
            sums)).append_column("heads", heads).append_column("worst", pa.array(worst, from_pandas=True))

    needed = texts.groupBy("__chunk").applyInArrow(distinct, "chunk int, gram long")
    known = needed.join(model.log2(needed.select("gram").distinct()), "gram")
    return texts.groupBy("__chunk").cogroup(known.groupBy("chunk")).applyInArrow(
        score, "doc_id long, lang string, text_key long, n_bytes long, log2 double, heads array<double>, worst double")


def _quantiles(scores: DataFrame, group: Column) -> DataFrame:
    """(lang, kind, class, n, lowest, highest): quantiles of bits per byte, by counting in steps of 0.0001, so no group is
    collected.  ``highest`` is that of texts the model was not trained on; ``lowest`` of all, which it knows better."""
    keys = ["lang", "kind", "class"]
    bins = scores.groupBy(group.alias("lang"), "kind", "class", F.floor(F.col("bits") / _STEP).alias("bin")).agg(
        F.count("*").alias("k"), F.sum(F.col("fresh").cast("long")).alias("f"))
    upto, all_ = Window.partitionBy(*keys).orderBy("bin"), Window.partitionBy(*keys)
    share = bins.select("*", *[F.sum(c).over(w).alias(n) for c, w, n in (("k", upto, "k_upto"), ("f", upto, "f_upto"), ("k", all_, "m"), ("f", all_, "n"))])
    found = share.groupBy(*keys).agg(F.max("n").alias("n"), F.min(F.when(F.col("k_upto") >= F.col("m") * LOW, F.col("bin"))).alias(
        "lowest"), F.min(F.when(F.col("f_upto") >= F.col("n") * HIGH, F.col("bin"))).alias("highest"))
    margin = (F.col("highest") - F.col("lowest")) * MARGIN / F.sqrt("n")
    return found.select(*keys, "n", ((F.col("lowest") - margin) * _STEP).alias("lowest"), ((F.col("highest") + 1 + margin) * _STEP).alias("highest"))


def _class(size: Column) -> Column:
    return F.least(F.floor(F.log2(size)), F.lit(CLASSES[-1])).cast("int")


def classify_quality(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, lang, text_key, n_bytes, perplexity, kept), a row per input row.

    ``perplexity`` is per byte; null for a text without bytes, which is kept.  A text is rejected if its bits per byte lie
    outside the quantiles of its language's trusted texts, cut to its class of length, or if those of its worst stretch lie
    above that of trusted texts of its class.  The quantiles are widened by ``MARGIN`` / sqrt(n) of their distance, n being
    the texts they rest on.  Languages with fewer than ``LEAST_CALIBRATION`` such texts, and null, take the quantiles of all;
    classes with fewer than ``LEAST_POOLED`` of all reject nothing.
    Training takes every trusted row of the four fifths, whole.  Repeated rows get the same verdict.
    """
    training, calibration = trusted_ids(labels)
    model = KneserNey(count_trusted(docs, training, text))
    scores = stage(perplexities(docs, model, text).withColumn("bits", F.when(F.col("n_bytes") > 0, -F.col("log2") / F.col("n_bytes"))), "kn-scores")
    trusted = training.withColumn("fresh", F.lit(False)).unionByName(calibration.withColumn("fresh", F.lit(True)))
    known = scores.join(trusted, "doc_id")
    heads = known.select("lang", "fresh", F.posexplode("heads").alias("k", "head")).where("head IS NOT NULL").select(
        "lang", "fresh", F.lit(0).alias("kind"), (F.col("k") + CLASSES[0]).alias("class"), (-F.col("head") / F.pow(F.lit(2.0), F.col("k") + CLASSES[0])).alias("bits"))
    worst = known.where("worst IS NOT NULL").select("lang", "fresh", F.lit(1).alias("kind"), _class(F.col("n_bytes")).alias("class"), (-F.col(
        "worst") / STRETCH).alias("bits"))
    known = stage(heads.unionByName(worst), "kn-calibration")
    per = stage(_quantiles(known, F.col("lang")).where(F.col("n") >= LEAST_CALIBRATION), "kn-quantiles")
    pooled = stage(_quantiles(known, F.lit(None).cast("string")).where(F.col("n") >= LEAST_POOLED), "kn-quantiles")
    judged = scores.withColumn("class", _class(F.col("n_bytes")))
    for kind in (0, 1):
        own = per.where(F.col("kind") == kind).select(F.col("lang").alias("__lang"), F.col("class").alias("__class"), "lowest", "highest")
        every = pooled.where(F.col("kind") == kind).select(F.col("class").alias("__any"), F.col("lowest").alias("low_all"), F.col("highest").alias("high_all"))
        judged = judged.join(own, (F.col("lang") == F.col("__lang")) & (F.col("class") == F.col("__class")), "left").join(
            F.broadcast(every), F.col("class") == F.col("__any"), "left").select(judged["*"], F.coalesce("lowest", "low_all").alias(
                f"low{kind}"), F.coalesce("highest", "high_all").alias(f"high{kind}"))  # at most a row per class
    outside = F.coalesce((F.col("bits") < F.col("low0")) | (F.col("bits") > F.col("high0")), F.lit(False))
    odd = F.coalesce(-F.col("worst") / STRETCH > F.col("high1"), F.lit(False))
    return judged.select("doc_id", "lang", "text_key", "n_bytes", F.pow(F.lit(2.0), "bits").alias("perplexity"), (~(outside | odd)).alias("kept"))


def keep_quality(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows that the classifier keeps, with all their columns."""
    gone = classify_quality(docs, labels, text).where("NOT kept").select("doc_id", "text_key").distinct()
    key = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["doc_id"]) & (key == gone["text_key"]), "left_anti")
