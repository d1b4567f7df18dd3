"""Operator 12: documents whose sets of word shingles have a Jaccard similarity of at least a limit, by universe partition.

Sets are put into bands by size; a set's partners lie in its own band or in a neighbouring one.  Per band the universe of
shingles is cut by hash into segments, one more than the shingles in which two partners can differ.

1. *Pigeonhole*.  A set gives each segment 0, 1 or 2 points: 1 looks for partners whose part in the segment is equal, 2 also
   for those with one shingle more or less there.  With more points than differences some segment must succeed.
2. *Index*.  Each set lists a signature for each part, and for the first few segments also one for each part less one shingle.
3. *Allocation*.  How many sets list a signature is its cost.  A set hands out its points where they cost least, so it avoids
   parts that many share (empty ones, boilerplate) by paying for the one-deletion neighbourhood of another segment.
4. *Candidates* share a signature.  Sizes and a parity sketch (its distance never exceeds the true difference) drop most;
   the rest is verified on the exact sets.

Equal sets are one class from the start.  The members of a bucket are first compared with one of them only; sets that are
linked by then need no comparison any more.  What is left, pairs from different components, is compared in full: by a join in
small buckets, in blocks of bounded size in large ones, where only pairs that pass the sketch come out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .components import connected_components
from .stages import few_tasks
from .words import Words, mixed, window_hashes

SHINGLE, PERCENT = 3, 90
ROUNDS, SMALL_BUCKET, BLOCK = 4, 48, 256
COST_SLOTS, HOT, FILTER_BITS = 1 << 18, 16, 1 << 23
_LARGEST_SET = 1 << 40
_SLICE_BYTES = 4 << 20
_INDEX, _PROBE = 1, 2
_WORDS = [f"s{i}" for i in range(4)]  # the parity sketch
_TOKEN, _VALUE, _PARITY = (np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0xA24BAED4963EE407, 0x9FB21C651E98DF25))
_TABLE = "own array<long>, own_less array<long>, own_n array<int>, other array<long>, other_less array<long>, other_n array<int>"


class Bands:
    """By band: the smallest size, how many segments, and how many of these have one-deletion neighbourhoods.

    Two partners, the smaller in the band, differ in less shingles than there are segments.  Bands where only equal sets can
    be partners have none.
    """

    def __init__(self, percent: int = PERCENT):
        if not 50 < percent < 100:
            raise ValueError("the limit must lie between 51 and 99 percent")
        least, segments = [1], []
        while least[-1] < _LARGEST_SET:
            most = least[-1] * 100 // percent
            differ = (most + most * 100 // percent) * (100 - percent) // (100 + percent)
            segments.append(differ + 1 if differ else 0)
            least.append(most + 1)
        self.least, self.segments = np.array(least[:-1]), np.array(segments, dtype=np.int64)
        self.open = np.where(self.segments > 0, 1 + self.segments // 16, 0)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.least, sizes, side="right") - 1


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's distinct shingles, rising within a row, and how many each row has."""
    words = Words.of(texts)
    hashes, counts = words.hashes(lower=True), words.counts()
    first = np.cumsum(counts) - counts
    found, row = window_hashes(hashes, shingle), words.row[:max(0, len(words.row) - shingle + 1)]
    inside = words.row[shingle - 1:] == row
    found, row = [found[inside]], [row[inside]]
    for few in range(1, shingle):
        short = np.flatnonzero(counts == few)
        at = first[short][:, None] + np.arange(few)
        found.append(window_hashes(hashes[at].T, few)[0] if len(short) else hashes[:0])
        row.append(short)
    found, row = np.concatenate(found), np.concatenate(row)
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    return found[new], np.bincount(row[new], minlength=words.rows)


def digests(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A number per set, whatever the order."""
    total = np.zeros(len(sizes), dtype=np.uint64)
    np.add.at(total, np.repeat(np.arange(len(sizes)), sizes), mixed(tokens ^ _VALUE))
    return mixed(total + sizes.astype(np.uint64) * _TOKEN)


def sketches(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """256 parities per set: two sketches differ in at most as many as the sets do."""
    out = np.zeros(len(sizes) * 4, dtype=np.uint64)
    where = mixed(tokens ^ _PARITY) >> np.uint64(56)
    slot = np.repeat(np.arange(len(sizes)), sizes) * 4 + (where >> np.uint64(6)).astype(np.int64)
    np.bitwise_xor.at(out, slot, np.uint64(1) << (where & np.uint64(63)))
    return out.reshape(-1, 4)


def signatures(tokens: np.ndarray, sizes: np.ndarray, band: np.ndarray, bands: Bands) -> tuple[np.ndarray, ...]:
    """Signatures of all parts under the partition of each row's ``band`` (-1: none), those of the parts less one shingle,
    and how many of the latter each open segment has; with the number of each per row."""
    known = band >= 0
    segments, opened = (np.where(known, x[band], 0) for x in (bands.segments, bands.open))
    row = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.cumsum(segments) - segments
    used = segments[row] > 0
    row, tokens = row[used], tokens[used]
    segment = ((mixed(tokens ^ _TOKEN) >> np.uint64(32)) * segments[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    value, at = mixed(tokens ^ _VALUE), begin[row] + segment
    sums = np.zeros(int(segments.sum()), dtype=np.uint64)
    np.add.at(sums, at, value)
    owner = np.repeat(np.arange(len(sizes)), segments)
    number = np.arange(len(owner)) - begin[owner]
    salt = mixed((band[owner].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64) + np.uint64(1))
    free = np.flatnonzero(segment < opened[row])
    free = free[np.argsort(at[free], kind="stable")]
    less = mixed(sums[at[free]] - value[free] + salt[at[free]])
    many = np.bincount(at[free], minlength=len(sums))[number < opened[owner]]
    return mixed(sums + salt), segments, less, np.bincount(row[free], minlength=len(sizes)), many, opened


def allocate(cost: np.ndarray, neighbours: np.ndarray) -> np.ndarray:
    """Points (0, 1, 2) per segment, as many in all as there are segments, where they cost least.

    ``neighbours`` has what the second point costs in the open segments, the first ones.
    """
    second = np.maximum(neighbours, cost[:len(neighbours)])
    taken = np.argsort(np.concatenate([cost, second]), kind="stable")[:len(cost)]
    return np.bincount(np.where(taken < len(cost), taken, taken - len(cost)), minlength=len(cost))


def _list(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat))


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with a bounded number of bytes (a longer text is a run of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    start = held = 0
    for i, size in enumerate(sizes.to_pylist()):
        if held and held + size > _SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def sign(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n, k, sketch, signature lists) per row: ``k`` names the set, and is null for an empty one."""
    bands = Bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 1):
                tokens, sizes = shingle_sets(batch.column(1), shingle)
                band = bands.of(sizes)
                lists = []
                for partition in (band, np.maximum(band, 0) - 1):
                    parts, n_parts, less, n_less, many, n_many = signatures(tokens, sizes, partition, bands)
                    lists += [_list(parts.view(np.int64), n_parts), _list(less.view(np.int64), n_less), _list(many.astype(np.int32), n_many)]
                sketch = sketches(tokens, sizes).view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(sizes), pa.array(digests(tokens, sizes).view(np.int64), mask=sizes == 0),
                    *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(4)], *lists],
                    names=["doc_id", "n", "k", *_WORDS, "own", "own_less", "own_n", "other", "other_less", "other_n"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n long, k long, {', '.join(f'{w} long' for w in _WORDS)}, {_TABLE}")


def cost_table(signed: DataFrame) -> np.ndarray:
    """About how many sets list the signatures that fall into each of ``COST_SLOTS`` slots: the most of any one of them."""
    listed = signed.select(F.explode(F.concat("own", "own_less")).alias("sig")).groupBy("sig").agg(F.count("*").alias("n")).where(F.col("n") >= HOT)
    slots = listed.groupBy(F.col("sig").bitwiseAND(COST_SLOTS - 1).alias("slot")).agg(F.max("n").alias("n"))
    found = slots.toArrow()  # one row per slot at most
    out = np.zeros(COST_SLOTS)
    out[found["slot"].to_numpy()] = found["n"].to_numpy()
    return out


def _points(sigs: pa.Array, less: pa.Array, many: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of every segment of every row, and those of the segment that each shortened part belongs to."""
    cost = table[sigs.flatten().to_numpy() & (COST_SLOTS - 1)]
    n, n_open = (x.value_lengths().to_numpy() for x in (sigs, many))
    row, begin = np.repeat(np.arange(len(n)), n), np.cumsum(n) - n
    points = np.ones(len(cost), dtype=np.int64)
    per_open = many.flatten().to_numpy()
    less_cost, less_of = table[less.flatten().to_numpy() & (COST_SLOTS - 1)], np.repeat(np.arange(len(per_open)), per_open)
    neighbours = np.bincount(less_of, weights=less_cost, minlength=len(per_open)) + 0.5 + 0.05 * per_open
    open_begin = np.cumsum(n_open) - n_open
    for i in np.unique(row[cost > 0]).tolist():  # cold sets give each segment its one point
        a, b = begin[i], open_begin[i]
        points[a:a + n[i]] = allocate(cost[a:a + n[i]], neighbours[b:b + n_open[i]])
    open_row = np.repeat(np.arange(len(n_open)), n_open)
    place = begin[open_row] + np.arange(len(open_row)) - open_begin[open_row]
    return points, points[place[less_of]]


def entries(signed: DataFrame, costs: Broadcast, wanted: Broadcast | None = None) -> DataFrame:
    """(sig, k, role): what each set lists (1) and looks for (2); with ``wanted``, of the signatures in that filter only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.column(0).to_numpy()
            sig, role, owner = [], [], []
            for at, listed in ((1, _INDEX), (4, 0)):
                sigs, less, many = batch.column(at), batch.column(at + 1), batch.column(at + 2)
                points, beyond = _points(sigs, less, many, costs.value)
                for column, roles in ((sigs, listed | np.where(points > 0, _PROBE, 0)), (less, listed | np.where(beyond > 1, _PROBE, 0))):
                    sig.append(column.flatten().to_numpy())
                    role.append(roles)
                    owner.append(np.repeat(k, column.value_lengths().to_numpy()))
            sig, role, owner = (np.concatenate(x) for x in (sig, role, owner))
            keep = role > 0
            if wanted is not None:
                keep &= _inside(sig, wanted.value)
            yield pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(owner[keep]), pa.array(role[keep].astype(np.int32))], names=["sig", "k", "role"])

    rows = signed.where("k IS NOT NULL").select("k", "own", "own_less", "own_n", "other", "other_less", "other_n")
    return rows.mapInArrow(run, "sig long, k long, role int")


def bit_filter(values: DataFrame) -> np.ndarray:
    """A Bloom filter with one hash, of ``FILTER_BITS`` bits whatever the number of values, which are hashes themselves."""
    name = F.col(values.columns[0])
    place = name.bitwiseAND(FILTER_BITS - 1)
    found = values.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.call_function(
        "shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))).alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS >> 6, dtype=np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def _inside(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = values & (FILTER_BITS - 1)
    return (bits[place >> 6] >> (place & 63)) & 1 > 0


def fetch_sets(docs: DataFrame, wanted: DataFrame, text: str, shingle: int) -> DataFrame:
    """(k, tokens): the sets named in ``wanted``, and a few more; each once."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, 0):
                tokens, sizes = shingle_sets(batch.column(0), shingle)
                k = digests(tokens, sizes).view(np.int64)
                begin = np.cumsum(sizes) - sizes
                keep = np.flatnonzero(_inside(k, shared.value) & (sizes > 0))
                yield pa.RecordBatch.from_arrays([pa.array(k[keep]), pa.array(
                    [tokens[begin[i]:begin[i] + sizes[i]].tobytes() for i in keep], pa.binary())], names=["k", "tokens"])

    return docs.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "k long, tokens binary").groupBy("k").agg(
        F.min("tokens").alias("tokens"))


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[place] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    one, two = (sets.select(F.col("k").alias(name), F.col("tokens").alias(f"t{name}")) for name in ("a", "b"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _near(x: str, y: str, percent: int) -> Column:
    """Whether the sizes and sketches of two sides let them be partners."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"{x}{w}").bitwiseXOR(F.col(f"{y}{w}"))) for w in _WORDS])
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * apart <= (100 - percent) * (n + m))


def _named(prefix: str, *columns: str) -> list[Column]:
    return [F.col(c).alias(f"{prefix}{c}") for c in columns]


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x_k", "y_k").alias("a"), F.greatest("x_k", "y_k").alias("b")).distinct()


def star_pairs(members: DataFrame, rows: int, turn: int, percent: int) -> DataFrame:
    """Pairs of the ``rows`` members of buckets with one of their bucket, the smallest by a hash that changes with ``turn``."""
    columns = ["k", "comp", "n", *_WORDS]
    heads = stage(few_tasks(members.groupBy("sig").agg(F.min_by(F.struct(*columns), F.xxhash64("k", F.lit(turn))).alias("h")).select(
        "sig", *[F.col(f"h.{c}").alias(f"y_{c}") for c in columns]), rows), "jaccard-heads")
    both = members.select("sig", *_named("x_", *columns)).join(heads, "sig")
    return _ordered(both.where(F.col("x_comp") != F.col("y_comp")).where(_near("x_", "y_", percent)))


def left_pairs(members: DataFrame, percent: int, small: int = SMALL_BUCKET, block: int = BLOCK) -> DataFrame:
    """All pairs of a bucket from different components, one listing what the other looks for, that may be partners."""
    columns = ["k", "comp", "role", "n", *_WORDS]
    sizes = stage(members.groupBy("sig").agg(F.count("*").alias("bucket")), "jaccard-buckets")
    sized = members.join(sizes, "sig")
    fits = (F.col("x_role").bitwiseAND(_INDEX) > 0) & (F.col("y_role").bitwiseAND(_PROBE) > 0) | (
        F.col("x_role").bitwiseAND(_PROBE) > 0) & (F.col("y_role").bitwiseAND(_INDEX) > 0)
    few = sized.where(F.col("bucket") <= small)
    joined = few.select("sig", *_named("x_", *columns)).join(few.select(F.col("sig").alias("y_sig"), *_named("y_", *columns)), (
        F.col("sig") == F.col("y_sig")) & (F.col("x_comp") < F.col("y_comp")) & fits & _near("x_", "y_", percent)).select("x_k", "y_k")

    def run(table: pa.Table) -> pa.Table:
        c = {name: table[name].to_numpy() for name in ("k", "comp", "role", "n", "mine", "one", "two")}
        sketch = np.stack([table[w].to_numpy() for w in _WORDS], axis=1).view(np.uint64)
        left, right = np.flatnonzero(c["mine"] == c["one"]), np.flatnonzero(c["mine"] == c["two"])
        x, y = [], []
        for i in left.tolist():
            j = right[c["k"][right] > c["k"][i]] if c["one"][0] == c["two"][0] else right
            n, m = c["n"][i], c["n"][j]
            j = j[(c["comp"][j] != c["comp"][i]) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (
                (c["role"][j] & _INDEX > 0) & (c["role"][i] & _PROBE > 0) | (c["role"][j] & _PROBE > 0) & (c["role"][i] & _INDEX > 0))]
            apart = np.bitwise_count(sketch[j] ^ sketch[i]).sum(axis=1)
            j = j[(100 + percent) * apart <= (100 - percent) * (n + c["n"][j])]
            x.append(np.full(len(j), c["k"][i]))
            y.append(c["k"][j])
        none = np.zeros(0, dtype=np.int64)
        return pa.table({"x_k": np.concatenate([none, *x]), "y_k": np.concatenate([none, *y])})

    many = sized.where(F.col("bucket") > small).withColumn("blocks", F.ceil(F.col("bucket") / block).cast("int")).withColumn(
        "mine", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    blocks = many.select("sig", *columns, "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "sig", *columns, "mine", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"))
    return _ordered(joined.unionByName(blocks.groupBy("sig", "one", "two").applyInArrow(run, "x_k long, y_k long")))


def similar_links(docs: DataFrame, signed: DataFrame, classes: DataFrame, text: str, shingle: int, percent: int, rounds: int = ROUNDS,
                  small: int = SMALL_BUCKET, block: int = BLOCK) -> DataFrame | None:
    """(a, b): links that connect all classes that are similar enough; None if there are no candidates."""
    context = docs.sparkSession.sparkContext
    costs = context.broadcast(cost_table(signed))
    buckets = stage(entries(signed, costs).groupBy("sig").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.bit_or("role").alias(
        "roles")).where(f"low < high AND roles = {_INDEX | _PROBE}").select("sig"), "jaccard-buckets")
    wanted = context.broadcast(bit_filter(buckets))
    shared = entries(signed, costs, wanted).join(buckets, "sig").groupBy("sig", "k").agg(F.bit_or("role").alias("role"))
    members = stage(shared.join(classes.select("k", "n", *_WORDS), "k").withColumn("comp", F.col("k")), "jaccard-members")
    sets = stage(fetch_sets(docs, members.select("k"), text, shingle), "jaccard-sets")
    links, left = None, members.count()
    for turn in range(rounds + 1):
        if not left:
            break
        pairs = star_pairs(members, left, turn, percent) if turn < rounds else left_pairs(members, percent, small, block)
        found = stage(verify(pairs, sets, percent), "jaccard-links")
        links = found if links is None else links.unionByName(found)
        if turn == rounds:
            break
        roots = stage(connected_components(links), "jaccard-roots")
        named = members.drop("comp").join(roots.withColumnRenamed("node", "k"), "k", "left").withColumn(
            "comp", F.coalesce("root", "k")).drop("root")
        open_ = named.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("sig")
        members = stage(few_tasks(named.join(stage(few_tasks(open_, left), "jaccard-open"), "sig"), left), "jaccard-members")
        before, left = left, members.count()
        if turn < rounds - 1 and left > 0.8 * before:  # another turn would settle little
            pairs = left_pairs(members, percent, small, block)
            return links.unionByName(stage(verify(pairs, sets, percent), "jaccard-links"))
    return links


def similar_documents(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, rounds: int = ROUNDS,
                      small: int = SMALL_BUCKET, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row per input row.

    Two rows are linked if ``100 * common >= percent * united`` of their distinct shingles, A-Z lower-cased; fewer words than
    a shingle are one.  ``component_id`` is the smallest ``doc_id`` that links reach.  Null texts and those without a word have
    no shingles and are linked with nothing, not even their equals.  Repeated rows are returned each.  A null ``doc_id``
    counts only if its component has no other (then ``component_id`` is null).  Shingles and whole sets are compared by 64-bit
    hashes.  Other columns are not read; an empty table gives an empty table.
    """
    signed = stage(sign(docs, text, shingle, percent), "jaccard-signed")
    rows = signed.select("doc_id", "n", "k")
    classes = stage(signed.where("k IS NOT NULL").groupBy("k").agg(
        F.min("doc_id").alias("least"), F.min("n").alias("n"), *[F.min(w).alias(w) for w in _WORDS]), "jaccard-classes")
    links = similar_links(docs, signed, classes, text, shingle, percent, rounds, small, block)
    labelled = classes.select("k", "least", F.col("k").alias("root"))
    if links is not None:
        roots = connected_components(links).withColumnRenamed("node", "k")
        labelled = stage(classes.select("k", "least").join(roots, "k", "left").select("k", "least", F.coalesce("root", "k").alias("root")), "jaccard-labels")
    names = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    names = stage(labelled.join(names, "root").select("k", "component_id"), "jaccard-components")
    alone = rows.where("k IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.join(names, "k").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)
