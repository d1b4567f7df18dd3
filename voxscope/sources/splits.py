"""Large text files read by many tasks although their records hold the line's end inside quotes, or have no lines at all.

A file is cut at every separator, wherever a task's byte range begins.  Whether a piece begins inside quotes, and how deep, follows
from counts over all pieces before it: sums within each range, and over the few ranges of a file.  So no task reads a file alone.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import session

stage = partial(session.stage, compression="zstd")

_PLACE = ["file", "block", "pos"]
_CHUNK = ["file", "block", "chunk"]
_LINES_A_CHUNK = 4096
_BYTES_A_TASK = 16 << 20


def pieces(spark: SparkSession, path: str | list[str], separator: str, glob: str | None = None) -> DataFrame:
    """(file, size, block, pos, text): what stands between separators, in order of (block, pos) within a file."""
    reader = spark.read.option("lineSep", separator)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("text"))


def with_sum_before(rows: DataFrame, value: str, out: str) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows of the file; ``rows`` should be staged, as it is read twice."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stage(rows.groupBy("file", "block").agg(F.sum(value).alias("_n")).select(
        "file", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")), "block-sums")
    inside = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.join(blocks, ["file", "block"]).withColumn(out, F.col("_in") + F.col("_base")).drop("_in", "_base")


def _joined(rows: DataFrame, separator: str, group: tuple[str, ...] | list[str] = ("file",)) -> DataFrame:
    """(file, record, text), beside the columns of ``group``: the pieces of each record in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "pos", "text"))), lambda p: p["text"])
    return rows.groupBy(*group, "record").agg(F.array_join(parts, separator).alias("text"))


def csv_records(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """(file, record, text) of CSV files: lines whose quotes are still open are one record with the next ones.

    Lines are stored once and shuffled once, in chunks; the lines that end a record of an earlier chunk go there.  Only one row per chunk
    is put in order over a file.
    """
    lines = pieces(spark, path, "\n")
    odd = F.length("text") - F.length(F.replace("text", F.lit(quote), F.lit("")))
    stored = stage(lines.drop("size").withColumns({"quotes": odd.cast("long"), "bytes": F.octet_length("text").cast("long"), "chunk": F.floor(
        F.col("pos") / _LINES_A_CHUNK)}), "csv-lines")
    # A line begins a record where an even number of quotes stands before it: counted for chunks that begin outside quotes, and inside.
    inside = Window.partitionBy(*_CHUNK).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    counted = stored.select(*_CHUNK, "pos", "quotes", "bytes", (F.coalesce(F.sum("quotes").over(inside), F.lit(0)) % 2 == 0).alias("_even"))
    chunks = stage(counted.groupBy(_CHUNK).agg(
        F.sum("quotes").alias("quotes"), F.sum("bytes").alias("bytes"), F.count_if("_even").alias("n_out"), F.count_if(~F.col("_even")).alias("n_in"),
        F.min(F.when(F.col("_even"), F.col("pos"))).alias("first_out"), F.min(F.when(~F.col("_even"), F.col("pos"))).alias("first_in")), "csv-chunks")
    before = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    outside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 0
    opened = chunks.withColumn("_out", outside).select(*_CHUNK, F.when(F.col("_out"), F.col("n_out")).otherwise(F.col("n_in")).alias("n"), F.when(
        F.col("_out"), F.col("first_out")).otherwise(F.col("first_in")).alias("first"))
    numbered = opened.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    home = F.last(F.when(F.col("n") > 0, F.struct("block", "chunk", "base")), ignorenulls=True).over(before)
    places = stage(numbered.withColumn("home", home), "csv-places")
    own = F.coalesce(F.col("pos") >= F.col("first"), F.lit(False))
    at = {f"_{c}": F.when(own, F.col(c)).otherwise(F.col(f"home.{c}")) for c in ("block", "chunk", "base")}
    located = stored.join(places, _CHUNK).select(*_PLACE, "text", "quotes", *[c.alias(n) for n, c in at.items()])
    size = chunks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // _BYTES_A_TASK))
    group = ["file", "_block", "_chunk"]
    dealt = located.repartition(tasks, *group)
    order = Window.partitionBy(*group).orderBy("block", "pos")
    begins = (F.coalesce(F.sum("quotes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2 == 0).cast("long")
    rows = dealt.withColumn("_begins", begins).withColumn("record", F.col("_base") - 1 + F.sum("_begins").over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    return _joined(rows, "\n", group).select("file", "record", F.regexp_replace("text", "\r$", "").alias("text"))


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def json_elements(spark: SparkSession, path: str | list[str], glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """((file, record, text), (file)): the elements of JSON arrays that end with a brace, and the files that are no whole array.

    Text before an element that belongs to none, such as a number, stands in front of it.
    """
    found = pieces(spark, path, "}", glob)
    # Without escaped characters every quote opens or closes a text; the parts between are in turn outside and inside.
    plain = F.regexp_replace("text", r"(?s)\\.", "")
    parts = F.split(plain, '"', -1)

    def deeper(outside: int) -> Column:
        kept = F.array_join(F.filter(parts, lambda _, i: i % 2 == outside), "")
        return (_count(kept, "{") + _count(kept, "[") - _count(kept, "]")).cast("long")

    stored = stage(found.withColumns({"quotes": (F.size(parts) - 1).cast("long"), "from_out": deeper(0), "from_in": deeper(1)}), "json-pieces")
    files = stage(stored.groupBy("file").agg(F.max(F.struct("block", "pos")).alias("last"), F.max("size").alias("size"), F.sum(
        F.octet_length("text") + F.lit(1)).alias("bytes"), F.sum("quotes").alias("quotes")), "json-files")
    placed = with_sum_before(stored, "quotes", "before").join(files.select("file", "last", (F.col("bytes") > F.col("size")).alias("open")), "file")
    tail = (F.struct("block", "pos") == F.col("last")) & F.col("open")  # nothing ends the last piece
    outside = (F.col("before") + F.col("quotes")) % 2 == 0
    ends_out = outside & ~tail
    change = F.when(F.col("before") % 2 == 0, F.col("from_out")).otherwise(F.col("from_in")) - ends_out.cast("long")
    deep = stage(placed.select(*_PLACE, "text", change.alias("change"), ends_out.alias("closes"), tail.alias("tail")), "json-depth")
    ended = stage(with_sum_before(deep, "change", "depth").withColumn(
        "ends", (F.col("closes") & (F.col("depth") + F.col("change") == 1)).cast("long")), "json-ends")
    numbered = with_sum_before(ended, "ends", "record")
    # A whole array leaves nothing open and only its bracket behind the last element.
    state = ended.groupBy("file").agg(F.sum("change").alias("left"), F.min(F.col("depth") + F.col("change")).alias("low"), F.max_by(
        "text", F.struct("block", "pos")).alias("rest"), F.max("tail").alias("open"), F.sum("ends").alias("n"), F.min_by("text", F.struct("block", "pos")).alias("head"))
    whole = (F.col("left") == 0) & (F.col("low") >= 0) & F.col("open") & F.col("head").rlike(r"^\s*\[") & F.when(
        F.col("n") == 0, F.col("rest").rlike(r"^\s*\[")).otherwise(F.col("rest").rlike(r"^\s*(,.*)?\]\s*$"))
    broken = stage(state.where(~F.coalesce(whole, F.lit(False))).select("file"), "json-broken")
    kept = numbered.where(~F.col("tail")).join(broken, "file", "left_anti")
    first = F.when(F.col("record") == 0, F.regexp_replace("text", r"^\s*\[", "")).otherwise(F.regexp_replace("text", r"^\s*,", ""))
    return _joined(kept, "}").select("file", "record", F.concat(F.trim(first), F.lit("}")).alias("text")), broken
