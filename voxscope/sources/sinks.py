"""Writers: files in several formats, appends, bundles, keyed tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge
from ..session import settings
from .csv_safe import CSV_OPTIONS, is_missing
from .keyed_tables import KeyedTable

# White space at the ends of a text is content, not layout.
_CSV_WRITE = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"} | {
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


_OPEN_FILES = 256


@contextmanager
def _dealt(df: DataFrame, parts: tuple[str, ...], tasks: int | None) -> Iterator[DataFrame]:
    """Rows for folders by ``parts``: few files per folder, none too large, or what ``tasks`` tasks write without a shuffle."""
    if tasks is None:
        yield df.hint("rebalance", *parts) if parts else df
    else:
        # A file stays open for each folder a task meets, up to a limit, instead of sorting its rows by folder first.
        with settings(df.sparkSession, spark__sql__maxConcurrentOutputFileWriters=str(_OPEN_FILES)):
            yield df.coalesce(tasks)


def write_outputs(df: DataFrame, path: str, partition_by: str | None = None, compression: str = "none", tasks: int | None = None,
                  table_compression: str | None = None) -> dict[str, str]:
    """Write Parquet, CSV and JSON Lines copies; returns their folders.

    The plan runs once, for Parquet; the other copies are made from that table.  ``compression`` is that of the text files, every
    reader of this library takes either, but a compressed file is one task; ``table_compression`` that of Parquet, the session's
    unless given.  Rows are shuffled for few files per folder; with ``tasks`` that many tasks write them where they are, each at most
    one file per folder, which suits long texts that lie in large partitions.
    """
    folders = {fmt: os.path.join(path, fmt) for fmt in ("parquet", "csv", "jsonl")}
    with _dealt(df, (partition_by,) if partition_by else (), tasks) as clustered:
        writer = clustered.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(folders["parquet"], compression=table_compression)
    stored = df.sparkSession.read.schema(df.schema).parquet(folders["parquet"]).select(df.columns)
    _flat(stored).write.mode("overwrite").options(**_CSV_WRITE, compression=compression).csv(folders["csv"])
    stored.write.mode("overwrite").options(ignoreNullFields="false", compression=compression).json(folders["jsonl"])
    return folders


def write_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header; only for small results, since one task writes it."""
    # repartition, unlike coalesce, keeps the stage before it parallel.
    _flat(df).repartition(1).write.mode("overwrite").options(**_CSV_WRITE).csv(path)


PARTS = ("platform", "crawl_type", "item", "dt")


def append_csv(df: DataFrame, path: str, parts: tuple[str, ...] = PARTS, compression: str = "none", tasks: int | None = None) -> None:
    """Append rows below platform/type/item/day folders; ``tasks`` as in :func:`write_outputs`."""
    with _dealt(_flat(df), parts, tasks) as rows:
        rows.write.mode("append").partitionBy(*parts).options(**_CSV_WRITE, compression=compression).csv(path)


def append_json(df: DataFrame, path: str, parts: tuple[str, ...] = PARTS, compression: str = "none", tasks: int | None = None) -> None:
    """Append rows as JSON Lines; existing files are never rewritten; ``tasks`` as in :func:`write_outputs`."""
    with _dealt(df, parts, tasks) as rows:
        rows.write.mode("append").partitionBy(*parts).options(ignoreNullFields="false", compression=compression).json(path)


def cell_text(column: Column, kind: T.DataType) -> Column:
    """Sheet cell: null becomes '', nested values become JSON, everything else its text."""
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(column)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(""))


def as_sheet(df: DataFrame) -> DataFrame:
    return df.select(*[cell_text(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def write_bundle(sheets: Mapping[str, DataFrame], path: str, fmt: str = "parquet") -> dict[str, str]:
    """One folder per non-empty sheet; nothing is written when all are empty."""
    written = {}
    for name, df in sheets.items():
        if df.isEmpty():
            continue
        written[name] = os.path.join(path, name)
        as_sheet(df).write.mode("overwrite").format(fmt).options(
            **(_CSV_WRITE if fmt == "csv" else {})).save(written[name])
    return written


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A whole stored table."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The stored table, or an empty one before the first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return spark.createDataFrame([], schema)


def read_keyed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A keyed table as its last batch left it; before the first, an empty one."""
    return KeyedTable(spark, path).read(schema)


def _wide(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns of either."""
    return old.unionByName(new.limit(0), allowMissingColumns=True), new.unionByName(old.limit(0), allowMissingColumns=True)


def upsert_table(df: DataFrame, path: str, keys: list[str], order: list[str],
                 update: list[str] | None = None) -> DataFrame:
    """Merge a batch into the keyed table at ``path`` and return the new content.

    ``update`` names the columns a match may change; without it a match replaces the row.
    """
    def merged(old: DataFrame, new: DataFrame) -> DataFrame:
        old, new = _wide(old, new)
        return merge.upsert_partial(old, new, keys, update, order) if update else merge.upsert_all(old, new, keys, order)

    return KeyedTable(df.sparkSession, path).merge(df, keys, merged)


_PRESENT = "_present"


def upsert_documents(df: DataFrame, path: str, keys: list[str], order: list[str], present: str | None = None) -> DataFrame:
    """Document ``$set``: the batch's fields overwrite, those it does not have stay, over any number of batches.

    ``present`` names a column with the fields each document carries; without it these are all of the batch.
    """
    fields = [c for c in df.columns if c != present]
    given = F.col(present) if present else F.array(*[F.lit(c) for c in fields])
    batch = df.withColumn(_PRESENT, given).select(*fields, _PRESENT)

    def merged(old: DataFrame, new: DataFrame) -> DataFrame:
        wide, rows = _wide(old.drop(_PRESENT), new)
        return merge.set_merge(wide.drop(_PRESENT), rows, keys, _PRESENT, order).withColumn(_PRESENT, F.lit(None).cast("array<string>"))

    return KeyedTable(df.sparkSession, path).merge(batch, keys, merged).drop(_PRESENT)


def find_many(df: DataFrame, query: Mapping[str, object], limit: int = 0, order: str | None = None) -> DataFrame:
    """Rows that equal every value of ``query``; a limit of 0 returns all."""
    for column, value in query.items():
        df = df.filter(F.col(column).eqNullSafe(F.lit(value)))
    if order:
        df = df.orderBy(order)
    return df.limit(limit) if limit else df


def find_one(df: DataFrame, query: Mapping[str, object], order: str | None = None) -> DataFrame:
    return find_many(df, query, 1, order)


def _flat(df: DataFrame) -> DataFrame:
    """CSV has no nested types; they are written as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
                       for f in df.schema.fields])


def _write_csv(df: DataFrame, path: str, **_) -> None:
    _flat(df).write.mode("append").options(**_CSV_WRITE).csv(path)


def _write_json(df: DataFrame, path: str, **_) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def _write_parquet(df: DataFrame, path: str, **_) -> None:
    df.write.mode("append").parquet(path)


def _write_sheet(df: DataFrame, path: str, name: str = "Contents", **_) -> None:
    write_bundle({name: df}, path)


def _write_keyed(df: DataFrame, path: str, keys: list[str], order: list[str], update: list[str] | None = None,
                 **_) -> None:
    upsert_table(df, path, keys, order, update)


def _write_documents(df: DataFrame, path: str, keys: list[str], order: list[str], present: str | None = None, **_) -> None:
    upsert_documents(df, path, keys, order, present)


FORMATS: dict[str, Callable[..., None]] = {
    "csv": _write_csv, "json": _write_json, "parquet": _write_parquet, "excel": _write_sheet,
    "db": _write_keyed, "sqlite": _write_keyed, "mongodb": _write_documents,
}


def create_sink(fmt: str) -> Callable[..., None]:
    """The writer for a save option; the keyed ones also take ``keys``, ``order``, ``update``."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown save option {fmt!r}; choose one of {', '.join(sorted(FORMATS))}")
    return FORMATS[fmt]
