"""Keyed Parquet tables: a batch rewrites the buckets its keys fall into, and a small manifest makes that visible at once.

A table is a folder of versions; each holds the buckets that one batch wrote.  A manifest names for every bucket the version that
counts, the schema, and the bytes per bucket.  A batch writes its buckets into a new version first and then its manifest, under
the next number and by renaming, so readers see all of a batch or none of it, and a writer that comes second fails.  What a
failed batch left behind is not named by any manifest and goes with the next clean-up.

The number of buckets grows with the table: a bucket keeps about ``TARGET_BYTES``, so a batch costs the buckets it touches and
not a share of the table.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

BUCKET, TARGET_BYTES, LEAST_BUCKETS = "_bucket", 128 << 20, 8
_MANIFESTS, _DATA, _KEPT_MANIFESTS = "_manifests", "data", 2


class Files:
    """What a table needs of the file system that its folder lies in."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._jvm = spark._jvm

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Write a file that appears whole or not at all; raises if it is there already."""
        draft = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(draft), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._fs.exists(self._path(path)) or not self._fs.rename(self._path(draft), self._path(path)):
            self._fs.delete(self._path(draft), False)
            raise RuntimeError(f"another writer was faster: {path} exists")

    def delete(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)


@dataclass
class Manifest:
    """``versions`` and ``sizes`` by bucket number; a bucket without rows is in neither."""

    number: int = 0
    buckets: int = 0
    schema: T.StructType = field(default_factory=T.StructType)
    versions: dict[int, str] = field(default_factory=dict)
    sizes: dict[int, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"buckets": self.buckets, "schema": self.schema.jsonValue(), "versions": self.versions, "sizes": self.sizes})

    @staticmethod
    def of(number: int, text: str) -> Manifest:
        found = json.loads(text)
        return Manifest(number, found["buckets"], T.StructType.fromJson(found["schema"]),
                        {int(k): v for k, v in found["versions"].items()}, {int(k): v for k, v in found["sizes"].items()})


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark, path)

    def _manifest_path(self, number: int) -> str:
        return f"{self.path}/{_MANIFESTS}/{number:012d}.json"

    def manifest(self) -> Manifest:
        """The newest one; an empty one before the first batch."""
        numbers = [n for n in self.files.names(f"{self.path}/{_MANIFESTS}") if n.endswith(".json")]
        return Manifest.of(int(numbers[-1][:-5]), self.files.read(f"{self.path}/{_MANIFESTS}/{numbers[-1]}")) if numbers else Manifest()

    def _read(self, manifest: Manifest, buckets: list[int], schema: T.StructType) -> DataFrame:
        paths = [f"{self.path}/{_DATA}/{manifest.versions[b]}/{BUCKET}={b}" for b in buckets if b in manifest.versions]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """All rows as the last complete batch left them; fields that a row was stored without are null."""
        found = self.manifest()
        return self._read(found, sorted(found.versions), found.schema if found.number else schema or found.schema)

    def merge(self, df: DataFrame, keys: list[str], merged: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """Rewrite the buckets that hold keys of ``df`` as ``merged(stored rows, new rows)`` and return the table.

        The table has the columns of all batches so far; a column keeps the type it was first stored with, and values of
        another type are cast to it, which fails if they do not fit.
        """
        before = self.manifest()
        known = {f.name: f.dataType for f in before.schema.fields}
        extra = [f for f in df.schema.fields if f.name not in known]
        schema = T.StructType([*before.schema.fields, *[T.StructField(f.name, f.dataType) for f in extra]])
        batch = stage(df.select(*[F.col(f"`{c}`").cast(known[c]).alias(c) if c in known else F.col(f"`{c}`") for c in df.columns]), "upsert-batch")
        buckets = before.buckets or LEAST_BUCKETS
        while sum(before.sizes.values()) > 2 * TARGET_BYTES * buckets:
            buckets *= 2
        number = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        # A bucket number per row at most; growing rewrites all of them once.
        touched = [r[0] for r in batch.select(number).distinct().collect()]
        if before.buckets and buckets != before.buckets:
            old, left, touched = self._read(before, sorted(before.versions), schema), {}, list(range(buckets))
        else:
            old = self._read(before, touched, schema)
            left = {b: v for b, v in before.versions.items() if b not in set(touched)}
        rows = merged(old, batch).select(*[f.name for f in schema.fields]).withColumn(BUCKET, number)
        version = f"{before.number + 1:012d}-{uuid.uuid4().hex[:8]}"
        folder = f"{self.path}/{_DATA}/{version}"
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
        files = self.spark.read.schema(T.StructType([T.StructField(BUCKET, T.IntegerType())])).parquet(folder).select(
            BUCKET, F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s")).distinct()
        sizes = {r[0]: r.s for r in files.groupBy(BUCKET).agg(F.sum("s").alias("s")).collect()}
        after = Manifest(before.number + 1, buckets, schema, {**left, **{b: version for b in sizes}},
                         {**{b: n for b, n in before.sizes.items() if b in left}, **sizes})
        self.publish(after)
        self._clean(after)
        return self._read(after, sorted(after.versions), schema)

    def publish(self, manifest: Manifest) -> None:
        self.files.publish(self._manifest_path(manifest.number), manifest.text())

    def _clean(self, newest: Manifest) -> None:
        """Remove manifests but the last ones, and versions that none of these name; who reads the one before still can."""
        numbers = [n for n in self.files.names(f"{self.path}/{_MANIFESTS}") if n.endswith(".json")]
        kept = [Manifest.of(int(n[:-5]), self.files.read(f"{self.path}/{_MANIFESTS}/{n}")) for n in numbers[-_KEPT_MANIFESTS:]]
        named = {v for m in [*kept, newest] for v in m.versions.values()}
        for n in numbers[:-_KEPT_MANIFESTS]:
            self.files.delete(f"{self.path}/{_MANIFESTS}/{n}")
        for version in self.files.names(f"{self.path}/{_DATA}"):
            if version not in named:
                self.files.delete(f"{self.path}/{_DATA}/{version}")
