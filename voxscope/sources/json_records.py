"""Raw JSON batches: an array of records, an object wrapping one, or a single record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .splits import json_elements

# A wrapping object is searched for these keys in this order; the first one present decides.
WRAPPERS = ("data", "comments", "items")


def payload_records(text: Column, record: T.StructType | str, wrappers: Sequence[str] = WRAPPERS) -> Column:
    """Array of the records a JSON payload holds; null when the payload is not valid JSON.

    A wrapper key whose value is not an array yields no records, even if a later key has some.
    """
    kind = record if isinstance(record, str) else record.simpleString()
    many = f"array<{kind}>" if kind.startswith("struct<") else f"array<struct<{kind}>>"
    one = kind if kind.startswith("struct<") else f"struct<{kind}>"
    keys = F.json_object_keys(text)
    wrapped = F.from_json(text, T.StructType([T.StructField(k, T.StringType()) for k in wrappers]))
    nothing = F.array().cast(many)

    records = F.array(F.from_json(text, one))
    for key in reversed(wrappers):
        inner = wrapped[key]
        is_list = F.json_array_length(inner).isNotNull()
        records = F.when(F.array_contains(keys, key),
                         F.when(is_list, F.from_json(inner, many)).otherwise(nothing)).otherwise(records)
    # Inside brackets, anything left over after the first value makes the array longer or invalid.
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return (F.when(alone & F.json_array_length(text).isNotNull(), F.from_json(text, many))
            .when(alone & keys.isNotNull(), records))


def _as_texts(record: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in record.fields])


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(text, kind)
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def explode_payloads(df: DataFrame, payload: str, record: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of a column of payloads; other columns travel along.

    The quarantine has the payloads that are not valid JSON, and each record of which a value does not fit its
    type, as a payload of its own.  Payloads are parsed once.
    """
    kind = T.StructType.fromDDL(record) if isinstance(record, str) else record
    keep = [c for c in df.columns if c != payload]
    parsed = df.withColumn("_records", payload_records(F.col(payload), _as_texts(kind))).select(
        *keep, F.when(F.col("_records").isNull(), F.col(payload)).alias("_broken"), F.explode_outer("_records").alias("_r"))
    values = F.struct(*[_typed(F.col(f"_r.`{f.name}`"), f.dataType).alias(f.name) for f in kind.fields])
    lost = F.lit(False)
    for f in kind.fields:
        lost = lost | (F.col(f"_r.`{f.name}`").isNotNull() & F.col(f"_v.`{f.name}`").isNull())
    stored = stage(parsed.withColumn("_v", values).withColumn("_lost", lost), "payloads")
    records = stored.filter("_r IS NOT NULL AND NOT _lost").select(*keep, "_v.*")
    quarantine = stored.filter("_broken IS NOT NULL OR _lost").select(*keep, F.coalesce(
        "_broken", F.to_json("_r")).alias(payload)).select(df.columns)
    return records, quarantine


def read_json_records(spark: SparkSession, path: str, record: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of every ``*.json`` file below ``path``; broken files do not fail.

    A file is one payload and is read by one task, so keep files well below 2 GB.  Files that
    are plain arrays of any size go through :func:`read_json_arrays`.
    """
    files = (spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True)
             .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("payload")))
    return explode_payloads(files, "payload", record)


def read_json_arrays(spark: SparkSession, path: str | list[str], record: T.StructType | str,
                     glob: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of files that hold one JSON array of objects each; a large file is read by many tasks.

    The quarantine has (file, payload): a record that is no object, or of which a value does not fit its type, with its own
    text; a file that is no whole array with null, none of it is a record.
    """
    kind = T.StructType.fromDDL(record) if isinstance(record, str) else record
    elements, broken = json_elements(spark, path, glob)
    parsed = elements.withColumn("_r", F.when(F.json_object_keys("text").isNotNull(), F.from_json("text", _as_texts(kind))))
    values = F.struct(*[_typed(F.col(f"_r.`{f.name}`"), f.dataType).alias(f.name) for f in kind.fields])
    lost = F.col("_r").isNull()
    for f in kind.fields:
        lost = lost | (F.col(f"_r.`{f.name}`").isNotNull() & F.col(f"_v.`{f.name}`").isNull())
    stored = stage(parsed.withColumn("_v", values).withColumn("_lost", lost), "json-arrays")
    quarantine = stored.filter("_lost").select("file", F.col("text").alias("payload")).unionByName(
        broken.select("file", F.lit(None).cast("string").alias("payload")))
    return stored.filter("NOT _lost").select("_v.*"), quarantine
