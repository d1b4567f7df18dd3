"""Unions, upserts by key, schema comparison.

All upserts reduce the incoming batch to one row per key with map-side combination first, so
many versions of one key never meet in one task, and then join unique keys with unique keys.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union aligned by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_batches(old: DataFrame, new: DataFrame, order: list[str], key: str = "content") -> DataFrame:
    """Old and new rows together, one row per ``key``; old rows win, then the given order."""
    from .dedup import dedup_any, dedup_keep_first

    both = union_by_name(old.withColumn("_source", F.lit(0)), new.withColumn("_source", F.lit(1)))
    if key not in both.columns:
        return dedup_any(both.drop("_source"))
    return dedup_keep_first(both, key, ["_source", *order]).drop("_source")


def _order(columns: Iterable[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def _join_sides(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join; sides become structs ``o`` and ``n`` that are null where absent."""
    left = old.select(*keys, F.struct(*[F.col(c) for c in old.columns]).alias("o"))
    right = new.select(*keys, F.struct(*[F.col(c) for c in new.columns]).alias("n"))
    return left.join(right, keys, "full")


def upsert_partial(old: DataFrame, new: DataFrame, keys: list[str], update: list[str],
                   order: list[str]) -> DataFrame:
    """Insert whole rows; on a match replace only the ``update`` columns.

    Of several versions in one batch the first supplies the fixed columns and the last the
    updated ones, so that the result does not depend on how rows are cut into batches.
    """
    fixed = [c for c in old.columns if c not in update and c not in keys]
    batch = new.groupBy(*keys).agg(
        F.min_by(F.struct(*fixed), _order(order)).alias("_first"),
        F.max_by(F.struct(*update), _order(order)).alias("_last"))
    rows = batch.select(*keys, "_first.*", "_last.*")
    joined = _join_sides(old, rows, keys)
    picks = []
    for c in old.columns:
        if c in keys:
            picks.append(F.col(c))
        elif c in update:
            picks.append(F.when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            picks.append(F.when(F.col("o").isNotNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
    return joined.select(*picks)


def upsert_all(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last written row per key replaces all earlier ones; one shuffle."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    rest = [c for c in old.columns if c not in keys]
    return (both.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.struct("_batch", *order)).alias("_row"))
            .select(*keys, "_row.*").select(*old.columns))


def upsert_known_columns(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Like :func:`upsert_all` for the columns the target has; others of ``new`` are ignored."""
    known = [c for c in old.columns if c in new.columns]
    rest = [c for c in known if c not in keys]
    batch = (new.groupBy(*keys).agg(F.max_by(F.struct(*rest), _order(order)).alias("_row"))
             .select(*keys, "_row.*"))
    joined = _join_sides(old, batch, keys)
    return joined.select(*[
        F.col(c) if c in keys
        else F.when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) if c in rest
        else F.col(f"o.{c}").alias(c) for c in old.columns])


def set_merge(old: DataFrame, new: DataFrame, keys: list[str], present: str, order: list[str]) -> DataFrame:
    """Document ``$set``: fields listed in ``present`` overwrite, even with null; others stay."""
    fields = [c for c in old.columns if c not in keys]
    aggregates = []
    for c in fields:
        given = F.array_contains(present, c)
        aggregates += [F.max_by(F.struct(c), F.when(given, _order(order))).alias(f"_{c}"),
                       F.max(given).alias(f"_has_{c}")]
    batch = new.groupBy(*keys).agg(*aggregates)
    joined = old.join(batch, keys, "full")
    return joined.select(*keys, *[
        F.when(F.coalesce(F.col(f"_has_{c}"), F.lit(False)), F.col(f"_{c}.{c}")).otherwise(F.col(c)).alias(c)
        for c in fields])


def insert_guarded(old: DataFrame, new: DataFrame, keys: list[str], order: list[str], guard: str) -> DataFrame:
    """:func:`upsert_all`, but a key is only inserted once a version has a non-empty ``guard``."""
    rest = [c for c in old.columns if c not in keys]
    filled = F.coalesce(F.col(guard) != "", F.lit(False))
    batch = new.groupBy(*keys).agg(F.max_by(F.struct(*rest), _order(order)).alias("_row"),
                                   F.max(filled).alias("_ok"))
    left = old.select(*keys, F.struct(*rest).alias("_old"))
    joined = left.join(batch, keys, "full").filter(F.col("_old").isNotNull() | F.col("_ok"))
    return (joined.select(*keys, F.coalesce("_row", "_old").alias("_row"))
            .select(*keys, "_row.*").select(*old.columns))


def new_feature_columns(raw: DataFrame, clean: DataFrame) -> list[str]:
    """Columns that cleaning added, in table order."""
    return [c for c in clean.columns if c not in raw.columns]


def observed_schema(df: DataFrame, table: str, json: str) -> DataFrame:
    """(table, column, type) triples that occur in a column of JSON objects.

    Types are bigint, double, boolean, null, or string; a column seen with several types has
    the widest of them.
    """
    pairs = df.select(F.col(table).alias("table"), F.explode(
        F.from_json(json, "map<string,string>")).alias("column", "value"))
    rank = (F.when(F.col("value").isNull(), 0).when(F.col("value").isin("true", "false"), 1)
            .when(F.col("value").rlike("^-?[0-9]+$"), 2)
            .when(F.col("value").rlike(r"^-?[0-9]+\.[0-9]+([eE][+-]?[0-9]+)?$"), 3).otherwise(4))
    names = F.array(*[F.lit(n) for n in ("null", "boolean", "bigint", "double", "string")])
    return (pairs.groupBy("table", "column").agg(F.max(rank).alias("_rank"))
            .select("table", "column", F.element_at(names, F.col("_rank") + 1).alias("type")))


def schema_diff(actual: DataFrame, declared: DataFrame) -> DataFrame:
    """Columns of the tables both frames have: added, dropped, retyped or same."""
    a = actual.select("table", "column", F.col("type").alias("actual_type"))
    d = declared.select("table", "column", F.col("type").alias("declared_type"))
    a, d = (a.join(declared.select("table").distinct(), "table", "left_semi"),
            d.join(actual.select("table").distinct(), "table", "left_semi"))
    status = (F.when(F.col("actual_type").isNull(), "added").when(F.col("declared_type").isNull(), "dropped")
              .when(F.col("actual_type") != F.col("declared_type"), "retyped").otherwise("same"))
    return a.join(d, ["table", "column"], "full").withColumn("status", status)


def table_diff(actual: DataFrame, declared: DataFrame) -> DataFrame:
    """Tables that only one of the two frames has."""
    a = actual.select("table").distinct().withColumn("_a", F.lit(True))
    d = declared.select("table").distinct().withColumn("_d", F.lit(True))
    return (a.join(d, "table", "full").filter(F.col("_a").isNull() | F.col("_d").isNull())
            .select("table", F.when(F.col("_a").isNull(), "added").otherwise("dropped").alias("status")))
