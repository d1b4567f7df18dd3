"""Frequent item sets and association rules, level by level.

A set can only be frequent if all its parts are, so candidates of one size come from the frequent sets of the size before, and
a row of (transaction, frequent set) leads to the next size by a join inside the transaction.  Nothing holds all transactions
of an item, or all sets, in one task or on the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage


def feature_items(df: DataFrame, key: str, features: dict[str, Column]) -> DataFrame:
    """(key, item): one item ``name=value`` per row and feature; missing values are no items."""
    items = F.array(*[F.concat(F.lit(f"{name}="), value.cast("string")) for name, value in features.items()])
    return df.select(key, F.explode(F.array_compact(items)).alias("item"))


def _without(items: Column, at: Column) -> Column:
    """The set without its element ``at`` (from 1)."""
    return F.filter(items, lambda _, i: i != at - 1)


def candidates(frequent: DataFrame, size: int) -> DataFrame:
    """(items) of ``size``: two frequent sets that differ in their last element, if every part of one element less is frequent."""
    head = F.slice("items", 1, size - 2)
    sides = [frequent.select(head.alias("head"), F.element_at("items", -1).alias(name)) for name in ("a", "b")]
    joined = sides[0].join(sides[1], "head").where("a < b").select(F.concat("head", F.array("a", "b")).alias("items"))
    if size == 2:
        return joined
    parts = joined.select("items", F.explode(F.sequence(F.lit(1), F.lit(size))).alias("at")).select(
        F.col("items").alias("whole"), _without(F.col("items"), F.col("at")).alias("items"))
    held = parts.join(frequent.select("items"), "items", "left_semi")
    return held.groupBy("whole").agg(F.count("*").alias("n")).where(F.col("n") == size).select(F.col("whole").alias("items"))


def frequent_itemsets(baskets: DataFrame, key: str, item: str = "item", min_share: float = 0.1, max_size: int = 3) -> DataFrame:
    """(items, size, support, transactions): every set of up to ``max_size`` items that at least ``min_share`` of the
    transactions hold, its items in ascending order.

    Repeated rows count once; rows without a key or an item do not count.  Transactions are the distinct keys.
    """
    rows = stage(baskets.where(F.col(key).isNotNull() & F.col(item).isNotNull()).select(
        F.col(key).alias("key"), F.col(item).alias("item")).distinct(), "baskets")
    total = rows.agg(F.count_distinct("key")).first()[0]
    least = -(-total * round(min_share * 1_000_000) // 1_000_000)
    held = rows.select("key", F.array("item").alias("items"))
    found = []
    for size in range(1, max_size + 1):
        if size > 1:
            possible = stage(candidates(found[-1], size), "pattern-candidates")
            head = F.slice("items", 1, size - 2)
            sides = [held.select("key", head.alias("head"), F.element_at("items", -1).alias(name)) for name in ("a", "b")]
            pairs = sides[0].join(sides[1], ["key", "head"]).where("a < b").select("key", F.concat("head", F.array("a", "b")).alias("items"))
            held = stage(pairs.join(possible, "items", "left_semi"), "pattern-rows")
        counts = held.groupBy("items").agg(F.count("*").alias("support"))
        found.append(stage(counts.where(F.col("support") >= max(least, 1)), "patterns"))
        if size < max_size:
            if found[-1].isEmpty():
                break
            held = held.join(found[-1].select("items"), "items", "left_semi")
    return reduce(DataFrame.unionByName, found).select(
        "items", F.size("items").alias("size"), "support", F.lit(total).cast("long").alias("transactions"))


def association_rules(itemsets: DataFrame, min_confidence: float = 0.8) -> DataFrame:
    """(antecedent, consequent, support, confidence, lift): rules with one item on the right.

    ``itemsets`` comes from :func:`frequent_itemsets`; a rule's parts are frequent, so their supports are there.
    """
    whole = itemsets.where("size > 1").select("items", "support", "transactions", F.explode(F.sequence(F.lit(1), F.col("size"))).alias("at"))
    rules = whole.select(_without(F.col("items"), F.col("at")).alias("antecedent"), F.element_at("items", F.col("at")).alias("consequent"),
                         "support", "transactions")
    left = itemsets.select(F.col("items").alias("antecedent"), F.col("support").alias("_left"))
    right = itemsets.where("size = 1").select(F.col("items")[0].alias("consequent"), F.col("support").alias("_right"))
    confidence = F.col("support") / F.col("_left")
    return (rules.join(left, "antecedent").where(confidence >= min_confidence).join(right, "consequent")
            .select("antecedent", "consequent", "support", confidence.alias("confidence"),
                    (confidence * F.col("transactions") / F.col("_right")).alias("lift")))
