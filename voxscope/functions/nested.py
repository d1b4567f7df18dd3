"""Arrays, maps and nested payloads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def join_field(items: Column, field: str, where: tuple[str, str] | None = None) -> Column:
    """Comma-joined ``field`` of an array of structs, optionally of items with a given value."""
    if where:
        items = F.filter(items, lambda item: item[where[0]] == where[1])
    values = F.transform(items, lambda item: F.coalesce(item[field].cast("string"), F.lit("")))
    return F.coalesce(F.array_join(values, ","), F.lit(""))


def entries_to_map_json(items: Column, key: str, value: str) -> Column:
    """``{key: value}`` as JSON text; the last item with a key wins."""
    def is_last(item: Column, i: Column) -> Column:
        later = F.slice(items, i + 2, F.size(items))
        return ~F.exists(later, lambda other: other[key] == item[key])

    kept = F.filter(items, is_last)
    return F.to_json(F.map_from_entries(F.transform(
        kept, lambda item: F.struct(item[key].cast("string"), item[value]))))


def pivot_interactions(items: Column, kinds: Sequence[str] = ("follows", "fans", "interaction"),
                       kind: str = "type", count: str = "count") -> dict[str, Column]:
    """One column per interaction kind, 0 where the array lacks it; a repeated kind: last one."""
    def pick(name: str) -> Column:
        hits = F.filter(items, lambda item: item[kind] == name)
        return F.coalesce(F.try_element_at(hits, F.lit(-1))[count].cast("bigint"), F.lit(0).cast("bigint"))

    return {name: pick(name) for name in kinds}


def last_of(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def second_of(values: Column) -> Column:
    """The second value, '' when there are fewer than two."""
    return F.when(F.size(values) > 1, values[1]).otherwise("")


def first_nonempty_list(*lists: Column) -> Column:
    """The first list that is neither null nor empty; an empty array if all are."""
    return F.coalesce(*[F.when(F.size(values) > 0, values) for values in lists],
                      F.array().cast("array<string>"))


def find_tag_text(tags: Column, kind: str) -> Column:
    """``text`` of the first tag of a type, '' if there is none."""
    hits = F.filter(tags, lambda tag: tag["type"] == kind)
    return F.coalesce(F.try_element_at(hits, F.lit(1))["text"], F.lit(""))


def author_resolve(author: Column, users: Column, field: str) -> Column:
    """Field of the user an author key names in the ``users`` map."""
    return F.try_element_at(users, author)[field]


def author_or_member(author: Column, field: str) -> Column:
    """Field of an author struct whose data may sit one level down, in ``member``."""
    has_id = F.coalesce(author["id"], F.lit("")) != ""
    return F.when(has_id, author[field]).otherwise(author["member"][field])


def schema_from_paths(paths: Sequence[str]) -> T.StructType:
    """Struct type with text leaves for dotted paths such as ``user.id``."""
    tree: dict = {}
    for path in paths:
        node = tree
        for part in path.split("."):
            node = node.setdefault(part, {})

    def build(node: Mapping) -> T.StructType:
        return T.StructType([T.StructField(name, build(child) if child else T.StringType())
                             for name, child in node.items()])

    return build(tree)


def flatten_payload(df: DataFrame, payload: str, fields: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """JSON payload to flat text columns; ``fields`` maps a name to (dotted path, default).

    The payload is parsed once, whatever the number of fields.
    """
    schema = schema_from_paths([path for path, _ in fields.values()])
    parsed = df.withColumn("_parsed", F.from_json(payload, schema))
    columns = [F.coalesce(F.col(f"_parsed.{path}"), F.lit(default)).alias(name) if default is not None
               else F.col(f"_parsed.{path}").alias(name) for name, (path, default) in fields.items()]
    return parsed.select(*[c for c in df.columns if c != payload], *columns)


def flatten_cards(cards: Column, wanted: int = 9) -> Column:
    """Whole cards of the wanted type, each followed by such cards of its group.

    ``cards`` is an array of structs with ``card_type``, an array ``card_group`` of structs, and whatever else a card holds;
    the elements of a group have the same fields but ``card_group``.
    """
    def own_and_group(card: Column) -> Column:
        group = F.coalesce(F.filter(card["card_group"], lambda inner: inner["card_type"] == wanted), F.slice(card["card_group"], 1, 0))
        own = F.filter(F.array(card.dropFields("card_group")), lambda c: c["card_type"] == wanted)
        return F.when(card["card_group"].isNull(), own).otherwise(F.concat(own, group))

    return F.flatten(F.transform(cards, own_and_group))


def flatten_replies(df: DataFrame, replies: str) -> DataFrame:
    """Append embedded replies, an array of structs of the same shape, to their parents' rows."""
    parents = df.drop(replies)
    embedded = df.select(F.inline(replies))
    return parents.unionByName(embedded, allowMissingColumns=True)


def split_keywords(df: DataFrame, column: str, keep_empty: bool = False) -> DataFrame:
    """One row per keyword of a comma list; the empty one after a final comma is dropped."""
    out = df.withColumn("keyword", F.explode(F.split(column, ",")))
    return out if keep_empty else out.filter(F.trim("keyword") != "")


def directed_contacts(df: DataFrame, creator: str, contact: str, relation: str) -> DataFrame:
    """Contact rows as (up_id, fan_id): a fan follows the creator, a creator follows a following."""
    is_fan = F.col(relation) == "fan"
    return df.filter(F.col(relation).isin("fan", "following")).select(
        F.when(is_fan, F.col(creator)).otherwise(F.col(contact)).alias("up_id"),
        F.when(is_fan, F.col(contact)).otherwise(F.col(creator)).alias("fan_id"))
