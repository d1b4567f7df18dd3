"""Elements of a page with everything inside them, by a scan over its tags that keeps the depth.

A page is cut at the open and close tags of one name.  One pass over the tags counts the depth and remembers the wanted elements
that are open, so an element ends where its own close tag stands, not where the next element begins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STATE = "struct<depth:int,open:array<struct<first:int,depth:int>>,done:array<struct<first:int,last:int>>>"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def class_is(name: str) -> str:
    """Pattern of an open tag whose class attribute is ``name``, but for blanks at its end."""
    return rf"""\sclass\s*=\s*["']{name}\s*["']"""


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of an open tag; '' if it has none."""
    pattern = rf"""(?i)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    return F.concat(F.regexp_extract(tag, pattern, 1), F.regexp_extract(tag, pattern, 2))


def tag_pattern(name: str) -> str:
    """Open and close tags of a name; a ``>`` inside quotes does not end them."""
    return rf"""(?i)</?{name}(?=[\s/>])(?:[^'">]++|"[^"]*+"|'[^']*+')*+>"""


def elements(html: Column, name: str, marker: str = "") -> Column:
    """The elements of a name whose open tag matches ``marker``: an array of (tag, inner), in the order of their open tags.

    Elements inside others count as well.  One that is never closed reaches to the end; a close tag too many is ignored; a tag
    that closes itself is an element without content.  Null has none.
    """
    pattern = F.lit(tag_pattern(name))
    parts = F.struct(F.regexp_extract_all(html, pattern, F.lit(0)).alias("tags"), F.split(html, pattern, -1).alias("texts"))

    def step(state: Column, tag: Column) -> Column:
        top = F.try_element_at(state["open"], F.lit(-1))
        ends = F.coalesce(top["depth"] == state["depth"], F.lit(False))
        depth = state["depth"]
        wanted = tag["tag"].rlike(marker) if marker else F.lit(True)
        opened = F.struct(
            (depth + 1).alias("depth"),
            F.when(wanted, F.concat(state["open"], F.array(F.struct(tag["i"].alias("first"), (depth + 1).alias("depth"))))).otherwise(
                state["open"]).alias("open"), state["done"].alias("done"))
        closed = F.struct(
            F.greatest(depth - 1, F.lit(0)).alias("depth"),
            F.when(ends, F.slice(state["open"], 1, F.greatest(F.size(state["open"]) - 1, F.lit(0)))).otherwise(state["open"]).alias("open"),
            F.when(ends, F.concat(state["done"], F.array(F.struct(top["first"].alias("first"), tag["i"].alias("last"))))).otherwise(
                state["done"]).alias("done"))
        alone = F.struct(depth.alias("depth"), state["open"].alias("open"), F.when(wanted, F.concat(state["done"], F.array(
            F.struct(tag["i"].alias("first"), tag["i"].alias("last"))))).otherwise(state["done"]).alias("done"))
        return F.when(tag["tag"].startswith("</"), closed.cast(_STATE)).when(tag["tag"].endswith("/>"), alone.cast(_STATE)).otherwise(opened.cast(_STATE))

    def spans(page: Column) -> Column:
        numbered = F.transform(page["tags"], lambda t, i: F.struct(t.alias("tag"), i.alias("i")))
        start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<struct<first:int,depth:int>>").alias("open"),
                         F.array().cast("array<struct<first:int,last:int>>").alias("done"))
        end = F.aggregate(numbered, start, step)
        return let(end, lambda s: F.sort_array(F.concat(s["done"], F.transform(s["open"], lambda o: F.struct(
            o["first"].alias("first"), F.size(page["tags"]).alias("last"))))))

    def inner(page: Column, span: Column) -> Column:
        # texts[k] stands before tags[k].
        texts = F.slice(page["texts"], span["first"] + 2, F.greatest(span["last"] - span["first"], F.lit(0)))
        tags = F.slice(page["tags"], span["first"] + 2, F.greatest(span["last"] - span["first"] - 1, F.lit(0)))
        return F.array_join(F.transform(texts, lambda x, i: F.concat(x, F.coalesce(F.get(tags, i), F.lit("")))), "")

    found = let(parts, lambda page: F.transform(spans(page), lambda s: F.struct(
        F.get(page["tags"], s["first"]).alias("tag"), inner(page, s).alias("inner"))))
    return F.when(html.isNotNull(), found)


def first_element(html: Column, name: str, marker: str = "") -> Column:
    """(tag, inner) of the first such element; null if there is none."""
    return F.get(elements(html, name, marker), F.lit(0))


def own_text(inner: Column) -> Column:
    """What stands before the first tag, trimmed; '' for nothing."""
    return F.coalesce(F.trim(F.regexp_extract(inner, r"(?s)^([^<]*)", 1)), F.lit(""))
