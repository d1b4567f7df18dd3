"""Fields, records and embedded JSON taken from HTML with regular expressions.

Pages are matched by the markers that sites keep stable (a class, an attribute, a script
variable), which needs no document tree and stays a column expression.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as fv
from .text import extract_text_from_html

# Markers of the page layouts the extractors know.  FIXED VALUES.
PAGE_FIELDS = {
    "title": r"<title>([^<]*)</title>",
    "page_lang": r'<html lang="([^"]*)"',
    "headline": r"<h1>([^<]*)</h1>",
}
FORUM_FIELDS = {
    "ip_location": r"IP属地:([^\s]+)</span>",
    "publish_time": r'<span class="tail-info">([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2})</span>',
    "registration_duration": r"<span>吧龄:([^\s]+)</span>",
}
FOLLOW_COUNT = r'<span class="concern_num">\(<a[^>]*>([0-9]+)</a>\)</span>'
SEARCH_POST_FIELDS = {
    "note_id": r'data-tid="([^"]*)"',
    "title": r'<span class="p_title">\s*<a[^>]*>(.*?)</a>',
    "content": r'<div class="p_content">(.*?)</div>',
    "href": r'<span class="p_title">\s*<a[^>]*href="([^"]*)"',
    "forum": r'<a class="p_forum"[^>]*>\s*<font[^>]*>(.*?)</font>',
    "author": r'<a href="/home/main[^"]*"[^>]*>\s*<font[^>]*>(.*?)</font>',
    "publish_time": r'<font class="p_green p_date">(.*?)</font>',
}
ANCHOR = r'<a href="([^"]*)">([^<]*)</a>'
MALE_MARK, FEMALE_MARK = "sex_male", "sex_female"

STATE_PATTERNS = {
    "initial_state": r"(?s)window\.__INITIAL_STATE__=(\{.*?\})</script>",
    "initial_data": r'(?s)<script id="js-initialData"[^>]*>(.*?)</script>',
    "render_data": r"(?s)var \$render_data = (\[.*?\])\[0\]",
}


def html_fields(html: Column, fields: Mapping[str, str] = PAGE_FIELDS) -> dict[str, Column]:
    """One column per field: the first match, trimmed; '' when the page lacks it."""
    return {name: F.trim(F.regexp_extract(html, pattern, 1)) for name, pattern in fields.items()}


def forum_profile(html: Column) -> dict[str, Column]:
    """Place, time, membership age, gender and follow counts of a forum page."""
    counts = F.regexp_extract_all(html, F.lit(FOLLOW_COUNT), F.lit(1))
    both = F.size(counts) == 2
    columns = html_fields(html, FORUM_FIELDS)
    columns["gender"] = (F.when(F.contains(html, F.lit(MALE_MARK)), "男")
                         .when(F.contains(html, F.lit(FEMALE_MARK)), "女").otherwise("未知"))
    columns["follows"] = F.when(both, F.try_element_at(counts, F.lit(1)).cast("bigint")).otherwise(0)
    columns["fans"] = F.when(both, F.try_element_at(counts, F.lit(2)).cast("bigint")).otherwise(0)
    return columns


def html_links(df: DataFrame, html: str = "html", pattern: str = ANCHOR) -> DataFrame:
    """One row per link of a page: position, ``href`` and link text."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))
    texts = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(2))
    return (df.select("*", F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("text")))
                      .alias("position", "link"))
            .select(*[c for c in df.columns if c != html], "position",
                    F.col("link.href").alias("href"), F.col("link.text").alias("link_text")))


def html_blocks(df: DataFrame, block_start: str, fields: Mapping[str, str],
                html: str = "html") -> DataFrame:
    """One row per repeated block of a list page, each with its fields as plain text."""
    blocks = F.slice(F.split(F.col(html), block_start), F.lit(2), F.lit(2**31 - 1))
    exploded = df.select(*[c for c in df.columns if c != html],
                         F.posexplode(blocks).alias("position", "_block"))
    picked = {name: extract_text_from_html(F.regexp_extract("_block", f"(?s){pattern}", 1))
              for name, pattern in fields.items()}
    return exploded.withColumns(picked).drop("_block")


def search_posts(df: DataFrame, html: str = "html") -> DataFrame:
    """Posts of a forum search result page."""
    return html_blocks(df, '<div class="s_post">', SEARCH_POST_FIELDS, html)


def embedded_state(html: Column, kind: str = "initial_state", undefined: str = '""') -> Column:
    """JSON text a page carries in a script; JavaScript ``undefined`` is replaced.

    Null when the page has no such script or an empty one.
    """
    raw = F.regexp_extract(html, STATE_PATTERNS[kind], 1)
    if kind == "initial_state":
        raw = F.replace(raw, F.lit("undefined"), F.lit(undefined))
    return F.when(~F.trim(raw).isin("", "{}", "[]"), F.trim(raw))


def html_unescape(text: Column) -> Column:
    """Resolve the five entities that attributes use; the ampersand last."""
    for entity, char in fv.HTML_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def unescape_json(attribute: Column) -> Column:
    """JSON text of an escaped attribute; ``{}`` when it is missing or broken."""
    text = html_unescape(F.trim(attribute))
    return F.when(F.json_object_keys(text).isNotNull(), text).otherwise("{}")
