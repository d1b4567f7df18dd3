"""URL scalars: parameters, entity ids, kinds, links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv


def _last_wins(entries: Column) -> Column:
    """Array of key/value structs to a map; of several entries with one key the last counts.

    Written out, so that the session's ``mapKeyDedupPolicy`` has no say.
    """
    def is_last(entry: Column, i: Column) -> Column:
        later = F.slice(entries, i + 2, F.size(entries))
        return ~F.exists(later, lambda other: other["key"] == entry["key"])

    return F.map_from_entries(F.filter(entries, is_last))


def kv_string_to_map(text: Column, separator: str = ";") -> Column:
    """``a=1; b=2`` to a map; pairs without exactly one ``=`` are skipped."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), separator),
                        lambda p: F.split(F.trim(p), "="))
    pairs = F.filter(parts, lambda p: F.size(p) == 2)
    return _last_wins(F.transform(pairs, lambda p: F.struct(p[0].alias("key"), p[1].alias("value"))))


def _decode(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def url_params(url: Column) -> Column:
    """Query parameters as a map; parameters without a value are dropped."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike("=.+"))
    return _last_wins(F.transform(pairs, lambda p: F.struct(
        _decode(F.regexp_extract(p, "^([^=]*)=", 1)).alias("key"),
        _decode(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("value"))))


def url_param(url: Column, name: str, default: str = "") -> Column:
    return F.coalesce(F.try_element_at(url_params(url), F.lit(name)), F.lit(default))


def paging_offset(next_url: Column) -> Column:
    """The ``offset`` parameter of a next-page URL, '' if there is none."""
    return url_param(next_url, "offset")


def _found(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def last_path_segment(url: Column) -> Column:
    return F.element_at(F.split(F.element_at(F.split(url, "/"), -1), r"\?"), 1)


def content_id(platform: Column, url: Column) -> Column:
    """Id of the post or video a link (or a bare id) names; null when it names none.

    A short link that only its server can resolve gives ''.
    """
    bare = ~url.startswith("http") & ~F.contains(url, F.lit("kuaishou.com"))
    short = F.contains(url, F.lit("v.douyin.com")) | (
        url.startswith("http") & (F.length(url) < 50) & ~F.contains(url, F.lit("video")))
    modal = F.nullif(url_param(url, "modal_id"), F.lit(""))
    return (
        F.when(platform == "xhs", last_path_segment(url))
        .when(platform == "bilibili", F.when(url.startswith("BV"), url)
              .otherwise(_found(url, "/video/(BV[a-zA-Z0-9]+)")))
        .when(platform == "douyin", F.when(url.rlike("^[0-9]+$"), url).when(short, "")
              .otherwise(F.coalesce(modal, _found(url, "/video/([0-9]+)"))))
        .when(platform == "kuaishou", F.when(bare, url)
              .otherwise(_found(url, "/short-video/([a-zA-Z0-9_-]+)"))))


def creator_id(platform: Column, url: Column) -> Column:
    """Id of the creator a profile link (or a bare id) names; null when it names none."""
    bare_kuaishou = ~url.startswith("http") & ~F.contains(url, F.lit("kuaishou.com"))
    bare_douyin = url.startswith("MS4wLjABAAAA") | (
        ~url.startswith("http") & ~F.contains(url, F.lit("douyin.com")))
    return (
        F.when(platform == "xhs", F.when(url.rlike("^[0-9a-f]{24}$"), url)
               .otherwise(_found(url, "/user/profile/([^/?]+)")))
        .when(platform == "bilibili", F.when(url.rlike("^[0-9]+$"), url)
              .otherwise(_found(url, r"space\.bilibili\.com/([0-9]+)")))
        .when(platform == "douyin", F.when(bare_douyin, url).otherwise(_found(url, "/user/([^/?]+)")))
        .when(platform == "kuaishou", F.when(bare_kuaishou, url)
              .otherwise(_found(url, "/profile/([a-zA-Z0-9_-]+)"))))


def url_kind(url: Column) -> Column:
    """answer, article or zvideo, '' for any other link."""
    return (F.when(F.contains(url, F.lit("/answer/")), "answer")
            .when(F.contains(url, F.lit("/p/")), "article")
            .when(F.contains(url, F.lit("/zvideo/")), "zvideo").otherwise(""))


def media_id(url: Column) -> Column:
    """Last path part of a media link, with its ``spectrum/`` prefix where the link has one."""
    name = F.element_at(F.split(url, "/"), -1)
    return F.when(F.contains(url, F.lit("spectrum")), F.concat(F.lit("spectrum/"), name)).otherwise(name)


def mirror_urls(media: Column, hosts: Sequence[str] = fv.IMAGE_MIRRORS, image_format: str = "png") -> Column:
    """One link per mirror host."""
    return F.transform(F.array(*[F.lit(h) for h in hosts]), lambda host: F.concat(
        host, F.lit("/"), media, F.lit(f"?imageView2/format/{image_format}")))


def build_link(platform: Column, key: Column, token: Column | None = None,
               question: Column | None = None) -> Column:
    """Public link of a post."""
    token = F.coalesce(token, F.lit("")) if token is not None else F.lit("")
    answer = F.concat(F.lit("https://www.zhihu.com/question/"), question, F.lit("/answer/"), key) \
        if question is not None else F.lit(None).cast("string")
    return (
        F.when(platform == "xhs", F.concat(F.lit("https://www.xiaohongshu.com/explore/"), key,
                                           F.lit("?xsec_token="), token, F.lit("&xsec_source=pc_search")))
        .when(platform == "douyin", F.concat(F.lit("https://www.douyin.com/video/"), key))
        .when(platform == "kuaishou", F.concat(F.lit("https://www.kuaishou.com/short-video/"), key))
        .when(platform == "bilibili", F.concat(F.lit("https://www.bilibili.com/video/av"), key))
        .when(platform == "weibo", F.concat(F.lit("https://m.weibo.cn/detail/"), key))
        .when(platform == "tieba", F.concat(F.lit("https://tieba.baidu.com/p/"), key))
        .when(platform == "zhihu", F.coalesce(
            answer, F.concat(F.lit("https://zhuanlan.zhihu.com/p/"), key))))


def build_profile_link(platform: Column, key: Column) -> Column:
    """Public link of an author; null for platforms without one."""
    bases = {"xhs": "https://www.xiaohongshu.com/user/profile/", "douyin": "https://www.douyin.com/user/",
             "kuaishou": "https://www.kuaishou.com/profile/", "bilibili": "https://space.bilibili.com/",
             "weibo": "https://weibo.com/u/", "tieba": "https://tieba.baidu.com/home/main?id=",
             "zhihu": "https://www.zhihu.com/people/"}
    out = F.lit(None).cast("string")
    for name, base in bases.items():
        out = F.when(platform == name, F.concat(F.lit(base), key)).otherwise(out)
    return out
