"""Records from whole pages: forum comments, replies, threads, posts and creators; creators and contents in script data.

FIXED VALUES: classes, attributes and field names are those of the sites' pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text
from ..functions.elements import attribute, class_is, elements, first_element, own_text
from . import platforms

FORUM = "https://tieba.baidu.com"
COMMENT_CLASS = "l_post l_post_bright j_l_post clearfix"
REPLY_CLASS = r"lzl_single_post j_lzl_s_p (?:first_no_border)?"


def _blocks(df: DataFrame, found: Column, html: str) -> DataFrame:
    """A row per element: the other columns, ``position`` (from 0), ``tag``, ``inner``."""
    keep = [F.col(c) for c in df.columns if c != html]
    return df.select(*keep, F.posexplode(found).alias("position", "e")).select(*keep, "position", "e.tag", "e.inner")


def _data(tag: Column) -> Column:
    return F.try_parse_json(H.unescape_json(attribute(tag, "data-field")))


def _field(data: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(data, f"$.{path}", kind)


def _text_of(html: Column, name: str, marker: str) -> Column:
    return F.coalesce(own_text(first_element(html, name, marker)["inner"]), F.lit(""))


def _attribute_of(html: Column, name: str, marker: str, wanted: str) -> Column:
    return F.coalesce(F.trim(attribute(first_element(html, name, marker)["tag"], wanted)), F.lit(""))


def _tail(html: Column) -> dict[str, Column]:
    tail = F.coalesce(first_element(html, "div", class_is("post-tail-wrap"))["inner"], F.lit(""))
    return {name: F.trim(F.regexp_extract(tail, H.FORUM_FIELDS[name], 1)) for name in ("ip_location", "publish_time")}


def _author(html: Column) -> dict[str, Column]:
    face = first_element(html, "a", class_is("p_author_face"))
    return {"user_link": F.concat(F.lit(FORUM), F.coalesce(attribute(face["tag"], "href"), F.lit(""))),
            "user_nickname": _text_of(html, "a", class_is("p_author_name j_user_card")),
            "user_avatar": F.coalesce(F.regexp_extract(face["inner"], r"""<img[^>]*?\ssrc\s*=\s*["']([^"']*)["']""", 1), F.lit(""))}


def _forum(html: Column) -> Column:
    return _text_of(html, "a", class_is("card_title_fname"))


def forum_comments(df: DataFrame, html: str = "html") -> DataFrame:
    """The comments of a thread page; other columns travel along.  Blocks without data are skipped."""
    named = df.withColumn("tieba_name", _forum(F.col(html)))
    blocks = _blocks(named, elements(F.col(html), "div", class_is(COMMENT_CLASS)), html).withColumn("data", _data(F.col("tag")))
    d, inner = F.col("data"), F.col("inner")
    out = blocks.select(*[c for c in named.columns if c not in (html, "tieba_name")], "position",
                        _field(d, "content.post_id").alias("comment_id"),
                        text.extract_first_int(_field(d, "content.comment_num")).alias("sub_comment_count"),
                        text.extract_text_from_html(_field(d, "content.content")).alias("content"),
                        *[c.alias(n) for n, c in {**_author(inner), **_tail(inner)}.items()],
                        F.coalesce(_field(d, "content.forum_id"), F.lit("")).alias("tieba_id"), "tieba_name",
                        F.concat(F.lit(f"{FORUM}/f?kw="), "tieba_name").alias("tieba_link"))
    return out.where("comment_id IS NOT NULL")


def forum_replies(df: DataFrame, html: str = "html") -> DataFrame:
    """The replies below a comment; other columns, such as the comment's id, travel along."""
    blocks = _blocks(df, elements(F.col(html), "li", class_is(REPLY_CLASS)), html).withColumn("data", _data(F.col("tag")))
    d, inner = F.col("data"), F.col("inner")
    user = first_element(inner, "a", class_is("j_user_card lzl_p_p"))
    return blocks.select(*[c for c in df.columns if c != html], "position", _field(d, "spid").alias("comment_id"),
                         text.extract_text_from_html(F.coalesce(first_element(inner, "span", class_is("lzl_content_main"))["inner"], F.lit(""))).alias("content"),
                         F.coalesce(attribute(user["tag"], "href"), F.lit("")).alias("user_link"), _field(d, "showname").alias("user_nickname"),
                         F.coalesce(F.regexp_extract(user["inner"], r"""<img[^>]*?\ssrc\s*=\s*["']([^"']*)["']""", 1), F.lit("")).alias("user_avatar"),
                         _text_of(inner, "span", class_is("lzl_time")).alias("publish_time")).where("comment_id IS NOT NULL")


def forum_threads(df: DataFrame, html: str = "html") -> DataFrame:
    """The threads of a forum's list page, which keeps them in comments."""
    page = F.replace(F.col(html), F.lit("<!--"), F.lit(""))
    named = df.withColumns({"tieba_name": _forum(page), "tieba_link": F.concat(F.lit(FORUM), _attribute_of(page, "a", class_is("card_title_fname"), "href"))})
    listed = first_element(page, "ul", r"""\sid\s*=\s*["']thread_list["']""")["inner"]
    blocks = _blocks(named, elements(listed, "li", r"\sdata-field\s*="), html).withColumn("data", _data(F.col("tag")))
    d, inner = F.col("data"), F.col("inner")
    return blocks.select(*[c for c in df.columns if c != html], "position", _field(d, "id").alias("note_id"),
                         _text_of(inner, "a", class_is("j_th_tit")).alias("title"),
                         _text_of(inner, "div", class_is("threadlist_abs threadlist_abs_onlyline")).alias("description"),
                         F.concat(F.lit(f"{FORUM}/p/"), _field(d, "id")).alias("note_url"),
                         F.concat(F.lit(FORUM), _attribute_of(inner, "a", class_is("frs-author-name j_user_card"), "href")).alias("user_link"),
                         text.first_nonempty(_field(d, "authoer_nickname"), _field(d, "author_name")).alias("user_nickname"),
                         F.coalesce(_field(d, "reply_num", "bigint"), F.lit(0).cast("bigint")).alias("reply_count"),
                         "tieba_name", "tieba_link").where("note_id IS NOT NULL")


def forum_post(df: DataFrame, html: str = "html") -> DataFrame:
    """The post of a thread page: its first floor and its counts."""
    page = F.col(html)
    floor = F.coalesce(first_element(page, "div", class_is("p_postlist"))["inner"], F.lit(""))
    only = _attribute_of(page, "[a-z]+", r"""\sid\s*=\s*["']lzonly_cntn["']""", "href")
    counts = F.transform(elements(first_element(page, "li", class_is("l_reply_num"))["inner"], "span", class_is("red")), lambda e: own_text(e["inner"]))
    found = df.withColumns({
        "note_id": F.element_at(F.split(F.split_part(only, F.lit("?"), F.lit(1)), "/"), -1), "tieba_name": _forum(page),
        "_title": F.trim(F.regexp_extract(page, r"(?s)<title>([^<]*)</title>", 1)),
        "description": F.trim(F.regexp_extract(page, r"""(?s)<meta\s+name="description"\s+content="([^"]*)\"""", 1)), **_author(floor), **_tail(page),
        "total_replay_num": F.get(counts, F.lit(0)).try_cast("bigint"), "total_replay_page": F.get(counts, F.lit(1)).try_cast("bigint")})
    return found.select(*[c for c in df.columns if c != html], "note_id", F.replace("_title", F.concat(F.lit("【"), "tieba_name", F.lit("】_百度贴吧")), F.lit("")).alias("title"),
                        "description", F.concat(F.lit(f"{FORUM}/p/"), "note_id").alias("note_url"), "user_link", "user_nickname", "user_avatar",
                        "tieba_name", "ip_location", "publish_time", "total_replay_num", "total_replay_page")


def forum_creator(df: DataFrame, html: str = "html") -> DataFrame:
    """The creator of a profile page."""
    page = F.col(html)
    link = _attribute_of(F.coalesce(first_element(page, "p", class_is("space"))["inner"], F.lit("")), "a", "", "href")
    query = F.str_to_map(F.try_url_decode(F.element_at(F.split(link, r"\?"), -1)), F.lit("&"), F.lit("="))
    head = F.coalesce(first_element(page, "div", class_is("userinfo_left_head"))["inner"], F.lit(""))
    profile = H.forum_profile(page)
    return df.select(*[c for c in df.columns if c != html], F.coalesce(F.try_element_at(query, F.lit("id")), F.lit("")).alias("user_id"),
                     F.coalesce(F.try_element_at(query, F.lit("un")), F.lit("")).alias("user_name"),
                     _text_of(page, "span", class_is("userinfo_username")).alias("nickname"),
                     F.trim(F.regexp_extract(head, r"""<img[^>]*?\ssrc\s*=\s*["']([^"']*)["']""", 1)).alias("avatar"),
                     *[profile[n].alias(n) for n in ("gender", "ip_location", "follows", "fans", "registration_duration")])


def creator_threads(df: DataFrame, html: str = "html") -> DataFrame:
    """(…, position, note_id): the threads that a creator's page lists."""
    listed = first_element(F.col(html), "ul", class_is("new_list clearfix"))["inner"]
    blocks = _blocks(df, elements(listed, "div", class_is("thread_name")), html)
    href = attribute(first_element(F.col("inner"), "a")["tag"], "href")
    return blocks.select(*[c for c in df.columns if c != html], "position",
                         F.element_at(F.split(F.split_part(href, F.lit("?"), F.lit(1)), "/"), -1).alias("note_id")).where("note_id IS NOT NULL")


# --- script data and payloads ----------------------------------------------------------------

ZHIHU_CREATOR = {
    "user_id": "id", "user_nickname": "name", "user_avatar": "avatarUrl", "ip_location": "ipInfo", "follows": "followingCount",
    "fans": "followerCount", "answer_count": "answerCount", "video_count": "zvideoCount", "question_count": "questionCount",
    "article_count": "articlesCount", "column_count": "columnsCount", "get_voteup_count": "voteupCount"}
BILIBILI_CREATOR = {
    "user_id": "Card.card.mid", "nickname": "Card.card.name", "sex": "Card.card.sex", "sign": "Card.card.sign", "avatar": "Card.card.face",
    "total_fans": "Card.card.fans", "total_liked": "Card.like_num", "user_rank": "Card.card.level_info.current_level",
    "is_official": "Card.card.official_verify.type"}
DYNAMIC = {
    "dynamic_id": "id_str", "text": "modules.module_dynamic.desc.text", "type": "type", "pub_ts": "modules.module_author.pub_ts",
    "total_comments": "modules.module_stat.comment.count", "total_forwards": "modules.module_stat.forward.count",
    "total_liked": "modules.module_stat.like.count"}
_COUNTS = ("follows", "fans", "total_fans", "total_liked", "total_comments", "total_forwards", "pub_ts", "user_rank", "is_official")


def _fields(data: Column, places: dict[str, str]) -> dict[str, Column]:
    return {name: _field(data, path, "bigint" if name in _COUNTS or name.endswith("_count") else "string") for name, path in places.items()}


def zhihu_creators(df: DataFrame, token: str, html: str = "html") -> DataFrame:
    """The creator whose token a profile page belongs to; pages without that user give no row."""
    users = F.try_variant_get(F.try_parse_json(H.embedded_state(F.col(html), "initial_data")), "$.initialState.entities.users", "map<string,variant>")
    found = df.withColumn("user", F.try_element_at(users, F.col(token)))
    u = F.col("user")
    gender = _field(u, "gender", "bigint")
    row = {**_fields(u, ZHIHU_CREATOR), "user_link": F.concat(F.lit("https://www.zhihu.com/people/"), F.col(token)),
           "url_token": text.first_nonempty(_field(u, "urlToken"), F.col(token)),
           "gender": F.when(gender == 1, "男").when(gender == 0, "女").otherwise("未知")}
    kept = F.when(F.size(F.try_variant_get(u, "$", "map<string,variant>")) > 0, F.array(F.struct(*[c.alias(n) for n, c in row.items()])))
    return found.select(*[c for c in df.columns if c != html], F.inline_outer(kept)).where("user_link IS NOT NULL")


ZHIHU_ENTITIES = {"answer": "answers", "article": "articles", "zvideo": "zvideos"}


def zhihu_page_contents(df: DataFrame, kind: str, html: str = "html") -> DataFrame:
    """The first answer, article or video of a page, as :func:`platforms.zhihu_contents` gives it."""
    state = df.select(H.embedded_state(F.col(html), "initial_data").alias("state"))
    held = state.select("state", F.get_json_object("state", f"$.initialState.entities.{ZHIHU_ENTITIES[kind]}").alias("held"))
    # The first by the page's order, which a parsed object does not keep.
    first = held.select("state", F.try_element_at(F.from_json("held", "map<string,string>"), F.get(F.json_object_keys("held"), F.lit(0))).alias("payload"))
    users = F.from_json(F.get_json_object("state", "$.initialState.entities.users"), "map<string,string>")
    author = F.try_element_at(users, F.get_json_object("payload", "$.author"))
    return platforms.zhihu_contents(first.where("payload IS NOT NULL").withColumn("author", author), "payload", kind, "author")


def weibo_page_contents(df: DataFrame, html: str = "html") -> DataFrame:
    """The post of a detail page, as :func:`platforms.contents_of` gives it."""
    status = F.get_json_object(H.embedded_state(F.col(html), "render_data"), "$[0].status")
    return platforms.contents_of("weibo", df.select(F.concat(F.lit('{"mblog":'), status, F.lit("}")).alias("payload")))


def bilibili_creators(df: DataFrame, payload: str = "payload") -> DataFrame:
    """The uploader of a video's payload."""
    parsed = df.withColumn("v", F.try_parse_json(payload))
    return parsed.select(*[c for c in df.columns if c != payload], *[c.alias(n) for n, c in _fields(F.col("v"), BILIBILI_CREATOR).items()])


def bilibili_dynamics(df: DataFrame, payload: str = "payload") -> DataFrame:
    """A row per dynamic of a payload that lists them; its creator's columns travel along."""
    items = F.try_variant_get(F.try_parse_json(payload), "$", "array<variant>")
    listed = df.select(*[c for c in df.columns if c != payload], F.explode(items).alias("v"))
    row = _fields(F.col("v"), DYNAMIC)
    row["text"] = F.coalesce(row["text"], F.lit(""))
    row["type"] = F.element_at(F.split(row["type"], "_"), -1)
    return listed.select(*[c for c in df.columns if c != payload], *[c.alias(n) for n, c in row.items()])
