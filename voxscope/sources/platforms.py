"""Payloads of seven platforms mapped to the canonical comment, content and creator tables.

FIXED VALUES: the paths below are the field names of the platforms' payloads.
A field is (dotted path, default); the default stands in for a missing value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import links, numbers, text, times
from ..functions.nested import flatten_payload

COMMENT_FIELDS = {
    "xhs": {
        "comment_id": ("id", None), "create_time": ("create_time", None), "ip_location": ("ip_location", None),
        "note_id": ("note_id", None), "content": ("content", None), "user_id": ("user_info.user_id", None),
        "nickname": ("user_info.nickname", None), "avatar": ("user_info.image", None),
        "sub_comment_count": ("sub_comment_count", "0"), "pictures": ("pictures", None),
        "parent_comment_id": ("target_comment.id", "0"), "like_count": ("like_count", "0"),
    },
    "douyin": {
        "comment_id": ("cid", None), "create_time": ("create_time", None), "ip_location": ("ip_label", ""),
        "note_id": ("aweme_id", None), "content": ("text", None), "user_id": ("user.uid", None),
        "nickname": ("user.nickname", None), "avatar": ("user.avatar_thumb.url_list", None),
        "sub_comment_count": ("reply_comment_total", "0"), "pictures": ("image_list", None),
        "parent_comment_id": ("reply_id", "0"), "like_count": ("digg_count", "0"),
    },
    "weibo": {
        "comment_id": ("id", None), "create_time": ("created_at", None), "ip_location": ("source", ""),
        "note_id": ("note_id", None), "content": ("text", None), "user_id": ("user.id", None),
        "nickname": ("user.screen_name", ""), "avatar": ("user.profile_image_url", ""),
        "sub_comment_count": ("total_number", "0"), "parent_comment_id": ("rootid", ""),
        "like_count": ("like_count", "0"),
    },
    "bilibili": {
        "comment_id": ("rpid", None), "create_time": ("ctime", None), "note_id": ("video_id", None),
        "content": ("content.message", None), "user_id": ("member.mid", None),
        "nickname": ("member.uname", None), "avatar": ("member.avatar", None),
        "sub_comment_count": ("rcount", "0"), "parent_comment_id": ("parent", "0"), "like_count": ("like", "0"),
    },
    "kuaishou": {
        "comment_id": ("commentId", None), "create_time": ("timestamp", None), "note_id": ("video_id", None),
        "content": ("content", None), "user_id": ("authorId", None), "nickname": ("authorName", None),
        "avatar": ("headurl", None), "sub_comment_count": ("subCommentCount", "0"),
    },
    "zhihu": {
        "comment_id": ("id", ""), "create_time": ("created_time", None), "ip_location": ("comment_tag", None),
        "note_id": ("content_id", None), "content": ("content", None), "user_id": ("author.id", None),
        "nickname": ("author.name", None), "avatar": ("author.avatar_url", None),
        "member_id": ("author.member.id", None), "member_name": ("author.member.name", None),
        "member_avatar": ("author.member.avatar_url", None), "type": ("type", None),
        "sub_comment_count": ("child_comment_count", "0"), "parent_comment_id": ("reply_comment_id", "0"),
        "like_count": ("like_count", "0"),
    },
    "tieba": {
        "data_field": ("data_field", None), "tail": ("tail", ""), "note_id": ("note_id", None),
        "user_id": ("user_link", None), "nickname": ("user_nickname", None), "avatar": ("user_avatar", None),
        "parent_comment_id": ("parent_comment_id", "0"),
    },
}

CANONICAL_COMMENT = ["platform", "comment_id", "create_time", "ip_location", "note_id", "content", "user_id",
                     "nickname", "avatar", "sub_comment_count", "pictures", "parent_comment_id", "like_count"]

CONTENT_FIELDS = {
    "xhs": {
        "content_id": ("note_id", None), "kind": ("type", None), "title": ("title", ""), "description": ("desc", ""),
        "create_time": ("time", None), "user_id": ("user.user_id", None), "nickname": ("user.nickname", None),
        "avatar": ("user.avatar", None), "liked_count": ("interact_info.liked_count", None),
        "comment_count": ("interact_info.comment_count", None), "share_count": ("interact_info.share_count", None),
        "ip_location": ("ip_location", ""), "token": ("xsec_token", None),
    },
    "douyin": {
        "content_id": ("aweme_id", None), "kind": ("aweme_type", None), "title": ("desc", ""),
        "description": ("desc", ""), "create_time": ("create_time", None), "user_id": ("author.uid", None),
        "nickname": ("author.nickname", None), "avatar": ("author.avatar_thumb.url_list", None),
        "liked_count": ("statistics.digg_count", None), "comment_count": ("statistics.comment_count", None),
        "share_count": ("statistics.share_count", None), "ip_location": ("ip_label", ""),
    },
    "bilibili": {
        "content_id": ("View.aid", None), "title": ("View.title", ""), "description": ("View.desc", ""),
        "create_time": ("View.pubdate", None), "user_id": ("View.owner.mid", None),
        "nickname": ("View.owner.name", None), "avatar": ("View.owner.face", ""),
        "liked_count": ("View.stat.like", ""), "comment_count": ("View.stat.reply", ""),
        "share_count": ("View.stat.share", ""),
    },
    "kuaishou": {
        "content_id": ("photo.id", None), "kind": ("type", None), "title": ("photo.caption", ""),
        "description": ("photo.caption", ""), "create_time": ("photo.timestamp", None),
        "user_id": ("author.id", None), "nickname": ("author.name", None), "avatar": ("author.headerUrl", ""),
        "liked_count": ("photo.realLikeCount", None), "share_count": ("photo.viewCount", None),
    },
    "weibo": {
        "content_id": ("mblog.id", None), "title": ("mblog.text", ""), "description": ("mblog.text", ""),
        "create_time": ("mblog.created_at", None), "user_id": ("mblog.user.id", None),
        "nickname": ("mblog.user.screen_name", ""), "avatar": ("mblog.user.profile_image_url", ""),
        "liked_count": ("mblog.attitudes_count", "0"), "comment_count": ("mblog.comments_count", "0"),
        "share_count": ("mblog.reposts_count", "0"), "ip_location": ("mblog.region_name", ""),
    },
    "tieba": {
        "content_id": ("note_id", None), "title": ("title", ""), "description": ("desc", ""),
        "create_time": ("publish_time", None), "user_id": ("user_link", None), "nickname": ("user_nickname", None),
        "avatar": ("user_avatar", ""), "comment_count": ("total_replay_num", "0"), "ip_location": ("ip_location", ""),
    },
}

CANONICAL_CONTENT = ["platform", "content_id", "kind", "title", "description", "create_time", "user_id", "nickname",
                     "avatar", "liked_count", "comment_count", "share_count", "ip_location", "content_url"]

TITLE_LIMIT = {"xhs": 255, "bilibili": 500, "kuaishou": 500}


def _time(platform: str, value: Column) -> Column:
    """Creation time as UTC wall time."""
    if platform == "weibo":
        return times.epoch_autounit(times.rfc2822_to_epoch(value))
    if platform == "tieba":
        return F.to_timestamp_ntz(F.nullif(value, F.lit("")), F.lit("yyyy-MM-dd HH:mm"))
    return times.epoch_autounit(value.try_cast("bigint"))


def _leaf(payload: Column, path: str, kind: str = "string") -> Column:
    """A value of a parsed payload; null if it is missing or does not fit."""
    return F.try_variant_get(payload, f"$.{path}", kind)


def _merged(payload: Column, platform: Column, fields: dict[str, dict], name: str) -> Column:
    """A field of every platform at its own place: one CASE, null where a platform has no such field."""
    places: dict[tuple, list[str]] = {}
    for owner, own in fields.items():
        if name in own:
            places.setdefault(own[name], []).append(owner)
    out = F
    for (path, default), owners in places.items():
        value = _leaf(payload, path)
        out = out.when(platform.isin(*owners), value if default is None else F.coalesce(value, F.lit(default)))
    return out if places else F.lit(None).cast("string")


def _raw(payload: Column, platform: Column, fields: dict[str, dict]) -> dict[str, Column]:
    return {name: _merged(payload, platform, fields, name) for name in dict.fromkeys(n for own in fields.values() for n in own)}


def _flat(rows: DataFrame, fields: dict[str, dict]) -> DataFrame:
    """(platform, v, one text column per field): each payload is parsed once."""
    parsed = rows.select("platform", F.try_parse_json("payload").alias("v"))
    return parsed.select("platform", "v", *[x.alias(n) for n, x in _raw(F.col("v"), F.col("platform"), fields).items()])


def _kept(flat: DataFrame, keep: Column, columns: dict[str, Column], order: list[str]) -> DataFrame:
    """The columns of the rows to keep.  A filter would be pushed below the parsing and repeat it; a list is not."""
    row = F.struct(*[columns.get(name, F.col(name)).alias(name) for name in order])
    return flat.select(F.inline_outer(F.when(keep, F.array(row)))).where("platform IS NOT NULL")


def _times(platform: Column, value: Column) -> Column:
    """Creation time of each platform as UTC wall time."""
    return F.when(platform == "weibo", _time("weibo", value)).when(platform == "tieba", _time("tieba", value)).otherwise(_time("", value))


def _comments(rows: DataFrame) -> DataFrame:
    """Canonical comments of (platform, payload) rows, in one pass over them."""
    c, p, v = F.col, F.col("platform"), F.col("v")
    flat = _flat(rows, COMMENT_FIELDS)
    # What a forum page keeps in an escaped attribute and in the tail of a post.
    body = F.when(p == "tieba", F.try_parse_json(H.unescape_json(c("data_field"))))
    flat = flat.withColumns({"body": body, **{f"tail_{k}": F.when(p == "tieba", x) for k, x in H.html_fields(c("tail"), H.FORUM_FIELDS).items()}})
    xhs = F.transform(_leaf(v, "pictures", "array<struct<url_default:string>>"), lambda x: F.coalesce(x["url_default"], F.lit("")))
    images = _leaf(v, "image_list", "array<struct<origin_url:struct<url_list:array<string>>>>")
    douyin = F.transform(F.filter(images, lambda i: F.size(i["origin_url"]["url_list"]) > 1), lambda i: i["origin_url"]["url_list"][1])
    urls = F.when(p == "xhs", xhs).when(p == "douyin", douyin)
    tags = F.filter(_leaf(v, "comment_tag", "array<struct<type:string,text:string>>"), lambda t: t["type"] == "ip_info")
    own = F.coalesce(c("user_id"), F.lit("")) != ""
    member = (p == "zhihu") & ~own
    words = F.when(p == "tieba", _leaf(c("body"), "content.content")).otherwise(c("content"))
    key = F.when(p == "tieba", _leaf(c("body"), "content.post_id")).otherwise(c("comment_id"))
    keep = F.when(p == "zhihu", c("type") == "comment").when(p == "tieba", key.isNotNull()).otherwise(True)
    return _kept(flat, keep, {
        "comment_id": key,
        "create_time": _times(p, F.when(p == "tieba", c("tail_publish_time")).otherwise(c("create_time"))),
        "ip_location": F.when(p == "weibo", text.strip_labels(c("ip_location"), ["来自"])).when(
            p == "zhihu", F.coalesce(F.try_element_at(tags, F.lit(1))["text"], F.lit(""))).when(
            p == "tieba", c("tail_ip_location")).otherwise(c("ip_location")),
        "content": F.when(p == "weibo", text.strip_html_tags(words)).when(
            p.isin("zhihu", "tieba"), text.extract_text_from_html(words)).otherwise(words),
        "user_id": F.when(member, c("member_id")).otherwise(c("user_id")),
        "nickname": F.when(member, c("member_name")).otherwise(c("nickname")),
        "avatar": F.when(p == "douyin", F.coalesce(F.get(_leaf(v, "user.avatar_thumb.url_list", "array<string>"), F.lit(0)), F.lit(""))).when(
            member, c("member_avatar")).otherwise(c("avatar")),
        "sub_comment_count": text.extract_first_int(F.when(p == "tieba", _leaf(c("body"), "content.comment_num")).otherwise(c("sub_comment_count"))),
        "pictures": F.when(p.isin("xhs", "douyin"), F.coalesce(F.array_join(urls, ","), F.lit(""))),
        "like_count": F.when(p.isin("kuaishou", "tieba"), F.lit(0).cast("bigint")).otherwise(text.extract_first_int(c("like_count"))),
    }, CANONICAL_COMMENT)


def comments_of(platform: str, df: DataFrame, payload: str = "payload") -> DataFrame:
    """Canonical comments of one platform's comment payloads (JSON text)."""
    return _comments(df.select(F.lit(platform).alias("platform"), F.col(payload).alias("payload")))


def _contents(rows: DataFrame) -> DataFrame:
    """Canonical posts of (platform, payload) rows, in one pass over them."""
    c, p = F.col, F.col("platform")
    flat = _flat(rows, CONTENT_FIELDS)
    title = F.when(p == "xhs", F.coalesce(F.nullif("title", F.lit("")), c("description"))).when(
        p == "weibo", text.strip_html_tags(c("title"))).otherwise(c("title"))
    for limit in set(TITLE_LIMIT.values()):
        title = F.when(p.isin(*[k for k, n in TITLE_LIMIT.items() if n == limit]), text.truncate(title, limit)).otherwise(title)
    return _kept(flat, F.coalesce("content_id", F.lit("")) != "", {
        "kind": F.when(p == "bilibili", "video").otherwise(c("kind")),
        "title": title,
        "description": F.when(p == "weibo", text.strip_html_tags(c("description"))).otherwise(c("description")),
        "create_time": _times(p, c("create_time")),
        "avatar": F.when(p == "douyin", F.coalesce(F.get(_leaf(c("v"), "author.avatar_thumb.url_list", "array<string>"), F.lit(0)), F.lit(""))).otherwise(c("avatar")),
        "ip_location": F.when(p == "weibo", text.strip_labels(c("ip_location"), ["发布于 "])).otherwise(c("ip_location")),
        "content_url": links.build_link(p, c("content_id"), c("token")),
    }, CANONICAL_CONTENT)


def contents_of(platform: str, df: DataFrame, payload: str = "payload") -> DataFrame:
    """Canonical posts of one platform's content payloads (JSON text)."""
    return _contents(df.select(F.lit(platform).alias("platform"), F.col(payload).alias("payload")))


def union_contents(payloads: DataFrame, platform: str = "platform", payload: str = "payload") -> DataFrame:
    """Canonical posts of a table of (platform, payload) rows; names are read without case and outer blanks."""
    named = payloads.select(_platform_name(platform).alias("platform"), F.col(payload).alias("payload"))
    return _contents(named.filter(F.col("platform").isin(*CONTENT_FIELDS)))


ZHIHU_TYPES = ("answer", "article", "zvideo")


def zhihu_contents(df: DataFrame, payload: str = "payload", kind: str | None = None, author: str | None = None) -> DataFrame:
    """Answers, articles and videos, which keep their fields in different places; others are skipped.

    ``kind`` says what all payloads are, whatever their type field holds.  ``author`` names a column with the author's JSON,
    for payloads that only name the author.
    """
    fields = {name: (name, None) for name in (
        "id", "type", "title", "content", "description", "excerpt", "created_time", "created", "created_at",
        "published_at", "updated_time", "updated", "updated_at", "voteup_count", "comment_count", "video_url",
        "video")}
    fields.update({"question_id": ("question.id", None), "user_id": ("author.id", None),
                   "nickname": ("author.name", None)})
    flat = flatten_payload(df.select(payload, *[author] if author else []), payload, fields)
    if kind:
        flat = flat.withColumn("type", F.lit(kind))
    if author:
        flat = flat.withColumns({"user_id": F.coalesce("user_id", F.get_json_object(author, "$.id")),
                                 "nickname": F.coalesce("nickname", F.get_json_object(author, "$.name"))})
    flat = flat.filter(F.col("type").isin(*ZHIHU_TYPES))
    c, kind = F.col, F.col("type")
    own_page = c("video").startswith("{")
    base = F.lit("https://www.zhihu.com")
    url = (F.when(kind == "answer", F.concat(base, F.lit("/question/"), c("question_id"), F.lit("/answer/"), c("id")))
           .when(kind == "article", F.concat(F.lit("https://zhuanlan.zhihu.com/p/"), c("id")))
           .when(own_page, F.concat(base, F.lit("/zvideo/"), c("id"))).otherwise(c("video_url")))
    brief = (F.when(kind == "answer", text.first_nonempty(c("description"), c("excerpt")))
             .when(kind == "article", c("excerpt")).otherwise(c("description")))
    created = (F.when(kind == "answer", c("created_time"))
               .when(kind == "article", F.coalesce(F.nullif("created_time", F.lit("0")), "created", F.lit("0")))
               .when(own_page, c("published_at")).otherwise(c("created_at")))
    updated = (F.when(kind == "answer", c("updated_time"))
               .when(kind == "article", F.coalesce(F.nullif("updated_time", F.lit("0")), "updated", F.lit("0")))
               .when(own_page, c("updated_at")))
    return flat.select(
        c("id").alias("content_id"), kind.alias("content_type"),
        F.when(kind != "zvideo", text.extract_text_from_html(c("content"))).otherwise("").alias("content_text"),
        F.when(kind == "answer", c("question_id")).alias("question_id"), url.alias("content_url"),
        text.extract_text_from_html(c("title")).alias("title"),
        text.extract_text_from_html(brief).alias("description"),
        created.try_cast("bigint").alias("created_time"), updated.try_cast("bigint").alias("updated_time"),
        text.extract_first_int(c("voteup_count")).alias("voteup_count"),
        text.extract_first_int(c("comment_count")).alias("comment_count"), "user_id", "nickname")


def creators(platform: str, df: DataFrame, payload: str = "payload") -> DataFrame:
    """Canonical creators: id, name, gender label, description, place, follows, fans, interaction."""
    flat = flatten_payload(df, payload, CREATOR_FIELDS[platform])
    out = flat.withColumn("gender", numbers.gender_label(F.lit(platform), F.col("gender")))
    if platform == "weibo":
        out = out.withColumn("ip_location", text.strip_labels(F.col("ip_location"), ["来自"]))
    if platform == "xhs":
        kinds = F.from_json("interactions", "array<struct<type:string,count:string>>")
        from ..functions.nested import entries_to_map_json, pivot_interactions
        out = out.withColumns(pivot_interactions(kinds)).withColumn("tag_list", entries_to_map_json(
            F.from_json("tags", "array<struct<tagType:string,name:string>>"), "tagType", "name"))
        out = out.drop("interactions", "tags")
    return _canonical(out.withColumn("platform", F.lit(platform)).withColumns({
        k: text.extract_first_int(F.col(k).cast("string")) for k in ("follows", "fans", "interaction")
        if k in out.columns}), CANONICAL_CREATOR)


CREATOR_FIELDS = {
    "xhs": {"nickname": ("basicInfo.nickname", None), "gender": ("basicInfo.gender", None),
            "avatar": ("basicInfo.images", None), "description": ("basicInfo.desc", None),
            "ip_location": ("basicInfo.ipLocation", None), "interactions": ("interactions", None),
            "tags": ("tags", None)},
    "douyin": {"nickname": ("user.nickname", None), "gender": ("user.gender", None),
               "avatar": ("user.avatar_300x300.uri", None), "description": ("user.signature", None),
               "ip_location": ("user.ip_location", None), "follows": ("user.following_count", "0"),
               "fans": ("user.max_follower_count", "0"), "interaction": ("user.total_favorited", "0")},
    "weibo": {"nickname": ("screen_name", None), "gender": ("gender", None), "avatar": ("avatar_hd", None),
              "description": ("description", None), "ip_location": ("source", ""),
              "follows": ("follow_count", ""), "fans": ("followers_count", "")},
    "kuaishou": {"nickname": ("profile.user_name", None), "gender": ("profile.gender", None),
                 "avatar": ("profile.headurl", None), "description": ("profile.user_text", None),
                 "follows": ("ownerCount.follow", None), "fans": ("ownerCount.fan", None),
                 "interaction": ("ownerCount.photo_public", None)},
}

CANONICAL_CREATOR = ["platform", "user_id", "nickname", "gender", "avatar", "description", "ip_location",
                     "follows", "fans", "interaction", "tag_list"]


def _canonical(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(name) if name in df.columns else F.lit(None).cast("string").alias(name)
                       for name in columns])


def union_platforms(payloads: DataFrame, platform: str = "platform", payload: str = "payload") -> DataFrame:
    """Canonical comments of a table of (platform, payload) rows; names are read without case and outer blanks.

    The table is read once.  Rows of other platforms are not in the result: see :func:`unknown_platforms`.
    """
    named = payloads.select(_platform_name(platform).alias("platform"), F.col(payload).alias("payload"))
    return _comments(named.filter(F.col("platform").isin(*COMMENT_FIELDS)))


def unknown_platforms(payloads: DataFrame, platform: str = "platform") -> DataFrame:
    """The rows that :func:`union_platforms` has no mapping for, null platforms among them."""
    return payloads.filter(~F.coalesce(_platform_name(platform).isin(*COMMENT_FIELDS), F.lit(False)))


def _platform_name(platform: str):
    return F.lower(F.trim(F.col(platform)))
