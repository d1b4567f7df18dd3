"""Arrays, maps, JSON payloads and the platform mappings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested
from ..session import stage_path
from ..sources import json_records, platforms
from .base import Registry, with_comments
from .text import q

registry = Registry()
add = registry.add

_TAGS = ("array(named_struct('type', 'topic', 'name', lang), named_struct('type', 'source', 'name', source), "
         "named_struct('type', 'topic', 'name', concat('d', doc_id % 7)))")


@add("join_list", "SELECT doc_id, lang || ',' || source || ',d' || CAST(doc_id % 7 AS VARCHAR) AS all_names, "
     "lang || ',d' || CAST(doc_id % 7 AS VARCHAR) AS topics FROM documents")
def _(t):
    tags = F.expr(_TAGS)
    return t.documents.select("doc_id", nested.join_field(tags, "name").alias("all_names"),
                              nested.join_field(tags, "name", ("type", "topic")).alias("topics"))


@add("entries_to_map_json", """SELECT doc_id, '{"source":"' || source || '","topic":"d' || CAST(doc_id % 7 AS VARCHAR)
 || '"}' AS tags FROM documents""")
def _(t):
    return t.documents.select("doc_id", nested.entries_to_map_json(F.expr(_TAGS), "type", "name").alias("tags"))


@add("pivot_interactions", """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 0 ELSE user_id END AS follows,
 event_id AS fans, 0 AS interaction FROM events""")
def _(t):
    items = F.expr("filter(array(named_struct('type', 'fans', 'count', event_id), named_struct('type', "
                   "CASE WHEN event_id % 4 = 0 THEN 'other' ELSE 'follows' END, 'count', user_id)), x -> true)")
    return t.events.select("event_id", *[c.alias(n) for n, c in nested.pivot_interactions(items).items()])


@add("pick_nth", r"""SELECT doc_id, w[-1] AS last_word, CASE WHEN len(w) > 1 THEN w[2] ELSE '' END AS second_word,
 CAST(len(w) AS BIGINT) AS n FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents) AS s""")
def _(t):
    words = F.split("text", " ")
    chosen = nested.first_nonempty_list(F.array().cast("array<string>"), F.lit(None).cast("array<string>"), words)
    return t.documents.select("doc_id", nested.last_of(words).alias("last_word"),
                              nested.second_of(words).alias("second_word"), F.size(chosen).cast("bigint").alias("n"))


@add("nested_flatten", """SELECT event_id, CAST(user_id AS VARCHAR) AS author_id, event_type AS kind,
 CASE WHEN event_id % 3 = 0 THEN '0' ELSE CAST(event_id % 10 AS VARCHAR) END AS likes, 'none' AS missing
 FROM events""")
def _(t):
    payload = F.to_json(F.struct(
        F.struct(F.struct(F.col("user_id").alias("mid")).alias("owner"), F.struct(
            F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 10).alias("like")).alias("stat")).alias("View"),
        F.col("event_type").alias("kind")))
    df = t.events.select("event_id", payload.alias("payload"))
    return nested.flatten_payload(df, "payload", {
        "author_id": ("View.owner.mid", None), "kind": ("kind", None), "likes": ("View.stat.like", "0"),
        "missing": ("View.rights.pay", "none")})


@add("flatten_cards", """SELECT conv_id, turn, card, CASE WHEN card = 'g3' THEN md5(text) WHEN card = 'g1' THEN role
 ELSE md5(role) END AS body FROM (SELECT conv_id, turn, text, role, unnest(CASE WHEN turn % 2 = 0 THEN ['t' || CAST(turn AS VARCHAR)]
 ELSE [] END || CASE WHEN length(text) > 100 THEN ['g1', 'g3'] ELSE ['g1'] END) AS card FROM conversations) AS c""")
def _(t):
    cards = F.expr("""array(
      named_struct('card_type', CASE WHEN turn % 2 = 0 THEN 9 ELSE 11 END, 'id', concat('t', turn), 'mblog', md5(role), 'card_group',
        array(named_struct('card_type', 9, 'id', 'g1', 'mblog', role), named_struct('card_type', 4, 'id', 'g2', 'mblog', role))),
      named_struct('card_type', 4, 'id', 'x', 'mblog', md5(role), 'card_group', array(named_struct('card_type',
        CASE WHEN length(text) > 100 THEN 9 ELSE 1 END, 'id', 'g3', 'mblog', md5(text)))))""")
    return t.conversations.select("conv_id", "turn", F.explode(nested.flatten_cards(cards)).alias("c")).select(
        "conv_id", "turn", F.col("c.id").alias("card"), F.col("c.mblog").alias("body"))


@add("flatten_sub_comments", """SELECT conv_id, turn, md5(text) AS text_md5 FROM conversations
 UNION ALL SELECT conv_id, turn + 1000, role FROM conversations WHERE turn % 2 = 1""")
def _(t):
    replies = F.when(F.col("turn") % 2 == 1, F.array(F.struct(
        F.col("conv_id"), (F.col("turn") + 1000).alias("turn"), F.col("role").alias("text_md5"))))
    df = t.conversations.select("conv_id", "turn", F.md5("text").alias("text_md5"), replies.alias("sub_comments"))
    return nested.flatten_replies(df, "sub_comments")


@add("find_tag_text", """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '' ELSE md5(url) END AS place FROM pages""")
def _(t):
    tags = F.expr("array(named_struct('type', 'hot', 'text', 'x'), named_struct('type', "
                  "CASE WHEN page_id % 3 = 0 THEN 'other' ELSE 'ip_info' END, 'text', md5(url)))")
    return t.pages.select("page_id", nested.find_tag_text(tags, "ip_info").alias("place"))


@add("author_resolve", """SELECT comment_id, name, CASE WHEN comment_id % 2 = 0 THEN name ELSE 'member ' || name END
 AS shown FROM (SELECT event_id AS comment_id, 'user_' || CAST(user_id AS VARCHAR) AS name FROM events) AS s""")
def _(t):
    df = t.events.withColumn("name", F.concat(F.lit("user_"), F.col("user_id").cast("string")))
    users = F.create_map(F.lit("k0"), F.struct(F.lit("nobody").alias("name")),
                         F.col("name"), F.struct(F.col("name").alias("name")))
    author = F.struct(
        F.when(F.col("event_id") % 2 == 0, F.col("name")).alias("id"),
        F.when(F.col("event_id") % 2 == 0, F.col("name")).alias("name"),
        F.struct(F.col("name").alias("id"), F.concat(F.lit("member "), "name").alias("name")).alias("member"))
    return df.select(F.col("event_id").alias("comment_id"),
                     nested.author_resolve(F.col("name"), users, "name").alias("name"),
                     nested.author_or_member(author, "name").alias("shown"))


@add("split_keywords", """SELECT doc_id, unnest([lang, source, 'AI']) AS keyword FROM documents""")
def _(t):
    df = t.documents.select("doc_id", F.concat_ws(",", "lang", "source", F.lit("AI"), F.lit("")).alias("keywords"))
    return nested.split_keywords(df, "keywords").select("doc_id", "keyword")


@add("directed_contacts", """SELECT CASE WHEN l_linenumber % 2 = 0 THEN o_custkey ELSE l_suppkey END AS up_id,
 CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey ELSE o_custkey END AS fan_id
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def _(t):
    rows = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).withColumn(
        "relation", F.when(F.col("l_linenumber") % 2 == 0, "fan").otherwise("following"))
    return nested.directed_contacts(rows, "o_custkey", "l_suppkey", "relation")


# --- payloads --------------------------------------------------------------------------------

_RECORD = "id bigint, kind string"


def _payloads(t):
    """One payload per event in each of the shapes a batch file may have; some are broken."""
    one = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind")))
    shape = F.col("event_id") % 7
    many = F.concat(F.lit("["), one, F.lit(","), one, F.lit("]"))
    payload = (F.when(shape == 0, many).when(shape == 1, F.concat(F.lit('{"data":'), many, F.lit("}")))
               .when(shape == 2, F.concat(F.lit('{"data":1,"comments":'), many, F.lit("}")))
               .when(shape == 3, F.concat(F.lit('{"comments":'), many, F.lit(',"items":[]}')))
               .when(shape == 4, F.concat(F.lit('{"items":'), many, F.lit("}")))
               .when(shape == 5, one).otherwise(F.concat(many, F.lit(",{"))))
    return t.events.select(payload.alias("payload"))


@add("read_json_records", """SELECT event_id AS id, event_type AS kind FROM events WHERE event_id % 7 IN (0, 1, 3, 4, 5)
 UNION ALL SELECT event_id, event_type FROM events WHERE event_id % 7 IN (0, 1, 3, 4)""")
def _(t):
    return json_records.explode_payloads(_payloads(t), "payload", _RECORD)[0]


@add("json_lost_values", "SELECT event_id AS id FROM events WHERE event_id % 3 = 0")
def _(t):
    # A word where a number belongs is not read as null: the record is set aside.
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("x"), F.col("event_id").cast("string"))).otherwise(F.col("event_id").cast("string"))
    rows = t.events.select("event_id", F.to_json(F.array(F.struct(text.alias("id"), F.col("event_type").alias("kind")))).alias("payload"))
    records, set_aside = json_records.explode_payloads(rows, "payload", _RECORD)
    return set_aside.select(F.col("event_id").alias("id"))


@add("json_arrays_quarantine", """SELECT 'records' AS part, count(*) AS n FROM events WHERE event_id % 2 = 0
 UNION ALL SELECT 'broken files', 1""")
def _(t):
    path = stage_path(t.spark, "json-arrays")
    record = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind")))
    arrays = t.events.filter("event_id % 2 = 0").groupBy(F.floor(F.col("event_id") / 5000).alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]")).alias("value"))  # a file of 2,500 records each
    arrays.write.partitionBy("file").text(path)
    cut = t.spark.createDataFrame([(-1, '[{"id": 3}, {"id": 4}, {"id":')], "file int, value string")
    cut.write.mode("append").partitionBy("file").text(path)
    records, broken = json_records.read_json_arrays(t.spark, path, "id bigint, kind string", glob="*.txt")
    return records.agg(F.lit("records").alias("part"), F.count("*").alias("n")).unionByName(
        broken.agg(F.lit("broken files").alias("part"), F.count("*").alias("n")))


@add("json_arrays_lost_values", """SELECT CASE WHEN event_id % 10 = 3 THEN 'set aside' ELSE 'record' END AS part, event_id AS id,
 CASE WHEN event_id % 10 <> 3 THEN event_type || ' "}]{[' || chr(92) END AS kind FROM events""")
def _(t):
    # One record in ten has a word for a number; it alone is set aside, whatever file it is in and however the file is cut.
    path = stage_path(t.spark, "json-lost")
    number = F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("x"), F.col("event_id").cast("string"))).otherwise(F.col("event_id").cast("string"))
    record = F.to_json(F.struct(number.alias("id"), F.concat("event_type", F.lit(' "}]{['), F.lit(chr(92))).alias("kind"), F.struct(
        F.array(F.lit(1), F.lit(2)).alias("a")).alias("deep")))
    t.events.groupBy((F.col("event_id") % 4).alias("file")).agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(record), " ,"), F.lit("]\n")).alias(
        "value")).write.partitionBy("file").text(path)
    records, set_aside = json_records.read_json_arrays(t.spark, path, "id bigint, kind string", glob="*.txt")
    wrong = F.get_json_object("payload", "$.id")
    return records.select(F.lit("record").alias("part"), "id", "kind").unionByName(set_aside.select(
        F.lit("set aside").alias("part"), F.substring(wrong, 2, 30).cast("bigint").alias("id"), F.lit(None).cast("string").alias("kind")))


@add("json_quarantine", "SELECT count(*) AS broken FROM events WHERE event_id % 7 = 6")
def _(t):
    return json_records.explode_payloads(_payloads(t), "payload", _RECORD)[1].agg(F.count("*").alias("broken"))


def _nest(path_values: dict) -> str:
    """SQL building nested JSON from {dotted path: expression}."""
    tree: dict = {}
    for path, expr in path_values.items():
        *parents, leaf = path.split(".")
        node = tree
        for part in parents:
            node = node.setdefault(part, {})
        node[leaf] = expr

    def build(node: dict) -> str:
        return "named_struct(" + ", ".join(
            f"'{k}', {build(v) if isinstance(v, dict) else v}" for k, v in node.items()) + ")"

    return f"to_json({build(tree)})"


_SECONDS = "timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', create_time)"
_ID = "CAST(comment_id AS STRING)"
_PAYLOADS = {
    "xhs": {"id": _ID, "create_time": f"{_SECONDS} * 1000", "ip_location": "ip_location", "note_id": "note_id",
            "content": "content", "user_info.user_id": "user_id", "user_info.nickname": "nickname",
            "user_info.image": "avatar", "sub_comment_count": "sub_comment_count",
            "pictures": "array(named_struct('url_default', pictures))", "like_count": "like_count",
            "target_comment.id": "parent_comment_id"},
    "douyin": {"cid": _ID, "create_time": _SECONDS, "ip_label": "ip_location", "aweme_id": "note_id",
               "text": "content", "user.uid": "user_id", "user.nickname": "nickname",
               "user.avatar_thumb.url_list": "array(avatar)", "reply_comment_total": "sub_comment_count",
               "reply_id": "parent_comment_id", "digg_count": "like_count", "image_list":
               "array(named_struct('origin_url', named_struct('url_list', array('small', pictures))))"},
    "weibo": {"id": _ID, "created_at": "date_format(create_time, \"'Mon 'MMM dd HH:mm:ss '+0000' yyyy\")",
              "source": "concat('来自', ip_location)", "note_id": "note_id", "text": "content", "user.id": "user_id",
              "user.screen_name": "nickname", "user.profile_image_url": "avatar",
              "total_number": "sub_comment_count", "rootid": "parent_comment_id", "like_count": "like_count"},
    "bilibili": {"rpid": _ID, "ctime": _SECONDS, "video_id": "note_id", "content.message": "content",
                 "member.mid": "user_id", "member.uname": "nickname", "member.avatar": "avatar",
                 "rcount": "sub_comment_count", "parent": "parent_comment_id", "like": "like_count"},
    "kuaishou": {"commentId": _ID, "timestamp": f"{_SECONDS} * 1000", "video_id": "note_id", "content": "content",
                 "authorId": "user_id", "authorName": "nickname", "headurl": "avatar",
                 "subCommentCount": "sub_comment_count"},
    "zhihu": {"id": _ID, "type": "'comment'", "created_time": _SECONDS, "content_id": "note_id",
              "content": "content", "author.member.id": "user_id", "author.member.name": "nickname",
              "author.member.avatar_url": "avatar", "child_comment_count": "sub_comment_count",
              "reply_comment_id": "parent_comment_id", "like_count": "like_count",
              "comment_tag": "array(named_struct('type', 'ip_info', 'text', ip_location))"},
    "tieba": {"data_field": "replace(to_json(named_struct('content', named_struct('post_id', comment_id, "
              "'comment_num', sub_comment_count, 'content', content))), '\"', '&quot;')",
              "tail": "concat('<span class=\"tail-info\">', date_format(create_time, 'yyyy-MM-dd HH:mm'), "
              "'</span><span>IP属地:', coalesce(ip_location, ''), '</span>')", "note_id": "note_id", "user_link": "user_id",
              "user_nickname": "nickname", "user_avatar": "avatar", "parent_comment_id": "parent_comment_id"},
}
_PLATFORMS = list(_PAYLOADS)


def _platform_sql() -> str:
    def case(values: dict[str, str], default: str) -> str:
        return "CASE p " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {default} END"

    names = "CASE comment_id % 7 " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(_PLATFORMS)) + " END"
    # Sites that deliver HTML have their tags removed; a mark-up-free text is otherwise unchanged.
    edge = r"^[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{2028}\x{2029}\x{3000}]+|[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{2028}\x{2029}\x{3000}]+$"
    visible = f"regexp_replace(regexp_replace(content, '<[^>]+>', '', 'g'), {q(edge)}, '', 'g')"
    content = case({"weibo": r"regexp_replace(content, '<[^\n]*?>', '', 'g')", "zhihu": visible,
                    "tieba": visible}, "content")
    # The marker on a forum page ends at the first space.
    marked = "CASE WHEN contains(coalesce(ip_location, ''), ' ') THEN '' ELSE coalesce(ip_location, '') END"
    place = case({"xhs": "ip_location", "bilibili": "NULL", "kuaishou": "NULL", "tieba": marked},
                 "coalesce(ip_location, '')")
    at = case({"tieba": "strftime(create_time, '%Y-%m-%d %H:%M:00')"}, "strftime(create_time, '%Y-%m-%d %H:%M:%S')")
    image = case({"xhs": "pictures", "douyin": "pictures"}, "NULL")
    return f"""SELECT p AS platform, CAST(comment_id AS VARCHAR) AS comment_id, {at} AS created, {place} AS ip_location,
 md5({content}) AS content_md5, CAST(user_id AS VARCHAR) AS user_id, nickname,
 {case({"douyin": "coalesce(avatar, '')", "weibo": "coalesce(avatar, '')"}, "avatar")} AS avatar, sub_comment_count,
 {image} AS pictures, {case({"kuaishou": "NULL"}, "CAST(parent_comment_id AS VARCHAR)")} AS parent_comment_id,
 {case({"kuaishou": "0", "tieba": "0"}, "like_count")} AS like_count
 FROM (SELECT *, {names} AS p FROM comments) AS s"""


@add("union_platforms", with_comments(_platform_sql()))
def _(t):
    payload = "CASE comment_id % 7 " + " ".join(
        f"WHEN {i} THEN {_nest(_PAYLOADS[p])}" for i, p in enumerate(_PLATFORMS)) + " END"
    name = "CASE comment_id % 7 " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(_PLATFORMS)) + " END"
    rows = t.comments.select(F.expr(name).alias("platform"), F.expr(payload).alias("payload"))
    return platforms.union_platforms(rows).select(
        "platform", "comment_id", F.date_format("create_time", "yyyy-MM-dd HH:mm:ss").alias("created"), "ip_location",
        F.md5("content").alias("content_md5"), "user_id", "nickname", "avatar", "sub_comment_count", "pictures",
        "parent_comment_id", "like_count")


@add("union_platforms_quarantine", """SELECT event_id, event_type AS platform FROM events WHERE event_type <> 'click'""")
def _(t):
    name = F.when(F.col("event_type") == "click", F.lit(" XHS ")).otherwise(F.col("event_type"))
    rows = t.events.select("event_id", "event_type", name.alias("platform"))
    return platforms.unknown_platforms(rows).select("event_id", F.col("event_type").alias("platform"))


@add("platform_contents", """SELECT 'bilibili' AS platform, CAST(doc_id AS VARCHAR) AS content_id, 'video' AS kind,
 md5(substr(text, 1, 500)) AS title_md5, CAST(n_chars AS VARCHAR) AS liked_count,
 'https://www.bilibili.com/video/av' || CAST(doc_id AS VARCHAR) AS content_url FROM documents
 UNION ALL SELECT 'xhs', CAST(doc_id AS VARCHAR), lang, md5(substr(text, 1, 255)), CAST(n_chars AS VARCHAR),
 'https://www.xiaohongshu.com/explore/' || CAST(doc_id AS VARCHAR) || '?xsec_token=T&xsec_source=pc_search'
 FROM documents""")
def _(t):
    bili = _nest({"View.aid": "doc_id", "View.title": "text", "View.stat.like": "n_chars"})
    xhs = _nest({"note_id": "doc_id", "type": "lang", "title": "''", "desc": "text",
                 "interact_info.liked_count": "n_chars", "xsec_token": "'T'"})
    frames = [platforms.contents_of(p, t.documents.select(F.expr(e).alias("payload")))
              for p, e in (("bilibili", bili), ("xhs", xhs))]
    return frames[0].unionByName(frames[1]).select(
        "platform", "content_id", "kind", F.md5("title").alias("title_md5"), "liked_count", "content_url")


@add("dispatch_by_type", r"""SELECT CAST(doc_id AS VARCHAR) AS content_id, k AS content_type,
 CASE k WHEN 'zvideo' THEN md5('') ELSE md5(regexp_replace(text, '^[ \n\t\r]+|[ \n\t\r]+$', '', 'g')) END AS text_md5,
 CASE k WHEN 'answer' THEN 'https://www.zhihu.com/question/q' || CAST(doc_id AS VARCHAR) || '/answer/'
   || CAST(doc_id AS VARCHAR) WHEN 'article' THEN 'https://zhuanlan.zhihu.com/p/' || CAST(doc_id AS VARCHAR)
   ELSE 'https://v.example/' || CAST(doc_id AS VARCHAR) END AS content_url,
 CASE k WHEN 'answer' THEN 1000 + doc_id WHEN 'article' THEN 2000 + doc_id ELSE 3000 + doc_id END AS created_time
 FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '<(script|style)[^>]*>.*?</(script|style)>', '', 'gs'),
   '<[^>]+>', '', 'g') AS text, CASE doc_id % 4 WHEN 0 THEN 'answer' WHEN 1 THEN 'article' WHEN 2 THEN 'zvideo'
   ELSE 'ad' END AS k FROM documents) AS s WHERE k <> 'ad'""")
def _(t):
    kind = "CASE doc_id % 4 WHEN 0 THEN 'answer' WHEN 1 THEN 'article' WHEN 2 THEN 'zvideo' ELSE 'ad' END"
    payload = _nest({"id": "doc_id", "type": kind, "content": "text", "question.id": "concat('q', doc_id)",
                     "created_time": "CASE doc_id % 4 WHEN 0 THEN 1000 + doc_id ELSE 0 END",
                     "created": "2000 + doc_id", "created_at": "3000 + doc_id",
                     "video_url": "concat('https://v.example/', doc_id)"})
    return platforms.zhihu_contents(t.documents.select(F.expr(payload).alias("payload"))).select(
        "content_id", "content_type", F.md5("content_text").alias("text_md5"), "content_url", "created_time")


@add("platform_creators", """SELECT 'xhs' AS platform, c_custkey AS user_id, c_name AS nickname,
 CASE c_custkey % 3 WHEN 0 THEN '男' WHEN 1 THEN '女' END AS gender, c_custkey * 2 AS follows, c_custkey AS fans,
 0 AS interaction FROM customer UNION ALL SELECT 'douyin', c_custkey, c_name,
 CASE c_custkey % 3 WHEN 1 THEN '男' WHEN 2 THEN '女' ELSE '未知' END, 0, c_custkey * 3, 0 FROM customer""")
def _(t):
    xhs = _nest({"basicInfo.nickname": "c_name", "basicInfo.gender": "c_custkey % 3", "interactions":
                 "array(named_struct('type', 'fans', 'count', CAST(c_custkey AS STRING)), "
                 "named_struct('type', 'follows', 'count', CAST(c_custkey * 2 AS STRING)))",
                 "tags": "array(named_struct('tagType', 'a', 'name', c_mktsegment))"})
    douyin = _nest({"user.nickname": "c_name", "user.gender": "c_custkey % 3", "user.max_follower_count":
                    "c_custkey * 3"})
    frames = [platforms.creators(p, t.customer.select(F.col("c_custkey").alias("user_id"),
                                                      F.expr(e).alias("payload")))
              for p, e in (("xhs", xhs), ("douyin", douyin))]
    return frames[0].unionByName(frames[1]).select(
        "platform", "user_id", "nickname", "gender", "follows", "fans", "interaction")
