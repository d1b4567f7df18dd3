"""Whole pages and script data: every page is built from a row of the given tables, read back, and compared with that row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.html import html_unescape
from ..sources import page_records, platforms
from .base import Registry
from .nested import _nest

registry = Registry()
add = registry.add

# Texts without tags and without blanks at their ends.
_VISIBLE = r"""regexp_replace(regexp_replace(regexp_replace(text, '<(script|style)[^>]*>.*?</(script|style)>', '', 'gs'), '<[^>]+>', '', 'g'),
 '^[ \n\t\r]+|[ \n\t\r]+$', '', 'g')"""


def _page(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def _escaped(json: Column) -> Column:
    for char, entity in (("&", "&amp;"), ('"', "&quot;"), ("<", "&lt;"), (">", "&gt;"), ("'", "&#39;")):
        json = F.replace(json, F.lit(char), F.lit(entity))
    return json


def _comment(key: Column, words: Column, inside: Column) -> Column:
    data = F.to_json(F.struct(F.struct(key.alias("post_id"), F.col("n_chars").alias("comment_num"), F.lit(7).alias("forum_id"), words.alias("content")).alias("content")))
    return _page('<div class="l_post l_post_bright j_l_post clearfix  " data-field="', _escaped(data), '"><div class="d_author"><div>',
                 '<a class="p_author_face " href="/home/main?un=', F.col("doc_id"), '"><img class="" src="https://img.example/', F.col("doc_id"),
                 '"></a></div><a class="p_author_name j_user_card" href="#"> user_', F.col("doc_id"), " </a></div>", inside,
                 '<div class="post-tail-wrap"><span>IP属地:', F.col("source"), '</span> <span class="tail-info">', F.col("doc_id"),
                 '楼</span><span class="tail-info">2024-08-06 10:11</span></div></div>')


def _reply(key: Column, words: Column) -> Column:
    data = F.to_json(F.struct(key.alias("spid"), F.col("source").alias("showname")))
    plain = _escaped(F.regexp_replace(words, "[<>&]", ""))
    return _page("<li class=\"lzl_single_post j_lzl_s_p \" data-field='", _escaped(data), "'><a class=\"j_user_card lzl_p_p\" href=\"/u/", key,
                 '"><img src="https://img.example/r"/></a><div class="lzl_cnt"><span class="lzl_content_main"><span>', plain,
                 '</span><i>!</i></span><div class="lzl_content_reply"><span class="lzl_time">2024-8-6 22:11</span></div></div><ul><li>inner</li></ul></li>')


def _threads(t):
    """A thread page per document: two comments, replies inside the first, an advertisement between them."""
    two = F.col("doc_id") * 10
    replies = _page("<div><div><ul>", _reply(two + 3, F.col("text")), _reply(two + 4, F.col("lang")), "</ul></div></div>")
    html = _page('<html><a class="card_title_fname" href="#">', F.col("lang"), "</a><div>", _comment(two + 1, F.col("text"), replies),
                 '<div class="l_post l_post_bright j_l_post clearfix  " data-field="{}"><div>ad</div></div>', _comment(two + 2, F.col("lang"), F.lit("")), "</div></html>")
    return t.spread_documents.select("doc_id", html.alias("html"))


@add("forum_comments", f"""SELECT doc_id, p AS position, CAST(doc_id * 10 + CASE p WHEN 0 THEN 1 ELSE 2 END AS VARCHAR) AS comment_id,
 n_chars AS sub_comment_count, md5(CASE p WHEN 0 THEN {_VISIBLE} ELSE lang END) AS content_md5,
 'https://tieba.baidu.com/home/main?un=' || doc_id AS user_link, 'user_' || doc_id AS user_nickname, source AS ip_location,
 '2024-08-06 10:11' AS publish_time, lang AS tieba_name FROM documents, (VALUES (0), (2)) AS v(p)""")
def _(t):
    return page_records.forum_comments(_threads(t)).select(
        "doc_id", "position", "comment_id", "sub_comment_count", F.md5("content").alias("content_md5"), "user_link", "user_nickname",
        "ip_location", "publish_time", "tieba_name")


@add("forum_replies", r"""SELECT doc_id, p AS position, CAST(doc_id * 10 + 3 + p AS VARCHAR) AS comment_id, source AS user_nickname,
 '/u/' || (doc_id * 10 + 3 + p) AS user_link, '2024-8-6 22:11' AS publish_time, md5(ltrim(CASE p WHEN 0 THEN regexp_replace(text, '[<>&]', '', 'g')
 ELSE lang END, E' \n\t\r') || '!') AS content_md5 FROM documents, (VALUES (0), (1)) AS v(p)""")
def _(t):
    content = html_unescape(F.col("content"))
    return page_records.forum_replies(_threads(t)).select("doc_id", "position", "comment_id", "user_nickname", "user_link", "publish_time",
                                                          F.md5(content).alias("content_md5"))


@add("creator_threads", """SELECT c_custkey, CAST(p AS INT) AS position, CAST(c_custkey * 10 + p AS VARCHAR) AS note_id
 FROM customer, (SELECT unnest(range(0, 3)) AS p)""")
def _(t):
    key = F.col("c_custkey") * 10
    items = [_page('<li><div class="x"><div class="thread_name"><a href="/p/', key + p, '?pid=1">t</a><a href="/p/0">u</a></div></div></li>') for p in range(3)]
    html = _page('<div class="thread_name"><a href="/p/1">no</a></div><ul class="new_list clearfix">', *items, '</ul><div class="thread_name"><a href="/p/2">no</a></div>')
    return page_records.creator_threads(t.customer.select("c_custkey", html.alias("html")))


@add("forum_creators", """SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS user_name, c_name AS nickname, 'https://img.example/' || c_custkey AS avatar,
 CASE WHEN c_custkey % 2 = 0 THEN '男' ELSE '女' END AS gender, c_custkey * 2 AS follows, c_custkey * 3 AS fans, '1.9年' AS registration_duration FROM customer""")
def _(t):
    key = F.col("c_custkey")
    html = _page('<div class="userinfo_left_head"><div><a><img src="https://img.example/', key, '"></a></div></div><p class="space"><a href="/home/main?un=',
                 F.url_encode("c_name"), "&id=", key, '&fr=x">x</a></p><span class="userinfo_username "> ', F.col("c_name"), ' </span><span class="userinfo_sex ',
                 F.when(key % 2 == 0, "sex_male").otherwise("sex_female"), '"></span><div class="userinfo_userdata"><span>吧龄:1.9年</span> </div><span class="concern_num">(<a href="x">',
                 key * 2, '</a>)</span><span class="concern_num">(<a href="y">', key * 3, "</a>)</span>")
    return page_records.forum_creator(t.customer.select(html.alias("html"))).drop("ip_location")


def _script(state: str) -> Column:
    return _page('<html><script id="js-initialData" type="text/json">', F.replace(F.expr(state), F.lit("</"), F.lit(r"<\/")), "</script></html>")


@add("initial_data_creators", """SELECT c_name AS token, CAST(c_custkey AS VARCHAR) AS user_id, c_name AS user_nickname,
 CASE c_custkey % 3 WHEN 1 THEN '男' WHEN 0 THEN '女' ELSE '未知' END AS gender, c_custkey * 2 AS fans, c_custkey AS answer_count,
 'https://www.zhihu.com/people/' || c_name AS user_link FROM customer WHERE c_custkey % 4 <> 0""")
def _(t):
    user = "named_struct('id', c_custkey, 'name', c_name, 'gender', c_custkey % 3, 'followerCount', c_custkey * 2, 'answerCount', c_custkey)"
    state = f"to_json(named_struct('initialState', named_struct('entities', named_struct('users', map(IF(c_custkey % 4 = 0, 'other', c_name), {user})))))"
    return page_records.zhihu_creators(t.customer.select(F.col("c_name").alias("token"), _script(state).alias("html")), "token").select(
        "token", "user_id", "user_nickname", "gender", "fans", "answer_count", "user_link")


@add("initial_data_contents", f"""SELECT CAST(doc_id AS VARCHAR) AS content_id, 'answer' AS content_type, md5({_VISIBLE}) AS text_md5,
 'https://www.zhihu.com/question/q' || doc_id || '/answer/' || doc_id AS content_url, n_chars AS voteup_count, lang AS user_id FROM documents
 UNION ALL SELECT CAST(doc_id AS VARCHAR), 'zvideo', md5(''), 'https://v.example/' || doc_id, n_chars, source FROM documents""")
def _(t):
    # The page's first answer counts, though its key is not the smallest; a video only names its author.
    answer = "named_struct('id', doc_id, 'content', text, 'question', named_struct('id', concat('q', doc_id)), 'author', named_struct('id', lang), 'voteup_count', n_chars)"
    video = "named_struct('id', doc_id, 'author', 'tok', 'video_url', concat('https://v.example/', doc_id), 'voteup_count', n_chars)"
    state = (f"to_json(named_struct('initialState', named_struct('entities', named_struct('answers', named_struct('z', {answer}, 'a', named_struct('id', 0)), "
             f"'zvideos', named_struct('1', {video}), 'users', named_struct('tok', named_struct('id', source))))))")
    pages = t.spread_documents.select(_script(state).alias("html"))
    found = [page_records.zhihu_page_contents(pages, kind) for kind in ("answer", "zvideo")]
    return found[0].unionByName(found[1]).select("content_id", "content_type", F.md5("content_text").alias("text_md5"), "content_url", "voteup_count", "user_id")


@add("render_data_contents", r"""SELECT CAST(doc_id AS VARCHAR) AS content_id, md5(regexp_replace(text, '<[^\n]*?>', '', 'g')) AS title_md5, lang AS nickname,
 CAST(n_chars AS VARCHAR) AS liked_count, source AS ip_location FROM documents""")
def _(t):
    status = "to_json(named_struct('id', doc_id, 'text', text, 'attitudes_count', n_chars, 'region_name', concat('发布于 ', source), 'user', named_struct('screen_name', lang)))"
    html = _page("<script>var $render_data = [{\"status\":", F.expr(status), "}][0] || {};</script>")
    return page_records.weibo_page_contents(t.spread_documents.select(html.alias("html"))).select(
        "content_id", F.md5("title").alias("title_md5"), "nickname", "liked_count", "ip_location")


@add("bilibili_creators", """SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS nickname, c_mktsegment AS sign, c_custkey * 2 AS total_fans, c_custkey * 3 AS total_liked,
 c_custkey % 7 AS user_rank, CAST(-1 AS BIGINT) AS is_official FROM customer""")
def _(t):
    payload = _nest({"Card.card.mid": "CAST(c_custkey AS STRING)", "Card.card.name": "c_name", "Card.card.sign": "c_mktsegment", "Card.card.fans": "c_custkey * 2",
                     "Card.like_num": "c_custkey * 3", "Card.card.level_info.current_level": "c_custkey % 7", "Card.card.official_verify.type": "-1"})
    return page_records.bilibili_creators(t.customer.select(F.expr(payload).alias("payload"))).select(
        "user_id", "nickname", "sign", "total_fans", "total_liked", "user_rank", "is_official")


@add("bilibili_dynamics", """SELECT user_id, CAST(event_id AS VARCHAR) AS dynamic_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS text,
 upper(event_type) AS type, event_id * 2 AS pub_ts, event_id AS total_comments, event_id + 1 AS total_forwards, event_id + 2 AS total_liked FROM events""")
def _(t):
    one = ("named_struct('id_str', CAST(event_id AS STRING), 'type', concat('DYNAMIC_TYPE_', upper(event_type)), 'modules', named_struct('module_dynamic', "
           "named_struct('desc', IF(event_id % 3 = 0, NULL, named_struct('text', event_type))), 'module_author', named_struct('pub_ts', event_id * 2), "
           "'module_stat', named_struct('comment', named_struct('count', event_id), 'forward', named_struct('count', event_id + 1), 'like', named_struct('count', event_id + 2))))")
    # A payload holds the dynamics of a user within a few hours.
    payloads = t.events.groupBy("user_id", F.date_trunc("day", "ts").alias("day")).agg(F.to_json(F.collect_list(F.expr(one))).alias("payload"))
    return page_records.bilibili_dynamics(payloads.drop("day"))


_KINDS = {"tieba": {"note_id": "doc_id", "title": "text", "desc": "lang", "publish_time": "'2024-08-06 10:11'", "user_nickname": "source", "total_replay_num": "n_chars"},
          "weibo": {"mblog.id": "doc_id", "mblog.text": "concat('<a>', text, '</a>')", "mblog.user.screen_name": "source", "mblog.comments_count": "n_chars",
                    "mblog.created_at": "'Tue Aug 06 10:11:00 +0000 2024'"},
          "kuaishou": {"photo.id": "doc_id", "photo.caption": "text", "photo.timestamp": "1722939060000", "author.name": "source"},
          "douyin": {"aweme_id": "doc_id", "desc": "text", "create_time": "1722939060", "author.nickname": "source", "statistics.comment_count": "n_chars"},
          "bilibili": {"View.aid": "doc_id", "View.title": "text", "View.pubdate": "1722939060", "View.owner.name": "source", "View.stat.reply": "n_chars"}}


@add("union_contents", r"""SELECT p AS platform, CAST(doc_id AS VARCHAR) AS content_id, md5(CASE p WHEN 'kuaishou' THEN substr(text, 1, 500) WHEN 'bilibili' THEN substr(text, 1, 500)
 WHEN 'weibo' THEN regexp_replace(text, '<[^\n]*?>', '', 'g') ELSE text END) AS title_md5, '2024-08-06 10:11:00' AS created, source AS nickname,
 CASE p WHEN 'kuaishou' THEN NULL ELSE CAST(n_chars AS VARCHAR) END AS comment_count, CASE p WHEN 'tieba' THEN 'https://tieba.baidu.com/p/' WHEN 'weibo' THEN
 'https://m.weibo.cn/detail/' WHEN 'kuaishou' THEN 'https://www.kuaishou.com/short-video/' WHEN 'douyin' THEN 'https://www.douyin.com/video/' ELSE
 'https://www.bilibili.com/video/av' END || doc_id AS content_url FROM documents, (VALUES ('tieba'), ('weibo'), ('kuaishou'), ('douyin'), ('bilibili')) AS v(p)""")
def _(t):
    listed = F.array(*[F.struct(F.lit(p).alias("platform"), F.expr(_nest(fields)).alias("payload")) for p, fields in _KINDS.items()])
    rows = t.spread_documents.select(F.inline(listed))
    return platforms.union_contents(rows).select("platform", "content_id", F.md5("title").alias("title_md5"),
                                                 F.date_format("create_time", "yyyy-MM-dd HH:mm:ss").alias("created"), "nickname", "comment_count", "content_url")
