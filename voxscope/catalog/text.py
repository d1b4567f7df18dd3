"""Text, link and HTML queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import html as H
from ..functions import links, text
from .base import Registry, with_comments

registry = Registry()
add = registry.add


def q(literal: str) -> str:
    return "'" + literal.replace("'", "''") + "'"


def _rx(value: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({value}, {q(pattern)}, {q(by)}, 'g')"


_STEPS = {
    "strip_urls": (text.strip_urls, lambda v: _rx(v, fv.URL)),
    "strip_bracket_emoji": (text.strip_bracket_emoji, lambda v: _rx(v, fv.BRACKET_EMOJI)),
    "strip_html_tags": (text.strip_html_tags, lambda v: _rx(v, fv.HTML_TAG)),
    "strip_mentions": (text.strip_mentions, lambda v: _rx(v, fv.MENTION)),
    "collapse_whitespace": (text.collapse_whitespace, lambda v: f"trim({_rx(v, fv.SPACES, ' ')})"),
    "strip_control_chars": (text.strip_control_chars, lambda v: _rx(v, fv.CONTROL_CHARS)),
}


def clean_text_sql(value: str) -> str:
    cleaned = value
    for _, sql in _STEPS.values():
        cleaned = sql(cleaned)
    return f"CASE WHEN {value} IS NULL OR {value} = 'nan' THEN '' ELSE {cleaned} END"


def _digest(key: str, value):
    return [F.col(key), F.md5(value).alias("text_md5"), F.length(value).cast("bigint").alias("text_len")]


def _digest_sql(key: str, expr: str, source: str) -> str:
    return (f"SELECT {key}, md5(v) AS text_md5, CAST(length(v) AS BIGINT) AS text_len "
            f"FROM (SELECT {key}, {expr} AS v FROM {source}) AS d")


def _register_step(name, function, sql):
    add(name, with_comments(_digest_sql("comment_id", sql("content"), "comments")))(
        lambda t: t.comments.select(*_digest("comment_id", function(F.col("content")))))


for _name, (_function, _sql) in _STEPS.items():
    _register_step(_name, _function, _sql)
_register_step("clean_text", text.clean_text, clean_text_sql)

VISIBLE = (rf"regexp_replace(regexp_replace(regexp_replace(html, "
           rf"'<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'gs'), '<[^>]+>', '', 'g'), "
           rf"{q(f'^{fv.SPACES}|{fv.SPACES}$')}, '', 'g')")


@add("extract_text_from_html", _digest_sql("page_id", VISIBLE, "pages"))
def _(t):
    return t.pages.select(*_digest("page_id", text.extract_text_from_html(F.col("html"))))


@add("content_length", "SELECT doc_id, CAST(length(text) AS BIGINT) AS content_length FROM documents")
def _(t):
    return t.documents.select("doc_id", text.content_length(F.col("text")).alias("content_length"))


MENTION_SQL = f"regexp_extract(content, {q(fv.MENTION_TARGET)}, 1)"


@add("mention_target", with_comments(f"SELECT comment_id, {MENTION_SQL} AS target FROM comments"))
def _(t):
    return t.comments.select("comment_id", text.mention_target(F.col("content")).alias("target"))


@add("trim_names", with_comments(
    f"SELECT comment_id, trim(concat(' ', nickname, '  ')) AS src, trim({MENTION_SQL}) AS dst FROM comments"))
def _(t):
    return t.comments.select(
        "comment_id", F.trim(F.concat(F.lit(" "), "nickname", F.lit("  "))).alias("src"),
        F.trim(text.mention_target(F.col("content"))).alias("dst"))


@add("strip_prefix_label", with_comments(
    "SELECT comment_id, replace(replace('发布于 ' || ip_location || '来自' || nickname, '发布于 ', ''), '来自', '')"
    " AS label FROM comments"))
def _(t):
    raw = F.concat(F.lit("发布于 "), "ip_location", F.lit("来自"), "nickname")
    return t.comments.select("comment_id", text.strip_labels(raw, ["发布于 ", "来自"]).alias("label"))


@add("truncate_title", "SELECT doc_id, substr(text, 1, 255) AS title, md5(substr(text, 1, 500)) AS long_title "
                       "FROM documents")
def _(t):
    # The operator itself cuts titles; it reads the whole text.
    return t.documents.select("doc_id", text.truncate(F.col("text"), 255).alias("title"),
                              F.md5(text.truncate(F.col("text"), 500)).alias("long_title"))


@add("first_nonempty", with_comments(
    "SELECT comment_id, coalesce(nullif(pictures, ''), nullif(ip_location, ''), nickname) AS shown FROM comments"))
def _(t):
    return t.comments.select("comment_id", text.first_nonempty(
        F.col("pictures"), F.col("ip_location"), F.col("nickname")).alias("shown"))


@add("content_field_pick", with_comments(
    "SELECT comment_id, md5(coalesce(nullif(CASE WHEN comment_id % 2 = 0 THEN '' ELSE content END, ''), body2))"
    " AS picked FROM (SELECT comment_id, content, concat('text ', nickname) AS body2 FROM comments) AS s"))
def _(t):
    df = t.comments.select(
        "comment_id", F.when(F.col("comment_id") % 2 == 0, "").otherwise(F.col("content")).alias("content"),
        F.concat(F.lit("text "), "nickname").alias("text"))
    return df.select("comment_id", F.md5(text.content_field(df)).alias("picked"))


FIRST_INT = "coalesce(TRY_CAST(nullif(regexp_extract({0}, '([0-9]+)', 1), '') AS BIGINT), 0)"


@add("extract_first_int", "SELECT event_id, " + FIRST_INT.format("props") + " AS k, "
     + FIRST_INT.format("event_type") + " AS none FROM events")
def _(t):
    return t.events.select("event_id", text.extract_first_int(F.col("props")).alias("k"),
                           text.extract_first_int(F.col("event_type")).alias("none"))


@add("to_boolean", """SELECT event_id, CASE WHEN lower(w) IN ('yes','true','t','y','1') THEN true
 WHEN lower(w) IN ('no','false','f','n','0') THEN false END AS flag FROM (SELECT event_id,
 CASE event_type WHEN 'view' THEN 'Yes' WHEN 'click' THEN 'F' WHEN 'error' THEN '0' WHEN 'signup' THEN 'TRUE'
 ELSE event_type END AS w FROM events) AS s""")
def _(t):
    word = (F.when(F.col("event_type") == "view", "Yes").when(F.col("event_type") == "click", "F")
            .when(F.col("event_type") == "error", "0").when(F.col("event_type") == "signup", "TRUE")
            .otherwise(F.col("event_type")))
    return t.events.select("event_id", text.to_boolean(word).alias("flag"))


# --- links -----------------------------------------------------------------------------------

@add("kv_string_to_map", """SELECT event_id, nullif(m['type'], '') AS type, m['user'] AS user_name,
 m['broken'] IS NULL AS skipped FROM (SELECT event_id, map_from_entries(list_transform(list_filter(
  list_transform(string_split(concat('type=old; type=', event_type, '; user=u', CAST(user_id AS STRING),
   '; a=b=c; broken'), ';'), lambda x: string_split(trim(x), '=')), lambda p: len(p) = 2 AND p <> ['type', 'old']),
  lambda p: ROW(p[1], p[2]))) AS m FROM events) AS s""")
def _(t):
    cookie = F.concat(F.lit("type=old; type="), "event_type", F.lit("; user=u"), F.col("user_id").cast("string"),
                      F.lit("; a=b=c; broken"))
    m = links.kv_string_to_map(cookie)
    return t.events.select("event_id", F.nullif(m["type"], F.lit("")).alias("type"), m["user"].alias("user_name"),
                           F.try_element_at(m, F.lit("broken")).isNull().alias("skipped"))


@add("url_params", r"""SELECT page_id, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page,
 regexp_extract(url, '[?&]ref=([^&#]*)', 1) AS ref, regexp_extract(url, '[?&]utm_source=([^&#]*)', 1) AS source,
 CAST(len(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'),
   lambda p: regexp_matches(p, '=.'))) AS BIGINT) AS params FROM pages""")
def _(t):
    m = links.url_params(F.col("url"))
    return t.pages.select("page_id", links.url_param(F.col("url"), "page").alias("page"),
                          links.url_param(F.col("url"), "ref").alias("ref"),
                          links.url_param(F.col("url"), "utm_source").alias("source"),
                          F.size(m).cast("bigint").alias("params"))


@add("paging_offset", r"""SELECT page_id, regexp_extract(concat(regexp_replace(url, '#.*$', ''),
 CASE WHEN contains(url, '?') THEN '&offset=' ELSE '?offset=' END, CAST(page_id * 20 AS STRING)),
 '[?&]offset=([^&#]*)', 1) AS next_offset, '' AS no_offset FROM pages""")
def _(t):
    url = F.regexp_replace("url", "#.*$", "")
    nxt = F.concat(url, F.when(F.contains(url, F.lit("?")), "&offset=").otherwise("?offset="),
                   (F.col("page_id") * 20).cast("string"))
    return t.pages.select("page_id", links.paging_offset(nxt).alias("next_offset"),
                          links.paging_offset(F.col("url")).alias("no_offset"))


_SHAPES = [
    ("xhs", "'https://www.xiaohongshu.com/explore/' || k || '?xsec_token=AB&xsec_source=pc'", "k"),
    ("bilibili", "'https://www.bilibili.com/video/BV1' || k || '/?spm=1'", "'BV1' || k"),
    ("bilibili", "'BV9' || k", "'BV9' || k"),
    ("douyin", "'https://www.douyin.com/user/MS4?modal_id=' || n || '&from=a_rather_long_parameter'", "n"),
    ("douyin", "'https://www.douyin.com/video/' || n", "n"),
    ("douyin", "n", "n"),
    ("douyin", "'https://v.douyin.com/' || k || '/'", "''"),
    ("kuaishou", "'https://www.kuaishou.com/short-video/' || k || '?authorId=3x'", "k"),
    ("kuaishou", "k", "k"),
    ("bilibili", "url", "NULL"),
]
_LINKS = ("WITH keyed AS (SELECT page_id, url, md5(url) AS k, CAST(page_id + 7000000000 AS STRING) AS n, "
          f"page_id % {len(_SHAPES)} AS shape FROM {{pages}}) SELECT page_id, CASE shape "
          + " ".join(f"WHEN {i} THEN '{p}'" for i, (p, _, _) in enumerate(_SHAPES)) + " END AS platform, CASE shape "
          + " ".join(f"WHEN {i} THEN {u}" for i, (_, u, _) in enumerate(_SHAPES)) + " END AS link{answer} FROM keyed")


@add("content_link_ids", _LINKS.format(pages="pages", answer=", CASE shape " + " ".join(
    f"WHEN {i} THEN {a}" for i, (_, _, a) in enumerate(_SHAPES)) + " END AS content_id"))
def _(t):
    df = t.spark.sql(_LINKS.replace("{answer}", ""), pages=t.pages)
    return df.withColumn("content_id", links.content_id(F.col("platform"), F.col("link")))


_PROFILES = [
    ("xhs", "'https://www.xiaohongshu.com/user/profile/' || k || '?xsec_token=AB'", "k"),
    ("xhs", "substr(k, 1, 24)", "substr(k, 1, 24)"),
    ("bilibili", "'https://space.bilibili.com/' || n || '?spm=1'", "n"),
    ("bilibili", "n", "n"),
    ("douyin", "'https://www.douyin.com/user/MS4' || k || '?from=x'", "'MS4' || k"),
    ("douyin", "'MS4wLjABAAAA' || k", "'MS4wLjABAAAA' || k"),
    ("kuaishou", "'https://www.kuaishou.com/profile/' || k", "k"),
    ("kuaishou", "url", "NULL"),
]
_PROFILE_SQL = ("WITH keyed AS (SELECT page_id, url, md5(url) AS k, CAST(page_id + 7000 AS STRING) AS n, "
                f"page_id % {len(_PROFILES)} AS shape FROM {{pages}}) SELECT page_id, CASE shape "
                + " ".join(f"WHEN {i} THEN '{p}'" for i, (p, _, _) in enumerate(_PROFILES))
                + " END AS platform, CASE shape "
                + " ".join(f"WHEN {i} THEN {u}" for i, (_, u, _) in enumerate(_PROFILES))
                + " END AS link{answer} FROM keyed")


@add("creator_link_ids", _PROFILE_SQL.format(pages="pages", answer=", CASE shape " + " ".join(
    f"WHEN {i} THEN {a}" for i, (_, _, a) in enumerate(_PROFILES)) + " END AS creator_id"))
def _(t):
    df = t.spark.sql(_PROFILE_SQL.replace("{answer}", ""), pages=t.pages)
    return df.withColumn("creator_id", links.creator_id(F.col("platform"), F.col("link")))


_KIND_URL = ("concat(url, CASE page_id % 4 WHEN 0 THEN '/answer/1' WHEN 1 THEN '/p/2' WHEN 2 THEN '/zvideo/3' "
             "ELSE '' END)")


@add("url_kind", f"""SELECT page_id, CASE WHEN contains(u, '/answer/') THEN 'answer' WHEN contains(u, '/p/')
 THEN 'article' WHEN contains(u, '/zvideo/') THEN 'zvideo' ELSE '' END AS kind
 FROM (SELECT page_id, {_KIND_URL} AS u FROM pages) AS s""")
def _(t):
    return t.pages.select("page_id", links.url_kind(F.expr(_KIND_URL)).alias("kind"))


_PLATFORM_OF = ("CASE comment_id % 7 WHEN 0 THEN 'xhs' WHEN 1 THEN 'douyin' WHEN 2 THEN 'kuaishou' WHEN 3 THEN "
                "'bilibili' WHEN 4 THEN 'weibo' WHEN 5 THEN 'tieba' ELSE 'zhihu' END")


@add("build_link", with_comments(f"""SELECT comment_id, CASE comment_id % 7
 WHEN 0 THEN concat('https://www.xiaohongshu.com/explore/', n, '?xsec_token=', nickname, '&xsec_source=pc_search')
 WHEN 1 THEN concat('https://www.douyin.com/video/', n) WHEN 2 THEN concat('https://www.kuaishou.com/short-video/', n)
 WHEN 3 THEN concat('https://www.bilibili.com/video/av', n) WHEN 4 THEN concat('https://m.weibo.cn/detail/', n)
 WHEN 5 THEN concat('https://tieba.baidu.com/p/', n) ELSE concat('https://zhuanlan.zhihu.com/p/', n) END AS link
 FROM (SELECT comment_id, nickname, CAST(note_id AS STRING) AS n FROM comments) AS s"""))
def _(t):
    return t.comments.select("comment_id", links.build_link(
        F.expr(_PLATFORM_OF), F.col("note_id").cast("string"), F.col("nickname")).alias("link"))


@add("build_answer_link", with_comments("""SELECT comment_id, concat('https://www.zhihu.com/question/', CAST(note_id AS STRING),
 '/answer/', CAST(comment_id AS STRING)) AS link FROM comments"""))
def _(t):
    return t.comments.select("comment_id", links.build_link(F.lit("zhihu"), F.col("comment_id").cast("string"), question=F.col(
        "note_id").cast("string")).alias("link"))


@add("build_profile_link", with_comments("""SELECT comment_id, CASE comment_id % 3
 WHEN 0 THEN concat('https://www.zhihu.com/people/', u) WHEN 1 THEN concat('https://space.bilibili.com/', u) END AS link
 FROM (SELECT comment_id, CAST(user_id AS STRING) AS u FROM comments) AS s"""))
def _(t):
    platform = F.when(F.col("comment_id") % 3 == 0, "zhihu").when(F.col("comment_id") % 3 == 1, "bilibili").otherwise("elsewhere")
    return t.comments.select("comment_id", links.build_profile_link(platform, F.col("user_id").cast("string")).alias("link"))


_MEDIA = "concat(url, CASE WHEN page_id % 3 = 0 THEN '/spectrum/' ELSE '/' END, md5(url))"


@add("media_id", f"""SELECT page_id, CASE WHEN contains(u, 'spectrum') THEN 'spectrum/' ELSE '' END
 || string_split(u, '/')[-1] AS media_id FROM (SELECT page_id, {_MEDIA} AS u FROM pages) AS s""")
def _(t):
    return t.pages.select("page_id", links.media_id(F.expr(_MEDIA)).alias("media_id"))


@add("mirror_urls", "SELECT page_id, unnest([" + ", ".join(
    f"concat('{h}/', md5(url), '?imageView2/format/png')" for h in fv.IMAGE_MIRRORS) + "]) AS mirror FROM pages")
def _(t):
    return t.pages.select("page_id", F.explode(links.mirror_urls(F.md5("url"))).alias("mirror"))


# --- HTML ------------------------------------------------------------------------------------

@add("html_field_extract", "SELECT page_id, " + ", ".join(
    f"trim(regexp_extract(html, {q(p)}, 1)) AS {n}" for n, p in H.PAGE_FIELDS.items()) + " FROM pages")
def _(t):
    return t.pages.select("page_id", *[c.alias(n) for n, c in H.html_fields(F.col("html")).items()])


# Forum profile markers around each page's own values.
_PROFILE_HTML = ("concat(html, '<span>吧龄:', CAST(page_id % 9 AS STRING), '.5年</span> <span>IP属地:地', "
                 "CAST(page_id AS STRING), '</span> <span class=\"tail-info\">2024-01-0', "
                 "CAST(1 + page_id % 9 AS STRING), ' 10:00</span> <span class=\"concern_num\">(<a href=\"#\">', "
                 "CAST(page_id AS STRING), '</a>)</span>', CASE WHEN page_id % 5 = 0 THEN '' ELSE "
                 "concat('<span class=\"concern_num\">(<a>', CAST(page_id * 2 AS STRING), '</a>)</span>') END, "
                 "CASE page_id % 3 WHEN 0 THEN 'sex_male' WHEN 1 THEN 'sex_female' ELSE '' END)")


@add("forum_profile", """SELECT page_id, concat(CAST(page_id % 9 AS STRING), '.5年') AS registration_duration,
 concat('地', CAST(page_id AS STRING)) AS ip_location,
 concat('2024-01-0', CAST(1 + page_id % 9 AS STRING), ' 10:00') AS publish_time,
 CASE WHEN page_id % 5 = 0 THEN 0 ELSE page_id END AS follows,
 CASE WHEN page_id % 5 = 0 THEN 0 ELSE page_id * 2 END AS fans,
 CASE page_id % 3 WHEN 0 THEN '男' WHEN 1 THEN '女' ELSE '未知' END AS gender FROM pages""")
def _(t):
    page = t.pages.withColumn("html", F.expr(_PROFILE_HTML))
    return page.select("page_id", *[c.alias(n) for n, c in H.forum_profile(F.col("html")).items()])


@add("html_record_extract", f"""SELECT page_id, CAST(position AS BIGINT) AS position, href, link_text FROM (
 SELECT page_id, unnest(generate_series(0, len(h) - 1)) AS position, unnest(h) AS href, unnest(x) AS link_text
 FROM (SELECT page_id, regexp_extract_all(html, {q(H.ANCHOR)}, 1) AS h,
  regexp_extract_all(html, {q(H.ANCHOR)}, 2) AS x FROM pages) AS m WHERE len(h) > 0) AS s""")
def _(t):
    return H.html_links(t.pages.select("page_id", "html")).withColumn("position", F.col("position").cast("bigint"))


@add("html_block_extract", r"""SELECT page_id, CAST(position AS BIGINT) AS position, md5(body) AS body_md5 FROM (
 SELECT page_id, unnest(generate_series(0, len(b) - 1)) AS position, trim(regexp_replace(regexp_replace(regexp_replace(
  unnest(b), '<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'gs'), '<[^>]+>', '', 'g'),
  '^[ \n\t]+|[ \n\t]+$', '', 'g')) AS body FROM (
   SELECT page_id, list_transform(string_split(html, '<li>')[2:], lambda x: regexp_extract(x, '^(.*?)</li>', 1)) AS b
   FROM pages) AS m WHERE len(b) > 0) AS s""")
def _(t):
    items = H.html_blocks(t.pages.select("page_id", "html"), "<li>", {"body": "^(.*?)</li>"})
    return items.select("page_id", F.col("position").cast("bigint").alias("position"),
                        F.md5("body").alias("body_md5"))


_STATE_HTML = ("concat(html, '<script>window.__INITIAL_STATE__={\"user\":{\"id\":\"u', CAST(page_id AS STRING), "
               "'\",\"bio\":undefined}}</script>')")


@add("embedded_state_extract", """SELECT page_id, concat('u', CAST(page_id AS STRING)) AS state_user, '' AS bio
 FROM pages""")
def _(t):
    state = F.from_json(H.embedded_state(F.expr(_STATE_HTML)), "user struct<id:string,bio:string>")
    return t.pages.select("page_id", state["user"]["id"].alias("state_user"), state["user"]["bio"].alias("bio"))


_ATTRIBUTE = ("CASE WHEN page_id % 4 = 0 THEN '{broken' ELSE concat('{&quot;id&quot;:', CAST(page_id AS STRING), "
              "',&quot;t&quot;:&quot;a &amp; b&quot;}') END")


@add("html_unescape_json", """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN NULL ELSE page_id END AS id,
 CASE WHEN page_id % 4 = 0 THEN NULL ELSE 'a & b' END AS t FROM pages""")
def _(t):
    field = F.from_json(H.unescape_json(F.expr(_ATTRIBUTE)), "id bigint, t string")
    return t.pages.select("page_id", field["id"].alias("id"), field["t"].alias("t"))
