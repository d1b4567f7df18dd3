"""Elements with nesting, and the records of whole pages."""

import re

import pytest
from pyspark.sql import functions as F

from voxscope.functions.elements import attribute, class_is, elements
from voxscope.sources import page_records, platforms


def found(spark, html, name, marker=""):
    df = spark.createDataFrame([(html,)], "html string")
    got = df.select(elements(F.col("html"), name, marker).alias("e")).first().e
    return None if got is None else [(e.tag, e.inner) for e in got]


@pytest.mark.parametrize("html,want", [
    ("<div>a</div><div>b</div>", ["a", "b"]),
    ("x<div>a<div>b</div>c</div>d", ["a<div>b</div>c", "b"]),
    ("<div>a<div>b", ["a<div>b", "b"]),
    ("</div><div>a</div></div><div>b</div>", ["a", "b"]),
    ("<div/><div>a<div />b</div>", ["", "a<div />b", ""]),
    ("<divs>a</divs><DIV x='>'>b</DIV>", ["b"]),
    ('<div a="</div>">c</div>', ["c"]),
    ("", []), ("no tags", []), (None, None)])
def test_elements_end_where_they_end(spark, html, want):
    got = found(spark, html, "div")
    assert got == want if want is None else [inner for _, inner in got] == want


def test_marked_elements_inside_others(spark):
    html = '<div class="a"><div>1<div class="a ">2</div></div><p>x</p></div><div class="ab">3</div>'
    assert [i for _, i in found(spark, html, "div", class_is("a"))] == ['<div>1<div class="a ">2</div></div><p>x</p>', "2"]


def test_many_tags(spark):
    html = "".join(f'<li class="{"w" if i % 7 == 0 else "n"}">{i}<ul><li>in</li></ul></li>' for i in range(700))
    assert [re.match(r"\d+", i)[0] for _, i in found(spark, html, "li", class_is("w"))] == [str(i) for i in range(0, 700, 7)]


def test_attributes(spark):
    row = spark.createDataFrame([("""<a href='x"y' class="b c" data-field='{"k":1}'>""",)], "t string").select(
        *[attribute(F.col("t"), n).alias(n.replace("-", "_")) for n in ("href", "class", "data-field", "id")]).first()
    assert tuple(row) == ('x"y', "b c", '{"k":1}', "")


def reply(first, key, name, words, at):
    return f"""<li class="lzl_single_post j_lzl_s_p {"first_no_border" if first else ""}" data-field='{{&quot;spid&quot;:{key},&quot;showname&quot;:&quot;{name}&quot;}}'>
 <a rel="noopener" name="{key}"></a><a data-field='{{}}' class="j_user_card lzl_p_p" href="/home/main?id={name}"><img src="https://img.example/{name}"/></a>
 <div class="lzl_cnt"><a class="at j_user_card ">{name}</a>:<span class="lzl_content_main"><span class="w">{words}</span> <img src="s.png">end</span>
 <div class="lzl_content_reply"><span class="lzl_jb"></span><span class="lzl_time">{at}</span></div><ul><li>inner</li></ul></div></li>"""


def comment(key, name, words, replies=""):
    return f"""<div class="l_post l_post_bright j_l_post clearfix  " data-field="{{&quot;content&quot;:{{&quot;post_id&quot;:{key},&quot;comment_num&quot;:2,&quot;forum_id&quot;:77,&quot;content&quot;:&quot;{words}&quot;}}}}">
 <div class="d_author"><a class="p_author_face " href="/home/main?un={name}"><img class="" src="https://img.example/{name}"></a>
 <a class="p_author_name j_user_card" href="#"> {name} </a></div><div class="core"><div>{replies}</div>
 <div class="post-tail-wrap"><span>IP属地:四川</span><span class="tail-info">1楼</span><span class="tail-info">2024-08-06 10:11</span></div></div></div>"""


def test_comments_and_replies_of_a_page(spark):
    both = reply(True, 11, "r1", "hi <b>there</b>", "2024-8-6 22:11") + reply(False, 12, "r2", "so", "2024-8-7 01:02")
    page = f"""<html><a class="card_title_fname" href="/f?kw=x"> 跳水 </a>{comment(1, "ann", "one &lt;br&gt; two", both)}
 <div class="l_post l_post_bright j_l_post clearfix  " data-field="{{}}">ad</div>{comment(2, "bob", "three")}</html>"""
    df = spark.createDataFrame([(7, page), (8, None), (9, "")], "note_id int, html string")
    got = [tuple(r) for r in page_records.forum_comments(df).orderBy("position").collect()]
    assert [r[2] for r in got] == ["1", "2"] and got[0] == (
        7, 0, "1", 2, "one  two", "https://tieba.baidu.com/home/main?un=ann", "ann", "https://img.example/ann", "四川", "2024-08-06 10:11", "77", "跳水",
        "https://tieba.baidu.com/f?kw=跳水")
    assert got[1][4] == "three" and got[1][6] == "bob"
    replies = [tuple(r) for r in page_records.forum_replies(df).orderBy("position").collect()]
    assert replies == [(7, 0, "11", "hi there end", "/home/main?id=r1", "r1", "https://img.example/r1", "2024-8-6 22:11"),
                       (7, 1, "12", "so end", "/home/main?id=r2", "r2", "https://img.example/r2", "2024-8-7 01:02")]


def test_posts_threads_and_creators(spark):
    post = f"""<title>Fine weather【跳水】_百度贴吧</title><meta name="description" content="about it"><a class="card_title_fname">跳水</a>
 <a id="lzonly_cntn" href="/p/991?see_lz=1">x</a><div id="thread_theme_5"><ul><li class="l_reply_num"><span class="red">30</span>/<span class="red">2</span></li></ul></div>
 <div class="p_postlist">{comment(1, "ann", "one")}</div>"""
    df = spark.createDataFrame([(1, post)], "page int, html string")
    r = page_records.forum_post(df).first()
    assert (r.note_id, r.title, r.description, r.user_nickname, r.total_replay_num, r.total_replay_page, r.ip_location) == (
        "991", "Fine weather", "about it", "ann", 30, 2, "四川")
    listing = """<a class="card_title_fname" href="/f?kw=x">跳水</a><ul id="thread_list"><!--<li class=" j_thread_list" data-field='{"id":5,"author_name":"ann","reply_num":4}'>
 <a class="j_th_tit " href="/p/5"> Title </a><div class="threadlist_abs threadlist_abs_onlyline "> words </div>
 <a class="frs-author-name j_user_card " href="/home/main?un=ann">ann</a><ul><li>x</li></ul></li><li data-field='{}'>ad</li></ul>"""
    r = page_records.forum_threads(spark.createDataFrame([(1, listing)], "page int, html string")).collect()
    assert [tuple(x) for x in r] == [(1, 0, "5", "Title", "words", "https://tieba.baidu.com/p/5", "https://tieba.baidu.com/home/main?un=ann", "ann", 4, "跳水",
                                      "https://tieba.baidu.com/f?kw=x")]
    profile = """<div class="userinfo_left_head"><a><img src="https://img.example/a"></a></div><p class="space"><a href="/home/main?un=%E5%AE%89&id=tb.1&fr=x">x</a></p>
 <span class="userinfo_username "> An </span><span class="userinfo_sex userinfo_sex_female"></span><div class="userinfo_userdata"><span>吧龄:1.9年</span> <span>IP属地:四川</span></div>
 <span class="concern_num">(<a href="x">3</a>)</span><span class="concern_num">(<a href="y">9</a>)</span><ul class="new_list clearfix"><li><div class="thread_name">
 <a href="/p/61?pid=1">t</a><a href="/p/62">u</a></div></li><li><div class="thread_name"><a href="/p/63">v</a></div></li></ul><div class="thread_name"><a href="/p/64">w</a></div>"""
    df = spark.createDataFrame([(1, profile)], "page int, html string")
    r = page_records.forum_creator(df).first()
    assert (r.user_id, r.user_name, r.nickname, r.avatar, r.registration_duration, r.ip_location, r.follows, r.fans) == (
        "tb.1", "安", "An", "https://img.example/a", "1.9年", "四川", 3, 9)
    assert [x.note_id for x in page_records.creator_threads(df).orderBy("position").collect()] == ["61", "63"]


def test_script_data(spark):
    state = """<script id="js-initialData" type="text/json">{"initialState":{"entities":{"users":{"tok":{"id":"u1","name":"An","gender":1,"followerCount":5,"urlToken":""},"e":{}},
 "answers":{"9":{"id":"9","content":"<p>b</p>","question":{"id":"q"},"author":{"id":"u1","name":"An"},"voteup_count":3},"1":{"id":"1"}},
 "zvideos":{"4":{"id":"4","title":"v","author":"tok","video_url":"https://v.example"}}}}}</script>"""
    df = spark.createDataFrame([("tok", state), ("e", state), ("none", state), ("tok", "<p>"), ("tok", None)], "token string, html string")
    r = page_records.zhihu_creators(df, "token").collect()
    assert [(x.token, x.user_id, x.user_nickname, x.gender, x.fans, x.url_token, x.user_link) for x in r] == [
        ("tok", "u1", "An", "男", 5, "tok", "https://www.zhihu.com/people/tok")]
    one = df.limit(1)
    a, z = page_records.zhihu_page_contents(one, "answer").first(), page_records.zhihu_page_contents(one, "zvideo").first()
    assert (a.content_id, a.content_type, a.content_text, a.content_url, a.voteup_count, a.nickname) == (
        "9", "answer", "b", "https://www.zhihu.com/question/q/answer/9", 3, "An")
    assert (z.content_id, z.user_id, z.nickname, z.content_url) == ("4", "u1", "An", "https://v.example")
    assert page_records.zhihu_page_contents(one, "article").collect() == []
    weibo = """<script>var $render_data = [{"status":{"id":"5","text":"a <b>b</b>","created_at":"Wed Jan 10 08:00:00 +0800 2024","user":{"id":3,"screen_name":"n"}}}][0] || {};</script>"""
    r = page_records.weibo_page_contents(spark.createDataFrame([(weibo,), ("",)], "html string")).collect()
    assert [(x.content_id, x.title, x.user_id, x.nickname, str(x.create_time)) for x in r] == [("5", "a b", "3", "n", "2024-01-10 00:00:00")]


def test_bilibili_records(spark):
    up = '{"Card":{"like_num":8,"card":{"mid":"3","name":"n","sex":"女","fans":4,"level_info":{"current_level":6},"official_verify":{"type":-1}}}}'
    r = page_records.bilibili_creators(spark.createDataFrame([(up,), ("broken",)], "payload string")).collect()
    assert tuple(r[0]) == ("3", "n", "女", None, None, 4, 8, 6, -1) and set(r[1]) == {None}
    one = '{"id_str":"7","type":"DYNAMIC_TYPE_AV","modules":{"module_dynamic":{"desc":null},"module_author":{"pub_ts":99},"module_stat":{"comment":{"count":1},"forward":{"count":2},"like":{"count":3}}}}'
    two = one.replace('"desc":null', '"desc":{"text":"hello"}').replace("DYNAMIC_TYPE_AV", "DRAW")
    r = page_records.bilibili_dynamics(spark.createDataFrame([(1, f"[{one},{two}]"), (2, "[]"), (3, "x")], "creator int, payload string")).collect()
    assert [tuple(x) for x in r] == [(1, "7", "", "AV", 99, 1, 2, 3), (1, "7", "hello", "DRAW", 99, 1, 2, 3)]


def test_one_scan_for_all_platforms(spark, tmp_path):
    spark.createDataFrame([("xhs", "{}"), ("tieba", "{}"), (" WEIBO ", "{"), ("x", "{}")], "platform string, payload string").write.parquet(str(tmp_path / "p"))
    df = platforms.union_platforms(spark.read.parquet(str(tmp_path / "p")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and plan.count("try_parse_json(payload") + plan.count("parse_json(payload") <= 2
    assert sorted(r.platform for r in df.collect()) == ["weibo", "xhs"]
