"""Text scalars on Chinese fixtures and random strings."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxscope.functions import fixed_values as fv
from voxscope.functions import html, links, numbers, places, sentiment, text, times, tokens
from voxscope.operators import filters


def one(spark, function, *values):
    """Apply a column function to string values; returns the results in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v string").select("i", function(F.col("v")).alias("o"))
    return [r["o"] for r in sorted(df.collect())]


def python_clean(value):
    """The cleaning rules restated with Python's own regular expressions."""
    if value is None or value == "nan":
        return ""
    value = re.sub(r"https?://(?:[a-zA-Z0-9]|[$-_@.&+]|[!*\\(),]|(?:%[0-9a-fA-F]{2}))+", "", value)
    for pattern in (r"\[[^\n]*?\]", r"<[^\n]*?>", r"@\S+"):
        value = re.sub(pattern, "", value)
    return re.sub(r"[\x00-\x1f\x7f-\x9f]", "", re.sub(r"\s+", " ", value).strip())


PIECES = st.sampled_from(["好", "不错", "[哇h]", "[", "]", "<b>", "</b>", "<", ">", "@某人", "@", " ", "　", "\x85",
                          " ", "\x00", "\x1c", "\n", "\t", "https://a.com/x?id=1", "http", "#话题", "a", "9", "nan"])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=20, max_size=60))
def test_clean_text_equals_its_restatement(spark, values):
    assert one(spark, text.clean_text, *values) == [python_clean(v) for v in values]


def test_clean_text_examples(spark):
    assert one(spark, text.clean_text, None, "nan", "看 https://a.com/1?x=2 吧[doge]  <b>好</b> @某人 完",
               "　多\x85空 格 ") == ["", "", "看 吧 好 完", "多 空 格"]


def test_mentions_and_names(spark):
    assert one(spark, text.mention_target, "回复 @a: x", "回复 小明：好", "@bob hi", "nothing") == ["@a", "小明", "bob", ""]
    assert one(spark, text.normalise_mention, "@@a", "b") == ["a", "b"]
    assert one(spark, filters.is_valid_name, "😀", " ", "张三", None, "x") == [False, False, True, False, True]


def test_html(spark):
    page = "<script>var a='<p>'</script><style>p{}</style> <p>你好</p>\n"
    assert one(spark, text.extract_text_from_html, page, None) == ["你好", ""]
    attribute = "{&quot;id&quot;:1,&quot;t&quot;:&quot;a&amp;quot;b&quot;}"
    assert one(spark, html.unescape_json, attribute, "{bad", None) == ['{"id":1,"t":"a&quot;b"}', "{}", "{}"]
    state = '<script>window.__INITIAL_STATE__={"a":undefined}</script>'
    assert one(spark, html.embedded_state, state, "none") == ['{"a":""}', None]


def test_search_posts(spark):
    post = ('<div class="s_post"><span class="p_title"><a data-tid="{0}" href="/p/{0}">标题 <em>{0}</em></a></span>'
            '<div class="p_content">正文{0}</div><a class="p_forum" href="/f"><font class="p_violet">吧</font></a>'
            '<a href="/home/main?un=x"><font class="p_violet">作者</font></a>'
            '<font class="p_green p_date">2024-01-01</font></div>')
    df = spark.createDataFrame([("<html>" + post.format(1) + post.format(2),)], "html string")
    rows = html.search_posts(df).orderBy("position").collect()
    assert [(r.note_id, r.title, r.content, r.href, r.forum, r.author, r.publish_time) for r in rows] == [
        (str(i), f"标题 {i}", f"正文{i}", f"/p/{i}", "吧", "作者", "2024-01-01") for i in (1, 2)]


def test_links(spark):
    got = one(spark, links.kv_string_to_map, "a1=x; webId=y; ", "a=1;a=2;b=c=d", None)
    assert got == [{"a1": "x", "webId": "y"}, {"a": "2"}, {}]
    assert one(spark, links.url_params, "http://h/p?a=1&b=&c=%E5%A5%BD+x&a=2#f", "http://h/p") == [
        {"c": "好 x", "a": "2"}, {}]
    video = [("bilibili", "https://www.bilibili.com/video/BV1a22b3c4d5"), ("bilibili", "BV1"),
             ("bilibili", "https://example.com"), ("douyin", "7000000000000000001"),
             ("douyin", "https://www.douyin.com/root/search/python?modal_id=7000000000000000002"),
             ("douyin", "https://v.douyin.com/q1W2e3/"), ("kuaishou", "3xabcdefghijk12"),
             ("xhs", "https://www.xiaohongshu.com/explore/65aaaa00000000000b0c0d0e?xsec_token=AB")]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(video)], "i int, p string, u string")
    ids = df.select("i", links.content_id(F.col("p"), F.col("u")).alias("o")).orderBy("i").collect()
    assert [r.o for r in ids] == ["BV1a22b3c4d5", "BV1", None, "7000000000000000001", "7000000000000000002", "",
                                  "3xabcdefghijk12", "65aaaa00000000000b0c0d0e"]


def test_numbers(spark):
    assert one(spark, numbers.to_number, "1.2万", "12d", " 7 ", "-1e3", "5f2c", None, "") == [
        None, None, 7.0, -1000.0, None, None, None]
    assert one(spark, numbers.parse_cn_count, "1.2万", "3亿", "8") == [12000.0, 3e8, 8.0]
    assert one(spark, numbers.is_reply, "0", "", None, "9bc41fa7", "7") == [False, False, False, True, True]
    assert one(spark, lambda c: numbers.is_reply(c, numeric_only=True), "9bc41fa7", "7") == [False, True]
    assert one(spark, lambda c: numbers.bin_right_closed(c.cast("int")), "0", "20", "21", "60", "61", "1001") == [
        None, "短评 (<20字)", "中评 (20-60字)", "中评 (20-60字)", "长评 (>60字)", None]


def test_places(spark):
    assert one(spark, places.standardize_location, "中国香港", "Australia", "Africa", "", None, "火星", "河南") == [
        "中国", "美国", "加拿大", "其他地区", "未知", "其他地区", "中国"]
    assert one(spark, places.extract_province, "湖北武汉", "Shenzhen", "inner Mongolia", "火星", None) == [
        "湖北", "广东", "内蒙古", "未知", "未知"]
    assert one(spark, places.extract_city, "广东深圳", "Xian", "海口") == ["深圳", "西安", "未知"]


def test_sentiment_weights_and_substrings(spark):
    ratio = [one(spark, lambda c: sentiment.sentiment_ratio(c, fv.CLEANING_POSITIVE, fv.CLEANING_NEGATIVE), v)[0]
             for v in ("好贵", "不好", None, "平平", "喜欢")]
    # 贵 is listed four times; 好 also counts inside 不好.
    assert ratio == [-0.6, 0.0, 0.0, 0.0, 1.0]
    assert one(spark, lambda c: sentiment.sentiment_net(c, fv.TREND_POSITIVE, fv.TREND_NEGATIVE),
               "喜欢 喜欢 失业", None) == [0.0, 0.0]


def test_tokens(spark):
    got = one(spark, lambda c: tokens.tokenize(c, phrases=fv.CUSTOM_PHRASES), "AI裁员让就业焦虑加剧了 ok9 x", None, "好")
    assert got == [["AI裁员", "就业焦虑", "加剧", "剧了", "ok9"], [], []]
    kept = one(spark, lambda c: tokens.drop_stop_words(tokens.tokenize(c), ["没有"]), "没有 2024 就业 就业")
    assert kept == [["就业", "就业"]]


def test_times(spark):
    assert one(spark, times.rfc2822_to_epoch, "Sat Dec 23 17:12:54 +0800 2023", "bad") == [1703322774, None]
    assert one(spark, lambda c: times.rfc2822_to_epoch(c, True), "Sat Dec 23 17:12:54 +0800 2023") == [1703351574]
    assert one(spark, times.rfc2822_to_china_time, "Sat Dec 23 09:12:54 +0000 2023") == ["2023-12-23 17:12:54+08:00"]
    assert one(spark, times.time_string_to_epoch, "2023-12-02 13:01:23", "x", None) == [1701522083, 0, 0]
    stamps = one(spark, lambda c: F.date_format(times.epoch_to_ts(c), "yyyy-MM-dd HH:mm:ss.SSS"),
                 "1764858046123", "oops", None, "99999999999999999")
    assert stamps == ["2025-12-04 14:20:46.123", None, None, None]
    auto = one(spark, lambda c: F.date_format(times.epoch_autounit(c.cast("bigint")), "yyyy-MM-dd HH:mm:ss"),
               "1700000000", "1700000000999")
    assert auto == ["2023-11-14 22:13:20"] * 2


def test_plausible_timestamp(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("0.0",), ("1764858046000",), ("2024-13-45",), ("a-b-c-d-e-f",),
                                (None,)], "create_time string")
    assert [str(r.date) for r in filters.plausible_timestamp(df).collect()] == ["2024-01-02"]
