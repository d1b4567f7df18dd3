"""Time, number, place, sentiment and token queries, and row filters."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import numbers, places, sentiment, times, tokens
from ..operators import filters, spine
from ..session import stage
from .base import Registry, with_comments
from .text import clean_text_sql, q

registry = Registry()
add = registry.add

# --- time ------------------------------------------------------------------------------------


@add("epoch_to_ts", """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE
 strftime(make_timestamp(CAST(floor(epoch_us(ts) / 1000) AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S.%g') END AS wall,
 strftime(make_timestamp(event_id * 1000000000), '%Y-%m-%d %H:%M:%S') AS early FROM events""")
def _(t):
    millis = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts"))
    text = F.when(F.col("event_id") % 9 == 0, "bad").otherwise(millis.cast("string"))
    return t.events.select(
        "event_id", F.date_format(times.epoch_to_ts(text), "yyyy-MM-dd HH:mm:ss.SSS").alias("wall"),
        F.date_format(times.epoch_to_ts(F.col("event_id") * 1000000), "yyyy-MM-dd HH:mm:ss").alias("early"))


@add("epoch_autounit", """SELECT event_id, strftime(make_timestamp(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT)
 * 1000000), '%Y-%m-%d %H:%M:%S') AS wall, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def _(t):
    origin = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    value = F.when(F.col("event_id") % 2 == 0, F.timestamp_diff("SECOND", origin, F.col("ts"))).otherwise(
        F.timestamp_diff("MILLISECOND", origin, F.col("ts")))
    wall = times.epoch_autounit(value)
    return t.events.select("event_id", F.date_format(wall, "yyyy-MM-dd HH:mm:ss").alias("wall"),
                           F.date_format(wall, "yyyy-MM-dd").alias("day"))


@add("time_string_to_epoch", """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 0
 ELSE CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) END AS epoch FROM events""")
def _(t):
    text = F.when(F.col("event_id") % 10 == 0, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select("event_id", times.time_string_to_epoch(text).alias("epoch"))


_RFC = "date_format(ts, \"'Mon 'MMM dd HH:mm:ss '+0800' yyyy\")"


@add("rfc2822_to_china_time", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || '+08:00' AS china
 FROM events""")
def _(t):
    return t.events.select("event_id", times.rfc2822_to_china_time(F.expr(_RFC)).alias("china"))


@add("rfc2822_to_epoch", """SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) - 28800 AS epoch,
 CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS offset_ignored FROM events""")
def _(t):
    text = F.expr(_RFC)
    return t.events.select("event_id", times.rfc2822_to_epoch(text).alias("epoch"),
                           times.rfc2822_to_epoch(text, ignore_offset=True).alias("offset_ignored"))


CALENDAR_SQL = """year(create_time) AS year, quarter(create_time) AS quarter, month(create_time) AS month,
 day(create_time) AS day, hour(create_time) AS hour, isodow(create_time) - 1 AS day_of_week,
 dayname(create_time) AS day_name, CAST(create_time AS DATE) AS date,
 strftime(create_time, '%Y-%m-%d %H:%M:%S') AS datetime_str"""


@add("calendar_features", "SELECT event_id, " + CALENDAR_SQL.replace("create_time", "ts") + " FROM events")
def _(t):
    return times.calendar_features(t.events.select("event_id", "ts"), "ts").drop("ts")


@add("day_range_bounds", """SELECT user_id, CAST(epoch(CAST(CAST(min(ts) AS DATE) AS TIMESTAMP)) AS BIGINT) AS first_s,
 CAST(epoch(CAST(CAST(max(ts) AS DATE) AS TIMESTAMP)) AS BIGINT) + 86399 AS last_s FROM events GROUP BY user_id""")
def _(t):
    days = t.events.groupBy("user_id").agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
    first, last = times.day_range_bounds(F.col("a"), F.col("b"))
    return days.select("user_id", first.alias("first_s"), last.alias("last_s"))


@add("calendar_spine", """SELECT k.event_type AS keyword, strftime(d.day, '%Y-%m-%d') AS day,
 count(e.event_id) AS posts FROM (SELECT event_type, unnest(generate_series(min(CAST(ts AS DATE)),
  max(CAST(ts AS DATE)) + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS day FROM events GROUP BY event_type) AS d
 JOIN (SELECT DISTINCT event_type FROM events) AS k USING (event_type)
 LEFT JOIN events e ON e.event_type = k.event_type AND CAST(e.ts AS DATE) = CAST(d.day AS DATE)
 GROUP BY ALL""")
def _(t):
    ranges = t.events.groupBy(F.col("event_type").alias("keyword")).agg(
        F.to_date(F.min("ts")).alias("first"), F.date_add(F.to_date(F.max("ts")), 3).alias("last"))
    counts = t.events.groupBy(F.col("event_type").alias("keyword"), F.to_date("ts").alias("day")).agg(
        F.count("*").alias("posts"))
    days = spine.calendar_spine(ranges, "first", "last")
    return spine.fill_trend(days, counts, ["keyword", "day"], ["posts"]).withColumn(
        "day", F.date_format("day", "yyyy-MM-dd"))


# --- numbers ---------------------------------------------------------------------------------

_RAW_NUMBER = ("CASE event_id % 6 WHEN 0 THEN CAST(value AS STRING) WHEN 1 THEN '1.2万' WHEN 2 THEN '12d' "
               "WHEN 3 THEN concat(' ', CAST(user_id AS STRING)) WHEN 4 THEN md5(event_type) ELSE '-3.5e2' END")


@add("to_number", """SELECT event_id, CASE event_id % 6 WHEN 0 THEN value WHEN 3 THEN CAST(user_id AS DOUBLE)
 WHEN 5 THEN -350e0 END AS number FROM events""")
def _(t):
    return t.events.select("event_id", numbers.to_number(F.expr(_RAW_NUMBER)).alias("number"))


@add("parse_cn_count", """SELECT event_id, CASE event_id % 6 WHEN 0 THEN value WHEN 1 THEN 12000e0
 WHEN 3 THEN CAST(user_id AS DOUBLE) WHEN 5 THEN -350e0 END AS number FROM events""")
def _(t):
    return t.events.select("event_id", numbers.parse_cn_count(F.expr(_RAW_NUMBER)).alias("number"))


@add("interaction_count", with_comments("""SELECT comment_id, like_count + sub_comment_count AS interaction_count,
 like_count + sub_comment_count > 0 AS has_interaction FROM comments"""))
def _(t):
    both = numbers.interaction_count(F.col("like_count"), F.col("sub_comment_count"))
    return t.comments.select("comment_id", both.alias("interaction_count"), (both > 0).alias("has_interaction"))


@add("has_picture", with_comments("SELECT comment_id, coalesce(length(pictures) > 10, false) AS has_picture "
                                  "FROM comments"))
def _(t):
    return t.comments.select("comment_id", numbers.has_picture(F.col("pictures")).alias("has_picture"))


@add("is_reply", with_comments("""SELECT comment_id, parent_comment_id <> 0 AS is_reply,
 parent_comment_id <> 0 AS hex_reply, false AS hex_reply_numeric FROM comments"""))
def _(t):
    parent = F.col("parent_comment_id")
    hex_id = F.when(parent == 0, "0").otherwise(F.concat(F.lit("f"), F.hex(parent)))
    return t.comments.select("comment_id", numbers.is_reply(parent).alias("is_reply"),
                             numbers.is_reply(hex_id).alias("hex_reply"),
                             numbers.is_reply(hex_id, numeric_only=True).alias("hex_reply_numeric"))


@add("gender_label", """SELECT user_id, CASE WHEN user_id % 5 = 0 THEN CASE user_id % 3 WHEN 0 THEN '男'
 WHEN 1 THEN '女' END WHEN user_id % 5 = 1 THEN CASE user_id % 3 WHEN 1 THEN '男' WHEN 2 THEN '女' ELSE '未知' END
 WHEN user_id % 5 = 2 THEN CASE user_id % 3 WHEN 0 THEN '女' ELSE '男' END
 WHEN user_id % 5 = 3 THEN CASE user_id % 3 WHEN 0 THEN '女' ELSE '男' END
 ELSE CASE user_id % 3 WHEN 0 THEN '女' WHEN 1 THEN '男' ELSE '未知' END END AS gender
 FROM (SELECT c_custkey AS user_id FROM customer) AS u""")
def _(t):
    platform = F.expr("CASE c_custkey % 5 WHEN 0 THEN 'xhs' WHEN 1 THEN 'douyin' WHEN 2 THEN 'weibo' "
                      "WHEN 3 THEN 'kuaishou' ELSE 'zhihu' END")
    code = F.expr("CASE c_custkey % 5 WHEN 2 THEN substr('fmn', 1 + c_custkey % 3, 1) "
                  "WHEN 3 THEN substr('FMN', 1 + c_custkey % 3, 1) ELSE CAST(c_custkey % 3 AS STRING) END")
    return t.customer.select(F.col("c_custkey").alias("user_id"), numbers.gender_label(platform, code).alias("gender"))


@add("bin_right_closed", """SELECT doc_id, CASE WHEN n > 0 AND n <= 20 THEN '短评 (<20字)' WHEN n > 20 AND n <= 60
 THEN '中评 (20-60字)' WHEN n > 60 AND n <= 1000 THEN '长评 (>60字)' END AS len_group
 FROM (SELECT doc_id, length(text) AS n FROM documents) AS s""")
def _(t):
    return t.documents.select("doc_id", numbers.bin_right_closed(F.length("text")).alias("len_group"))


# --- places ----------------------------------------------------------------------------------


def place_sql(column: str, rules, other: str) -> str:
    cases = " ".join("WHEN " + " OR ".join(f"contains(lower({column}), {q(k.lower())})" for k in words)
                     + f" THEN {q(place)}" for place, words in rules)
    return (f"CASE WHEN {column} IS NULL OR {column} IN ('nan', '未知') THEN '未知' "
            f"ELSE CASE {cases} ELSE {q(other)} END END")


for _name, _function, _rules, _other in (
        ("standardize_location", places.standardize_location, fv.COUNTRY_RULES, fv.OTHER_REGION),
        ("extract_province", places.extract_province, fv.PROVINCE_RULES, fv.UNKNOWN_PLACE),
        ("extract_city", places.extract_city, fv.CITY_RULES, fv.UNKNOWN_PLACE)):
    def _register(function, rules, other, name):
        add(name, with_comments(f"SELECT comment_id, {place_sql('ip_location', rules, other)} AS place "
                                "FROM comments"))(
            lambda t: t.comments.select("comment_id", function(F.col("ip_location")).alias("place")))
    _register(_function, _rules, _other, _name)

# --- sentiment -------------------------------------------------------------------------------


def hits_sql(column: str, words) -> str:
    return "(" + " + ".join(f"{n} * CAST(contains({column}, {q(w)}) AS INT)"
                            for w, n in Counter(words).items()) + ")"


def ratio_sql(column: str, positive=fv.CLEANING_POSITIVE, negative=fv.CLEANING_NEGATIVE) -> str:
    p, n = hits_sql(column, positive), hits_sql(column, negative)
    return f"CASE WHEN {p} + {n} = 0 THEN 0e0 ELSE CAST({p} - {n} AS DOUBLE) / CAST({p} + {n} AS DOUBLE) END"


def net_sql(column: str, positive=fv.TREND_POSITIVE, negative=fv.TREND_NEGATIVE) -> str:
    return f"CAST({hits_sql(column, set(positive))} - {hits_sql(column, set(negative))} AS DOUBLE)"


LABEL_SQL = "CASE WHEN {0} > 0.1 THEN '正面' WHEN {0} < -0.1 THEN '负面' ELSE '中性' END"


@add("sentiment_ratio", with_comments(f"SELECT comment_id, round({ratio_sql('content')}, 6) AS score FROM comments"))
def _(t):
    score = sentiment.sentiment_ratio(F.col("content"), fv.CLEANING_POSITIVE, fv.CLEANING_NEGATIVE)
    return t.comments.select("comment_id", F.round(score, 6).alias("score"))


@add("sentiment_net", with_comments(
    f"SELECT comment_id, {net_sql('content')} AS trend_score, "
    f"{net_sql('content', fv.TRAINING_POSITIVE, fv.TRAINING_NEGATIVE)} AS training_score FROM comments"))
def _(t):
    text = F.col("content")
    return t.comments.select(
        "comment_id", sentiment.sentiment_net(text, fv.TREND_POSITIVE, fv.TREND_NEGATIVE).alias("trend_score"),
        sentiment.sentiment_net(text, fv.TRAINING_POSITIVE, fv.TRAINING_NEGATIVE).alias("training_score"))


@add("sentiment_label", with_comments(
    f"SELECT comment_id, {LABEL_SQL.format('s')} AS label FROM (SELECT comment_id, {ratio_sql('content')} AS s "
    "FROM comments) AS r"))
def _(t):
    score = sentiment.sentiment_ratio(F.col("content"), fv.CLEANING_POSITIVE, fv.CLEANING_NEGATIVE)
    return t.comments.select("comment_id", score.alias("score")).select(
        "comment_id", numbers.sentiment_label(F.col("score")).alias("label"))


TRAINING_NET = net_sql("content", fv.TRAINING_POSITIVE, fv.TRAINING_NEGATIVE)


def training_score(column: str = "content"):
    return sentiment.sentiment_net(F.col(column), fv.TRAINING_POSITIVE, fv.TRAINING_NEGATIVE)


@add("training_label", with_comments(
    f"SELECT comment_id, CASE WHEN {TRAINING_NET} > 0 THEN 1e0 ELSE 0e0 END AS label FROM comments "
    f"WHERE {TRAINING_NET} <> 0"))
def _(t):
    rows = filters.nonzero_score(t.comments.withColumn("score", training_score()))
    return rows.select("comment_id", numbers.training_label(F.col("score")).alias("label"))


@add("sentiment_density", with_comments(
    f"SELECT comment_id, round({TRAINING_NET} / length(content) * 100, 6) AS density FROM comments "
    "WHERE length(content) > 0"))
def _(t):
    density = numbers.sentiment_density(training_score(), F.length("content"))
    return t.comments.filter(F.length("content") > 0).select("comment_id", F.round(density, 6).alias("density"))


# --- tokens ----------------------------------------------------------------------------------

# The derived comments hold Han words of at most two characters, for which the bigram is the word.
TOKENS_SQL = ("list_filter(regexp_extract_all({0}, '[0-9A-Za-z\\x{{c0}}-\\x{{24f}}]+|[\\x{{4e00}}-\\x{{9fff}}]+'), "
              "lambda w: length(w) >= 2)")
STOPS = [*fv.STOP_WORDS, "the", "of", "de", "and", "to", "in", "la", "der"]
STOPS_SQL = ", ".join(q(w) for w in STOPS)
FILTERED_SQL = ("list_filter(" + TOKENS_SQL + ", lambda w: w NOT IN (" + STOPS_SQL
                + ") AND NOT regexp_matches(w, '^[0-9]+$'))")


@add("tokenize", with_comments(
    "SELECT comment_id, CAST(len(w) AS BIGINT) AS tokens, md5(array_to_string(w, ' ')) AS words_md5 FROM "
    f"(SELECT comment_id, {TOKENS_SQL.format('content')} AS w FROM comments) AS s"))
def _(t):
    words = t.comments.select("comment_id", tokens.tokenize(F.col("content")).alias("w"))
    return words.select("comment_id", F.size("w").cast("bigint").alias("tokens"),
                        F.md5(F.array_join("w", " ")).alias("words_md5"))


# A segmenter of one's own: runs of small letters, each with the capital before it.
@add("tokenize_with_segmenter", """SELECT doc_id, CAST(len(w) AS BIGINT) AS tokens, md5(array_to_string(w, ' ')) AS words_md5
 FROM (SELECT doc_id, regexp_extract_all(text, '[A-Z][a-z]{2,}|[a-z]{3,}') AS w FROM documents) AS s""")
def _(t):
    cut = tokens.tokenize(F.col("text"), min_len=3, segmenter=lambda x: F.regexp_extract_all(x, F.lit("[A-Z]?[a-z]+"), F.lit(0)))
    return t.spread_documents.select("doc_id", cut.alias("w")).select(
        "doc_id", F.size("w").cast("bigint").alias("tokens"), F.md5(F.array_join("w", " ")).alias("words_md5"))


@add("tokenize_filtered", with_comments(
    "SELECT comment_id, CAST(len(w) AS BIGINT) AS tokens, md5(array_to_string(w, ' ')) AS words_md5 FROM "
    f"(SELECT comment_id, {FILTERED_SQL.format('content')} AS w FROM comments) AS s WHERE len(w) > 0"))
def _(t):
    words = t.comments.select("comment_id", tokens.drop_stop_words(
        tokens.tokenize(F.col("content")), STOPS).alias("words"))
    return filters.nonempty_tokens(words).select(
        "comment_id", F.size("words").cast("bigint").alias("tokens"),
        F.md5(F.array_join("words", " ")).alias("words_md5"))


_PHRASES = {"of the": "function", "in the": "function", "AI裁员": "社会事件"}


@add("custom_phrases", """SELECT w AS term, CASE WHEN w IN ('of the', 'in the') THEN 'function' END AS phrase_group,
 count(*) AS n FROM (SELECT unnest(regexp_extract_all(text,
  'AI裁员|of the|in the|[0-9A-Za-z\\x{c0}-\\x{24f}]+|[\\x{4e00}-\\x{9fff}]+')) AS w FROM documents) AS s
 WHERE length(w) >= 2 GROUP BY ALL""".replace("\\\\", "\\"))
def _(t):
    words = t.spread_documents.select(F.explode(tokens.tokenize(F.col("text"), phrases=_PHRASES)).alias("term"))
    counts = words.groupBy("term").agg(F.count("*").alias("n"))
    return counts.select("term", tokens.phrase_group(F.col("term"), _PHRASES).alias("phrase_group"), "n")


# --- filters ---------------------------------------------------------------------------------


def _keep(name, sql_where, function, source="comments", key="comment_id"):
    """Register a filter by the keys it keeps."""
    add(name, with_comments(f"SELECT {key} FROM {source} WHERE {sql_where}"))(
        lambda t: function(getattr(t, source)).select(key))


add("drop_blank_rows", """SELECT event_id AS a, event_type AS b FROM (SELECT
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS event_id,
 CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END AS event_type FROM events) AS s
 WHERE event_id IS NOT NULL OR event_type IS NOT NULL""")(
    lambda t: filters.drop_blank_rows(t.events.selectExpr(
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS a",
        "CASE WHEN event_id % 6 = 0 THEN NULL ELSE event_type END AS b")))

_keep("drop_missing", "content IS NOT NULL AND user_id IS NOT NULL", filters.drop_missing, "raw")


@add("fill_missing", with_comments("""SELECT comment_id, coalesce(ip_location, '未知') AS ip_location,
 coalesce(like_count, 0) AS like_count, coalesce(sub_comment_count, 0) AS sub_comment_count,
 coalesce(parent_comment_id, 0) AS parent_comment_id FROM raw"""))
def _(t):
    return filters.fill_missing(t.raw).select("comment_id", "ip_location", "like_count", "sub_comment_count",
                                              "parent_comment_id")


@add("coalesce_time", with_comments("""SELECT comment_id, strftime(coalesce(create_time, last_modify_ts),
 '%Y-%m-%d %H:%M:%S') AS at FROM raw WHERE coalesce(create_time, last_modify_ts) IS NOT NULL"""))
def _(t):
    return filters.coalesce_time(t.raw).select(
        "comment_id", F.date_format("create_time", "yyyy-MM-dd HH:mm:ss").alias("at"))


_CLEANED = f"SELECT comment_id, {clean_text_sql('content')} AS content_clean FROM raw"


def _cleaned(t):
    from ..functions.text import clean_text
    return stage(t.raw.select("comment_id", clean_text(F.col("content")).alias("content_clean")), "clean-text")


for _name, _where, _function in (
        ("drop_empty_text", "length(content_clean) > 0", filters.drop_empty_text),
        ("min_length", "length(content_clean) >= 500", lambda df: filters.min_length(df, size=500)),
        ("exclude_patterns", " AND ".join(f"NOT contains(content_clean, {q(p)})" for p in fv.NOISE_FRAGMENTS),
         filters.exclude_patterns)):
    def _register_cleaned(name, where, function):
        add(name, with_comments(f"SELECT comment_id FROM ({_CLEANED}) AS s WHERE {where}"))(
            lambda t: function(_cleaned(t)).select("comment_id"))
    _register_cleaned(_name, _where, _function)

_keep("exclude_bot_avatar", "NOT coalesce(regexp_matches(avatar, 'default|placeholder|null'), false)",
      filters.exclude_bot_avatar)
_keep("valid_location", "ip_location IS NOT NULL AND ip_location NOT IN ('未知', '')",
      lambda df: filters.valid_location(df, "ip_location"))


@add("plausible_timestamp", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events
 WHERE event_id % 5 IN (0, 1)""")
def _(t):
    text = F.expr("CASE event_id % 5 WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss') "
                  "WHEN 1 THEN date_format(ts, 'yyyy-MM-dd') WHEN 2 THEN CAST(event_id AS STRING) "
                  "WHEN 3 THEN concat('not-a-date-', event_type) ELSE '0.0' END")
    return filters.plausible_timestamp(t.events.select("event_id", text.alias("create_time"))).select(
        "event_id", F.date_format("date", "yyyy-MM-dd").alias("date"))


_keep("nonzero_score", f"{TRAINING_NET} <> 0",
      lambda df: filters.nonzero_score(df.withColumn("score", training_score())))
add("max_length", "SELECT doc_id FROM documents WHERE length(text) <= 200")(
    lambda t: filters.max_length(t.documents.withColumn("content_len", F.length("text"))).select("doc_id"))
add("valid_name", """SELECT event_id, name FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '😀😀'
 WHEN 1 THEN '  ' WHEN 2 THEN concat('用户', CAST(user_id AS STRING)) ELSE event_type END AS name FROM events) AS s
 WHERE regexp_matches(trim(name), '[一-龥a-zA-Z0-9]')""")(
    lambda t: filters.valid_name(t.events.selectExpr(
        "event_id", "CASE event_id % 4 WHEN 0 THEN '😀😀' WHEN 1 THEN '  ' "
                    "WHEN 2 THEN concat('用户', CAST(user_id AS STRING)) ELSE event_type END AS name"), "name"))
_keep("publish_time_filter", "create_time >= (SELECT max(create_time) FROM comments) - INTERVAL 7 DAY",
      lambda df: filters.publish_time_filter(df, "week"))
_keep("type_filter", "event_type IN ('view', 'purchase')",
      lambda df: filters.type_filter(df, "event_type", ["view", "purchase"]))
_keep("key_present", "comment_id IS NOT NULL AND user_id IS NOT NULL",
      lambda df: filters.key_present(df, "comment_id", "user_id"), "raw")


@add("consistent_fk", """SELECT l_orderkey, l_linenumber, p.p_size IS NOT DISTINCT FROM CAST(l_quantity AS INT)
 AS accepted FROM lineitem JOIN (SELECT p_partkey, p_size FROM part) AS p ON p.p_partkey = l_partkey""")
def _(t):
    rows = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size"), "l_partkey").withColumn(
        "quantity", F.col("l_quantity").cast("int"))
    good, bad = filters.consistent_fk(rows, "p_size", "quantity")
    cols = ["l_orderkey", "l_linenumber"]
    return good.select(*cols, F.lit(True).alias("accepted")).union(bad.select(*cols, F.lit(False)))


add("nonempty_tokens", f"SELECT doc_id FROM documents WHERE len({TOKENS_SQL.format('text')}) > 0")(
    lambda t: filters.nonempty_tokens(t.documents.select(
        "doc_id", tokens.tokenize(F.col("text")).alias("words"))).select("doc_id"))
add("node_display_size", "SELECT c_custkey, round(c_acctbal / 10000 * 80000, 2) AS size FROM customer")(
    lambda t: t.customer.select("c_custkey", F.round(numbers.node_display_size(
        F.col("c_acctbal") / 10000), 2).alias("size")))
