"""Cleaning as a whole, aggregations, profiles and the report."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import numbers, places
from ..functions.tokens import drop_stop_words, tokenize
from ..operators import aggregates, joins, mining, report, topk
from ..plans import cleaning, opinion, topics
from ..session import stage
from .base import Registry, with_comments
from .scalar import (
    CALENDAR_SQL,
    FILTERED_SQL,
    LABEL_SQL,
    STOPS,
    TOKENS_SQL,
    TRAINING_NET,
    net_sql,
    place_sql,
    ratio_sql,
    training_score,
)
from .text import clean_text_sql, q

registry = Registry()
add = registry.add

# Documents are far longer and rarer than comments, hence the wider burst window.
OPTIONS = cleaning.CleaningOptions(burst_seconds=3600, burst_length=2500)


def round2(expr: str) -> str:
    """Decimal rounding to two places, half away from zero."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30,12)), 2) AS DOUBLE)"


_NOISE = " AND ".join(f"NOT contains(content_clean, {q(p)})" for p in fv.NOISE_FRAGMENTS)

CLEAN_SQL = f""",
prepared AS (
 SELECT comment_id, coalesce(create_time, last_modify_ts) AS create_time, coalesce(ip_location, '未知') AS ip_location,
  note_id, content, user_id, nickname, avatar, coalesce(sub_comment_count, 0) AS sub_comment_count, pictures,
  coalesce(parent_comment_id, 0) AS parent_comment_id, coalesce(like_count, 0) AS like_count,
  {clean_text_sql('content')} AS content_clean
 FROM raw WHERE content IS NOT NULL AND user_id IS NOT NULL AND coalesce(create_time, last_modify_ts) IS NOT NULL),
firsts AS (
 SELECT * FROM prepared WHERE length(content_clean) > 0
 QUALIFY row_number() OVER (PARTITION BY content_clean ORDER BY comment_id) = 1),
gaps AS (
 SELECT *, (epoch_us(create_time) - lag(epoch_us(create_time)) OVER
  (PARTITION BY user_id ORDER BY create_time, comment_id)) / 1e6 AS gap FROM firsts),
unique_rows AS (
 SELECT * EXCLUDE gap FROM gaps WHERE NOT coalesce(gap < 3600 AND length(content_clean) < 2500, false)),
stats AS (
 SELECT user_id, count(comment_id) AS user_comment_count, CAST(sum(like_count) AS BIGINT) AS user_total_likes,
  CAST(sum(sub_comment_count) AS BIGINT) AS user_total_replies, count(comment_id) * 1e0 + sum(like_count) * 1e-1
   + sum(sub_comment_count) * 5e-1 AS user_activity_score FROM unique_rows GROUP BY user_id),
judged AS (
 SELECT *, user_activity_score >= quantile_cont(user_activity_score, 0.9) OVER () AS is_kol
 FROM unique_rows JOIN stats USING (user_id)),
featured AS (
 SELECT *, CAST(length(content_clean) AS BIGINT) AS content_length,
  coalesce(length(pictures) > 10, false) AS has_picture, parent_comment_id <> 0 AS is_reply, {CALENDAR_SQL},
  {place_sql('ip_location', fv.COUNTRY_RULES, fv.OTHER_REGION)} AS location_standard,
  {place_sql('ip_location', fv.PROVINCE_RULES, fv.UNKNOWN_PLACE)} AS location_province,
  {place_sql('ip_location', fv.CITY_RULES, fv.UNKNOWN_PLACE)} AS location_city,
  {ratio_sql('content_clean')} AS sentiment_score, like_count + sub_comment_count AS interaction_count
 FROM judged),
cleaned AS (
 SELECT *, {LABEL_SQL.format('sentiment_score')} AS sentiment_label, interaction_count > 0 AS has_interaction
 FROM featured WHERE length(content_clean) >= 3 AND {_NOISE} AND NOT coalesce(
  regexp_matches(avatar, 'default|placeholder|null'), false))"""


def with_clean(select: str) -> str:
    return with_comments(f"{CLEAN_SQL} {select}")


def _cleaned(t):
    # Of the text as it came these queries ask at most whether there is one: beside the cleaned text it is kept empty, or null.
    kept = [F.substring("content", 1, 0).alias("content") if c == "content" else c for c in [*t.raw.columns, "content_clean"]]
    # A task sorts the unique texts of two that made comments.
    return cleaning.clean_comments(t.raw, replace(OPTIONS, text_tasks=t._tasks // 2), kept)


@add("heat_of_clean_comments", with_comments(f""", cleaned AS (SELECT comment_id, ip_location,
 {clean_text_sql('content')} AS content_clean FROM comments), firsts AS (SELECT * FROM cleaned
 WHERE length(content_clean) > 0 QUALIFY row_number() OVER (PARTITION BY content_clean ORDER BY comment_id) = 1)
 SELECT location_province, count(*) AS count, {round2('avg(s)')} AS avg_sentiment FROM (
  SELECT {place_sql('ip_location', fv.PROVINCE_RULES, fv.UNKNOWN_PLACE)} AS location_province,
   {net_sql('content_clean')} AS s FROM firsts) AS x
 WHERE location_province NOT IN ('未知', '') GROUP BY 1 ORDER BY count DESC, 1 LIMIT 34"""))
def _(t):
    rows = cleaning.unique_texts(t.comments, columns=["ip_location", "content_clean"])
    rows = opinion.scored(rows.withColumn("location_province", places.extract_province(F.col("ip_location"))),
                          text="content_clean")
    return topk.top_provinces(aggregates.province_heat(rows))


def _placed(t):
    return t.comments.withColumn("location_province", places.extract_province(F.col("ip_location")))


_ALL = ["comment_id", "user_id", "note_id", "ip_location", "content_length", "has_picture", "is_reply", "year",
        "quarter", "month", "day", "hour", "day_of_week", "day_name", "datetime_str", "location_standard",
        "location_province", "location_city", "user_comment_count", "user_total_likes", "user_total_replies",
        "is_kol", "sentiment_label", "interaction_count", "has_interaction"]


@add("clean_comments", with_clean(
    f"SELECT {', '.join(_ALL)}, md5(content_clean) AS content_md5, strftime(date, '%Y-%m-%d') AS date, "
    "round(user_activity_score, 4) AS user_activity_score, round(sentiment_score, 6) AS sentiment_score FROM cleaned"))
def _(t):
    return _cleaned(t).select(
        *_ALL, F.md5("content_clean").alias("content_md5"), F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.round("user_activity_score", 4).alias("user_activity_score"),
        F.round("sentiment_score", 6).alias("sentiment_score"))


@add("quality_metrics", with_clean("""SELECT count(*) FILTER (WHERE content IS NULL) AS missing_content,
 round(avg(content_length), 6) AS avg_content_length, round(avg(CAST(has_picture AS DOUBLE)), 6) AS has_picture_ratio,
 round(avg(CAST(is_reply AS DOUBLE)), 6) AS reply_ratio, round(avg(sentiment_score), 6) AS avg_sentiment_score,
 count(*) FILTER (WHERE is_kol) AS kol_count FROM cleaned"""))
def _(t):
    m = aggregates.quality_metrics(_cleaned(t))
    return m.select(*[F.round(c, 6).alias(c) if d == "double" else F.col(c) for c, d in m.dtypes])


@add("cleaning_report", with_clean("""SELECT (SELECT count(*) FROM raw) AS raw_records, count(*) AS cleaned_records,
 (SELECT count(*) FILTER (WHERE content IS NULL) FROM raw) AS missing_content,
 printf('%.2f%%', count(*) * 100.0 / (SELECT count(*) FROM raw)) AS retention_rate,
 strftime(min(create_time), '%Y-%m-%d %H:%M:%S') AS start,
 count(*) FILTER (WHERE sentiment_label = '正面') AS positive,
 count(*) FILTER (WHERE location_standard = '中国') AS china, 25 AS added FROM cleaned"""))
def _(t):
    # The report asks the raw rows for counts alone: a stored copy would write every text to save two narrow scans.  Of the cleaned
    # rows it asks no text but whether there is one; what the texts tell is in the columns beside them.
    clean = _cleaned(t).withColumn("content_clean", F.substring("content_clean", 1, 0))
    text = report.cleaning_report(t.raw, stage(clean, "cleaned"))
    parsed = F.from_json("report", """raw_data struct<total_records:bigint,missing_values:map<string,bigint>>,
      cleaned_data struct<total_records:bigint,retention_rate:string>,
      cleaning_stats struct<new_features_added:array<string>>,
      data_quality_metrics struct<time_range:struct<start:string>,location_distribution:map<string,bigint>,
        sentiment_distribution:map<string,bigint>>""")
    r = text.select(parsed.alias("r"))
    return r.select(
        F.col("r.raw_data.total_records").alias("raw_records"),
        F.col("r.cleaned_data.total_records").alias("cleaned_records"),
        F.col("r.raw_data.missing_values")["content"].alias("missing_content"),
        F.col("r.cleaned_data.retention_rate"), F.col("r.data_quality_metrics.time_range.start").alias("start"),
        F.col("r.data_quality_metrics.sentiment_distribution")["正面"].alias("positive"),
        F.col("r.data_quality_metrics.location_distribution")["中国"].alias("china"),
        F.size("r.cleaning_stats.new_features_added").alias("added"))


# --- heat, trend, activity -------------------------------------------------------------------

_SCORED = f"""SELECT *, {place_sql('ip_location', fv.PROVINCE_RULES, fv.UNKNOWN_PLACE)} AS location_province,
 {net_sql('content')} AS s FROM comments"""


def _scored(t):
    return opinion.scored(t.comments.withColumn("location_province", places.extract_province(F.col("ip_location"))))


_HEAT = f"""SELECT location_province, count(*) AS count, {round2('avg(s)')} AS avg_sentiment FROM ({_SCORED}) AS x
 WHERE location_province NOT IN ('未知', '') GROUP BY 1"""


@add("province_heat", with_comments(_HEAT))
def _(t):
    return aggregates.province_heat(_scored(t))


@add("top_provinces", with_comments(f"{_HEAT} ORDER BY count DESC, 1 LIMIT 34"))
def _(t):
    return topk.top_provinces(aggregates.province_heat(_scored(t)))


@add("top15_reversed", with_comments(f"SELECT * FROM ({_HEAT} ORDER BY count DESC, 1 LIMIT 15) AS h ORDER BY count"))
def _(t):
    return topk.top15_reversed(aggregates.province_heat(_scored(t)))


@add("minmax_normalise", with_comments(f"""SELECT location_province, round(CASE WHEN max(avg_sentiment) OVER ()
 = min(avg_sentiment) OVER () THEN 0 ELSE (avg_sentiment - min(avg_sentiment) OVER ()) / (max(avg_sentiment) OVER ()
 - min(avg_sentiment) OVER ()) END, 6) AS shade FROM ({_HEAT}) AS h"""))
def _(t):
    heat = aggregates.province_heat(_scored(t))
    return aggregates.minmax_normalise(heat, "avg_sentiment", "shade").select(
        "location_province", F.round("shade", 6).alias("shade"))


@add("daily_trend", with_comments(f"""SELECT strftime(create_time, '%Y-%m-%d') AS date, count(*) AS daily_count,
 {round2('avg(s)')} AS daily_sentiment FROM ({_SCORED}) AS x GROUP BY 1"""))
def _(t):
    return aggregates.daily_trend(_scored(t)).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@add("heat_and_trend_places", with_comments(f"{_HEAT} ORDER BY count DESC, 1 LIMIT 34"))
def _(t):
    return opinion.heat_and_trend(_placed(t))[0]


@add("heat_and_trend_days", with_comments(f"""SELECT strftime(create_time, '%Y-%m-%d') AS date, count(*) AS daily_count,
 {round2('avg(s)')} AS daily_sentiment FROM ({_SCORED}) AS x GROUP BY 1"""))
def _(t):
    return opinion.heat_and_trend(_placed(t))[1].withColumn("date", F.date_format("date", "yyyy-MM-dd"))


_STATS = """SELECT user_id, count(comment_id) AS user_comment_count, CAST(sum(like_count) AS BIGINT) AS user_total_likes,
 CAST(sum(sub_comment_count) AS BIGINT) AS user_total_replies, count(*) AS user_rows,
 count(comment_id) * 1e0 + sum(like_count) * 1e-1 + sum(sub_comment_count) * 5e-1 AS score
 FROM comments GROUP BY user_id"""


@add("user_activity", with_comments(f"SELECT * EXCLUDE score, round(score, 4) AS user_activity_score FROM ({_STATS}) "
                                    "AS s"))
def _(t):
    return aggregates.user_activity(t.comments).withColumn(
        "user_activity_score", F.round("user_activity_score", 4))


@add("activity_score", """SELECT o_custkey, round(count(*) * 1e0 + sum(o_totalprice) * 1e-1 + count(DISTINCT
 o_orderstatus) * 5e-1, 3) AS score FROM orders GROUP BY 1""")
def _(t):
    g = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("p"),
                                          F.countDistinct("o_orderstatus").alias("k"))
    return g.select("o_custkey", F.round(numbers.activity_score(F.col("n"), F.col("p"), F.col("k")), 3).alias("score"))


@add("activity_quantile", with_comments(
    f"SELECT round(quantile_cont(score, 0.9), 6) AS threshold FROM comments JOIN ({_STATS}) AS s USING (user_id)"))
def _(t):
    limit = joins.activity_threshold(stage(aggregates.user_activity(t.comments), "activity"))
    return t.spark.range(1).select(F.round(F.lit(limit), 6).alias("threshold"))


@add("exact_quantile", """SELECT round(quantile_cont(o_totalprice, 0.25), 4) AS p25,
 round(quantile_cont(o_totalprice, 0.5), 4) AS p50, round(quantile_cont(o_totalprice, 0.9), 4) AS p90 FROM orders""")
def _(t):
    values = [aggregates.exact_quantile(t.orders, "o_totalprice", p) for p in (0.25, 0.5, 0.9)]
    return t.spark.range(1).select(*[F.round(F.lit(v), 4).alias(n) for v, n in
                                     zip(values, ("p25", "p50", "p90"), strict=True)])


@add("flag_kol", with_comments(f"""SELECT comment_id, score >= quantile_cont(score, 0.9) OVER () AS is_kol
 FROM comments JOIN ({_STATS}) AS s USING (user_id)"""))
def _(t):
    stats = stage(aggregates.user_activity(t.comments), "activity")
    rows = joins.attach_user_stats(t.comments.select("comment_id", "user_id"), stats)
    return joins.flag_kol(rows, joins.activity_threshold(stats)).select("comment_id", "is_kol")


@add("attach_user_stats", with_comments(f"""SELECT comment_id, user_comment_count, user_total_likes,
 user_total_replies, round(score, 4) AS score FROM comments JOIN ({_STATS}) AS s USING (user_id)"""))
def _(t):
    rows = joins.attach_user_stats(t.comments)
    return rows.select("comment_id", "user_comment_count", "user_total_likes", "user_total_replies",
                       F.round("user_activity_score", 4).alias("score"))


# --- counts and profiles ---------------------------------------------------------------------


@add("word_frequency", "SELECT term, count(*) AS count FROM (SELECT unnest("
     + TOKENS_SQL.format("text") + ") AS term FROM documents) AS w WHERE term NOT IN (SELECT DISTINCT lang "
     "FROM documents) GROUP BY term")
def _(t):
    stops = t.documents.select(F.col("lang").alias("term")).distinct()
    return aggregates.word_frequency(t.spread_documents.select(tokenize(F.col("text")).alias("words")), stop_words=stops)


@add("most_frequent_terms", "SELECT term, count(*) AS count FROM (SELECT unnest("
     + FILTERED_SQL.format("text") + ") AS term FROM documents) AS w GROUP BY term ORDER BY 2 DESC, 1 LIMIT 150")
def _(t):
    words = t.spread_documents.select(drop_stop_words(tokenize(F.col("text")), STOPS).alias("words"))
    return topk.most_frequent_terms(aggregates.word_frequency(words))


@add("vocabulary_frequency", f"""WITH w AS (SELECT doc_id, unnest({FILTERED_SQL.format('text')}) AS term
 FROM documents) SELECT term, count(*) AS count, count(DISTINCT doc_id) AS doc_count FROM w GROUP BY term
 HAVING count(DISTINCT doc_id) >= 2 ORDER BY 2 DESC, 1 LIMIT 2000""")
def _(t):
    words = t.spread_documents.select(drop_stop_words(tokenize(F.col("text")), STOPS).alias("words"))
    return mining.vocabulary(words, size=2000, min_df=2)


@add("cluster_share", """SELECT label AS cluster_id, count(*) AS count,
 round(count(*) * 100.0 / (SELECT count(*) FROM embeddings), 1) AS percent FROM embeddings GROUP BY 1""")
def _(t):
    return aggregates.cluster_share(t.embeddings.withColumnRenamed("label", "cluster_id"))


@add("label_lookup", "SELECT vec_id, CASE label " + " ".join(
    f"WHEN {i} THEN {q(n)}" for i, n in fv.TOPIC_NAMES.items())
    + " ELSE 'Cluster ' || CAST(label AS VARCHAR) END AS topic FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", aggregates.topic_label(F.col("label")).alias("topic"))


_RAW_TYPES = {"comment_id": "bigint", "create_time": "timestamp_ntz", "last_modify_ts": "timestamp_ntz",
              "ip_location": "string", "note_id": "bigint", "content": "string", "user_id": "bigint",
              "nickname": "string", "avatar": "string", "sub_comment_count": "bigint", "pictures": "string",
              "parent_comment_id": "bigint", "like_count": "bigint"}


@add("null_profile", with_comments(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{d}' AS type, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM raw"
    for c, d in _RAW_TYPES.items())))
def _(t):
    return aggregates.null_profile(t.raw)


@add("retention", with_comments(f"""SELECT count(*) AS raw_records, count(*) FILTER (WHERE ok) AS cleaned_records,
 count(*) FILTER (WHERE NOT ok) AS records_removed, printf('%.2f%%', count(*) FILTER (WHERE ok) * 100.0 / count(*))
 AS retention_rate FROM (SELECT content IS NOT NULL AND user_id IS NOT NULL AND coalesce(create_time, last_modify_ts)
 IS NOT NULL AND length({clean_text_sql('content')}) > 0 AS ok FROM raw) AS s"""))
def _(t):
    return aggregates.retention(t.raw, cleaning.prepared(t.raw))


@add("time_range", with_comments("""SELECT strftime(min(create_time), '%Y-%m-%d %H:%M:%S') AS start,
 strftime(max(create_time), '%Y-%m-%d %H:%M:%S') AS end FROM raw"""))
def _(t):
    return aggregates.time_range(t.raw)


@add("value_counts", with_comments(
    f"SELECT location_standard, count(*) AS count FROM (SELECT "
    f"{place_sql('ip_location', fv.COUNTRY_RULES, fv.OTHER_REGION)} AS location_standard FROM comments) AS s GROUP BY 1"))
def _(t):
    return aggregates.value_counts(t.comments.select(
        places.standardize_location(F.col("ip_location")).alias("location_standard")), "location_standard")


@add("keyword_yield", "SELECT source AS source_keyword, count(*) AS posts FROM documents GROUP BY 1")
def _(t):
    return aggregates.keyword_yield(t.documents.withColumnRenamed("source", "source_keyword"))


# --- length and sentiment --------------------------------------------------------------------

# The test documents are longer than posts; the reported length is in units of ten characters.
_LENGTHS = f"""SELECT comment_id, CAST(ceil(length(content) / 10.0) AS BIGINT) AS content_len, {TRAINING_NET} AS score
 FROM comments"""


def _lengths(t):
    return t.comments.select("comment_id", F.ceil(F.length("content") / 10.0).alias("content_len"),
                             training_score().alias("score")).withColumn(
        "norm_score", numbers.sentiment_density(F.col("score"), F.col("content_len")))


@add("boxplot_stats", with_comments(f""", v AS (SELECT CASE WHEN content_len <= 20 THEN '短评 (<20字)'
 WHEN content_len <= 60 THEN '中评 (20-60字)' ELSE '长评 (>60字)' END AS len_group, score / content_len * 100 AS x
 FROM ({_LENGTHS}) AS l WHERE content_len <= 200 AND content_len > 0 AND score <> 0),
 b AS (SELECT len_group, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
  quantile_cont(x, 0.75) AS q3 FROM v GROUP BY 1)
 SELECT len_group, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(least(min(x) FILTER (WHERE x >= q1 - (q3 - q1) * 1.5), q1), 6) AS whisker_low,
  round(greatest(max(x) FILTER (WHERE x <= q3 + (q3 - q1) * 1.5), q3), 6) AS whisker_high
 FROM v JOIN b USING (len_group) GROUP BY len_group, n, b.q1, b.median, b.q3"""))
def _(t):
    # Quartiles read their rows once a pass: numbers are stored, so texts are joined and measured once.
    rows = stage(_lengths(t).filter("content_len <= 200 AND score <> 0").select("content_len", "norm_score"), "lengths")
    stats = aggregates.boxplot_stats(rows)
    return stats.select("len_group", "n", *[F.round(c, 6).alias(c) for c in
                                            ("q1", "median", "q3", "whisker_low", "whisker_high")])


# Real-valued scores, one per row: no two need be equal.
@add("boxplot_real_scores", with_comments(""", v AS (SELECT CASE WHEN n <= 20 THEN '短评 (<20字)'
 WHEN n <= 60 THEN '中评 (20-60字)' ELSE '长评 (>60字)' END AS len_group, x FROM (SELECT 1 + comment_id % 200 AS n,
 ln(2 + (comment_id * 7919) % 10007) * sqrt(1 + comment_id) AS x FROM comments) AS s),
 b AS (SELECT len_group, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM v GROUP BY 1)
 SELECT len_group, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(least(min(x) FILTER (WHERE x >= q1 - (q3 - q1) * 1.5), q1), 6)
 AS whisker_low, round(greatest(max(x) FILTER (WHERE x <= q3 + (q3 - q1) * 1.5), q3), 6) AS whisker_high FROM v JOIN b USING (len_group)
 GROUP BY len_group, n, b.q1, b.median, b.q3"""))
def _(t):
    rows = t.comments.select((1 + F.col("comment_id") % 200).alias("n"), F.expr("ln(2 + (comment_id * 7919) % 10007) * sqrt(1 + comment_id)").alias("x"))
    stats = aggregates.boxplot_stats(rows, "n", "x")
    return stats.select("len_group", "n", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")])


_BUCKET = "(CAST(('0x' || substr(md5({salt} || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) % 100)"


@add("length_sentiment_table", with_comments(
    f"SELECT CAST(length(content) AS BIGINT) AS content_len, round({TRAINING_NET} / length(content) * 100, 6) AS "
    f"norm_score FROM comments WHERE length(content) > 0 AND {_BUCKET.format(salt=q('sample'), key='comment_id')} < 50"))
def _(t):
    rows = topics.length_sentiment(t.comments, "comment_id")
    return rows.select("content_len", F.round("norm_score", 6).alias("norm_score"))


@add("random_split", f"""SELECT event_id, {_BUCKET.format(salt=q('split'), key='event_id')} < 80 AS train
 FROM events""")
def _(t):
    train, test = mining.random_split(t.events, "event_id")
    return train.select("event_id", F.lit(True).alias("train")).union(test.select("event_id", F.lit(False)))


@add("keyed_sample", f"SELECT event_id FROM events WHERE {_BUCKET.format(salt=q('sample'), key='event_id')} < 50")
def _(t):
    return mining.sample(t.events, "event_id").select("event_id")
