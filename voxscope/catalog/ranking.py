"""Deduplication, gaps and bursts, caps, top-k, unions and schema comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, merge, topk
from ..plans import opinion
from ..session import stage
from .base import Registry, with_comments
from .text import MENTION_SQL

registry = Registry()
add = registry.add


@add("dedup_keep_first", """SELECT doc_id FROM documents
 QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def _(t):
    return dedup.dedup_keep_first(t.documents, "text", "doc_id").select("doc_id")


@add("dedup_any", "SELECT md5(text) AS text_md5 FROM (SELECT DISTINCT text FROM documents) AS d")
def _(t):
    return dedup.dedup_any(t.documents, ["text"]).select(F.md5("text").alias("text_md5"))


@add("dedup_whole_rows", "SELECT DISTINCT user_id, event_type FROM events")
def _(t):
    return dedup.dedup_any(t.events.select("user_id", "event_type"))


_GAP = """(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6"""


@add("time_since_prev_by_user", f"SELECT event_id, round({_GAP}, 6) AS gap FROM events")
def _(t):
    rows = dedup.time_since_prev(t.events, ts="ts", tie="event_id", out="gap")
    return rows.select("event_id", F.round("gap", 6).alias("gap"))


@add("burst_spam_filter", with_comments("""SELECT comment_id FROM (SELECT comment_id, content, (epoch_us(create_time)
 - lag(epoch_us(create_time)) OVER (PARTITION BY user_id ORDER BY create_time, comment_id)) / 1e6 AS gap
 FROM comments) AS g WHERE NOT coalesce(gap < 3600 AND length(content) < 1500, false)"""))
def _(t):
    return dedup.burst_spam_filter(t.comments, 3600, 1500, text="content").select("comment_id")


@add("cap_per_group", with_comments("""SELECT note_id, comment_id FROM comments
 QUALIFY row_number() OVER (PARTITION BY note_id ORDER BY create_time, comment_id) <= 3"""))
def _(t):
    return topk.cap_per_group(t.comments, "note_id", ["create_time", "comment_id"], 3).select("note_id", "comment_id")


@add("cap_per_day_and_total", """SELECT event_type, event_id FROM (SELECT event_type, event_id, ts FROM events
 QUALIFY row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id) <= 4) AS d
 QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 50""")
def _(t):
    return topk.cap_per_day_and_total(t.events, "event_type", "ts", ["ts", "event_id"], 4, 50).select(
        "event_type", "event_id")


@add("latest_per_key", """SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def _(t):
    return topk.latest_per_key(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderstatus")


EDGES_SQL = f"""SELECT trim(nickname) AS src, trim({MENTION_SQL}) AS dst, count(*) AS weight FROM comments
 WHERE length({MENTION_SQL}) > 0 GROUP BY 1, 2"""


@add("node_tiers", """SELECT *, CASE WHEN position <= 5 THEN 'highlighted' WHEN position <= 10 THEN 'labelled'
 ELSE 'shown' END AS tier FROM (SELECT c_name AS user, c_acctbal AS pagerank,
 row_number() OVER (ORDER BY c_acctbal DESC, c_name) AS position FROM customer) AS r WHERE position <= 50""")
def _(t):
    return topk.node_tiers(t.customer.select(F.col("c_name").alias("user"), F.col("c_acctbal").alias("pagerank")))


@add("ranked_search", with_comments("""(SELECT 'popular' AS sort, comment_id FROM comments
 ORDER BY like_count DESC, comment_id LIMIT 20) UNION ALL (SELECT 'latest', comment_id FROM comments
 ORDER BY create_time DESC, comment_id LIMIT 20) UNION ALL (SELECT 'oldest', comment_id FROM comments
 ORDER BY create_time, comment_id LIMIT 20) UNION ALL (SELECT 'most_replied', comment_id FROM comments
 ORDER BY sub_comment_count DESC, comment_id LIMIT 20)"""))
def _(t):
    found = [topk.ranked_search(t.comments, s, 20).select(F.lit(s).alias("sort"), "comment_id")
             for s in ("popular", "latest", "oldest", "most_replied")]
    return merge.union_by_name(*found)


@add("ranked_search_contents", """(SELECT 'most_clicked' AS sort, doc_id AS content_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50)
 UNION ALL (SELECT 'most_marked', doc_id FROM documents ORDER BY n_chars % 97 DESC, doc_id LIMIT 50)
 UNION ALL (SELECT 'most_bullet_comments', doc_id FROM documents ORDER BY n_chars % 89 DESC, doc_id LIMIT 50)""")
def _(t):
    posts = t.documents.select(F.col("doc_id").alias("content_id"), F.col("n_chars").alias("view_count"), (
        F.col("n_chars") % 97).alias("collect_count"), (F.col("n_chars") % 89).alias("bullet_count"))
    return merge.union_by_name(*[topk.ranked_search(posts, s, 50, "content_id").select(F.lit(s).alias("sort"), "content_id")
                                 for s in ("most_clicked", "most_marked", "most_bullet_comments")])


@add("union_by_name", """SELECT doc_id, text_md5, lang, quality FROM (
 SELECT doc_id, md5(text) AS text_md5, lang, NULL AS quality FROM documents
 UNION ALL SELECT doc_id, NULL, NULL, quality FROM labels) AS u""")
def _(t):
    docs = t.documents.select("doc_id", F.md5("text").alias("text_md5"), "lang")
    return merge.union_by_name(docs, t.labels.select("doc_id", "quality")).select(
        "doc_id", "text_md5", "lang", "quality")


@add("merge_update", """SELECT source, doc_id FROM (SELECT 0 AS source, doc_id, text AS content FROM documents
 UNION ALL SELECT 1, item_id, text FROM benchmark) AS u
 QUALIFY row_number() OVER (PARTITION BY content ORDER BY source, doc_id) = 1""")
def _(t):
    old = t.documents.select("doc_id", F.col("text").alias("content"), F.lit(0).alias("source"))
    new = t.benchmark.select(F.col("item_id").alias("doc_id"), F.col("text").alias("content"),
                             F.lit(1).alias("source"))
    return opinion.merge_update(old, new, ["doc_id"]).select("source", "doc_id")


_NEW_COLUMNS = ["year", "quarter", "month", "day", "hour", "day_of_week", "day_name", "date", "datetime_str"]


@add("new_feature_columns", "SELECT unnest([" + ", ".join(f"'{c}'" for c in _NEW_COLUMNS) + "]) AS new_column, "
     "count(*) AS rows_with_value FROM events WHERE ts IS NOT NULL")
def _(t):
    from ..functions.times import calendar_features
    clean = calendar_features(t.events, "ts")
    names = merge.new_feature_columns(t.events, clean)
    filled = clean.agg(*[F.count(c).alias(c) for c in names])
    return filled.select(F.inline(F.array(*[F.struct(F.lit(c).alias("new_column"), F.col(c).alias("rows_with_value"))
                                            for c in names])))


def _schemas(t):
    declared = t.documents.join(t.labels, "doc_id", "left").select(
        "lang", F.to_json(F.struct("doc_id", "text", F.concat(F.lit("n"), "n_chars").alias("n_chars"), "quality"))
        .alias("j"))
    # One frame is read from the stored documents, the other from what a new version would store.
    actual = t.documents.select("lang", F.to_json(F.struct("doc_id", "text", "source", "n_chars")).alias("j"))
    extra = t.conversations.select(F.lit("chat").alias("lang"), F.to_json(F.struct("role", "turn")).alias("j"))
    # Schemas are tiny and read several times; the records behind them are not.
    return (stage(merge.observed_schema(actual, "lang", "j"), "actual-schema"),
            stage(merge.observed_schema(declared.unionByName(extra), "lang", "j"), "declared-schema"))


_LANGS = "(SELECT DISTINCT lang AS \"table\" FROM documents) AS l"


@add("schema_diff", f"""SELECT l."table", c."column", c.actual_type, c.declared_type, c.status FROM {_LANGS},
 (VALUES ('doc_id', 'bigint', 'bigint', 'same'), ('text', 'string', 'string', 'same'),
  ('source', 'string', NULL, 'dropped'), ('n_chars', 'bigint', 'string', 'retyped'),
  ('quality', NULL, 'bigint', 'added')) AS c("column", actual_type, declared_type, status)""")
def _(t):
    return merge.schema_diff(*_schemas(t))


@add("schema_table_diff", """SELECT DISTINCT 'chat' AS "table", 'added' AS status FROM conversations""")
def _(t):
    return merge.table_diff(*_schemas(t))
