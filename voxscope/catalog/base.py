"""Registration of queries, and the comment tables derived from the given tables.

The given tables hold no social-media comments.  ``COMMENTS`` derives them: one comment per
event, with the whole text of a document, decorated with the links, mentions, emoji
placeholders, tags and opinion words the operators look for.  The statement runs unchanged in
Spark and in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
         "labels conversations").split()

# Where the customers of each nation write from.
PLACES = ["北京", "上海", "广东", "江苏", "浙江", "四川", "湖北武汉", "黑龙江", "内蒙古", "Guangdong Shenzhen",
          "Xian", "美国", "USA", "Japan", "日本", "韩国", "Europe", "United Kingdom", "加拿大", "Australia",
          "Africa", "中国香港", "火星", "未知", "山西"]
_PLACE_CASE = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PLACES))

COMMENTS = f"""
WITH keyed AS (
 SELECT *, event_id % (SELECT count(*) FROM {{documents}}) AS doc_key,
  (event_id * 31 + 7) % (SELECT max(user_id) + 1 FROM {{events}}) AS target_id
 FROM {{events}}),
base AS (
 SELECT e.event_id, e.ts, e.user_id, e.target_id, e.event_type, e.value, e.props, d.doc_id, d.lang, d.source,
  concat(coalesce(d.text, ''), CASE e.event_type WHEN 'purchase' THEN ' 喜欢 推荐 不错' WHEN 'error' THEN ' 垃圾 失望 贵'
   WHEN 'click' THEN ' 好' WHEN 'signup' THEN ' 焦虑 支持 难' ELSE '' END) AS body,
  CASE c.c_nationkey {_PLACE_CASE} END AS place
 FROM keyed e
 LEFT JOIN {{documents}} d ON d.doc_id = e.doc_key
 LEFT JOIN {{customer}} c ON c.c_custkey = e.user_id),
comments AS (
 SELECT event_id AS comment_id, ts AS create_time, doc_id AS note_id, user_id,
  concat('user_', CAST(user_id AS STRING)) AS nickname,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE place END AS ip_location,
  CASE event_id % 8
   WHEN 0 THEN concat('回复 user_', CAST(target_id AS STRING), ': ', body)
   WHEN 1 THEN concat('@user_', CAST(target_id AS STRING), ' ', body)
   WHEN 2 THEN concat(body, ' https://a.example.com/p?id=', CAST(doc_id AS STRING))
   WHEN 3 THEN concat('[doge]', body, ' <b>x</b>')
   WHEN 4 THEN concat('  ', body, chr(9), chr(10), ' end')
   WHEN 5 THEN CASE WHEN event_id % 3 = 0 THEN concat('转发 ', body) ELSE body END
   ELSE body END AS content,
  event_type, lang, source AS source_keyword,
  CAST(floor(value) AS BIGINT) AS like_count,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS sub_comment_count,
  CASE WHEN event_id % 3 = 0 AND event_id >= 7 THEN event_id - 7 ELSE 0 END AS parent_comment_id,
  CASE WHEN event_id % 17 = 0 THEN 'https://x.example/default.png' WHEN event_id % 31 = 0 THEN NULL
       ELSE concat('https://x.example/', CAST(user_id AS STRING)) END AS avatar,
  CASE WHEN event_id % 13 = 0 THEN 'https://x.example/p.png' ELSE '' END AS pictures
 FROM base),
raw AS (
 SELECT comment_id, CASE WHEN comment_id % 29 = 0 THEN NULL ELSE create_time END AS create_time,
  CASE WHEN comment_id % 58 = 0 THEN NULL ELSE create_time + INTERVAL '1' HOUR END AS last_modify_ts,
  ip_location, note_id, CASE WHEN comment_id % 23 = 0 THEN NULL ELSE content END AS content,
  CASE WHEN comment_id % 37 = 0 THEN NULL ELSE user_id END AS user_id, nickname, avatar,
  CASE WHEN comment_id % 5 = 0 THEN NULL ELSE sub_comment_count END AS sub_comment_count, pictures,
  parent_comment_id, CASE WHEN comment_id % 7 = 0 THEN NULL ELSE like_count END AS like_count
 FROM comments)"""

# The same joins for Spark.  The one that brings the texts comes last, so that what is shuffled for the other is narrow, and as a
# merge: it spreads the rows whatever files they come from, and a file's size says little about its texts, so they are not broadcast.
# Nor do the bytes of the keys: tasks are dealt by number of comments, so that what a task sorts with its texts fits its memory.
_WIDE, _NARROW = " LEFT JOIN {documents} d ON d.doc_id = e.doc_key", " LEFT JOIN {customer} c ON c.c_custkey = e.user_id"
_TEXTS_LAST = COMMENTS.replace(f"FROM keyed e\n{_WIDE}\n{_NARROW}", f"""FROM (SELECT /*+ REPARTITION({{tasks}}, doc_key) */ e.*, c.c_nationkey
 FROM keyed e{_NARROW}) e\n{_WIDE}""").replace("CASE c.c_nationkey", "CASE e.c_nationkey").replace(
    "SELECT e.event_id", "SELECT /*+ MERGE(d) */ e.event_id")
COMMENTS_A_TASK = 25_000

_DUCK = COMMENTS.format(**{n: n for n in NAMES})


def with_comments(sql: str) -> str:
    """DuckDB statement over the derived ``comments`` and ``raw`` tables.

    ``sql`` is a SELECT, or further named queries and a SELECT when it starts with a comma.
    """
    return f"{_DUCK}{sql}" if sql.lstrip().startswith(",") else f"{_DUCK}\n{sql}"


class Tables:
    """The given tables, and the ones derived from them, as frames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _derived(self, name: str) -> DataFrame:
        """A derived table, as a plan: a query joins in only what it reads.

        A comment repeats its document's text, so a stored table would hold each text many times.  Here the texts are
        shuffled once, to meet the keys of their comments, and grow with the documents and not with the comments.
        """
        used = {n: getattr(self, n) for n in ("events", "documents", "customer")}
        return self.spark.sql(f"{_TEXTS_LAST} SELECT * FROM {name}", tasks=self._tasks, **used)

    @cached_property
    def _tasks(self) -> int:
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return max(least, -(-self.events.count() // COMMENTS_A_TASK))

    @property
    def spread_documents(self) -> DataFrame:
        """Documents over all cores, for heavy work per text; the table may be a single file."""
        return self.documents.repartition("doc_id")

    @cached_property
    def comments(self) -> DataFrame:
        return self._derived("comments")

    @cached_property
    def raw(self) -> DataFrame:
        return self._derived("raw")


@dataclass(frozen=True)
class Entry:
    run: Callable[[Tables], DataFrame]
    sql: str | None


class Registry(dict):
    """Name -> Entry, filled by decorating the Spark side with the DuckDB side."""

    def add(self, name: str, sql: str | None = None):
        def register(run: Callable[[Tables], DataFrame]):
            if name in self:
                raise ValueError(f"{name} is registered twice")
            self[name] = Entry(run, sql)
            return run

        return register
