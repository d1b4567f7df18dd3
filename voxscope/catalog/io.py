"""Writers and readers: every query writes whole tables and checks what comes back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tokens import tokenize
from ..operators.aggregates import word_frequency
from ..session import stage_path
from ..sources import csv_safe, sinks
from ..sources.word_lists import read_stop_words
from .base import Registry, with_comments

registry = Registry()
add = registry.add

_COMMENT = ["comment_id", "note_id", "nickname", "content"]
_PACKED = "gzip"  # comments repeat their documents' texts, and text files hold each of them
# CSV cannot tell '' from null; neither occurs in these columns.
_COMMENT_SQL = "SELECT CAST(comment_id AS VARCHAR) AS comment_id, CAST(note_id AS VARCHAR) AS note_id, nickname, " \
               "md5(content) AS content_md5 FROM comments"


def _large(t, least):
    """How many tasks write the comments where they lie, each the rows of eight; so no text is shuffled for large files."""
    return max(least, t._tasks // 8)


def _writers(t):
    return _large(t, t.spark.sparkContext.defaultParallelism)


def _as_text(df):
    return df.select("comment_id", "note_id", "nickname", F.md5("content").alias("content_md5"))


@add("read_csv_safe", with_comments(_COMMENT_SQL))
def _(t):
    path = stage_path(t.spark, "csv")
    t.comments.select(_COMMENT).write.options(**sinks._CSV_WRITE, compression=_PACKED).csv(path)
    return _as_text(csv_safe.read_csv_safe(t.spark, path))


@add("read_csv_split", with_comments(f"SELECT c.*, false AS corrupt FROM ({_COMMENT_SQL}) AS c"))
def _(t):
    path = stage_path(t.spark, "csv-split")
    t.comments.select(_COMMENT).coalesce(_large(t, 2)).write.options(**sinks._CSV_WRITE).csv(path)
    rows = csv_safe.read_csv_split(t.spark, path)
    return rows.select("comment_id", "note_id", "nickname", F.md5("content").alias("content_md5"), F.col("_corrupt_record").isNotNull().alias("corrupt"))


@add("read_csv_inferred", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = stage_path(t.spark, "csv-inferred")
    columns = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    t.customer.select(columns).write.option("header", "true").csv(path)
    found = csv_safe.read_csv_inferred(t.spark, path)
    assert [kind for _, kind in found.dtypes] == ["int", "string", "double", "string"]
    return found.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), *columns[1:])


@add("write_outputs", with_comments(f"""SELECT f.format, c.* FROM ({_COMMENT_SQL}) AS c,
 (VALUES ('parquet'), ('csv'), ('jsonl')) AS f(format)"""))
def _(t):
    rows = t.comments.select(*_COMMENT, F.to_date("create_time").alias("date"))
    folders = sinks.write_outputs(rows, stage_path(t.spark, "outputs"), partition_by="date", compression=_PACKED, tasks=_writers(t), table_compression="zstd")
    schema = "comment_id bigint, note_id bigint, nickname string, content string, date date"
    back = {"parquet": t.spark.read.parquet(folders["parquet"]), "csv": csv_safe.read_csv_safe(t.spark, folders["csv"]),
            "jsonl": t.spark.read.schema(schema).json(folders["jsonl"])}
    parts = [_as_text(df).select(F.lit(name).alias("format"), F.col("comment_id").cast("string").alias("comment_id"), F.col(
        "note_id").cast("string").alias("note_id"), "nickname", "content_md5") for name, df in back.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@add("write_single_csv", """SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(count(*) AS VARCHAR) AS n, '1' AS files
 FROM events GROUP BY user_id""")
def _(t):
    path = stage_path(t.spark, "single")
    sinks.write_single_csv(t.events.groupBy("user_id").agg(F.count("*").alias("n")), path)
    rows = csv_safe.read_csv_safe(t.spark, path)
    names = t.spark.read.text(path).select(F.input_file_name().alias("f")).distinct()
    files = names.agg(F.count("*")).scalar()
    return rows.select("user_id", "n", files.cast("string").alias("files"))


def _parts(df):
    return df.select(F.lit("xhs").alias("platform"), F.lit("search").alias("crawl_type"),
                     F.col("event_type").alias("item"), F.to_date("create_time").alias("dt"), "comment_id", "content")


_APPENDED = """SELECT item, dt, CAST(comment_id AS VARCHAR) AS comment_id, md5(content) AS content_md5 FROM (SELECT event_type AS item,
 strftime(create_time, '%Y-%m-%d') AS dt, comment_id, content FROM comments UNION ALL
 SELECT event_type, strftime(create_time, '%Y-%m-%d'), comment_id, content FROM comments WHERE like_count > 100) AS a"""


def _register_append(name, append, read):
    @add(name, with_comments(_APPENDED))
    def _(t):
        path = stage_path(t.spark, name)
        append(_parts(t.comments), path, compression=_PACKED, tasks=_writers(t))
        append(_parts(t.comments.filter("like_count > 100")), path, compression=_PACKED, tasks=_writers(t))
        return read(t.spark, path).select("item", F.date_format(F.col("dt").cast("date"), "yyyy-MM-dd").alias("dt"), F.col(
            "comment_id").cast("string").alias("comment_id"), F.md5("content").alias("content_md5"))


_register_append("append_csv", sinks.append_csv, csv_safe.read_csv_safe)
_register_append("append_json", sinks.append_json, lambda spark, path: spark.read.schema(
    "comment_id bigint, content string, platform string, crawl_type string, item string, dt date").json(path))


@add("stop_words", """SELECT term, count(*) AS count FROM (SELECT unnest(regexp_extract_all(text,
 '[0-9A-Za-z\\x{c0}-\\x{24f}]{2,}|[\\x{4e00}-\\x{9fff}]{2,}')) AS term FROM documents) AS w
 WHERE term NOT IN (SELECT DISTINCT lang FROM documents UNION SELECT 'the') GROUP BY term""")
def _(t):
    path = stage_path(t.spark, "stop-words")
    words = t.documents.select("lang").unionByName(t.spark.createDataFrame([("the",), ("",)], "lang string"))
    words.distinct().write.text(path)
    tokens = t.spread_documents.select(tokenize(F.col("text")).alias("words"))
    return word_frequency(tokens, stop_words=read_stop_words(t.spark, path))


@add("upsert_sink", with_comments("""SELECT note_id, nickname, like_count, comment_id FROM comments
 QUALIFY row_number() OVER (PARTITION BY note_id ORDER BY late DESC, comment_id DESC) = 1""").replace(
     "FROM comments\n QUALIFY", "FROM (SELECT *, create_time >= TIMESTAMP '2024-01-16 00:00:00' AS late "
     "FROM comments) AS c QUALIFY"))
def _(t):
    path = stage_path(t.spark, "upsert-sink")
    split = F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    cols = ["note_id", "nickname", "like_count", "comment_id"]
    for batch in (t.comments.filter(F.col("create_time") < split), t.comments.filter(F.col("create_time") >= split)):
        stored = sinks.upsert_table(batch.select(cols), path, ["note_id"], ["comment_id"])
    return stored


@add("select_all", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(t):
    return sinks.read_table(t.spark, f"{t.folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")


@add("find_many", """(SELECT 'all' AS q, o_orderkey FROM orders WHERE o_orderstatus = 'F') UNION ALL
 (SELECT 'three', o_orderkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 3) UNION ALL
 (SELECT 'one', o_orderkey FROM orders WHERE o_custkey = 7 ORDER BY o_orderkey LIMIT 1)""")
def _(t):
    found = {"all": sinks.find_many(t.orders, {"o_orderstatus": "F"}),
             "three": sinks.find_many(t.orders, {"o_orderstatus": "P"}, 3, "o_orderkey"),
             "one": sinks.find_one(t.orders, {"o_custkey": 7}, "o_orderkey")}
    frames = [df.select(F.lit(n).alias("q"), "o_orderkey") for n, df in found.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@add("write_bundle", """SELECT 'Contents' AS sheet, count(*) AS n, '0:' || CAST(count(*) FILTER (WHERE lang = 'en')
 AS VARCHAR) AS detail FROM documents UNION ALL SELECT 'Creators', count(*),
 CAST(count(*) FILTER (WHERE c_acctbal < 0) AS VARCHAR) || ':' || CAST(count(*) AS VARCHAR) FROM customer""")
def _(t):
    sheets = {
        "Contents": t.documents.select("doc_id", "lang", F.array("source").alias("tags")),
        "Creators": t.customer.select("c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
                                      F.lit("en").alias("lang")),
        "Comments": t.events.filter("event_id < 0"),
    }
    written = sinks.write_bundle(sheets, stage_path(t.spark, "bundle"))
    frames = [t.spark.read.parquet(path).withColumn("sheet", F.lit(name)) for name, path in written.items()]
    blank = F.count(F.when(F.col("balance") == "", 1)) if len(frames) == 2 else F.lit(0)
    both = frames[0].unionByName(frames[1], allowMissingColumns=True)
    return both.groupBy("sheet").agg(F.count("*").alias("n"), F.concat_ws(
        ":", blank.cast("string"), F.count(F.when(F.col("lang") == "en", 1)).cast("string")).alias("detail"))


@add("sink_factory", """SELECT f.format, CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority
 FROM orders, (VALUES ('csv'), ('json'), ('parquet'), ('excel'), ('db'), ('sqlite'), ('mongodb')) AS f(format)""")
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    parts = []
    for fmt in ("csv", "json", "parquet", "excel", "db", "sqlite", "mongodb"):
        path = stage_path(t.spark, f"sink-{fmt}")
        sinks.create_sink(fmt)(rows, path, keys=["o_orderkey"], order=["o_custkey"])
        if fmt in ("db", "sqlite", "mongodb"):
            back = sinks.read_keyed(t.spark, path)
        elif fmt in ("csv", "json"):
            back = t.spark.read.format(fmt).options(header="true").load(path)
        else:
            back = t.spark.read.parquet(f"{path}/Contents" if fmt == "excel" else path)
        parts.append(back.select(F.lit(fmt).alias("format"), *[F.col(c).cast("string").alias(c) for c in ("o_orderkey", "o_custkey")], "o_orderpriority"))
    return reduce(DataFrame.unionByName, parts)


# Three batches of documents with different fields: what a batch does not carry stays.
@add("document_sink_fields", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'third' ELSE o_orderstatus END AS status,
 CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS customer, CASE WHEN o_orderkey % 5 = 0 THEN 3 ELSE 1 END AS seq FROM orders""")
def _(t):
    path = stage_path(t.spark, "documents")
    key = F.col("o_orderkey")
    batches = [t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.lit(1).alias("seq")),
               t.orders.where(key % 3 == 0).select("o_orderkey", F.col("o_custkey").alias("customer")),
               t.orders.where(key % 5 == 0).select("o_orderkey", F.lit("third").alias("status"), F.lit(3).alias("seq"))]
    for batch in batches:
        sinks.upsert_documents(batch, path, ["o_orderkey"], ["o_orderkey"])
    return sinks.read_keyed(t.spark, path).select("o_orderkey", "status", "customer", "seq")
