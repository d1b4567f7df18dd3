"""Operators against brute force, with one key holding a third of all rows."""

import json
import math
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxscope.operators import aggregates, dedup, graph, joins, merge, mining, topk
from voxscope.plans import cleaning, opinion, topics
from voxscope.sources import csv_safe, json_records, platforms, sinks
from voxscope.streaming import jobs


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    data = []
    for i in range(3000):
        user = 1 if i % 3 == 0 else rng.randint(2, 200)
        data.append((i, user, pd.Timestamp("2024-01-01") + pd.Timedelta(milliseconds=rng.randint(0, 10**9)),
                     "x" * rng.randint(1, 40), rng.randint(0, 50), rng.randint(0, 9)))
    pdf = pd.DataFrame(data, columns=["comment_id", "user_id", "create_time", "content_clean", "like_count",
                                      "sub_comment_count"])
    df = spark.createDataFrame(pdf).withColumn("create_time", F.col("create_time").cast("timestamp_ntz"))
    return df.repartition(7), pdf


def test_gap_equals_pandas(skewed):
    df, pdf = skewed
    ordered = pdf.sort_values(["user_id", "create_time", "comment_id"])
    want = dict(zip(ordered.comment_id, ordered.groupby("user_id").create_time.diff().dt.total_seconds(), strict=True))
    got = {r.comment_id: r.time_diff for r in dedup.time_since_prev(df, ranges=13).collect()}
    assert len(got) == len(want)
    assert all((got[k] is None and math.isnan(v)) or math.isclose(got[k], v, abs_tol=1e-6) for k, v in want.items())


def test_gaps_of_hot_users_hours_instants_and_rows_without_user(spark):
    """A third of the rows is one user's hour, another third one instant, the rest has no user: all are split."""
    at = pd.Timestamp("2024-01-01 10:00")
    data = [(i, 7 if i % 3 == 0 else 5 if i % 3 == 1 else None, at + pd.Timedelta(milliseconds=i * 37 % 3_600_000 if i % 3 == 0 else 0))
            for i in range(6000)] + [(6000, 6, None), (6001, 6, at), (6002, 8, at)]
    df = spark.createDataFrame([(i, u, None if t is None else t.to_pydatetime()) for i, u, t in data],
                               "comment_id long, user_id int, create_time timestamp_ntz").repartition(5)
    out = dedup.time_since_prev(df, ranges=12)
    want, last = {}, {}
    for i, u, t in sorted((r for r in data if r[1] is not None), key=lambda r: (r[1], r[2] or pd.Timestamp.min, r[0])):
        want[i] = None if last.get(u) is None or t is None else (t - last[u]).total_seconds()
        last[u] = t
    got = {r.comment_id: r.time_diff for r in out.collect()}
    assert len(got) == len(data) and all(got[i] == pytest.approx(want.get(i)) for i in got)
    read = next(x for x in out.inputFiles() if "ranges" in x).rsplit("/", 1)[0]
    sizes = [r["count"] for r in spark.read.parquet(read).groupBy("_range").count().collect()]
    assert len(sizes) == 12 and max(sizes) < len(data) / 6
    assert dedup.time_since_prev(df.limit(0)).collect() == []


def test_burst_filter_does_not_depend_on_ranges_or_layout(skewed):
    df, _ = skewed
    wide = rows_of(dedup.burst_spam_filter(df, 500, 20).select("comment_id"))
    fine = rows_of(dedup.burst_spam_filter(df.repartition(1), 500, 20, ranges=31).select("comment_id"))
    assert wide == fine and 0 < len(wide) < 3000


def test_quantile_equals_pandas(skewed):
    df, pdf = skewed
    for q in (0.0, 0.1, 0.5, 0.9, 0.999, 1.0):
        assert aggregates.exact_quantile(df, "like_count", q, slots=7) == pytest.approx(pdf.like_count.quantile(q))
    stats = aggregates.user_activity(df)
    score = pdf.groupby("user_id").agg(n=("comment_id", "count"), likes=("like_count", "sum"),
                                       replies=("sub_comment_count", "sum"))
    per_row = pdf.user_id.map(score.n + score.likes * 0.1 + score.replies * 0.5)
    assert joins.activity_threshold(stats) == pytest.approx(per_row.quantile(0.9))


def test_quantile_of_odd_values(spark):
    values = [0.0, 0.0, 0.0, 1e-300, 1e300, -1e300, 5.0, 5.0, 5.000000000000001]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    for q in (0.0, 0.25, 0.4, 0.8, 1.0):
        assert aggregates.exact_quantile(df, "v", q, slots=3) == pytest.approx(np.quantile(values, q), rel=1e-12)
    assert aggregates.exact_quantile(df.limit(0), "v", 0.5) is None


def test_caps_on_a_hot_key(spark):
    rows = [(("hot" if i % 3 else f"k{i % 11}"), f"2024-01-{1 + i % 9:02d}", i) for i in range(900)]
    df = spark.createDataFrame(rows, "kw string, day string, id int").withColumn("ts", F.to_timestamp_ntz("day"))
    pdf = pd.DataFrame(rows, columns=["kw", "day", "id"]).sort_values(["kw", "day", "id"])
    daily = pdf.groupby(["kw", "day"]).head(5)
    want = sorted(daily.groupby("kw").head(12)["id"])
    got = topk.cap_per_day_and_total(df, "kw", "ts", ["id"], 5, 12)
    assert sorted(r.id for r in got.collect()) == want


@pytest.mark.parametrize("n", [3, 1500])
def test_cap_of_a_hot_group(spark, n):
    df = spark.range(6000).select(F.col("id"), F.when(F.col("id") % 3 != 0, "hot").otherwise("cold").alias("k"))
    got = topk.cap_per_group(df, "k", ["id"], n).groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    want = {"hot": (n, [i for i in range(6000) if i % 3][n - 1]), "cold": (n, 3 * (n - 1))}
    assert {r.k: (r.n, r.m) for r in got.collect()} == want


def test_parents_hand_down_columns(spark):
    rows = [("1", "0", "n1"), ("2", "1", "n9"), ("3", "404", "n3"), ("4", None, "n4")]
    df = spark.createDataFrame(rows, "comment_id string, parent_comment_id string, note_id string")
    got = {r.comment_id: r.note_id for r in joins.inherit_parent(df, ["note_id"]).collect()}
    assert got == {"1": "n1", "2": "n1", "3": "n3", "4": "n4"}


def test_a_segmenter_of_your_own(spark):
    from voxscope.functions.tokens import tokenize

    df = spark.createDataFrame([("很 满意 的 服务",)], "t string")
    words = df.select(tokenize(F.col("t"), segmenter=lambda c: F.split(c, " ")).alias("w")).first().w
    assert words == ["满意", "服务"]


def dense_pagerank(edges, alpha=0.85, rounds=200):
    nodes = sorted({n for s, d, _ in edges for n in (s, d)})
    index = {n: i for i, n in enumerate(nodes)}
    m = np.zeros((len(nodes), len(nodes)))
    for s, d, w in edges:
        m[index[s], index[d]] += w
    out = m.sum(axis=1)
    rank = np.full(len(nodes), 1 / len(nodes))
    for _ in range(rounds):
        spread = np.divide(rank, out, out=np.zeros_like(rank), where=out > 0) @ m
        rank = alpha * (spread + rank[out == 0].sum() / len(nodes)) + (1 - alpha) / len(nodes)
    return dict(zip(nodes, rank, strict=True))


@pytest.mark.parametrize("piece", [100_000, 3])
def test_pagerank_with_a_popular_node(spark, piece):
    rng = random.Random(5)
    edges = {("hub", f"u{i}"): 1 + i % 3 for i in range(20)}
    edges |= {(f"u{rng.randint(0, 30)}", f"u{rng.randint(0, 40)}"): rng.randint(1, 4) for _ in range(40)}
    edges[("u1", "u1")] = 2
    edges |= {(f"u{i}", "hub"): 1 for i in range(0, 30, 2)}
    rows = [(s, d, w) for (s, d), w in edges.items()]
    df = spark.createDataFrame(rows, "src string, dst string, weight bigint")
    got = {r.user: r.pagerank for r in graph.pagerank(df, tolerance=1e-9, piece=piece).collect()}
    want = dense_pagerank(rows)
    assert sum(got.values()) == pytest.approx(1.0)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in want)


def test_batches_do_not_matter_for_upserts(spark):
    rng = random.Random(9)
    rows = [(rng.randint(0, 8), f"t{i}", i % 5, i) for i in range(80)]
    df = spark.createDataFrame(rows, "k int, title string, likes int, seq int")
    empty = df.limit(0)
    cut = df.filter("seq < 33"), df.filter("seq >= 33")
    for step in (lambda o, n: merge.upsert_partial(o, n, ["k"], ["likes", "seq"], ["seq"]),
                 lambda o, n: merge.upsert_all(o, n, ["k"], ["seq"]),
                 lambda o, n: merge.insert_guarded(o, n, ["k"], ["seq"], "title")):
        assert rows_of(step(empty, df)) == rows_of(step(step(empty, cut[0]), cut[1]))
    first = {k: t for k, t, _, _ in reversed(rows)}
    got = merge.upsert_partial(empty, df, ["k"], ["likes", "seq"], ["seq"]).collect()
    assert {r.k: r.title for r in got} == first


def test_set_merge_overwrites_with_null(spark):
    old = spark.createDataFrame([(1, "a", "b")], "k int, x string, y string")
    new = spark.createDataFrame([(1, None, "z", ["x"], 1), (2, "n", None, ["x"], 2)],
                                "k int, x string, y string, present array<string>, seq int")
    assert sorted(map(tuple, merge.set_merge(old, new, ["k"], "present", ["seq"]).collect())) == [
        (1, None, "b"), (2, "n", None)]


def test_json_files(spark, tmp_path):
    record = {"id": 1, "c": "好"}
    files = {"list": [record, record], "data": {"data": [record]}, "blocked": {"data": 1, "comments": [record]},
             "comments": {"comments": [record]}, "items": {"items": [record, record]}, "single": record}
    for name, content in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(content, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "broken.json").write_text('[{"id": 1}, {', encoding="utf-8")
    (tmp_path / "extra.json").write_text('[{"id": 1}] []', encoding="utf-8")
    records, quarantine = json_records.read_json_records(spark, str(tmp_path), "id bigint, c string")
    counts = {r.file.rsplit("/", 1)[1]: r["n"] for r in records.groupBy("file").agg(F.count("*").alias("n")).collect()}
    assert counts == {"list.json": 2, "data.json": 1, "comments.json": 1, "items.json": 2, "single.json": 1}
    assert {r.file.rsplit("/", 1)[1] for r in quarantine.collect()} == {"broken.json", "extra.json"}


def test_broken_array_files_are_set_aside(spark, tmp_path):
    (tmp_path / "good.json").write_text('[{"id": 1}, {"id": 2}]')
    (tmp_path / "cut.json").write_text('[{"id": 3}, {"id": 4}, {"id":')
    records, quarantine = json_records.read_json_arrays(spark, str(tmp_path), "id bigint")
    assert sorted(r.id for r in records.collect()) == [1, 2]
    (broken,) = quarantine.collect()
    assert broken.file.endswith("cut.json") and broken.payload is None


def test_values_of_another_type_are_set_aside(spark):
    rows = spark.createDataFrame([('[{"id": "x9", "c": "a"}, {"id": "7", "c": null}, {"id": 8}]',), ("nonsense",)], "payload string")
    records, quarantine = json_records.explode_payloads(rows, "payload", "id bigint, c string")
    assert sorted(r.id for r in records.collect()) == [7, 8]
    assert sorted(r.payload for r in quarantine.collect()) == ["nonsense", '{"id":"x9","c":"a"}']


def test_csv_keeps_blanks_at_the_ends(spark, tmp_path):
    rows = [("1", "  padded text  "), ("2", "\ttab")]
    df = spark.createDataFrame(rows, "id string, content string")
    folders = sinks.write_outputs(df, str(tmp_path / "o"))
    assert sorted(rows_of(csv_safe.read_csv_safe(spark, folders["csv"]))) == rows
    sinks.append_csv(df.withColumn("dt", F.lit("d")), str(tmp_path / "a"), ("dt",))
    assert sorted((r.id, r.content) for r in csv_safe.read_csv_safe(spark, str(tmp_path / "a")).collect()) == rows


def test_surplus_fields_are_reported(spark, tmp_path):
    (tmp_path / "c.csv").write_text("a,b\n1,2\n1,2,3\n")
    got = csv_safe.read_csv_safe(spark, str(tmp_path / "c.csv"), ["a", "b"]).collect()
    assert [r._corrupt_record for r in got] == [None, "1,2,3"]


def test_a_broken_table_is_not_an_empty_one(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "_SUCCESS").write_text("")
    schema = spark.createDataFrame([(1,)], "id int").schema
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        sinks.read_if_exists(spark, str(tmp_path / "t"), schema)
    assert sinks.read_if_exists(spark, str(tmp_path / "none"), schema).count() == 0


def test_upserts_leave_untouched_buckets_alone(spark, tmp_path):
    path = tmp_path / "t"
    first = spark.createDataFrame([(i, f"v{i}") for i in range(300)], "id int, v string")
    sinks.upsert_table(first, str(path), ["id"], ["v"])
    before = {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}
    got = sinks.upsert_table(spark.createDataFrame([(5, "new"), (900, "more")], "id int, v string"), str(path), ["id"], ["v"])
    kept = [p for p in path.rglob("*.parquet") if before.get(p) == p.stat().st_mtime_ns]
    assert len({p.parent for p in path.rglob("*.parquet")} - {p.parent for p in kept}) <= 2
    assert {r.id: r.v for r in got.collect()} == {**{i: f"v{i}" for i in range(300)}, 5: "new", 900: "more"}


def test_documents_keep_fields_that_a_batch_lacks(spark, tmp_path):
    path, write = str(tmp_path / "d"), sinks.create_sink("mongodb")
    write(spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "id int, name string, n int"), path, keys=["id"], order=["n"])
    write(spark.createDataFrame([(1, 7), (3, 8)], "id int, n int"), path, keys=["id"], order=["n"])
    got = {r.id: (r.name, r.n) for r in sinks.read_keyed(spark, path).collect()}
    assert got == {1: ("a", 7), 2: ("b", 6), 3: (None, 8)}


def test_unsettled_ranks_raise(spark):
    edges = spark.createDataFrame([("a", "b", 1), ("b", "c", 1), ("c", "a", 1), ("a", "c", 2)], "src string, dst string, weight int")
    with pytest.raises(ArithmeticError):
        graph.pagerank(edges, tolerance=1e-12, max_rounds=2)


def test_bursts_are_found_without_shuffling_texts(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00", 1, "long enough text to be kept"), (1, "2024-01-01 00:00:03", 2, "ok"),
                                (None, "2024-01-01 00:00:03", 3, "ok"), (1, "2024-01-01 02:00:00", 4, "ok")],
                               "user_id int, create_time string, comment_id int, content_clean string")
    df = df.withColumn("create_time", F.col("create_time").cast("timestamp"))
    spam = dedup.burst_rows(df)
    plan = spam._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "content_clean" in line]
    assert [r.comment_id for r in spam.collect()] == [2]
    assert sorted(r.comment_id for r in dedup.burst_spam_filter(df).collect()) == [1, 3, 4]


def test_stored_texts_hold_the_named_columns_only(spark):
    rows = [("1", "a text", "北京", None), ("2", "a text", "上海", None), ("3", "", "上海", None)]
    raw = spark.createDataFrame(rows, "comment_id string, content string, ip_location string, pictures string")
    stored = cleaning.unique_texts(raw, columns=["ip_location", "content_clean"])
    assert stored.columns == ["ip_location", "content_clean"] and rows_of(stored) == [("北京", "a text")]


def test_platform_names_are_read_without_case(spark):
    rows = spark.createDataFrame([(" XHS", "{}"), ("nowhere", "{}"), (None, "{}")], "platform string, payload string")
    assert sorted(str(r.platform) for r in platforms.unknown_platforms(rows).collect()) == ["None", "nowhere"]


def test_csv_with_line_breaks_and_quotes(spark, tmp_path):
    path = str(tmp_path / "c")
    rows = [("1", 'a "quoted", text\nwith a break'), ("2", "plain")]
    sinks.write_single_csv(spark.createDataFrame(rows, "id string, content string"), path)
    assert rows_of(csv_safe.read_csv_safe(spark, path)) == rows
    assert csv_safe.read_csv_safe(spark, str(tmp_path / "missing")) is None
    assert csv_safe.read_csv_inferred(spark, path).count() != len(rows)  # the defect it is known for


def test_bundle_skips_empty_sheets_and_flattens(spark, tmp_path):
    df = spark.createDataFrame([(1, None, ["a"])], "i int, n string, t array<string>")
    written = sinks.write_bundle({"Contents": df, "Comments": df.limit(0)}, str(tmp_path))
    assert list(written) == ["Contents"]
    assert rows_of(spark.read.parquet(written["Contents"])) == [("1", "", '["a"]')]
    with pytest.raises(ValueError):
        sinks.create_sink("tape")


RAW = [
    # id, create_time, last_modify, place, content, user, avatar, likes, replies, parent, pictures
    ("c1", "1764858046000", None, "河南", "这个产品很好，推荐大家", "u1", "a.png", "11", "0", "0", ""),
    ("c2", "1764858049000", None, "广东", "太贵了", "u1", "b.png", "1.2万", "x", "9bc41fa7", "http://p/1.png"),
    ("c3", None, "1764858146000", None, "<b>支持</b> 国产手机 [赞]", "u2", None, "3", "1", "0", None),
    ("c4", "1764858246000", None, "US", "转发微博一下", "u3", "c.png", "0", "0", "0", None),
    ("c5", "1764858346000", None, "美国", "默认头像的人说话", "u4", "http://x/default.png", "0", "0", "0", None),
    ("c6", "1764858446000", None, "北京", "这个产品很好，推荐大家", "u5", "d.png", "5", "5", "0", None),
    ("c7", "1764858546000", None, "北京", None, "u5", "d.png", "5", "5", "0", None),
    ("c8", "bad", None, "北京", "没有时间的评论", "u5", "d.png", "5", "5", "0", None),
    (None,) * 11,
]
SCHEMA = ("comment_id string, create_time string, last_modify_ts string, ip_location string, content string, "
          "user_id string, avatar string, like_count string, sub_comment_count string, parent_comment_id string, "
          "pictures string")


def test_cleaning_by_hand(spark):
    clean, report = cleaning.clean_with_report(spark.createDataFrame(RAW, SCHEMA))
    rows = {r.comment_id: r for r in clean.collect()}
    # c2 is a burst (3 s, short), c4 is noise, c5 has a stock avatar, c6 repeats c1, c7 and c8 are incomplete.
    assert set(rows) == {"c1", "c3"}
    assert rows["c1"].location_province == "河南" and rows["c1"].sentiment_label == "正面"
    assert rows["c3"].content_clean == "支持 国产手机" and rows["c3"].ip_location == "未知"
    assert rows["c3"].day_name == "Thursday" and rows["c3"].like_count == 3 and rows["c3"].is_reply is False
    summary = json.loads(report.first().report)
    assert summary["raw_data"]["total_records"] == 9 and summary["cleaned_data"]["retention_rate"] == "22.22%"
    assert summary["data_quality_metrics"]["sentiment_distribution"] == {"正面": 2}


def test_cleaning_without_optional_columns(spark):
    df = spark.createDataFrame([("a", "很好的产品"), ("b", "很好的产品")], "comment_id string, content string")
    assert [r.comment_id for r in cleaning.clean_comments(df).collect()] == ["a"]


def test_merge_update(spark):
    old = spark.createDataFrame([("1", "x")], "id string, content string")
    new = spark.createDataFrame([("2", "x", 1), ("3", "y", 2)], "id string, content string, likes int")
    assert sorted((r.id, r.content) for r in opinion.merge_update(old, new, ["id"]).collect()) == [("1", "x"), ("3", "y")]
    assert opinion.merge_update(None, old, ["id"]).count() == 1
    with pytest.raises(ValueError):
        opinion.merge_update(None, None, ["id"])


def test_topics_do_not_depend_on_layout(spark):
    docs = [(i, " ".join(random.Random(i).choices(["就业", "薪资", "焦虑", "学习", "考研", "offer", "hello"], k=8)))
            for i in range(200)]
    df = spark.createDataFrame(docs, "id int, content string")
    a = topics.topic_clusters(df.repartition(1), "id", min_df=1, points=True)
    b = topics.topic_clusters(df.repartition(6), "id", min_df=1, points=True)
    assert {r.id: r.cluster_id for r in a.rows.collect()} == {r.id: r.cluster_id for r in b.rows.collect()}
    table = topics.keyword_table(a.keywords).collect()
    assert len(table) == 4 and set(a.vocabulary) >= {"就业", "薪资"}


def test_pca_matches_a_singular_value_decomposition(spark):
    from pyspark.ml.functions import array_to_vector

    data = np.random.default_rng(1).normal(size=(60, 5)) @ np.diag([5, 3, 1, 1, 1])
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(data)], "i int, v array<double>")
    points = mining.pca_points(df.withColumn("features", array_to_vector("v"))).orderBy("i").collect()
    _, _, vt = np.linalg.svd(data - data.mean(axis=0))
    want = np.abs(data @ vt[:2].T)
    assert np.allclose(np.abs([[p.x, p.y] for p in points]), want, atol=1e-6)


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(5000)
    train, test = mining.random_split(df, "id")
    again, _ = mining.random_split(df.repartition(3), "id")
    assert train.join(test, "id").count() == 0 and train.count() + test.count() == 5000
    assert rows_of(train) == rows_of(again) and 0.77 < train.count() / 5000 < 0.83


def test_classifier_beats_guessing(spark):
    good, bad = ["很 喜欢 优秀", "支持 加油 成功"], ["垃圾 失望 讨厌", "焦虑 失业 裁员"]
    rows = [(i, (good if i % 2 else bad)[i // 2 % 2]) for i in range(200)]
    _, _, accuracy = topics.train_classifier(spark.createDataFrame(rows, "id int, content string"), "id")
    assert accuracy.first().accuracy > 0.9


def test_streams_over_several_batches(spark, tmp_path):
    rows = [(i, f"u{i % 4}", pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=7 * i), "short" if i % 2 else "x" * 30)
            for i in range(60)]
    schema = "comment_id bigint, user_id string, create_time timestamp, content_clean string"
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["comment_id", "user_id", "create_time", "content_clean"]),
                               schema).withColumn("create_time", F.col("create_time").cast("timestamp_ntz"))
    folder = str(tmp_path / "in")
    for part in range(3):
        df.filter(f"comment_id >= {part * 20} AND comment_id < {part * 20 + 20}").coalesce(1).write.mode(
            "append").parquet(folder)

    def stream():
        return jobs.read_stream(spark, folder, df.schema, files_per_batch=1)

    path = str(tmp_path / "upsert")
    stored = jobs.stream_upsert(stream(), path, ["user_id"], ["comment_id"], update=["comment_id", "create_time"])()
    want = merge.upsert_partial(df.limit(0), df, ["user_id"], ["comment_id", "create_time"], ["comment_id"])
    assert rows_of(stored) == rows_of(want)
    # A second run finds nothing new and still returns the table.
    again = jobs.stream_upsert(stream(), path, ["user_id"], ["comment_id"], update=["comment_id", "create_time"])()
    assert rows_of(again) == rows_of(want)


def _write_times(spark, folder, batches):
    """One file per batch of (second, id, text), in order of their names."""
    for n, rows in enumerate(batches):
        df = spark.createDataFrame([(i, f"2024-01-01 {s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}", t) for s, i, t in rows],
                                   "id int, at string, text string").withColumn("at", F.col("at").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(1.1)  # file sources go by the time of the file
    return df.schema


def test_keys_expire_in_a_stream(spark, tmp_path):
    schema = _write_times(spark, tmp_path / "in", [[(0, 1, "a")], [(10, 1, "a"), (7200, 2, "b")], [(7300, 3, "c")], [(7400, 1, "a")]])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = jobs.append_rows(jobs.stream_expiring_dedup(stream, ["id"], "at", "1 minute"), str(tmp_path / "out"))()
    assert sorted(r.id for r in got.collect()) == [1, 1, 2, 3]  # the late copy is dropped, the one after expiry is new


def test_upserts_of_several_files(spark, tmp_path):
    schema = _write_times(spark, tmp_path / "in", [[(0, 1, "a"), (1, 2, "b")], [(2, 1, "c")], [(3, 3, "d"), (4, 1, "e")]])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = jobs.stream_upsert(stream, str(tmp_path / "out"), ["id"], ["at"])()
    assert sorted((r.id, r.text) for r in got.collect()) == [(1, "e"), (2, "b"), (3, "d")]
