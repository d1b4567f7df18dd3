import os
import re

from pyspark.sql import functions as F

from voxscope import session
from voxscope.catalog import entries
from voxscope.catalog.base import Tables
from voxscope.functions import fixed_values as fv
from voxscope.functions import sentiment, tokens
from voxscope.plans import topics

TEXTS = ["喜欢 not 失望", "喜x欢 不错不错", "", None, "垃圾\n圾 推荐", "日本語の支持ñ Ā ɏɏ ÀÉ a1 ab_cd", "喜\U00020000欢 ﷽", "x" * 50 + "好评" + "é" * 9, "喜 欢"]


def test_words_are_searched_in_han_runs_alone(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    words = (fv.TRAINING_POSITIVE, fv.TRAINING_NEGATIVE)
    narrow = sentiment.searched(F.col("text"), [*words[0], *words[1]])
    found = rows.select("text", narrow.alias("n"), sentiment.sentiment_net(narrow, *words).alias("a"), sentiment.sentiment_net(F.col("text"), *words).alias("b")).collect()
    assert all(r.a == r.b for r in found) and any(r.a for r in found) and found[7].n == " 好评 "
    assert str(sentiment.searched(F.col("text"), ["好", "ok"])) == str(F.col("text"))


def test_tokens_as_python_finds_them(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "text string")
    for (text, found) in rows.select("text", tokens.tokenize(F.col("text"))).collect():
        runs = re.findall("[0-9A-Za-zÀ-ɏ]{2,}|[一-鿿]{2,}", text)
        assert found == [t for r in runs for t in ([r[i:i + 2] for i in range(len(r) - 1)] if r[0] >= "一" else [r])]


def test_labelled_rows_score_once(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1])], "id int, content string")
    found = topics.labelled_rows(rows)
    assert found.columns == ["id", "content", "words", "content_len", "score", "label"]
    assert sorted((r.id, r.score, r.label) for r in found.collect()) == [
        (1, 1.0, 1.0), (1, 1.0, 1.0), (4, -1.0, 0.0), (5, 1.0, 1.0), (7, 1.0, 1.0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Contains(_searched#") == len({*fv.TRAINING_POSITIVE, *fv.TRAINING_NEGATIVE})


def test_only_rows_to_predict_are_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "checkpoint_root", lambda _: str(tmp_path))
    tables = Tables(spark, "/root/testdata/sf0.001")
    found = entries()["naive_bayes_predictions"].run(tables)
    (stored,) = [os.path.join(d, x) for d, xs, _ in os.walk(tmp_path) for x in xs if x.startswith("labelled")]
    assert spark.read.parquet(stored).count() == found.count() < topics.labelled_rows(tables.comments).count() / 3
