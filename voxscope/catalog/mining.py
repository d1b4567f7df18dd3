"""Term vectors, TF-IDF, topics, projection and classification."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.tokens import drop_stop_words, tokenize
from ..operators import aggregates, mining
from ..plans import topics
from ..session import stage
from .aggregate import _BUCKET
from .base import Registry, with_comments
from .scalar import FILTERED_SQL, STOPS, TOKENS_SQL, TRAINING_NET, training_score
from .text import q

registry = Registry()
add = registry.add


def _words(t):
    return t.spread_documents.select("doc_id", drop_stop_words(tokenize(F.col("text")), STOPS).alias("words"))


_TERMS = f"t AS (SELECT doc_id, unnest({FILTERED_SQL.format('text')}) AS term FROM documents)"
_COUNTS = f"""{_TERMS}, vocab AS (SELECT term, count(*) AS n FROM t GROUP BY term HAVING count(DISTINCT doc_id) >= 5
 ORDER BY n DESC, term LIMIT 1000), c AS (SELECT doc_id, term, count(*) AS tf FROM t
 WHERE term IN (SELECT term FROM vocab) GROUP BY ALL)"""


def _counts(t):
    words = stage(_words(t), "words")
    return mining.term_counts(words, "doc_id", vocab=mining.vocabulary(words, size=1000, min_df=5))


@add("count_vectors", f"WITH {_COUNTS} SELECT doc_id, term, tf FROM c")
def _(t):
    return _counts(t)


@add("vocabulary_ids", f"""WITH {_COUNTS} SELECT term, n AS count, CAST(row_number() OVER (ORDER BY n DESC, term) - 1
 AS INT) AS term_id FROM vocab""")
def _(t):
    return mining.with_term_ids(mining.vocabulary(_words(t), size=1000, min_df=5)).select("term", "count", "term_id")


@add("tfidf", f"""WITH {_COUNTS}, df AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1e0)) AS idf
 FROM c GROUP BY term) SELECT doc_id, term, tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf
 FROM c JOIN df USING (term)""")
def _(t):
    weights = mining.tfidf(stage(_counts(t), "counts"), "doc_id", t.documents.agg(F.count("*")).scalar())
    return weights.select("doc_id", "term", "tf", F.round("idf", 6).alias("idf"), F.round("tfidf", 6).alias("tfidf"))


@add("tfidf_vectors", f"""WITH {_TERMS}, vocab AS (SELECT term, count(DISTINCT doc_id) AS d FROM t GROUP BY term
 HAVING count(DISTINCT doc_id) >= 5) SELECT doc_id, round(sum(ln(((SELECT count(*) FROM documents) + 1) / (d + 1e0))), 4)
 AS weight FROM t JOIN vocab USING (term) GROUP BY doc_id""")
def _(t):
    # Every term found in at least five documents, as rows: no vocabulary is cut and no vector is as wide as it.
    counts = stage(mining.term_counts(_words(t), "doc_id"), "counts")
    common = counts.groupBy("term").agg(F.count("*").alias("n")).filter("n >= 5")
    weights = mining.tfidf(counts.join(common, "term", "left_semi"), "doc_id", t.documents.agg(F.count("*")).scalar())
    return weights.groupBy("doc_id").agg(F.round(F.sum("tfidf"), 4).alias("weight"))


@add("hashing_tf", f"SELECT doc_id, CAST(len({TOKENS_SQL.format('text')}) AS DOUBLE) AS tokens FROM documents")
def _(t):
    hashed = mining.hashing_tf(t.spread_documents.select("doc_id", tokenize(F.col("text")).alias("words")))
    counts = F.aggregate(vector_to_array("raw_features"), F.lit(0.0), lambda a, x: a + x)
    return hashed.select("doc_id", counts.alias("tokens"))


# --- topics ----------------------------------------------------------------------------------


def _topics(t, size=1000, min_df=5.0, points=False):
    return topics.topic_clusters(t.documents, "doc_id", "text", size=size, min_df=min_df, stop_words=STOPS, points=points)


@add("kmeans_clusters")
def _(t):
    return _topics(t).rows


@add("cluster_keywords")
def _(t):
    return topics.keyword_table(_topics(t).keywords)


@add("topic_points")
def _(t):
    return _topics(t, 2000, 2.0, points=True).rows


def _embedding_features(t):
    from pyspark.ml.functions import array_to_vector
    return mining.repeatable(t.embeddings.select(
        "vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")), "vec_id")


@add("embedding_clusters")
def _(t):
    with mining.persisted(_embedding_features(t)) as rows:
        clusters, _model = mining.kmeans(rows, 4, 1)
    return clusters.select("vec_id", "label", "cluster_id")


def _lloyd_sql(k: int, rounds: int) -> str:
    parts = ["e AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings)",
             "c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1 AS INT) AS cluster, f AS centre "
             f"FROM e ORDER BY cluster LIMIT {k})"]
    for i in range(rounds + 1):
        parts.append(f"a{i} AS MATERIALIZED (SELECT vec_id, f, cluster FROM e CROSS JOIN c{i} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY "
                     "list_sum(list_transform(list_zip(f, centre), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), cluster) = 1)")
        parts.append(f"c{i + 1} AS MATERIALIZED (SELECT o.cluster, coalesce(n.centre, o.centre) AS centre FROM c{i} o LEFT JOIN (SELECT cluster, "
                     "list(m ORDER BY j) AS centre FROM (SELECT cluster, j, avg(x) AS m FROM (SELECT cluster, unnest(f) AS x, "
                     f"generate_subscripts(f, 1) AS j FROM a{i}) AS u GROUP BY ALL) AS v GROUP BY cluster) AS n USING (cluster))")
    return f"WITH {', '.join(parts)} SELECT vec_id, cluster AS cluster_id FROM a{rounds}"


@add("embedding_clusters_lloyd", _lloyd_sql(4, 5))
def _(t):
    rows = stage(t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("f")), "vectors")
    return mining.lloyd(rows, "vec_id", "f", 4, 5)


@add("pca_products", """SELECT count(*) AS n, 0e0 AS mean_product FROM embeddings""")
def _(t):
    # Projections by the library's fit are uncorrelated whatever their signs: the centred products cancel out.
    points = mining.pca_points(_embedding_features(t))
    return points.agg(F.count("*").alias("n"), F.abs(F.round(F.covar_pop("x", "y"), 6)).alias("mean_product"))


# --- classification --------------------------------------------------------------------------

_LABELLED = f"""SELECT comment_id, CASE WHEN {TRAINING_NET} > 0 THEN 1e0 ELSE 0e0 END AS label,
 {TOKENS_SQL.format('content')} AS words FROM comments WHERE {TRAINING_NET} <> 0"""


def _labelled(t):
    return topics.labelled_rows(t.comments).select("label", "words")


@add("naive_bayes_priors", with_comments(f""", r AS ({_LABELLED}) SELECT label, round(ln(count(*) + 1e0)
 - ln((SELECT count(*) FROM r) + (SELECT count(DISTINCT label) FROM r)), 6) AS log_prior FROM r GROUP BY label"""))
def _(t):
    priors, _thetas = mining.naive_bayes_parameters(_labelled(t))
    return priors.select("label", F.round("log_prior", 6).alias("log_prior"))


@add("naive_bayes_parameters", with_comments(f""", r AS ({_LABELLED}), w AS (SELECT label, unnest(words) AS term FROM r),
 c AS (SELECT label, term, count(*) AS tf FROM w GROUP BY ALL), s AS (SELECT label, sum(tf) AS total FROM c GROUP BY 1),
 g AS (SELECT s.label, s.total, t.term FROM s, (SELECT DISTINCT term FROM w) AS t)
 SELECT g.label, g.term, round(ln(coalesce(c.tf, 0) + 1e0) - ln(g.total + (SELECT count(DISTINCT term) FROM w)), 6)
 AS log_theta FROM g LEFT JOIN c USING (label, term)"""))
def _(t):
    _priors, thetas = mining.naive_bayes_parameters(_labelled(t))
    return thetas.select("label", "term", F.round("log_theta", 6).alias("log_theta"))


@add("naive_bayes_classifier")
def _(t):
    _model, predictions, _accuracy = topics.train_classifier(t.comments, "comment_id")
    return predictions.select("comment_id", "label", "prediction")


@add("classifier_accuracy")
def _(t):
    return topics.train_classifier(t.comments, "comment_id")[2]


_SPLIT = _BUCKET.format(salt=q("split"), key="comment_id")
_PREDICTED = f""", r AS MATERIALIZED ({_LABELLED}), tr AS (SELECT * FROM r WHERE {_SPLIT} < 80), te AS (SELECT * FROM r WHERE {_SPLIT} >= 80),
 w AS MATERIALIZED (SELECT label, unnest(words) AS term FROM tr), c AS (SELECT label, term, count(*) AS tf FROM w GROUP BY ALL),
 s AS (SELECT label, sum(tf) AS total FROM c GROUP BY 1), v AS MATERIALIZED (SELECT DISTINCT term FROM w),
 th AS MATERIALIZED (SELECT s.label, v.term, ln(coalesce(c.tf, 0) + 1e0) - ln(s.total + (SELECT count(*) FROM v)) AS theta
  FROM s CROSS JOIN v LEFT JOIN c ON c.label = s.label AND c.term = v.term),
 pr AS (SELECT label, ln(count(*) + 1e0) - ln((SELECT count(*) FROM tr) + (SELECT count(DISTINCT label) FROM tr)) AS prior FROM tr GROUP BY 1),
 x AS (SELECT comment_id, term, count(*) AS tf FROM (SELECT comment_id, unnest(words) AS term FROM te) AS u GROUP BY ALL),
 z AS (SELECT x.comment_id, th.label, sum(x.tf * th.theta) AS t FROM x JOIN th USING (term) GROUP BY ALL),
 p AS (SELECT te.comment_id, te.label, pr.label AS prediction FROM te CROSS JOIN pr LEFT JOIN z ON z.comment_id = te.comment_id AND z.label = pr.label
  QUALIFY row_number() OVER (PARTITION BY te.comment_id ORDER BY prior + coalesce(t, 0) DESC, pr.label) = 1)"""


def _predicted(t):
    train, test = mining.random_split(topics.labelled_rows(t.comments).select("comment_id", "label", "words"), "comment_id")
    test = stage(test, "labelled")  # read more than once; the rows to learn from are counted as they come
    priors, thetas = mining.naive_bayes_parameters(train)
    found = mining.naive_bayes_predict(test, "comment_id", priors, thetas)
    return test.select("comment_id", "label").join(found, "comment_id")


@add("naive_bayes_predictions", with_comments(f"{_PREDICTED} SELECT comment_id, label, prediction FROM p"))
def _(t):
    return _predicted(t)


@add("naive_bayes_accuracy", with_comments(f"""{_PREDICTED} SELECT round(avg(CASE WHEN label = prediction THEN 1e0 ELSE 0e0 END), 6)
 AS accuracy FROM p"""))
def _(t):
    return aggregates.accuracy(_predicted(t)).select(F.round("accuracy", 6).alias("accuracy"))


@add("accuracy", with_comments(f"""SELECT round(avg(CASE WHEN (CASE WHEN {TRAINING_NET} > 0 THEN 1e0 ELSE 0e0 END)
 = (CASE WHEN like_count % 2 = 0 THEN 1e0 ELSE 0e0 END) THEN 1e0 ELSE 0e0 END), 6) AS accuracy FROM comments"""))
def _(t):
    rows = t.comments.select((training_score() > 0).cast("double").alias("label"),
                             (F.col("like_count") % 2 == 0).cast("double").alias("prediction"))
    return aggregates.accuracy(rows).select(F.round("accuracy", 6).alias("accuracy"))
