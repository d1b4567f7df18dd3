"""Topics by TF-IDF and k-means, and a sentiment classifier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import NaiveBayesModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import numbers
from ..functions.sentiment import searched, sentiment_net
from ..functions.tokens import drop_stop_words, tokenize
from ..operators import aggregates, clusters, filters, mining
from ..session import stage


@dataclass
class Topics:
    """Rows with ``cluster_id`` (and ``x``, ``y``), the vocabulary, and the best terms per cluster."""

    rows: DataFrame
    vocabulary: list[str]
    keywords: DataFrame


def tokenized(df: DataFrame, text: str = "content", stop_words=None, phrases=tuple(fv.CUSTOM_PHRASES),
              segmenter=None) -> DataFrame:
    """Add ``words``; with stop words given, also drop them, pure numbers and rows left empty."""
    words = tokenize(F.col(text), phrases=phrases, segmenter=segmenter)
    if stop_words is None:
        return df.withColumn("words", words)
    return filters.nonempty_tokens(df.withColumn("words", drop_stop_words(words, stop_words)))


def topic_clusters(df: DataFrame, key: str, text: str = "content", k: int = 4, seed: int = 1, size: int = 1000,
                   min_df: float = 5.0, stop_words=None, points: bool = False) -> Topics:
    """Cluster texts by their weighted terms.

    Rows are partitioned and sorted by key first, so that the seeded start, and with it the
    clusters, do not depend on how the input was laid out.  Texts are cut into tokens once; the
    term vectors are stored, and everything after reads the stored vectors.
    """
    spread = mining.repeatable(filters.drop_missing(df, [text]).select(key, text), key)
    with mining.persisted(tokenized(spread, text, stop_words).select(key, "words")) as words:
        counted, vocabulary = mining.count_vectorize(words, size=size, min_df=min_df)
        vectors = stage(counted.select(key, "raw_features"), "topic-vectors")
    weighted = mining.idf_weight(mining.repeatable(vectors, key)).select(key, "features")
    with mining.persisted(weighted) as features:
        _, model = mining.kmeans(features, k, seed)
    rows = model.transform(weighted)
    if points:
        rows = mining.pca_points(rows)
    columns = [key, "cluster_id", *(["x", "y"] if points else [])]
    if points:  # the drawing shows the text of each point
        rows, columns = rows.join(df.select(key, text), key), [key, text, *columns[1:]]
    keywords = mining.top_terms_per_cluster(model.clusterCenters(), vocabulary.vocabulary, df)
    return Topics(rows.select(columns), vocabulary.vocabulary, keywords)


def weighted_terms(df: DataFrame, key: str, text: str = "content", size: int = 1000, min_df: int = 5, stop_words=None) -> DataFrame:
    """(doc, norm, terms): the TF-IDF rows of texts as :func:`~voxscope.operators.clusters.sparse_rows`.

    The vocabulary is the ``size`` most frequent terms of at least ``min_df`` texts; a text without any of them has no terms.
    """
    words = stage(tokenized(filters.drop_missing(df, [text]).select(key, text), text, stop_words).select(key, "words"), "topic-words")
    counts = stage(mining.term_counts(words, key, vocab=mining.vocabulary(words, size=size, min_df=min_df)), "topic-counts")
    return clusters.sparse_rows(mining.tfidf(counts, key, words.count()), words, key)


def sparse_topics(df: DataFrame, key: str, text: str = "content", k: int = 4, rounds: int = 10, size: int = 1000,
                  min_df: int = 5, stop_words=None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(key, cluster_id, x, y), the ten heaviest terms per cluster, and the share of each cluster.

    The same steps as :func:`topic_clusters` without vectors as wide as the vocabulary, for vocabularies of any size.
    """
    rows = weighted_terms(df, key, text, size, min_df, stop_words)
    assigned, centres = clusters.sparse_kmeans(rows, k, rounds)
    assigned = stage(assigned, "topic-assigned")
    points = clusters.project(rows, clusters.principal_axes(rows))
    return (assigned.join(points, "doc").withColumnRenamed("doc", key), clusters.heaviest_terms(centres),
            aggregates.cluster_share(assigned))


def keyword_table(keywords: DataFrame, n: int = 10) -> DataFrame:
    """One row per cluster with columns w1 ... wn."""
    return (keywords.groupBy("cluster_id").pivot("position", list(range(1, n + 1))).agg(F.first("term"))
            .select("cluster_id", *[F.col(str(i)).alias(f"w{i}") for i in range(1, n + 1)]))


def labelled_rows(df: DataFrame, text: str = "content", positive=fv.TRAINING_POSITIVE,
                  negative=fv.TRAINING_NEGATIVE) -> DataFrame:
    """Rows with a polar lexicon score, their label, length and tokens."""
    han = df.filter(F.col(text).isNotNull()).withColumn("_searched", searched(F.col(text), [*positive, *negative]))
    # Exploded, as a filter on a computed column would repeat the search for every word, and the text with it.
    scored = han.select("*", F.explode(F.array(sentiment_net(F.col("_searched"), positive, negative))).alias("score"))
    rows = tokenized(filters.nonzero_score(scored), text, phrases=()).withColumns({
        "content_len": F.length(text), "label": numbers.training_label(F.col("score"))})
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], "words", "content_len", "score", "label")


def train_classifier(df: DataFrame, key: str, text: str = "content", positive=fv.TRAINING_POSITIVE,
                     negative=fv.TRAINING_NEGATIVE, features: int = 2000
                     ) -> tuple[NaiveBayesModel, DataFrame, DataFrame]:
    """(model, predictions on the test rows, accuracy).

    Labels come from words that are also features, so the accuracy measures self-consistency.
    The term counts are stored once; weighting, training and prediction read them.
    """
    rows = labelled_rows(df, text, positive, negative).select(key, "words", "label")
    counts = stage(mining.hashing_tf(rows, features=features).select(key, "label", "raw_features"), "hashed-terms")
    vectors = mining.idf_weight(counts).select(key, "label", "features")
    train, test = mining.random_split(vectors, key)
    model = mining.naive_bayes(train)
    predictions = model.transform(test)
    return model, predictions, aggregates.accuracy(predictions)


def length_sentiment(df: DataFrame, key: str, text: str = "content", positive=fv.TRAINING_POSITIVE,
                     negative=fv.TRAINING_NEGATIVE, fraction: float = 0.5) -> DataFrame:
    """(content_len, norm_score) of a repeatable sample of rows with text."""
    length = F.length(text)
    rows = df.filter(length > 0)
    score = sentiment_net(F.col(text), positive, negative)
    return mining.sample(rows, key, fraction).select(
        length.cast("bigint").alias("content_len"), numbers.sentiment_density(score, length).alias("norm_score"))


