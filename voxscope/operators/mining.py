"""Text mining: term counts, TF-IDF, topics, projection, classification, keyed splits."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import NaiveBayes, NaiveBayesModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, HashingTF, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage


@contextmanager
def persisted(df: DataFrame):
    """Keep a frame in memory (or on local disk) while it is read repeatedly."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


# --- relational form -------------------------------------------------------------------------

def vocabulary(df: DataFrame, tokens: str = "words", size: int = 2000, min_df: int = 2) -> DataFrame:
    """The ``size`` most frequent terms found in at least ``min_df`` rows; ties by term.

    Occurrences and documents are counted in one pass and combined in the map tasks.
    """
    marks = F.concat(
        F.transform(tokens, lambda t: F.struct(t.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df"))),
        F.transform(F.array_distinct(tokens),
                    lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df"))))
    counts = (df.select(F.inline(marks)).groupBy("term")
              .agg(F.sum("tf").alias("count"), F.sum("df").alias("doc_count")))
    return counts.filter(F.col("doc_count") >= min_df).orderBy(F.desc("count"), "term").limit(size)


def with_term_ids(vocab: DataFrame) -> DataFrame:
    """Number the terms of a vocabulary by rank; its size is bounded by its own limit."""
    position = F.row_number().over(Window.orderBy(F.desc("count"), "term")) - 1
    return vocab.withColumn("term_id", position)


def term_counts(df: DataFrame, doc: str, tokens: str = "words", vocab: DataFrame | None = None) -> DataFrame:
    """(doc, term, tf) rows, optionally only of vocabulary terms."""
    terms = df.select(doc, F.explode(tokens).alias("term"))
    if vocab is not None:
        terms = terms.join(vocab.select("term"), "term", "left_semi")
    return terms.groupBy(doc, "term").agg(F.count("*").alias("tf"))


def tfidf(counts: DataFrame, doc: str, documents: int | Column) -> DataFrame:
    """(doc, term, tf, idf, tfidf) with idf = ln((m + 1) / (df + 1)).

    ``counts`` is read twice; stage it first.
    ``documents`` is m.  Document frequencies are staged and joined back by term: the join then has
    exchanges of its own on both sides, and the adaptive skew join can split a very common term.
    """
    m = documents if isinstance(documents, Column) else F.lit(documents)
    idf = stage(counts.groupBy("term").agg(F.log((m + 1) / (F.count("*") + F.lit(1.0))).alias("idf")), "idf")
    return counts.join(idf, "term").select(doc, "term", "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def naive_bayes_parameters(df: DataFrame, label: str = "label", tokens: str = "words",
                           smoothing: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Multinomial naive Bayes by counting: (label, log_prior) and (label, term, log_theta).

    ``df`` is read once: rows are counted with their terms, at the first term or, without terms, at a row of their own.
    Only the counts are stored.
    """
    marks = df.select(label, F.posexplode_outer(tokens).alias("_at", "term"))
    found = stage(marks.groupBy("term", label).agg(F.count("_at").alias("_tf"), F.count_if(F.coalesce(F.col("_at") == 0, F.lit(True))).alias("_rows")),
                  "class-terms")
    classes = found.groupBy(label).agg(F.sum("_rows").alias("_n"))
    total, kinds = classes.agg(F.sum("_n")).scalar(), classes.agg(F.count("*")).scalar()
    priors = classes.select(label, (F.log(F.col("_n") + smoothing)
                                    - F.log(total + kinds * smoothing)).alias("log_prior"))
    counts = found.filter("_tf > 0").drop("_rows")
    terms = counts.select("term").distinct()
    per_class = counts.groupBy(label).agg(F.sum("_tf").alias("_sum"))
    v = terms.agg(F.count("*")).scalar()
    grid = terms.select("term", F.explode(
        classes.agg(F.collect_set(label)).scalar()).alias(label))  # one element per class
    thetas = (grid.join(counts, ["term", label], "left").join(per_class, label, "left")
              .select(label, "term", (F.log(F.coalesce("_tf", F.lit(0)) + smoothing)
                                      - F.log(F.coalesce("_sum", F.lit(0)) + v * smoothing)).alias("log_theta")))
    return priors, thetas


# --- MLlib form ------------------------------------------------------------------------------

def count_vectorize(df: DataFrame, tokens: str = "words", out: str = "raw_features", size: int = 1000,
                    min_df: float = 5.0) -> tuple[DataFrame, CountVectorizerModel]:
    model = CountVectorizer(inputCol=tokens, outputCol=out, vocabSize=size, minDF=min_df).fit(df)
    return model.transform(df), model


def hashing_tf(df: DataFrame, tokens: str = "words", out: str = "raw_features", features: int = 2000) -> DataFrame:
    return HashingTF(inputCol=tokens, outputCol=out, numFeatures=features).transform(df)


def idf_weight(df: DataFrame, features: str = "raw_features", out: str = "features") -> DataFrame:
    return IDF(inputCol=features, outputCol=out).fit(df).transform(df)


def repeatable(df: DataFrame, key: str) -> DataFrame:
    """Fix partition contents and order, on which seeded algorithms depend."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, key).sortWithinPartitions(key)


def kmeans(df: DataFrame, k: int = 4, seed: int = 1, features: str = "features",
           out: str = "cluster_id") -> tuple[DataFrame, KMeansModel]:
    """Fit and assign clusters; pass a persisted frame, since fitting reads it many times."""
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol=out).fit(df)
    return model.transform(df), model


def top_terms_per_cluster(centers: list, terms: list[str], df: DataFrame, n: int = 10) -> DataFrame:
    """The heaviest centre weights of each cluster with their terms.

    Centres are k x vocabulary numbers, bounded by the parameters that made them.
    """
    rows = [(i, terms[j], float(w)) for i, center in enumerate(centers) for j, w in enumerate(center)]
    weights = df.sparkSession.createDataFrame(rows, "cluster_id int, term string, weight double")
    w = Window.partitionBy("cluster_id").orderBy(F.desc("weight"), "term")
    return weights.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= n)


def pca_points(df: DataFrame, features: str = "features") -> DataFrame:
    """Add ``x`` and ``y``, the first two principal components.

    The sign of a component is arbitrary; here its largest loading is positive.  Spark's fit decomposes the covariance on the
    driver without a native library, which takes far longer than the rest; the covariance is Spark's, the decomposition LAPACK's.
    """
    found = df.select(Summarizer.metrics("variance").summary(F.col(features)).alias("s")).first()
    spread = np.sqrt(found["s"]["variance"].toArray())
    # Correlations are the covariance over both deviations, and undefined where there is none.
    covariance = np.nan_to_num(Correlation.corr(df, features).first()[0].toArray(), nan=0.0) * np.outer(spread, spread)
    values, vectors = np.linalg.eigh(covariance)
    largest = np.argsort(values)[::-1][:2]
    loadings = vectors[:, largest]
    signs = [1.0 if loadings[abs(loadings[:, i]).argmax(), i] >= 0 else -1.0 for i in range(2)]
    context = df.sparkSession.sparkContext
    share = DenseVector(values[largest] / max(values.sum(), np.finfo(float).tiny))
    fitted = context._jvm.org.apache.spark.ml.feature.PCAModel(f"pca_{uuid.uuid4().hex}", _py2java(
        context, DenseMatrix(len(loadings), 2, (loadings * signs).ravel(order="F").tolist())), _py2java(context, share))
    model = PCAModel(fitted)._set(k=2).setInputCol(features).setOutputCol("_pca")
    xy = vector_to_array("_pca")
    return model.transform(df).withColumns({"x": xy[0], "y": xy[1]}).drop("_pca")


def naive_bayes(train: DataFrame, smoothing: float = 1.0) -> NaiveBayesModel:
    return NaiveBayes(smoothing=smoothing, modelType="multinomial").fit(train)


# --- sampling --------------------------------------------------------------------------------

def keyed_bucket(key: Column, salt: str = "", buckets: int = 100) -> Column:
    """A bucket from the key's hash: the same row gets the same bucket on any cluster."""
    digest = F.md5(F.concat(F.lit(salt), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def lloyd(df: DataFrame, key: str, features: str, k: int, rounds: int) -> DataFrame:
    """(key, cluster_id) after ``rounds`` rounds of Lloyd's k-means over an array column.

    The first centres are the ``k`` rows whose keys have the smallest MD5, so the result does not depend on the layout.  A row
    goes to the nearest centre, of equal ones to the first; a centre that gets no row stays.  The driver holds k centres of
    the width of a row; a round is one aggregation.
    """
    starts = df.select(features).orderBy(F.md5(F.col(key).cast("string")), key).limit(k).collect()
    centres = [list(r[0]) for r in starts]

    def assigned() -> Column:
        gaps = F.array(*[F.aggregate(F.zip_with(features, F.array(*[F.lit(float(x)) for x in c]), lambda a, b: (a - b) * (a - b)),
                                     F.lit(0.0), lambda t, x: t + x) for c in centres])
        return F.aggregate(F.array(gaps), F.lit(0).cast("bigint"), lambda _, g: F.array_position(g, F.array_min(g)) - 1)

    for _ in range(rounds if centres else 0):
        width = range(len(centres[0]))
        for row in df.select(assigned().cast("int").alias("_c"), features).groupBy("_c").agg(
                *[F.avg(F.col(features)[i]).alias(f"m{i}") for i in width]).collect():
            centres[row["_c"]] = [row[f"m{i}"] for i in width]
    return df.select(key, (assigned().cast("int") if centres else F.lit(None).cast("int")).alias("cluster_id"))


def naive_bayes_predict(rows: DataFrame, key: str, priors: DataFrame, thetas: DataFrame, tokens: str = "words",
                        label: str = "label") -> DataFrame:
    """(key, prediction): the label with the highest log probability; of equal ones the smallest.

    Terms that training never saw are ignored.  The parameters are staged, so that Spark knows their size: small ones are
    broadcast, and only a sum per row and class is shuffled, never its terms.  Beside large ones terms are shuffled once,
    and the skew join splits a common one.
    """
    terms = rows.select(key, F.explode(tokens).alias("term"))
    joined = terms.join(stage(thetas.withColumnRenamed(label, "_label"), "thetas"), "term")
    sums = joined.groupBy(key, "_label").agg(F.sum("log_theta").alias("_sum"))
    # One row per class beside each row to predict.
    kinds = F.array(*[F.struct(F.lit(r[0]).alias("_label"), F.lit(r[1]).alias("_prior")) for r in priors.select(label, "log_prior").orderBy(label).collect()])
    grid = rows.select(key, F.inline(kinds)).join(sums, [key, "_label"], "left")
    best = grid.groupBy(key).agg(F.max(F.struct((F.col("_prior") + F.coalesce("_sum", F.lit(0.0))).alias("s"), (-F.col("_label")).alias("l"))).alias("b"))
    return best.select(key, (-F.col("b.l")).alias("prediction"))


def random_split(df: DataFrame, key: str, train: float = 0.8, salt: str = "split") -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test rows, decided by the key and not by the partition layout."""
    limit = round(train * 100)
    bucket = keyed_bucket(F.col(key), salt)
    return df.filter(bucket < limit), df.filter(bucket >= limit)


def sample(df: DataFrame, key: str, fraction: float = 0.5, salt: str = "sample") -> DataFrame:
    return df.filter(keyed_bucket(F.col(key), salt) < round(fraction * 100))


