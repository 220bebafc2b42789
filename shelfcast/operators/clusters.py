"""K-means groups of product descriptions."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators import text
from shelfcast.operators.partitions import stable_partitions
from shelfcast.session import cut_lineage

# Number of clusters, seed, and terms that describe a cluster.
CLUSTERS = 10
SEED = 42
TERMS_PER_CLUSTER = 5


@dataclass(frozen=True)
class DescriptionClusters:
    """``assigned``: Description, NLP_Category; ``centers`` follow ``vocabulary``."""

    assigned: DataFrame
    vocabulary: list[str]
    model: KMeansModel


def _fit(
    vectors: DataFrame, names: int, vocab: list[str], k: int, seed: int
) -> DescriptionClusters:
    points = stable_partitions(vectors, ["Description"], names).persist()
    try:
        # A name counts once per row it stands for, as if it had been repeated.
        model = KMeans(k=k, seed=seed, weightCol="n_rows", predictionCol="NLP_Category").fit(
            points.withColumn("n_rows", F.col("n_rows").cast("double"))
        )
    finally:
        points.unpersist()
    assigned = model.transform(vectors).select("Description", "NLP_Category")
    return DescriptionClusters(assigned, vocab, model)


def count_clusters(features: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> DescriptionClusters:
    """Clusters on plain term counts."""
    docs = cut_lineage(text.tokens(text.descriptions(features)))
    vocab = [row.term for row in text.vocabulary(docs, "filtered").select("term").collect()]
    vectors = text.count_vectors(docs, vocab, "filtered", "features")
    return _fit(vectors, docs.count(), vocab, k, seed)


def tfidf_clusters(features: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> DescriptionClusters:
    """Clusters on weighted one- and two-word phrases."""
    docs = cut_lineage(text.phrases(text.descriptions(features)))
    vocab = [(row.term, row.idf) for row in text.phrase_vocabulary(docs).collect()]
    terms = [term for term, _ in vocab]
    return _fit(text.tfidf_vectors(docs, vocab, "features"), docs.count(), terms, k, seed)


def cluster_terms(clusters: DescriptionClusters, n: int = TERMS_PER_CLUSTER) -> DataFrame:
    """The ``n`` heaviest terms of each cluster centre.

    Centres are ``k`` vectors over a bounded vocabulary; ranking them stays a query.
    """
    centers = clusters.model.clusterCenters()
    table = pa.table(
        {
            "NLP_Category": list(range(len(centers))),
            "weights": [[float(w) for w in center] for center in centers],
        }
    )
    spark = clusters.assigned.sparkSession
    words = F.lit(clusters.vocabulary)
    order = Window.partitionBy("NLP_Category").orderBy(F.col("weight").desc(), F.col("term"))
    return (
        spark.createDataFrame(table, "NLP_Category int, weights array<double>")
        .select("NLP_Category", F.inline(F.arrays_zip(words, "weights")))
        .toDF("NLP_Category", "term", "weight")
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= n)
        .select("NLP_Category", "position", "term", F.round("weight", 6).alias("weight"))
    )
