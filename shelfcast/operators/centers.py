"""K-means groups as tables: centres, assignments and cost that SQL can recompute.

Points are integer vectors with a weight. A centre is the sum of its points and of their
weights, kept as integers, so it does not depend on the order points arrive in; distances add up
coordinate by coordinate, so they do not either. A Lloyd step is one job: tasks assign their
points in numpy and sum them per centre, Spark adds the sums up. Steps go on until no centre
changes, so the result is a fixed point (or ``MOST_STEPS`` are done), the same on every run.

Starting centres are points that lie far apart: of ``CANDIDATES`` points drawn by a hash, the
first, then always the one farthest from those chosen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.operators import text
from shelfcast.operators.clusters import CLUSTERS, TERMS_PER_CLUSTER
from shelfcast.session import cut_lineage, ship_package

MOST_STEPS = 20
CANDIDATES = 200
SCALE = 1_000_000  # a weight between 0 and 1 as an integer
SEED = "centers-1"
SLICE = 1000  # points that are held as a matrix at a time


@dataclass(frozen=True)
class TableClusters:
    """``assigned``: Description, NLP_Category, cost (weight times squared distance); ``centers``:
    NLP_Category, term, sum, weight, in units of ``scale``; ``steps`` taken, the last of which
    changed no centre if ``settled``."""

    assigned: DataFrame
    centers: DataFrame
    vocabulary: list[str]
    scale: int
    steps: int
    settled: bool


@dataclass(frozen=True)
class _Centers:
    sums: list[list[int]]
    weights: list[int]

    @property
    def means(self) -> np.ndarray:
        return np.array([[s / w for s in row] for row, w in zip(self.sums, self.weights)], float)


def _distances(points: np.ndarray, means: np.ndarray) -> np.ndarray:
    """Squared distances of points to centres, added up from the first coordinate to the last."""
    total = np.zeros((len(points), len(means)))
    for j in range(points.shape[1]):
        gap = points[:, j, None] - means[None, :, j]
        total += gap * gap
    return total


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            values = part["vector"].flatten().to_numpy(zero_copy_only=False)
            yield part, values.reshape(part.num_rows, -1)


def _step(means: np.ndarray):
    """Sums of weights (term -1) and of weighted vectors per nearest centre, the first of ties."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, points in _slices(batches):
            nearest = _distances(points.astype(float), means).argmin(axis=1)
            weight = part["n_rows"].to_numpy(zero_copy_only=False)
            for center in np.unique(nearest):
                own = nearest == center
                summed = (points[own] * weight[own, None]).sum(axis=0)
                terms = np.flatnonzero(summed)
                yield pa.RecordBatch.from_pydict(
                    {
                        "center": pa.array([int(center)] * (len(terms) + 1), pa.int32()),
                        "term": pa.array([-1, *terms.tolist()], pa.int32()),
                        "held": pa.array([int(weight[own].sum()), *summed[terms].tolist()]),
                    }
                )

    return run


def _assign(means: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, points in _slices(batches):
            apart = _distances(points.astype(float), means)
            nearest = apart.argmin(axis=1)
            cost = apart[np.arange(len(points)), nearest]
            weight = part["n_rows"].to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_pydict(
                {
                    "Description": part["Description"],
                    "NLP_Category": pa.array(nearest, pa.int32()),
                    "cost": pa.array(cost * weight),
                }
            )

    return run


def starting_centers(points: DataFrame, k: int, seed: str = SEED) -> list[list[int]]:
    """Vectors of up to ``k`` different points that lie far apart.

    Of equally far ones the first by name. The candidates that reach the driver are
    ``CANDIDATES`` at most.
    """
    drawn = F.md5(F.concat(F.lit(f"{seed}|"), F.col("Description")))
    rows = points.orderBy(drawn, "Description").limit(CANDIDATES).select("Description", "vector")
    found = sorted(
        rows.collect(),
        key=lambda r: (hashlib.md5(f"{seed}|{r.Description}".encode()).hexdigest(), r.Description),
    )
    if not found:
        return []
    first, rest = found[0], sorted(found, key=lambda r: r.Description.encode())
    vectors = np.array([r.vector for r in rest], np.int64)
    chosen = [first.vector]
    apart = ((vectors - np.array(first.vector)) ** 2).sum(axis=1)
    while len(chosen) < k and apart.max() > 0:
        next_ = vectors[apart.argmax()]
        chosen.append(next_.tolist())
        apart = np.minimum(apart, ((vectors - next_) ** 2).sum(axis=1))
    return [list(map(int, v)) for v in chosen]


def lloyd_step(points: DataFrame, centers: _Centers) -> _Centers:
    """Centres of the points nearest to each; one without points stays where it is.

    What reaches the driver are centres: ``k`` times the vocabulary.
    """
    sums = points.mapInArrow(_step(centers.means), "center int, term int, held bigint")
    rows = sums.groupBy("center", "term").agg(F.sum("held").alias("held")).collect()
    weights = {r.center: r.held for r in rows if r.term < 0}
    found = {c: [0] * len(centers.sums[c]) for c in weights}
    for row in rows:
        if row.term >= 0:
            found[row.center][row.term] = row.held
    return _Centers(
        [found.get(c, own) for c, own in enumerate(centers.sums)],
        [weights.get(c, own) for c, own in enumerate(centers.weights)],
    )


def _table(spark: SparkSession, centers: _Centers, vocabulary: list[str]) -> DataFrame:
    n = len(vocabulary)
    table = pa.table(
        {
            "NLP_Category": pa.array([c for c in range(len(centers.sums)) for _ in range(n)], pa.int32()),
            "term": pa.array(vocabulary * len(centers.sums), pa.string()),
            "sum": pa.array([s for row in centers.sums for s in row], pa.int64()),
            "weight": pa.array([w for w in centers.weights for _ in range(n)], pa.int64()),
        }
    )
    return spark.createDataFrame(table, "NLP_Category int, term string, sum bigint, weight bigint")


def fit(
    points: DataFrame, vocabulary: list[str], k: int = CLUSTERS, scale: int = 1
) -> TableClusters:
    """Clusters of ``points`` (``Description, n_rows, vector`` of integers in units of ``scale``)."""
    spark = points.sparkSession
    ship_package(spark)
    points = cut_lineage(points)  # read once a step; sums do not depend on where points lie
    start = starting_centers(points, k)
    centers, steps, settled = _Centers(start, [1] * len(start)), 0, not start
    while not settled and steps < MOST_STEPS:
        after, steps = lloyd_step(points, centers), steps + 1
        settled = after == centers
        centers = after
    means = centers.means if start else np.zeros((1, len(vocabulary)))
    assigned = points.mapInArrow(_assign(means), "Description string, NLP_Category int, cost double")
    assigned = assigned.withColumn("cost", F.col("cost") / float(scale) ** 2)
    return TableClusters(assigned, _table(spark, centers, vocabulary), vocabulary, scale, steps, settled)


def count_clusters(features: DataFrame, k: int = CLUSTERS) -> TableClusters:
    """Clusters on plain term counts; a name weighs as many rows as it stands for."""
    docs = cut_lineage(text.tokens(text.descriptions(features)))
    vocab = [row.term for row in text.vocabulary(docs, "filtered").select("term").collect()]
    if not vocab:
        return fit(_without_terms(docs), [], k)
    vectors = text.count_vectors(docs, vocab, "filtered", "features")
    return fit(_integers(vectors, 1), vocab, k)


def tfidf_clusters(features: DataFrame, k: int = CLUSTERS) -> TableClusters:
    """Clusters on weighted one- and two-word phrases, weights to six places."""
    docs = cut_lineage(text.phrases(text.descriptions(features)))
    vocab = [(row.term, row.idf) for row in text.phrase_vocabulary(docs).collect()]
    if not vocab:
        return fit(_without_terms(docs), [], k, SCALE)
    vectors = text.tfidf_vectors(docs, vocab, "features")
    return fit(_integers(vectors, SCALE), [term for term, _ in vocab], k, SCALE)


def _without_terms(docs: DataFrame) -> DataFrame:
    """No name has a term of the vocabulary: all are one cluster."""
    return docs.select("Description", "n_rows", F.array().cast("array<bigint>").alias("vector"))


def _integers(vectors: DataFrame, scale: int) -> DataFrame:
    values = F.transform(vector_to_array("features"), lambda x: F.round(x * scale).cast("bigint"))
    return vectors.select("Description", "n_rows", values.alias("vector"))


def cluster_terms(clusters: TableClusters, n: int = TERMS_PER_CLUSTER) -> DataFrame:
    """The ``n`` heaviest terms of each centre; ties by term."""
    mean = F.col("sum").cast("double") / F.col("weight") / float(clusters.scale)
    order = Window.partitionBy("NLP_Category").orderBy(F.col("weight").desc(), F.col("term"))
    return (
        clusters.centers.select("NLP_Category", "term", F.round(mean, 6).alias("weight"))
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= n)
        .select("NLP_Category", "position", "term", "weight")
    )
