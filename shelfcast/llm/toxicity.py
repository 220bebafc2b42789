"""Toxicity by cumulative-link ordinal regression on sparse text features.

``P(grade > k) = sigmoid(w . x - threshold_k)``: one weight vector for all thresholds, which
are kept in ascending order. ``x`` counts the distinct words of a text that show a feature;
features are the letter runs of the text, lower-cased, and their prefixes, so that unseen
endings of a known stem still count.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import ship

LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
SAMPLE_PER_CLASS = 2000  # labelled documents fitted on, for each binary label
EVIDENCE = 5.0  # natural logarithm of the odds against chance that a feature needs
LEAST_DOCUMENTS = 3  # graded documents that show a feature
CUT_STEP = 0.5  # of the thresholds, whose curvature is a quarter at most
REJECT_FROM = 0.7  # expected severity: more than one weak sign
MARKER_ODDS = 8.0  # how much commoner a marker is in toxic documents
_SCORES = 400_000  # word scores remembered in a task


def features(word: str) -> list[str]:
    return [word] + [f"{word[:n]}*" for n in PREFIXES if len(word) > n]


def distinct_words(text: str | None) -> set[str]:
    return set(LETTERS.findall(text.lower())) if text else set()


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of the features that count, and ascending thresholds (none: always grade 0)."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def severity(self, margin: np.ndarray) -> np.ndarray:
        """Expected grade: the sum of P(grade > k)."""
        cut = np.asarray(self.thresholds)
        z = np.clip(margin[:, None] - cut[None, :], -500, 500)
        return (1.0 / (1.0 + np.exp(-z))).sum(axis=1)


def severity_grades(texts: list[set[str]], toxic: np.ndarray) -> np.ndarray:
    """Grades 0..3 from binary labels: how many words of a toxic text show a marker.

    Markers are features at least ``MARKER_ODDS`` times as common in toxic documents. Clean
    is 0; toxic is 1, from three such words 2, from six 3.
    """
    seen = [Counter(), Counter()]
    for found, label in zip(texts, toxic, strict=True):
        seen[int(label)].update({f for w in found for f in features(w)})
    n = [max(1, int((toxic == k).sum())) for k in (0, 1)]
    markers = {
        f
        for f, c in seen[1].items()
        if c >= LEAST_DOCUMENTS and c / n[1] >= MARKER_ODDS * (seen[0][f] + 1) / n[0]
    }
    hits = np.array([sum(any(f in markers for f in features(w)) for w in t) for t in texts])
    return np.where(toxic == 1, 1 + (hits >= 3) + (hits >= 6), 0)


def _telling(texts: list[set[str]], bad: np.ndarray) -> list[str]:
    """Features whose documents are graded so much more often than all documents that chance
    would have to be very kind: a divergence of ``EVIDENCE`` over their number."""
    seen, hits = Counter(), Counter()
    for found, label in zip(texts, bad, strict=True):
        own = {f for w in found for f in features(w)}
        seen.update(own)
        if label:
            hits.update(own)
    rate, names = bad.mean(), []
    for f, n in hits.items():
        share = n / seen[f]
        if share > rate and n >= LEAST_DOCUMENTS:
            rest = (1 - share) * math.log((1 - share) / (1 - rate)) if share < 1 else 0.0
            if seen[f] * (share * math.log(share / rate) + rest) >= EVIDENCE:
                names.append(f)
    return sorted(names)


def fit(
    texts: list[set[str]], grades: np.ndarray, penalty: float = 2e-4, steps: int = 400
) -> OrdinalModel:
    """Proximal gradient steps on the ordinal likelihood with an L1 penalty on the weights.

    Rows are weighted so that clean and graded texts count alike. One grade only, or no
    text: a model without thresholds, that grades everything 0.
    """
    grades = np.asarray(grades, np.int64)
    present = sorted(set(grades.tolist()))
    if len(present) < 2:
        return OrdinalModel({}, ())
    bad = grades > 0
    names = _telling(texts, bad)
    index = {f: i for i, f in enumerate(names)}
    rows, cols, vals = [], [], []
    for i, t in enumerate(texts):
        own = Counter(index[f] for w in t for f in features(w) if f in index)
        rows.append(np.full(len(own), i, np.int32))
        cols.append(np.fromiter(own.keys(), np.int32, len(own)))
        vals.append(np.fromiter(own.values(), np.float64, len(own)))
    row, col, val = (np.concatenate(x) for x in (rows, cols, vals))
    top = present[-1]
    above = grades[:, None] > np.arange(top)[None, :]
    share = np.where(grades > 0, 0.5 / max(1, (grades > 0).sum()), 0.5 / max(1, (grades == 0).sum()))

    def margin(w):
        return np.bincount(row, val * w[col], len(texts))

    def slopes(w, cut):
        """d(negative log-likelihood) / d(w . x), and / d(thresholds)."""
        z = np.clip(margin(w)[:, None] - cut, -30, 30)
        over = 1.0 / (1.0 + np.exp(-z))
        full = np.hstack([np.ones((len(z), 1)), over, np.zeros((len(z), 1))])
        at = np.arange(len(z))
        chance = np.maximum(full[at, grades] - full[at, grades + 1], 1e-12)
        bend = np.hstack([np.zeros((len(z), 1)), over * (1 - over), np.zeros((len(z), 1))])
        pull = -(bend[at, grades] - bend[at, grades + 1]) / chance
        by_cut = np.zeros((len(z), top + 2))
        by_cut[at, grades] += bend[at, grades] / chance
        by_cut[at, grades + 1] -= bend[at, grades + 1] / chance
        return pull * share, (by_cut[:, 1:-1] * share[:, None]).sum(axis=0)

    w = np.zeros(len(names))
    rate = np.clip(above.mean(axis=0), 1e-3, 1 - 1e-3)
    cut = np.maximum.accumulate(-np.log(rate / (1 - rate)) + 1e-3 * np.arange(top))
    seen_w, seen_cut, turn = w, cut, 1.0
    # a bound of the curvature for each weight alone: rows count by how many features share them
    many = np.bincount(row, minlength=len(texts))[row] + 1.0
    step = 4.0 / np.maximum(np.bincount(col, share[row] * many * val * val, len(names)), 1e-9)
    for _ in range(steps):
        by_margin, by_cut = slopes(seen_w, seen_cut)
        moved = seen_w - step * np.bincount(col, val * by_margin[row], len(names))
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0.0)
        new_cut = np.maximum.accumulate(seen_cut - CUT_STEP * by_cut)
        new_cut = new_cut + 1e-6 * np.arange(top)
        new_turn = (1 + (1 + 4 * turn * turn) ** 0.5) / 2
        pace = (turn - 1) / new_turn
        seen_w, seen_cut = new_w + pace * (new_w - w), new_cut + pace * (new_cut - cut)
        seen_cut = np.maximum.accumulate(seen_cut)
        w, cut, turn = new_w, new_cut, new_turn
    kept = np.flatnonzero(w)
    return OrdinalModel(
        {names[i]: float(w[i]) for i in kept}, tuple(float(c) for c in cut)
    )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS
) -> tuple[list[set[str]], np.ndarray]:
    """Distinct words and labels of at most ``per_class`` documents of each label.

    The choice follows a hash of the id, so it does not depend on file or task order. Rows
    without a label, an id or a text are passed over.
    """
    ship(docs.sparkSession)
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        "doc_id IS NOT NULL AND toxic IN (0, 1)"
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = known.filter("toxic = 1").orderBy(*order).limit(per_class).unionByName(
        known.filter("toxic = 0").orderBy(*order).limit(per_class)
    )
    # 2 * per_class rows of 12 bytes at most
    texts = docs.select("doc_id", F.col("text").alias("text")).join(F.broadcast(chosen), "doc_id")

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(distinct_words(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), batch.column("doc_id"), pa.array(found, pa.list_(pa.string()))],
                ["toxic", "doc_id", "words"],
            )

    table = texts.select("doc_id", "text", "toxic").mapInArrow(
        reduce, "toxic int, doc_id bigint, words array<string>"
    )
    rows = sorted(table.collect(), key=lambda r: (r.doc_id, r.toxic, r.words))
    return [set(r.words) for r in rows], np.array([r.toxic for r in rows], np.int64)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> OrdinalModel:
    """Model from binary labels: a bounded sample, graded by severity, then fitted."""
    texts, toxic = labelled_sample(docs, labels, per_class)
    return fit(texts, severity_grades(texts, toxic))


def score(docs: DataFrame, model: OrdinalModel, reject_from: float = REJECT_FROM) -> DataFrame:
    """``docs`` with ``severity`` (expected grade) and ``toxic_rejected`` appended.

    Columns of those two names are replaced; all others pass through. A null or empty text
    shows no feature and is never rejected; a text without any known feature gets the
    severity of the bare thresholds. Whole texts are read, in one pass without a shuffle.
    """
    ship(docs.sparkSession)
    weights, empty = dict(model.weights), not model.thresholds

    class Scores(dict):
        def __missing__(self, word: str) -> float:
            if len(self) >= _SCORES:
                self.clear()
            value = self[word] = sum(weights.get(f, 0.0) for f in features(word))
            return value

    base = docs.drop("severity", "toxic_rejected")
    added = [
        T.StructField("severity", T.DoubleType()),
        T.StructField("toxic_rejected", T.BooleanType()),
    ]
    schema = T.StructType([*base.schema.fields, *added])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = Scores()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            margin = np.array(
                [math.fsum(map(scores.__getitem__, distinct_words(t))) for t in texts]
            ).reshape(-1)
            grade = np.zeros(len(texts)) if empty else model.severity(margin)
            grade[[not t for t in texts]] = 0.0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(grade, pa.float64()), pa.array(grade >= reject_from)],
                [*batch.schema.names, "severity", "toxic_rejected"],
            )

    return base.mapInArrow(judge, schema)
