"""Exact top-k inner products with a vector-approximation file.

Each component is quantised to a cell; a vector's cells bound its inner product with a
query from both sides. The cells are scanned twice: for the kth best lower bound of each query
over the whole file, then for the vectors whose upper bound reaches it. Exact vectors of these
are read in the order of their bounds: first the most promising, then those that may still beat
the kth result.

Equal vectors are one entry with their smallest ids, so copies cost nothing. Components are
whole numbers held as doubles, exact at any size; where products leave the whole numbers that
doubles hold, bounds are widened by what rounding may take, and scores are summed in Python
integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import ship, stored

CELLS = 32  # of each component, equally wide between the least and the greatest value
PROBES = 16  # exact vectors read for a query before the bound is drawn tighter
BLOCK = 2048  # queries scanned for together
WAVE = 16  # blocks scanned for in one job; the driver holds the queries of so many
EXACT = 2.0**53  # whole numbers up to here are exact as doubles, and so are their sums
LONGEST, LEAST_LONG = (1 << 63) - 1, -(1 << 63)
BOUNDS = "query bigint, entry bigint, over double"


def integer_vectors(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """``vec_id, v``: floor(256 * x) of each component as a double, exact at any size.

    Left out: null ids, null vectors, and vectors that hold a null or non-finite component, or
    one whose 256-fold is beyond all doubles.
    """
    v = F.transform(F.col(vector).cast("array<double>"), lambda x: x * 256)
    fine = F.forall(
        F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )

    def whole(x):  # doubles of 2^53 and more have no fraction; 0.0 turns -0.0 into 0
        return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x) + F.lit(0.0)

    return (
        rows.select(F.col(id).cast("bigint").alias("vec_id"), v.alias("v"))
        .filter("vec_id IS NOT NULL AND v IS NOT NULL")
        .filter(F.coalesce(fine, F.lit(False)))
        .select("vec_id", F.transform("v", whole).alias("v"))
    )


class Grid:
    """The cells of vectors of one length: ``CELLS`` of each component, equally wide."""

    def __init__(self, low: np.ndarray, high: np.ndarray):
        self.low, self.high = low, high
        self.far = np.maximum(np.abs(low), np.abs(high))
        self.whole = bool(np.all(self.far < EXACT / 4))
        width = (high - low + 1) / CELLS if self.whole else high / CELLS - low / CELLS
        self.width = np.maximum(1.0, np.ceil(width))
        # what rounding may add to or take from a cell's edge
        self.slack = np.zeros(len(low)) if self.whole else self.far * 2.0**-40

    def code(self, v: np.ndarray) -> np.ndarray:
        if self.whole:
            return ((v - self.low) // self.width).astype(np.uint8)
        return np.clip(np.floor(v / self.width - self.low / self.width), 0, CELLS).astype(np.uint8)

    def edges(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest value that a cell may hold."""
        if self.whole:
            floor = self.low + code * self.width
            return floor, floor + self.width - 1
        place = self.low / self.width + code
        floor = np.clip(place * self.width, self.low, self.high)
        ceiling = np.clip((place + 1) * self.width, self.low, self.high)
        return floor - self.slack, ceiling + self.slack

    def bound(self, code: np.ndarray, asked: np.ndarray, upper: bool) -> np.ndarray:
        """Bounds of the inner products of cells (rows) and queries (columns).

        Whole numbers below 2^53 are exact; beyond, a bound is moved outwards by more than all
        the roundings, and one that leaves the doubles is no bound.
        """
        floor, ceiling = self.edges(code)
        plus, minus = np.maximum(asked, 0), np.minimum(asked, 0)
        with np.errstate(over="ignore", invalid="ignore"):
            one, two = (ceiling, floor) if upper else (floor, ceiling)
            out = one @ plus.T + two @ minus.T
            reach = (self.far + self.slack + self.width) @ np.abs(asked).T
            off = np.where(reach < EXACT, 0.0, reach * 2.0**-40)
            out = out + off if upper else out - off
        out[np.isnan(out)] = np.inf if upper else -np.inf
        # scores stop at the ends of 64 bits, so do their bounds
        return np.clip(out, float(LEAST_LONG), float(LONGEST))


def build(vectors: DataFrame, keep: int, is_query) -> tuple[DataFrame, dict]:
    """The approximation file: ``entry, ids, v, cells, asked`` per distinct vector.

    ``ids`` are its ``keep`` smallest ids, ``asked`` tells whether one of its ids is a
    query; the second result is the ``Grid`` of each length.
    """
    once = vectors.distinct()
    ranked = once.withColumn(
        "rank", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    ).filter(F.col("rank") <= keep)
    ids = ranked.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = once.groupBy("v").agg(F.max(is_query).alias("asked"))
    entries = stored(
        ids.join(asked, "v").select(F.get("ids", F.lit(0)).alias("entry"), "ids", "v", "asked")
    )
    ends = {
        (r.size, r.at): (r.low, r.high)
        for r in entries.select(F.size("v").alias("size"), F.posexplode("v").alias("at", "x"))
        .groupBy("size", "at")
        .agg(F.min("x").alias("low"), F.max("x").alias("high"))
        .collect()
    }
    grids = {0: Grid(np.zeros(0), np.zeros(0))}
    for size in {s for s, _ in ends}:
        at = [ends[size, i] for i in range(size)]
        grids[size] = Grid(np.array([x for x, _ in at]), np.array([x for _, x in at]))

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for v in batch.column("v").to_pylist():
                cells.append(grids[len(v)].code(np.array(v, np.float64)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.binary())], [*batch.schema.names, "cells"]
            )

    file = entries.mapInArrow(
        quantise, "entry bigint, ids array<bigint>, v array<double>, asked boolean, cells binary"
    )
    return stored(file), grids


def _in_sizes(batch: pa.RecordBatch, by_size: dict) -> Iterator[tuple]:
    """``(size, entries, codes)`` of a batch, for the lengths that are asked for."""
    entries = batch.column("entry").to_numpy()
    cells = batch.column("cells").to_pylist()
    sizes = np.array([len(c) for c in cells])
    for size in sorted(set(sizes.tolist()) & set(by_size)):
        at = np.flatnonzero(sizes == size)
        code = np.frombuffer(b"".join(cells[i] for i in at), np.uint8)
        yield size, entries[at], code.reshape(len(at), size)


def _lower(shared, k: int):
    """The ``k`` best lower bounds of each query among the entries of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size, grids = shared.value
        best: dict[int, np.ndarray] = {}
        for batch in batches:
            for size, _, code in _in_sizes(batch, by_size):
                under = grids[size].bound(code, by_size[size][1], upper=False)
                pool = np.vstack([best[size], under]) if size in best else under
                if len(pool) > k:
                    pool = np.partition(pool, len(pool) - k, axis=0)[len(pool) - k :]
                best[size] = pool
        for size, pool in best.items():
            names = np.broadcast_to(by_size[size][0], pool.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.ravel(), pa.int64()), pa.array(pool.ravel(), pa.float64())],
                ["query", "under"],
            )

    return run


def _upper(shared):
    """Entries whose upper bound reaches the query's bar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size, bars, grids = shared.value
        for batch in batches:
            for size, entries, code in _in_sizes(batch, by_size):
                names, asked = by_size[size]
                over = grids[size].bound(code, asked, upper=True)
                row, column = np.nonzero(over >= bars[size][None, :])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[column], pa.int64()),
                        pa.array(entries[row], pa.int64()),
                        pa.array(over[row, column], pa.float64()),
                    ],
                    ["query", "entry", "over"],
                )

    return run


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact inner products of two vectors a row; beyond 64 bits the nearest of these."""
    for batch in batches:
        scores = []
        vectors = (batch.column(c).to_pylist() for c in ("entry_v", "query_v"))
        for one, two in zip(*vectors, strict=True):
            a, b = np.array(one, np.float64), np.array(two, np.float64)
            with np.errstate(over="ignore"):
                reach = float(np.abs(a) @ np.abs(b))
            # a sum that stays below half of 2^53 with all its roundings is exact
            score = int(a @ b) if reach < EXACT / 2 else sum(int(x) * int(y) for x, y in zip(one, two))
            scores.append(min(max(score, LEAST_LONG), LONGEST))
        kept = [batch.column(c) for c in ("query", "entry", "over")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(scores, pa.int64())], ["query", "entry", "over", "score"]
        )


def _exact(pairs: DataFrame, file: DataFrame) -> DataFrame:
    """Integer inner products of (query, entry) pairs; reads the vectors of these alone."""
    one = file.select(F.col("entry"), F.col("v").alias("entry_v"))
    two = file.filter("asked").select(F.col("entry").alias("query"), F.col("v").alias("query_v"))
    joined = pairs.join(one, "entry").join(two, "query")
    return joined.select("query", "entry", "over", "entry_v", "query_v").mapInArrow(
        _products, BOUNDS + ", score bigint"
    )


def in_blocks(asked: DataFrame, many: int) -> DataFrame:
    """``asked`` with ``block``, a hash of the entry: blocks of about ``BLOCK``, without a shuffle."""
    blocks = max(1, -(-many // BLOCK))
    return asked.withColumn("block", F.pmod(F.xxhash64("entry"), F.lit(blocks)))


def _kth(table: DataFrame, column: str, k: int) -> DataFrame:
    """``query, bar``: the ``k``-th highest value of each query; null if there are fewer."""
    by = Window.partitionBy("query").orderBy(F.desc(column))
    ranked = table.select("query", column, F.row_number().over(by).alias("rank"))
    bar = F.when(F.count("*") == k, F.min(column)).otherwise(F.lit(None))
    return ranked.filter(F.col("rank") <= k).groupBy("query").agg(bar.alias("bar"))


def _candidates(cells: DataFrame, wave: list[dict], grids: dict, k: int) -> DataFrame:
    """``query, entry, over`` for the blocks of a wave: a job for the bars, one for the rest."""
    context = cells.sparkSession.sparkContext
    shared = [context.broadcast((by_size, grids)) for by_size in wave]
    lower = [cells.mapInArrow(_lower(s, k), "query bigint, under double") for s in shared]
    # k + 1 numbers a query and task come back from the tasks, one a query to the driver
    bars = _kth(reduce(DataFrame.unionByName, lower), "under", k).filter("bar IS NOT NULL")
    bar_of = {r.query: r.bar for r in bars.collect()}
    for s in shared:
        s.unpersist()
    shared = []
    for by_size in wave:
        own = {
            size: np.array([bar_of.get(q, -np.inf) for q in names.tolist()])
            for size, (names, _) in by_size.items()
        }
        shared.append(context.broadcast((by_size, own, grids)))
    upper = [cells.mapInArrow(_upper(s), BOUNDS) for s in shared]
    found = stored(reduce(DataFrame.unionByName, upper))
    for s in shared:
        s.unpersist()
    return found


def top_k(
    rows: DataFrame,
    k: int = 5,
    every: int = 50,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest integer inner products.

    Queries are the rows whose id is divisible by ``every``; their own row is no candidate.
    Ties go to the smaller id; fewer candidates give fewer rows. Vectors that are null or
    hold null or non-finite components take no part; vectors of different lengths are not
    compared. Rows that repeat an id with one vector count once; with different vectors
    each is a candidate, and the id asks once for each. Other columns are ignored. Components
    may be as large as a double's 256th part; a score beyond 64 bits is, and ranks as, the
    nearest 64-bit number.

    Queries are scanned for in blocks of about ``BLOCK`` distinct vectors, ``WAVE`` blocks a job,
    so what a task is sent and what the driver holds do not grow with the data.
    """
    spark = rows.sparkSession
    ship(spark)
    vectors = integer_vectors(rows, id, vector)
    is_query = F.pmod(F.col("vec_id"), F.lit(every)) == 0
    file, grids = build(vectors, k + 1, is_query)
    many = file.filter("asked").count()
    asked = stored(in_blocks(file.filter("asked").select("entry", "v"), many))
    cells = file.select("entry", "cells")
    scans = []
    blocks = -(-many // BLOCK)
    for first in range(0, blocks, WAVE):
        wave = []
        for n in range(first, min(first + WAVE, blocks)):
            held = asked.filter(F.col("block") == n).collect()
            by_size = {}
            for size in {len(r.v) for r in held}:
                own = [r for r in held if len(r.v) == size]
                by_size[size] = (
                    np.array([r.entry for r in own], np.int64),
                    np.array([r.v for r in own], np.float64).reshape(len(own), size),
                )
            wave.append(by_size)
        scans.append(_candidates(cells, wave, grids, k + 1))
    left = reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], BOUNDS)
    order = Window.partitionBy("query").orderBy(F.desc("over"), "entry")
    first = left.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= PROBES)
    probed = stored(_exact(first.drop("place"), file))
    rest = (
        left.join(_kth(probed, "score", k + 1), "query")
        .filter("bar IS NULL OR over >= bar")
        .drop("bar")
        .join(probed.select("query", "entry"), ["query", "entry"], "left_anti")
    )
    scored = probed.unionByName(_exact(rest, file)).join(file.select("entry", "ids"), "entry")
    candidates = scored.select("query", "score", F.explode("ids").alias("vec_id"))
    # k + 1 a query, so that k are left without the query's own row
    by = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = candidates.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k + 1)
    results = best.groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best")
    )
    queries = vectors.filter(is_query).distinct()
    entries = file.filter("asked").select("v", F.col("entry").alias("query"))
    answered = queries.withColumnRenamed("vec_id", "query_id").join(entries, "v").join(
        results, "query"
    )
    own = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return answered.select("query_id", F.posexplode(own).alias("at", "b")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("b.vec_id").alias("vec_id"),
        F.col("b.score").alias("score"),
    )
