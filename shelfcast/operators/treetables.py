"""Random forests as node tables.

A tree is rows of ``tree, node, feature, threshold, n_rows, value`` (the root is node 1, the
children of node i are 2i and 2i + 1), so a forest can be stored, read, joined and checked
with SQL. Trees grow a level at a time: one pass over the stored points sums, in numpy
inside the tasks, rows and labels per node, feature and bin; Spark adds the sums up; the best
cut of each node follows from them, per tree. All trees of all forests grow in the same passes.

Everything random is a hash of a key: bootstrap weights of the row and tree, candidate inputs of
the tree and node. Labels are integers, so sums do not depend on their order. A fit is a
function of the rows alone, whatever the partitions, and is the same after lost executors.

It follows that the first trees of a forest, cut off at a depth, are the smaller forest
that a grid point asks for. Tuning therefore grows one forest on the fitting rows and scores
every grid point on the hold-out rows; the final forest grows beside it.

Products enter as smoothed means of their labels over the growing rows: as many bins as any
other input has, however many products there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from math import ceil, exp, factorial, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.encode import INVENTORY_INPUTS, REGRESSION_INPUTS, label_index
from shelfcast.operators.order import numbered
from shelfcast.operators.partitions import ROWS_PER_PARTITION, partitions_for
from shelfcast.operators.split import INVENTORY_PARTS, REGRESSION_PARTS, split_by_key
from shelfcast.session import cut_lineage, ship_package

# The tuning grid and its hold-out ratio.
TREES = (10, 20)
DEPTHS = (5, 10)
TRAIN_RATIO = 0.8
KEYS = ["Description", "InvoiceMonth"]

MONEY = 10_000  # labels are ten-thousandths
PRIOR_ROWS = 10.0  # rows of the overall mean that are added to each product's
LEAST_GAIN = 1e-9  # of a node's own score, below which a cut gains nothing
BINS = 32
# a hash of 32 bits reaches the k-th bound with the chance that a Poisson(1) count exceeds k
POISSON_BOUNDS = tuple(
    int(sum(exp(-1) / factorial(j) for j in range(k + 1)) * 2**32) for k in range(8)
)
TUNE, FINAL = VIEWS = (0, 1)  # forests that grow together: on the fitting rows, on all of them


@dataclass(frozen=True)
class TreeGrid:
    """Grid points are all pairs; ``seed`` names the draws; ``bins`` of an input at most 128."""

    trees: tuple[int, ...] = TREES
    depths: tuple[int, ...] = DEPTHS
    train_ratio: float = TRAIN_RATIO
    bins: int = BINS
    seed: str = "forest-1"
    product: str = "Description"
    rows_per_partition: int = ROWS_PER_PARTITION

    @property
    def points(self) -> list[tuple[int, int]]:
        return [(t, d) for t in self.trees for d in self.depths]


@dataclass(frozen=True)
class TableForest:
    """``predictions`` of the test rows by the best grid point's forest; ``nodes`` of both forests
    (``view, tree, node, depth, feature, threshold, n_rows, sums``); ``tuning``: ``numTrees,
    maxDepth, score, best``; ``holdout``: the hold-out predictions behind it."""

    predictions: DataFrame
    nodes: DataFrame
    tuning: DataFrame
    holdout: DataFrame
    best_parameters: dict[str, int]
    inputs: list[str]
    labels: list[str]


# -- points: rows with binned inputs ---------------------------------------------------


def key_text() -> Column:
    return F.concat_ws("|", "Description", F.date_format("InvoiceMonth", "yyyy-MM-dd"))


def _share(first: int) -> Column:
    digits = F.substring(F.md5(key_text()), first, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**8))


def in_views(rows: DataFrame, parts: dict[str, float], ratio: float) -> DataFrame:
    """Rows as each forest sees them: ``view``, and ``grows`` or is scored.

    Test rows are scored by the final forest, training rows grow it; a hash of the key keeps some
    training rows from the tuning forest, which scores them. Validation rows take no part.
    """
    fits = _share(9) < ratio

    def seen(view: int, grows: Column) -> Column:
        return F.struct(F.lit(view).alias("view"), grows.alias("grows"))

    views = (
        F.when(F.col("split") == "train", F.array(seen(TUNE, fits), seen(FINAL, F.lit(True))))
        .when(F.col("split") == "test", F.array(seen(FINAL, F.lit(False))))
        .otherwise(F.array().cast("array<struct<view:int,grows:boolean>>"))
    )
    return split_by_key(rows, parts).select("*", F.inline(views)).drop("split")


def target_means(rows: DataFrame, product: str, values: dict[str, Column]) -> DataFrame:
    """``rows`` with the smoothed mean of each of ``values`` over the product's growing rows.

    ``(sum + PRIOR_ROWS * overall mean) / (rows + PRIOR_ROWS)``, by view; a product without
    growing rows has the overall mean. Needs ``view`` and ``grows``.
    """
    growing = rows.filter("grows").select(
        F.col("view").alias("_view"),
        F.col(product).alias("_product"),
        *[v.alias(f"_{k}") for k, v in values.items()],
    )
    sums = [F.sum(f"_{k}").alias(f"_{k}") for k in values]
    own = growing.groupBy("_view", "_product").agg(F.count(F.lit(1)).alias("_n"), *sums)
    whole = own.groupBy(F.col("_view").alias("_of")).agg(
        F.sum("_n").alias("_n_all"), *[F.sum(f"_{k}").alias(f"_{k}_all") for k in values]
    )
    same = (F.col("view") == F.col("_view")) & F.col(product).eqNullSafe(F.col("_product"))
    joined = rows.join(own, same, "left").join(whole, F.col("view") == F.col("_of"))
    n = F.coalesce("_n", F.lit(0)).cast("double")

    def smooth(k: str) -> Column:
        prior = F.col(f"_{k}_all").cast("double") / F.col("_n_all").cast("double")
        held = F.coalesce(f"_{k}", F.lit(0)).cast("double")
        return (held + PRIOR_ROWS * prior) / (n + PRIOR_ROWS)

    return joined.select(*rows.columns, *[smooth(k).alias(k) for k in values])


def bin_bounds(rows: DataFrame, inputs: list[str], bins: int) -> DataFrame:
    """``view, feature, bounds``: the distinct values at the exact ``bins``-quantiles of each input.

    A value's bin is the number of bounds below it.
    """
    each = F.inline(
        F.array(
            *[
                F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("value"))
                for i, c in enumerate(inputs)
            ]
        )
    )
    n_inputs = len(inputs)
    long = rows.filter("grows").select("view", each).filter("value IS NOT NULL")
    long = long.select((F.col("view") * n_inputs + F.col("feature")).alias("column"), "value")
    placed = numbered(long, [F.col("column"), F.col("value")], "place", within="column")
    placed = cut_lineage(placed)
    cuts = (
        placed.groupBy("column")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("column", F.explode(F.sequence(F.lit(1), F.lit(bins - 1))).alias("k"), "n")
        .select("column", F.expr(f"k * n div {bins}").alias("place"))
        .distinct()
    )
    bounds = placed.join(cuts, ["column", "place"]).groupBy("column")
    return bounds.agg(F.array_sort(F.collect_set("value")).alias("bounds")).select(
        F.expr(f"column div {n_inputs}").cast("int").alias("view"),
        (F.col("column") % n_inputs).cast("int").alias("feature"),
        "bounds",
    )


def bootstrap_weights(key: str, trees: int, seed: str) -> np.ndarray:
    """How often a row is drawn for each tree: Poisson(1), by a hash of the key for four trees."""
    digests = [hashlib.md5(f"{seed}|{key}|{i}".encode()).digest() for i in range(ceil(trees / 4))]
    drawn = np.frombuffer(b"".join(digests), ">u4")[:trees]
    return np.searchsorted(POISSON_BOUNDS, drawn, side="right").astype(np.int8)


def candidate_inputs(tree: int, node: int, n_inputs: int, most: int, seed: str) -> list[int]:
    """The inputs a node may be cut at: the first ``most`` in the order of a hash."""

    def drawn(feature: int) -> str:
        return hashlib.md5(f"{seed}|{tree}|{node}|{feature}".encode()).hexdigest()

    return sorted(range(n_inputs), key=drawn)[:most]


def _binned(bounds: dict[tuple[int, int], np.ndarray], n_inputs: int, trees: int, seed: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = batch["view"].to_numpy(zero_copy_only=False)
            bins = np.zeros((batch.num_rows, n_inputs), np.int8)
            for f in range(n_inputs):
                values = batch[f"x{f}"].to_numpy(zero_copy_only=False)
                for view in VIEWS:
                    own = views == view
                    cuts = bounds.get((view, f), np.empty(0))
                    bins[own, f] = np.searchsorted(cuts, values[own], side="left")
            weights = np.zeros((batch.num_rows, trees), np.int8)
            grows = batch["grows"].to_pylist()
            for i, key in enumerate(batch["key"].to_pylist()):
                if grows[i]:
                    weights[i] = bootstrap_weights(key, trees, seed)
            columns = {
                name: batch[name]
                for name in batch.schema.names
                if name != "key" and not name.startswith("x")
            }
            columns["bins"] = pa.array([row.tobytes() for row in bins], pa.binary())
            columns["weights"] = pa.array([row.tobytes() for row in weights], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    joined = b"".join(batch[name].to_pylist())
    return np.frombuffer(joined, np.int8).reshape(batch.num_rows, width)


# -- growing ---------------------------------------------------------------------------


@dataclass
class Nodes:
    """The forests grown so far, as arrays over view, tree and node."""

    feature: np.ndarray  # -1: not cut
    cut: np.ndarray  # bins up to this one go left
    sums: np.ndarray  # rows, then what the labels add up to

    @classmethod
    def empty(cls, trees: int, depth: int, stats: int) -> Nodes:
        shape = (len(VIEWS), trees, 2 ** (depth + 1))
        return cls(
            np.full(shape, -1, np.int8), np.zeros(shape, np.int8), np.zeros((*shape, stats), np.int64)
        )

    def reached(self, view: int, tree: int, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node of each row after ``depth`` cuts, or where it came to a leaf before."""
        feature, cut = self.feature[view, tree], self.cut[view, tree]
        at, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            f = feature[at]
            below = 2 * at + (bins[rows, f] > cut[at])
            at = np.where(f >= 0, below, at)
        return at


STATS = ["n", "a", "b", "c", "d", "e", "f", "g", "h"]


def _summed(cell: np.ndarray, n: np.ndarray, y: np.ndarray, classes: int) -> np.ndarray:
    """``cell``, its rows and what their labels add up to, exactly, for every cell that has rows."""
    order = np.argsort(cell, kind="stable")
    cell, n, y = cell[order], n[order], y[order]
    starts = np.flatnonzero(np.diff(cell, prepend=-1))
    values = [n, n * y] if classes == 1 else [n, *(n * (y == c) for c in range(classes))]
    return np.column_stack([cell[starts], *(np.add.reduceat(v, starts) for v in values)])


def _histograms(nodes: Nodes, level: int, allowed: np.ndarray, classes: int, n_inputs: int):
    """Sums of each batch per forest, node of the level, candidate input and bin."""
    trees, first = nodes.feature.shape[1], 2**level

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, weights = _matrix(batch, "bins", n_inputs), _matrix(batch, "weights", trees)
            views = batch["view"].to_numpy(zero_copy_only=False)
            label = batch["label"].to_numpy(zero_copy_only=False).astype(np.int64)
            parts = []
            for view in VIEWS:
                rows = np.flatnonzero(views == view)
                for tree in range(trees) if len(rows) else ():
                    at = nodes.reached(view, tree, bins[rows], level)
                    drawn = weights[rows, tree].astype(np.int64)
                    open_ = (at >= first) & (drawn > 0)
                    for f in range(n_inputs):
                        use = np.flatnonzero(open_ & allowed[tree, at, f])
                        if len(use):
                            cell = at[use] * 128 + bins[rows[use], f]
                            sums = _summed(cell, drawn[use], label[rows[use]], classes)
                            head = np.full((len(sums), 2), (view * trees + tree, f))
                            parts.append(np.hstack([head, sums]))
            if parts:
                forest, feature, cell, *sums = np.vstack(parts).T
                columns = [forest, cell // 128, feature, cell % 128, *sums]
                names = ["forest", "node", "feature", "bin", *STATS[: 1 + classes]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names)

    return run


def _score(sums: np.ndarray, classes: int) -> np.ndarray:
    """What a cut is to make large: squared label sums (of each class) over the rows."""
    n = sums[:, 0].astype(np.float64)
    if classes == 1:
        y = sums[:, 1].astype(np.float64)
        return y * y / n
    return (sums[:, 1:] ** 2).sum(axis=1).astype(np.float64) / n


def _best_cuts(classes: int):
    """The best cut of each node of a forest, from its sums; feature -1 where none gains."""
    width = 1 + classes

    def run(table):
        columns = ["node", "feature", "bin", *STATS[:width]]
        data = np.column_stack([table[c].to_numpy() for c in columns])
        data = data[np.lexsort((data[:, 2], data[:, 1], data[:, 0]))]
        sums = data[:, 3:]
        starts = np.flatnonzero(np.any(np.diff(data[:, :2], axis=0, prepend=-1) != 0, axis=1))
        lengths = np.diff(np.append(starts, len(data)))
        running = np.cumsum(sums, axis=0)
        before = np.repeat(running[starts] - sums[starts], lengths, axis=0)
        total = np.repeat(np.add.reduceat(sums, starts, axis=0), lengths, axis=0)
        left = running - before
        right = total - left
        real = right[:, 0] > 0
        score = np.full(len(data), -np.inf)
        score[real] = _score(left[real], classes) + _score(right[real], classes)
        own = _score(total, classes)
        score[~(score > own + LEAST_GAIN * np.abs(own))] = -np.inf
        order = np.lexsort((data[:, 2], data[:, 1], -score, data[:, 0]))
        _, first = np.unique(data[order, 0], return_index=True)
        best = order[first]
        cut = np.isfinite(score[best])
        out = {
            "forest": np.full(len(best), table["forest"][0].as_py()),
            "node": data[best, 0],
            "feature": np.where(cut, data[best, 1], -1),
            "bin": data[best, 2],
        }
        for i in range(width):
            out[f"left_{STATS[i]}"], out[f"right_{STATS[i]}"] = left[best, i], right[best, i]
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return run


def grow(points: DataFrame, n_inputs: int, classes: int, grid: TreeGrid, most: int) -> Nodes:
    """Grow all trees; ``most`` candidate inputs a node. One job a level.

    What reaches the driver is one row per cut: trees times ``2 ** depth`` at most, a bound
    that the grid sets and the data do not.
    """
    trees, depth = max(grid.trees), max(grid.depths)
    nodes = Nodes.empty(trees, depth, 1 + classes)
    nodes.sums[:, :, 1, 0] = 2  # not known yet
    growing = points.filter("grows").select("view", "label", "bins", "weights")
    stats = STATS[: 1 + classes]
    sums = ", ".join(f"{s} bigint" for s in stats)
    cuts = ", ".join(f"{side}_{s} bigint" for s in stats for side in ("left", "right"))
    for level in range(depth):
        allowed = np.zeros((trees, 2 ** (depth + 1), n_inputs), bool)
        for tree in range(trees):
            for node in range(2**level, 2 ** (level + 1)):
                if nodes.sums[:, tree, node, 0].max() > 1:
                    chosen = candidate_inputs(tree, node, n_inputs, most, grid.seed)
                    allowed[tree, node, chosen] = True
        if not allowed.any():
            break
        if level == 0:
            nodes.sums[:, :, 1, 0] = 0  # stays so in trees that drew no row
        cells = growing.mapInArrow(
            _histograms(nodes, level, allowed, classes, n_inputs),
            f"forest bigint, node bigint, feature bigint, bin bigint, {sums}",
        )
        added = cells.groupBy("forest", "node", "feature", "bin").agg(
            *[F.sum(s).alias(s) for s in stats]
        )
        found = added.groupBy("forest").applyInArrow(
            _best_cuts(classes), f"forest bigint, node bigint, feature bigint, bin bigint, {cuts}"
        )
        for row in found.collect():
            at = divmod(row.forest, trees)
            left = [row[f"left_{s}"] for s in stats]
            right = [row[f"right_{s}"] for s in stats]
            nodes.sums[(*at, row.node)] = [a + b for a, b in zip(left, right, strict=True)]
            if row.feature >= 0:
                nodes.feature[(*at, row.node)], nodes.cut[(*at, row.node)] = row.feature, row.bin
                nodes.sums[(*at, 2 * row.node)] = left
                nodes.sums[(*at, 2 * row.node + 1)] = right
    return nodes


def node_table(
    spark: SparkSession, nodes: Nodes, bounds: dict[tuple[int, int], np.ndarray], inputs: list[str]
) -> DataFrame:
    """Both forests as ``view, tree, node, depth, feature, threshold, n_rows, sums``.

    A row goes left where its input is at most the threshold; both are null in a leaf.
    """
    view, tree, node = np.nonzero(nodes.sums[..., 0] > 0)
    feature, cut = nodes.feature[view, tree, node], nodes.cut[view, tree, node]
    sums = nodes.sums[view, tree, node]
    limits = [
        float(bounds[v, f][c]) if f >= 0 else None
        for v, f, c in zip(view.tolist(), feature.tolist(), cut.tolist(), strict=True)
    ]
    table = pa.table(
        {
            "view": pa.array(view, pa.int32()),
            "tree": pa.array(tree, pa.int32()),
            "node": pa.array(node, pa.int32()),
            "depth": pa.array(np.floor(np.log2(node)), pa.float64()).cast(pa.int32()),
            "feature": pa.array([inputs[f] if f >= 0 else None for f in feature], pa.string()),
            "threshold": pa.array(limits, pa.float64()),
            "n_rows": pa.array(sums[:, 0], pa.int64()),
            "sums": pa.array(sums[:, 1:].tolist(), pa.list_(pa.int64())),
        }
    )
    return spark.createDataFrame(
        table,
        "view int, tree int, node int, depth int, feature string, threshold double, "
        "n_rows bigint, sums array<bigint>",
    )


# -- scoring ---------------------------------------------------------------------------


def _scored(nodes: Nodes, points: list[tuple[int, int]], classes: int, n_inputs: int, view: int):
    """For each grid point: the mean over its trees of a node's mean label, or the class whose
    shares in the nodes add up to most, the first of equal ones. Trees that drew no row take no
    part; without any there is no prediction."""

    def value(tree: int, at: np.ndarray) -> np.ndarray:
        sums = nodes.sums[view, tree, at].astype(np.float64)
        n = np.maximum(sums[:, :1], 1.0)
        return sums[:, 1:] / n / (MONEY if classes == 1 else 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = _matrix(batch, "bins", n_inputs)
            for trees, depth in points:
                total = np.zeros((batch.num_rows, classes))
                grown = [t for t in range(trees) if nodes.sums[view, t, 1, 0]]
                for tree in grown:
                    total += value(tree, nodes.reached(view, tree, bins, depth))
                found = total.argmax(axis=1) * 1.0
                if classes == 1 and grown:
                    found = total[:, 0] / len(grown)
                columns = {n: batch[n] for n in batch.schema.names if n not in ("bins", "view")}
                columns["numTrees"] = pa.array([trees] * batch.num_rows, pa.int32())
                columns["maxDepth"] = pa.array([depth] * batch.num_rows, pa.int32())
                columns["prediction"] = pa.array(found, mask=np.full(len(found), not grown))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _score_points(points: DataFrame, view: int, step: Callable, keep: list[str]) -> DataFrame:
    rows = points.filter((F.col("view") == view) & ~F.col("grows")).select("view", *keep, "bins")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(step, f"{kinds}, numTrees int, maxDepth int, prediction double")


def choose(holdout: DataFrame, score: Column, largest: bool) -> DataFrame:
    """``numTrees, maxDepth, score, best``: one row for each grid point.

    Scores are compared at six places; of equal ones the smaller forest is best.
    """
    scores = holdout.groupBy("numTrees", "maxDepth").agg(F.round(score, 6).alias("score"))
    rank = F.col("score").desc() if largest else F.col("score").asc()
    top = scores.orderBy(rank, "numTrees", "maxDepth").limit(1)
    top = top.select(F.col("numTrees").alias("_t"), F.col("maxDepth").alias("_d"))
    best = (F.col("numTrees") == F.col("_t")) & (F.col("maxDepth") == F.col("_d"))
    return scores.join(top, best, "left").select(
        "numTrees", "maxDepth", "score", F.col("_t").isNotNull().alias("best")
    )


def _fit(
    rows: DataFrame,
    inputs: list[str],
    values: dict[str, Column],
    parts: dict[str, float],
    classes: int,
    labels: list[str],
    keep: list[str],
    grid: TreeGrid,
) -> TableForest:
    """``rows`` need ``label``, an integer; ``values`` are what products are encoded by."""
    spark = rows.sparkSession
    ship_package(spark)
    own = [name for name in inputs if name != "DescriptionIndex"]
    rows = rows.select(*dict.fromkeys([*KEYS, "label", *keep, *own, grid.product]))
    inputs = [i for name in inputs for i in (values if name == "DescriptionIndex" else [name])]
    seen = in_views(rows, parts, grid.train_ratio)
    if any(i in values for i in inputs):
        seen = target_means(seen, grid.product, values)
    seen = cut_lineage(
        seen.select("view", "grows", "label", *keep, key_text().alias("key"), *inputs)
    )
    n_rows = seen.count()
    found = bin_bounds(seen, inputs, grid.bins).collect()
    bounds = {(r.view, r.feature): np.array(r.bounds) for r in found}
    n_inputs, trees = len(inputs), max(grid.trees)
    raw = seen.select(
        "view", "grows", "label", *keep, "key",
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)],
    )
    kinds = raw.select("view", "grows", "label", *keep).schema
    points = cut_lineage(
        raw.repartition(partitions_for(n_rows, grid.rows_per_partition), "key").mapInArrow(
            _binned(bounds, n_inputs, trees, grid.seed),
            ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds)
            + ", bins binary, weights binary",
        )
    )
    most = ceil(n_inputs / 3) if classes == 1 else ceil(sqrt(n_inputs))
    nodes = grow(points, n_inputs, classes, grid, most)
    step = _scored(nodes, grid.points, classes, n_inputs, TUNE)
    holdout = cut_lineage(_score_points(points, TUNE, step, ["label", *keep]))
    if classes == 1:
        gap = F.col("label") / MONEY - F.col("prediction")
        tuning = choose(holdout, F.sqrt(F.avg(gap * gap)), largest=False)
    else:
        hit = (F.col("label") == F.col("prediction")).cast("double")
        tuning = choose(holdout, F.avg(hit), largest=True)
    tuning = cut_lineage(tuning)
    best = tuning.filter("best").first()
    # no hold-out row: the largest forest
    chosen = (best.numTrees, best.maxDepth) if best else grid.points[-1]
    step = _scored(nodes, [chosen], classes, n_inputs, FINAL)
    predictions = _score_points(points, FINAL, step, ["label", *keep])
    table = node_table(spark, nodes, bounds, inputs)
    parameters = {"numTrees": chosen[0], "maxDepth": chosen[1]}
    return TableForest(predictions, table, tuning, holdout, parameters, inputs, labels)


def demand_forecast(
    features: DataFrame, inputs: list[str] = REGRESSION_INPUTS, grid: TreeGrid = TreeGrid()
) -> TableForest:
    """Predict monthly sales; ``features`` is read several times: pass a stored table.

    ``DescriptionIndex`` among ``inputs`` stands for the product, as its smoothed mean sales.
    The default inputs hold the label in disguise, see ``forest.demand_forecast``. A missing
    input counts as larger than all others. Rows without a label take no part.
    """
    label = F.round(F.col("TotalPrice") * MONEY).cast("bigint")
    rows = features.filter("TotalPrice IS NOT NULL").withColumn("label", label)
    means = {"product_mean": F.col("label")}
    keep = [*KEYS, "TotalPrice"]
    found = _fit(rows, inputs, means, REGRESSION_PARTS, 1, [], keep, grid)
    return replace(found, predictions=found.predictions.select(*keep, "prediction"))


def stock_forecast(
    labeled: DataFrame, inputs: list[str] = INVENTORY_INPUTS, grid: TreeGrid = TreeGrid()
) -> TableForest:
    """Predict the stock decision of a product-month.

    ``DescriptionIndex`` stands for the product, as its smoothed share of each decision but the
    last. Decisions are numbered by frequency, ties by name.
    """
    index = label_index(labeled)
    names = [r.stock_decision for r in index.orderBy("label").limit(len(STATS)).collect()]
    if len(names) >= len(STATS):
        raise ValueError(f"more than {len(STATS) - 1} decisions")
    place = F.lit(None).cast("bigint")
    for i, name in enumerate(names):
        place = F.when(F.col("stock_decision") == name, i).otherwise(place)
    rows = labeled.withColumn("label", place).filter("label IS NOT NULL")
    shares = {
        f"share_{i}": (F.col("label") == i).cast("bigint") for i in range(max(1, len(names) - 1))
    }
    keep = [*KEYS, "stock_decision"]
    classes = max(2, len(names))
    found = _fit(rows, inputs, shares, INVENTORY_PARTS, classes, names, keep, grid)
    said = F.get(F.lit(names) if names else F.array(F.lit("")), F.col("prediction").cast("int"))
    return replace(found, predictions=found.predictions.select(*keep, said.alias("predicted_label")))
