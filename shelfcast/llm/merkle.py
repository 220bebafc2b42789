"""A Merkle manifest of a document table, with proofs for its rows.

Every row is a leaf. The leaves of a language make a tree of ``FAN_OUT`` children a node, the
languages' subroots another one, whose top is the root. All nodes stand in one table,
``tree, level, position, digest``, built a level at a time by grouping.

Proofs are made an octopus at a time: a chunk of neighbouring leaves works out which node
coordinates its proofs need and it cannot derive itself, the union of them and each once;
one join fetches those of all chunks; then each chunk derives the interiors its leaves share
and writes out the single proofs. Neighbours share nearly all of their proofs, so a chunk of
4,096 leaves fetches a few dozen nodes, whatever the number of leaves.

Digests are lowercase hex SHA-256 texts; the digest of several is that of their concatenation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ship, stored
from shelfcast.operators.order import numbered

FAN_OUT = 8
CHUNK = FAN_OUT**4  # leaves whose proofs are made together
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1  # the tree over the subroots
HEX = 64


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf_digest(**changed: Column) -> Column:
    """Digest of a document row; ``changed`` takes the place of its own values."""
    values = (changed.get(name, F.col(name)) for name in FIELDS)
    return F.sha2(F.concat(*map(_field, values)), 256)


@dataclass(frozen=True)
class Manifest:
    """``leaves``: tree, position, lang, doc_id, leaf and what was asked for beside them;
    ``trees``: tree, lang, n_leaves; ``nodes``: tree, level, position, digest, leaves of the
    languages excluded; ``root``: digest, one row, none for an empty table."""

    leaves: DataFrame
    trees: DataFrame
    nodes: DataFrame
    root: DataFrame
    n_trees: int


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while FAN_OUT**levels < n:
        levels += 1
    return levels


def _levels(base: DataFrame, most: int) -> list[DataFrame]:
    """The levels above ``base`` (tree, n_leaves, position, digest), each a stored table.

    A tree of one node has none, so it drops out where its top is reached.
    """
    found = []
    for level in range(1, height(most) + 1):
        parent = F.floor(F.col("position") / FAN_OUT).cast("bigint")
        run = F.array_sort(F.collect_list(F.struct("position", "digest")))
        base = stored(
            base.filter(F.col("n_leaves") > FAN_OUT ** (level - 1))
            .groupBy("tree", "n_leaves", parent.alias("position"))
            .agg(F.sha2(F.array_join(run["digest"], ""), 256).alias("digest"))
        )
        found.append(base.withColumn("level", F.lit(level)))
    return found


def _top_of(levels: list[DataFrame], base: DataFrame) -> DataFrame:
    """``tree, digest`` of each tree's last node."""
    tops = [base.filter("n_leaves = 1")]
    for level, nodes in enumerate(levels, 1):
        last = F.col("n_leaves") > FAN_OUT ** (level - 1)
        tops.append(nodes.filter(last & (F.col("n_leaves") <= FAN_OUT**level)))
    return reduce(DataFrame.unionByName, (t.select("tree", "digest") for t in tops))


def build(docs: DataFrame, **beside: Column) -> Manifest:
    """The manifest of ``docs`` (``doc_id, source, lang, n_chars, text``; others are ignored).

    ``beside`` are further columns to keep for each leaf. In a language, leaves ascend by id,
    null ids first, rows that repeat an id by digest; equal rows are leaves of their own. A null
    language is one, the first; null values have a digest unlike empty ones. An empty table has
    no tree and no root. Texts are hashed whole, in the scan.
    """
    leaves = docs.select("lang", "doc_id", leaf_digest().alias("leaf"), *[
        value.alias(name) for name, value in beside.items()
    ])
    order = [F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    placed = stored(numbered(leaves, order, "position", within="lang"))
    sizes = placed.groupBy("lang").agg(F.count(F.lit(1)).alias("n_leaves"))
    trees = stored(numbered(sizes, [F.col("lang").asc_nulls_first()], "tree"))
    facts = trees.agg(F.count(F.lit(1)).alias("n"), F.max("n_leaves").alias("most")).first()
    named = trees.withColumnRenamed("lang", "_lang")
    leaves = stored(placed.join(named, placed["lang"].eqNullSafe(named["_lang"])).drop("_lang"))

    base = leaves.select("tree", "n_leaves", "position", F.col("leaf").alias("digest"))
    inner = _levels(base, facts.most or 0)
    subroots = stored(
        _top_of(inner, base).select(
            F.lit(TOP).cast("bigint").alias("tree"),
            F.lit(facts.n).cast("bigint").alias("n_leaves"),
            F.col("tree").alias("position"),
            "digest",
        )
    )
    above = _levels(subroots, facts.n)
    columns = ["tree", "level", "position", "digest"]
    parts = [*inner, subroots.withColumn("level", F.lit(0)), *above]
    nodes = reduce(DataFrame.unionByName, (p.select(*columns) for p in parts))
    root = _top_of(above, subroots).select("digest")
    return Manifest(leaves, trees, nodes, root, facts.n)


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _run(position: int, width: int) -> range:
    """The positions of a node's run on a level of ``width`` nodes."""
    first = position - position % FAN_OUT
    return range(first, min(first + FAN_OUT, width))


def _widths(n: int) -> list[int]:
    """Nodes on each level of a tree of ``n`` leaves, the top left out."""
    widths = []
    while n > 1:
        widths.append(n)
        n = -(-n // FAN_OUT)
    return widths


def missing(positions: set[int], n_leaves: int) -> list[tuple[int, int]]:
    """``(level, position)`` of the nodes that proofs for ``positions`` need and that cannot be
    derived from them: the least such set."""
    wanted, known = [], set(positions)
    for level, width in enumerate(_widths(n_leaves)):
        runs = {p // FAN_OUT for p in known}
        for run in sorted(runs):
            wanted += [(level, p) for p in _run(run * FAN_OUT, width) if p not in known]
        known = runs
    return wanted


def derive(known: dict[tuple[int, int], str], positions: set[int], n_leaves: int) -> str:
    """Add the interiors above ``positions`` to ``known``; returns the top."""
    for level, width in enumerate(_widths(n_leaves)):
        runs = {p // FAN_OUT for p in positions}
        for run in runs:
            known[level + 1, run] = _digest([known[level, p] for p in _run(run * FAN_OUT, width)])
        positions = runs
    (top,) = positions
    return known[len(_widths(n_leaves)), top]


def _wanted(n_trees: int):
    def run(key, table):
        tree, chunk = (k.as_py() for k in key)
        n_leaves = table["n_leaves"][0].as_py()
        own = [(tree, *c) for c in missing(set(table["position"].to_pylist()), n_leaves)]
        own += [(TOP, *c) for c in missing({tree}, n_trees)]
        return pa.table(
            {
                "tree": pa.array([tree] * len(own), pa.int64()),
                "chunk": pa.array([chunk] * len(own), pa.int64()),
                "in_tree": pa.array([c[0] for c in own], pa.int64()),
                "level": pa.array([c[1] for c in own], pa.int32()),
                "at": pa.array([c[2] for c in own], pa.int64()),
            }
        )

    return run


def _steps(known: dict, place: int, n_leaves: int) -> Iterator[tuple[int, str]]:
    """Per level: the leaf's place in its run, and the digests of the others."""
    for level, width in enumerate(_widths(n_leaves)):
        run = _run(place, width)
        yield place - run.start, "".join(known[level, p] for p in run if p != place)
        place //= FAN_OUT


def _expanded(n_trees: int, schema: pa.Schema):
    def run(key, leaves, fetched):
        tree = key[0].as_py()
        if not leaves.num_rows:
            return schema.empty_table()
        n_leaves = leaves["n_leaves"][0].as_py()
        places = leaves["position"].to_pylist()
        inside = dict(zip(((0, p) for p in places), leaves["leaf"].to_pylist(), strict=True))
        above: dict[tuple[int, int], str] = {}
        nodes = (fetched[c].to_pylist() for c in ("in_tree", "level", "at", "digest"))
        for in_tree, level, at, digest in zip(*nodes, strict=True):
            (above if in_tree == TOP else inside)[level, at] = digest
        above[0, tree] = subroot = derive(inside, set(places), n_leaves)
        root = derive(above, {tree}, n_trees)
        last = list(_steps(above, tree, n_trees))
        proofs = [[*_steps(inside, p, n_leaves), *last] for p in places]
        columns = {name: leaves[name] for name in leaves.column_names if name in schema.names}
        columns["subroot"] = pa.array([subroot] * len(places))
        columns["root"] = pa.array([root] * len(places))
        columns["places"] = pa.array([[s[0] for s in p] for p in proofs], pa.list_(pa.int32()))
        columns["siblings"] = pa.array([[s[1] for s in p] for p in proofs], pa.list_(pa.string()))
        return pa.table([columns[f.name].cast(f.type) for f in schema], schema=schema)

    return run


def prove(manifest: Manifest, chosen: DataFrame | None = None) -> DataFrame:
    """The proofs of ``chosen`` leaves (rows of ``manifest.leaves``; all of them if not given).

    The leaves' columns, ``subroot, root``, and the proof, level by level from the leaf to
    the root: ``places`` (int) of the way in its run, ``siblings`` (string), the run's other
    digests joined from left to right, empty where the run is one node. Top levels are wanted by
    every chunk: their join key is hot, and is split by adaptive execution's skew join.
    """
    chosen = manifest.leaves if chosen is None else chosen
    ship(chosen.sparkSession)
    chunked = chosen.withColumn("chunk", F.floor(F.col("position") / CHUNK).cast("bigint"))
    wanted = (
        chunked.select("tree", "chunk", "n_leaves", "position")
        .groupBy("tree", "chunk")
        .applyInArrow(
            _wanted(manifest.n_trees),
            "tree bigint, chunk bigint, in_tree bigint, level int, at bigint",
        )
    )
    base = manifest.leaves.select(
        "tree", F.lit(0).alias("level"), "position", F.col("leaf").alias("digest")
    )
    nodes = manifest.nodes.unionByName(base).toDF("in_tree", "level", "at", "digest")
    fetched = wanted.join(nodes, ["in_tree", "level", "at"]).select(
        "tree", "chunk", "in_tree", "level", "at", "digest"
    )
    kept = [f for f in chosen.schema if f.name != "n_leaves"]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    out += ", subroot string, root string, places array<int>, siblings array<string>"
    empty = chosen.sparkSession.createDataFrame([], out)
    return (
        chunked.groupBy("tree", "chunk")
        .cogroup(fetched.groupBy("tree", "chunk"))
        .applyInArrow(_expanded(manifest.n_trees, empty.toArrow().schema), out)
    )


def folded(leaf: Column, places: Column, siblings: Column) -> Column:
    """The root that a leaf and a proof lead to."""

    def up(digest: Column, step: Column) -> Column:
        left = step["places"] * HEX
        return F.sha2(
            F.concat(
                F.substring(step["siblings"], F.lit(1), left),
                digest,
                F.substring(step["siblings"], left + 1, F.length(step["siblings"])),
            ),
            256,
        )

    return F.aggregate(F.arrays_zip(places, siblings), leaf, up)


def proof_digest(siblings: Column) -> Column:
    return F.sha2(F.array_join(siblings, ""), 256)
