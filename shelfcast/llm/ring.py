"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at many points of a ring (its virtual nodes), a row at one, the hash of
its key. A row goes to the first shard clockwise that is not full; what overflows a full one
continues clockwise. Rows are inserted in the order of their place on the ring, so an arc
(the rows between two virtual nodes) is filled by the totals alone: the walk around the ring
sees one total per arc, ``shards * nodes`` numbers whatever the number of rows, and gives for
each arc the stretches of its rows that go to one shard. Rows meet their stretch in a join.

No bound is exceeded, so balance is guaranteed. Where a shard is added, only rows on the arcs
that it takes over, and what the tighter bounds push on, move.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import stored
from shelfcast.operators.order import in_order, part_of

SEED = "ring-1"
NODES = 256  # virtual nodes of a shard
DIGITS = 15  # hex digits of a hash that are a place on the ring


def place_of(key: Column) -> Column:
    """Place on the ring of a key, null being the empty text."""
    text = F.concat(F.lit(f"{SEED}:key:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("bigint")


def virtual_nodes(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """``(place, shard)`` of all virtual nodes, clockwise."""

    def place(shard: int, node: int) -> int:
        text = f"{SEED}:shard {shard} node {node}"
        return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)

    return sorted((place(s, n), s) for s in range(shards) for n in range(nodes))


def bounds(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """The load that each shard holds at most.

    Without slack they add up to the total and differ by one at most, so every shard is full.
    """
    if slack:
        return [-(-int(total * (1 + slack)) // shards) + 1] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def walk(loads: dict[int, int], ring: list[tuple[int, int]], room: list[int]) -> list[tuple]:
    """``(arc, start, shard)``: from which load of its arc on rows go to ``shard``.

    ``loads`` has the total of every arc; arc ``i`` ends at virtual node ``i``, the last one
    past all nodes at the first. Arcs are filled in the order of the ring.
    """
    room = list(room)
    found = []
    for arc in sorted(loads):
        at, left, seen = 0, loads[arc], set()
        for step in range(len(ring)):
            shard = ring[(arc + step) % len(ring)][1]
            if shard in seen:
                continue
            seen.add(shard)
            took = min(left, room[shard])
            if took:
                found.append((arc, at, shard))
                at, left, room[shard] = at + took, left - took, room[shard] - took
            if not left:
                break
    return found


def assign(
    rows: DataFrame,
    shards: int,
    key: str = "doc_id",
    load: str | None = None,
    slack: float = 0.0,
    nodes: int = NODES,
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, its place 0, 1, ... in the shard.

    Every shard holds ``bounds(...)`` rows at most, or, with ``load``, so much of that column
    (integers from 1 on); a row belongs where its first unit of load does, so that a shard may
    then exceed its bound by part of a row wherever a stretch ends. Other columns pass through.

    The key decides the place on the ring; a key that many rows share, null included, fills one
    shard after the other. Rows of one place are inserted by all their columns, equal rows
    share a task there. Reruns agree. An empty table has no shards. Columns that clash with
    ``shard`` or ``slot`` are replaced; ``_ring`` and names that begin with it are taken.
    """
    names = [c for c in rows.columns if c not in ("shard", "slot")]
    spark, row = rows.sparkSession, F.struct(*names)
    weight = F.lit(1) if load is None else F.col(load)
    placed = rows.select(
        row.alias("_ring_row"),
        place_of(F.col(key)).alias("_ring_place"),
        weight.cast("bigint").alias("_ring_load"),
        F.lit(0).alias("_ring_node"),
    )
    ring = virtual_nodes(shards, nodes)
    marks = spark.createDataFrame([(p,) for p, _ in ring], "_ring_place bigint").select(
        F.lit(None).cast(row_type(rows, names)).alias("_ring_row"),
        "_ring_place",
        F.lit(0).cast("bigint").alias("_ring_load"),
        F.lit(1).alias("_ring_node"),
    )
    sums = _running(
        in_order(
            placed.unionByName(marks),
            [F.col("_ring_place"), F.col("_ring_node"), F.col("_ring_row")],
        ),
        {"_ring_arc": "_ring_node", "_ring_at": "_ring_load"},
    ).filter("_ring_node = 0")
    sums = stored(sums.select("_ring_row", "_ring_arc", "_ring_at", "_ring_load", "_id"))
    arcs = sums.groupBy("_ring_arc").agg(
        F.sum("_ring_load").alias("load"), F.min("_ring_at").alias("first")
    )
    # one row for each of shards * nodes + 1 arcs at most
    found = {r["_ring_arc"]: r for r in arcs.collect()}
    loads = {arc: r["load"] for arc, r in found.items()}
    cuts = walk(loads, ring, bounds(sum(loads.values()), shards, slack))
    stretches = []
    for i, (arc, start, shard) in enumerate(cuts):
        next_ = cuts[i + 1][1] if i + 1 < len(cuts) and cuts[i + 1][0] == arc else loads[arc]
        first = found[arc]["first"]
        stretches.append((arc, i, first + start, first + next_, shard))
    table = spark.createDataFrame(
        stretches, "_ring_arc bigint, _ring_cut int, _ring_from bigint, _ring_to bigint, shard int"
    )
    # at most shards * nodes + shards + 1 stretches, so small at every size
    inside = (F.col("_ring_at") >= F.col("_ring_from")) & (F.col("_ring_at") < F.col("_ring_to"))
    homed = sums.join(F.broadcast(table), "_ring_arc").filter(inside)
    return _slots(homed).select("_ring_row.*", "shard", "slot")


def row_type(rows: DataFrame, names: list[str]):
    return rows.select(F.struct(*names).alias("r")).schema["r"].dataType


def _running(placed: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Add running sums over the order of ``_id``, the row itself excluded.

    They run inside each partition, and from one to the next over a row for each.
    """
    part = part_of(F.col("_id"))
    held = placed.groupBy(part.alias("_part")).agg(
        *[F.sum(column).alias(f"_{name}") for name, column in sums.items()]
    )
    zero = F.lit(0).cast("bigint")
    until = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        "_part", *[F.coalesce(F.sum(f"_{n}").over(until), zero).alias(f"_{n}") for n in sums]
    )
    inside = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumn("_part", part)
    own = own.withColumns({n: F.coalesce(F.sum(c).over(inside), zero) for n, c in sums.items()})
    return own.join(starts, "_part").withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums})


def _slots(homed: DataFrame) -> DataFrame:
    """Add ``slot``: places inside a stretch and partition, shifted by those before in the shard."""
    part = part_of(F.col("_id"))
    piece = Window.partitionBy("_part", "_ring_cut").orderBy("_id")
    own = homed.withColumn("_part", part)
    held = own.groupBy("shard", "_ring_cut", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_ring_cut", "_part")
    until = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select(
        "_ring_cut", "_part", F.coalesce(F.sum("_n").over(until), F.lit(0)).alias("_before")
    )
    placed = own.withColumn("_inside", F.row_number().over(piece) - 1)
    return placed.join(starts, ["_ring_cut", "_part"]).withColumn(
        "slot", (F.col("_before") + F.col("_inside")).cast("bigint")
    )


def write_shards(assigned: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Write a folder ``shard=N`` for each shard, in files of ``rows_per_file`` rows, by slot."""
    file = F.floor(F.col("slot") / rows_per_file)
    (
        assigned.repartition("shard", file)
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(path)
    )


def read_shard(spark, path: str, shard: int) -> DataFrame:
    """The rows of one shard; the others' files are not opened."""
    return spark.read.parquet(path).filter(F.col("shard") == shard)
