"""Near-duplicate documents by circulant MinHash, banding and exact confirmation.

A signature comes from two permutations of ``0 .. UNIVERSE - 1``: ``sigma`` scatters the
shingles, and coordinate ``k`` is the least value of ``pi`` read at ``sigma + k``. One
permutation, shifted circularly, thus serves for all coordinates.

Every stage works on distinct shingle sets (copies are one node), no bucket is expanded
into all of its pairs, and links are confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ship, stored, word_bytes
from shelfcast.llm.graph import components

UNIVERSE = 1 << 20
COORDINATES = 128
ROWS = 4  # of a band: 32 bands miss a pair of similarity 0.8 once in 20 million
SEED = 20_17
GROUP = 64  # texts held against one hub text in a task
LEFT, RIGHT = 256, 1024  # texts of a block of a large group
CHUNK = 4096
MIX = np.uint64(0x9E3779B97F4A7C15)
_WORDS = 400_000  # word hashes remembered in a task


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int, hashes: dict) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles.

    Fewer words than ``width``: the whole sequence is the one shingle. No word: empty.
    """
    found = word_bytes(text)
    if not found:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    span = min(width, len(codes))
    last = len(codes) - span + 1
    code = np.full(last, span, np.uint64)
    for k in range(span):
        code = _stir(code * MIX + codes[k : k + last])
    return np.unique(code)


class Signer:
    """Circulant MinHash signatures and their band keys."""

    def __init__(self, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.sigma = draw.permutation(UNIVERSE).astype(np.int32)
        pi = draw.permutation(UNIVERSE).astype(np.int32)
        ring = np.concatenate([pi, pi[: COORDINATES - 1]])
        self.shifts = np.lib.stride_tricks.sliding_window_view(ring, COORDINATES)

    def signature(self, codes: np.ndarray) -> np.ndarray:
        at = self.sigma[(codes >> np.uint64(44)).astype(np.int64)]
        parts = [self.shifts[at[i : i + CHUNK]].min(axis=0) for i in range(0, len(at), CHUNK)]
        return parts[0] if len(parts) == 1 else np.minimum.reduce(parts)

    def keys(self, codes: np.ndarray) -> np.ndarray:
        bands = self.signature(codes).astype(np.uint64).reshape(-1, ROWS)
        key = _stir(np.arange(1, len(bands) + 1, dtype=np.uint64) * MIX)
        for k in range(ROWS):
            key = _stir(key * MIX + bands[:, k])
        return key.view(np.int64)


def _signed(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, hashes = Signer(), _Hashes()
        for batch in batches:
            sets = [shingles(text, width, hashes) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array(
                        [signer.keys(s) if len(s) else [] for s in sets], pa.list_(pa.int64())
                    ),
                ],
                ["doc_id", "n_shingles", "print", "keys"],
            )

    return sign


def _confirmed(width: int, percent: int):
    def confirm(group: pd.DataFrame) -> pd.DataFrame:
        hashes = _Hashes()
        hubs = [shingles(t, width, hashes) for t in group.loc[group["is_hub"], "text"]]
        found = []
        for row in group[~group["is_hub"]].itertuples(index=False):
            own = shingles(row.text, width, hashes)
            for hub in hubs:
                both = len(np.intersect1d(hub, own, assume_unique=True))
                if both and 100 * both >= percent * (len(hub) + len(own) - both):
                    found.append((row.a, row.doc))
                    break
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return confirm


def confirm_pairs(
    pairs: DataFrame, texts: DataFrame, width: int = 5, percent: int = 80
) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full shingle sets link.

    A hub ``a`` with many partners is dealt over salted groups of about ``GROUP`` partners;
    its text travels once per group, not once per pair.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    dealt = pairs.join(parts, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("salt")
    )
    partners = dealt.select(F.col("b").alias("doc"), "a", "salt", F.lit(False).alias("is_hub"))
    hubs = dealt.select(F.col("a").alias("doc"), "a", "salt", F.lit(True).alias("is_hub"))
    routes = partners.unionByName(hubs.distinct())
    routed = routes.join(texts.select(F.col("doc_id").alias("doc"), "text"), "doc")
    return (
        routed.groupBy("a", "salt")
        .applyInPandas(_confirmed(width, percent), "a bigint, b bigint")
        .distinct()
    )


def _between(width: int, percent: int):
    """Links between the left and the right texts of a block, of different components."""

    def links(block: pd.DataFrame) -> pd.DataFrame:
        hashes, found = _Hashes(), []
        left = block[block["is_left"]].drop_duplicates("node").sort_values("node")
        sets = [shingles(t, width, hashes) for t in left["text"]]
        right = block[~block["is_left"]].drop_duplicates("node").sort_values("node")
        others = [
            (n, c, shingles(t, width, hashes))
            for n, c, t in zip(right["node"], right["component"], right["text"], strict=True)
        ]
        nodes, parts = left["node"].to_numpy(), left["component"].to_numpy()
        sizes = np.array([len(x) for x in sets], np.int64)
        at = 0
        while at < len(sets):
            stop, held = at + 1, sizes[at]
            while stop < len(sets) and stop - at < 64 and held + sizes[stop] <= 200_000:
                held += sizes[stop]
                stop += 1
            codes, place = np.unique(np.concatenate(sets[at:stop]), return_inverse=True)
            marks = np.zeros((len(codes), stop - at), bool)
            marks[place, np.repeat(np.arange(stop - at), sizes[at:stop])] = True
            seen = set()
            for node, part, own in others:
                where = np.searchsorted(codes, own)
                where[where == len(codes)] = 0
                both = marks[where[codes[where] == own]].sum(axis=0)
                linked = (both > 0) & (
                    100 * both >= percent * (sizes[at:stop] + len(own) - both)
                )
                for i in np.flatnonzero(linked & (parts[at:stop] != part)):
                    if (at + i, part) not in seen:  # one link to a component is enough
                        seen.add((at + i, part))
                        found.append((nodes[at + i], node))
            at = stop
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return links


def confirm_groups(
    placed: DataFrame, texts: DataFrame, width: int = 5, percent: int = 80
) -> DataFrame:
    """Links between members of different components of a group: ``a`` (the group), ``node``,
    ``component``.

    The members outside the group's largest component, in blocks of ``LEFT``, are held
    against those of the largest, in blocks of ``RIGHT``, and against each other. A task holds
    one block of each, however large the group.
    """
    sizes = placed.groupBy("a", "component").agg(F.count("*").alias("held"))
    group = (
        sizes.groupBy("a")
        .agg(
            F.count("*").alias("parts"),
            F.sum("held").alias("all"),
            F.max(F.struct("held", "component")).alias("top"),
        )
        .filter("parts > 1")
        .select(
            "a",
            F.col("top.component").alias("core"),
            F.ceil((F.col("all") - F.col("top.held")) / LEFT).alias("lefts"),
            F.ceil(F.col("top.held") / RIGHT).alias("rights"),
        )
    )
    rows = placed.join(group, "a").withColumn("inner", F.col("component") == F.col("core"))
    rows = rows.withColumn(
        "block",
        F.pmod(F.xxhash64("node"), F.when(F.col("inner"), F.col("rights")).otherwise(F.col("lefts"))),
    )
    lefts = rows.filter("NOT inner").select(
        "a", "node", "component", F.lit(True).alias("is_left"), F.col("block").alias("l"),
        F.explode(F.expr(
            "concat(sequence(0L, rights - 1), sequence(rights + block, rights + lefts - 1))"
        )).alias("r"),
    )
    same = rows.filter("NOT inner").select(
        "a", "node", "component", F.lit(False).alias("is_left"),
        F.explode(F.expr("sequence(0L, block)")).alias("l"),
        (F.col("rights") + F.col("block")).alias("r"),
    )
    cores = rows.filter("inner").select(
        "a", "node", "component", F.lit(False).alias("is_left"),
        F.explode(F.expr("sequence(0L, lefts - 1)")).alias("l"), F.col("block").alias("r"),
    )
    routed = lefts.unionByName(same).unionByName(cores)
    with_text = routed.join(texts.select(F.col("doc_id").alias("node"), "text"), "node")
    return (
        with_text.groupBy("a", "l", "r")
        .applyInPandas(_between(width, percent), "a bigint, b bigint")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Component of every document: ``doc_id, n_shingles, component_id, kept``.

    Two documents link when 100 * |intersection| >= percent * |union| of their distinct
    ``width``-word shingles. ``component_id`` is the least id reachable over links, ``kept``
    marks the document that has it.

    One row comes back per row that went in. Null and blank texts have an empty set and
    link with nothing. Rows that repeat an id are one document: they share a component, and
    all are marked kept if it is theirs. A null id links with nothing: null component, kept.
    Other columns are ignored, whatever their names.

    Candidates: documents with an equal band key. In a bucket, members are first held
    against its hub, the member that shares most bucket places; links collapse most buckets
    into one component. Then, for all buckets of a hub together, the members outside the
    largest component are held against every member of another component, in blocks that
    give back links only. No candidate is passed over, and no list of pairs is made.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = stored(
        rows.mapInArrow(
            _signed(width), "doc_id bigint, n_shingles bigint, print binary, keys array<bigint>"
        )
    )
    nodes = (
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("print")
        .agg(
            F.min("doc_id").alias("node"),
            F.first("n_shingles").alias("n"),
            F.first("keys").alias("keys"),
        )
    )
    places = nodes.select("node", "n", F.explode("keys").alias("key"))
    shared = places.groupBy("key").agg(F.count("*").alias("held")).filter("held > 1")
    members = stored(places.join(shared, "key"))
    wanted = members.select(F.col("node").alias("doc_id")).distinct()
    texts = stored(rows.join(wanted, "doc_id"))

    weight = members.groupBy("node").agg(F.sum("held").alias("weight"))
    ranked = members.join(weight, "node")
    hubs = ranked.groupBy("key").agg(
        F.max(F.struct("weight", (-F.col("node")).alias("minus"), "n")).alias("hub")
    )
    near_size = F.least("n", "hub_n") * 100 >= F.greatest("n", "hub_n") * percent
    stars = stored(
        members.join(
            hubs.select("key", (-F.col("hub.minus")).alias("a"), F.col("hub.n").alias("hub_n")),
            "key",
        )
        .filter((F.col("node") != F.col("a")) & near_size)
        .select("a", F.col("node").alias("b"))
        .distinct()
    )
    links = stored(confirm_pairs(stars, texts, width, percent))
    found = stored(components(links))

    groups = members.join(hubs.select("key", (-F.col("hub.minus")).alias("a")), "key")
    placed = groups.select("a", "node").distinct().join(found, "node", "left")
    placed = placed.select("a", "node", F.coalesce("component", "node").alias("component"))
    more = confirm_groups(stored(placed), texts, width, percent)
    kept_nodes = nodes.select("print", "node")
    twice = (
        signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("print").alias("low"), F.max("print").alias("high"))
        .filter("low < high")
        .select("doc_id")
    )
    repeats = (
        signed.join(twice, "doc_id")
        .join(kept_nodes, "print")
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    final = components(links.unionByName(more).unionByName(repeats))

    classes = nodes.select("print", "node").join(final, "node", "left")
    least = classes.select("print", F.coalesce("component", "node").alias("least"))
    out = signed.select("doc_id", "n_shingles", "print").join(least, "print", "left")
    out = out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"),
    )
    return out.withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
