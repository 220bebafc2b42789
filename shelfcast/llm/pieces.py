"""SentencePiece encoding and decoding as a relational lattice.

A text is normalised as the model says and cut where no piece can span. Each distinct
segment is encoded once: its substrings of bounded length are exploded, joined to the
piece table by equality, and the edges found are grouped by segment. A fold over the group,
by Spark's higher-order ``aggregate``, then picks the pieces: the best path (Viterbi) for a
unigram model, the merges in order of rank for a merge (BPE) model, whose pieces are not
those of the best path. Both give the ids of the SentencePiece library.

The commonest segments go to the tasks as a table of bounded size; a document's other
segments reach it by a join. Both are Arrow tables, texts are cut by the kinds of neighbouring
characters, and a batch looks each of its distinct segments up once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import lean, ship, stored

MARK = "▁"
FOLDED = 40  # characters of a segment that goes through the lattice; longer ones: a heap
ID_BITS = 21
ID_SPAN = 1 << ID_BITS  # ids and ranks of a merge model are below it
COMMON = 300_000  # segments sent to every task at most
DEALT = 16  # tasks that look up the common ones
SLICE = 200  # texts cut or decoded at a time
SHARE = 1 << 21  # segments of the texts, repeats counted, whose rare ones a task looks up
_FLUSH = 1_000_000  # rows of counts that a task holds before it sums them, or sends them on
# fixed values: kinds of piece and of model in the model file
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
UNIGRAM, BPE = 1, 2
_MARK, _SIGN, _LONER = 1, 2, 3  # kinds of characters, beside others


@dataclass(frozen=True)
class Model:
    """What a model file says."""

    kind: int
    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    dummy_prefix: bool
    loners: str  # ASCII characters that stand in no longer piece, so nothing spans them
    signs: str  # signs of the pieces that stand in none beside anything but signs and the mark
    bytes_of: dict[int, int] = field(default_factory=dict)  # byte -> id
    single: dict[str, int] = field(default_factory=dict)  # character that is a piece -> id

    @property
    def longest(self) -> int:
        return max((len(p) for p, k in zip(self.pieces, self.kinds) if k == NORMAL), default=1)

    def normal(self) -> list[tuple[str, int, float]]:
        rows = zip(self.pieces, range(len(self.pieces)), self.scores, self.kinds)
        return [(p, i, s) for p, i, s, k in rows if k == NORMAL]

    def fallback(self, character: str) -> list[int]:
        """Ids of a character by itself: of its piece, else of its bytes."""
        if character in self.single:
            return [self.single[character]]
        return [self.bytes_of[b] for b in character.encode("utf-8")]

    def normalise(self, text: str) -> str:
        plain = text.replace(" ", MARK)
        return MARK + plain if self.dummy_prefix and plain else plain


@lru_cache(maxsize=4)
def load(path: str) -> Model:
    """Read a model file. Only plain models are taken: no normalising rules, no user pieces,
    no piece that runs over a word's start, and a piece for every byte."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    kinds = tuple(p.type for p in model.pieces)
    pieces = tuple(p.piece for p in model.pieces)
    if model.trainer_spec.model_type not in (UNIGRAM, BPE):
        raise ValueError("not a unigram or BPE model")
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or USER_DEFINED in kinds:
        raise ValueError("a model with normalising rules or user-defined pieces")
    if kinds.count(BYTE) != 256:
        raise ValueError("a model without byte pieces")
    for piece, kind in zip(pieces, kinds, strict=True):
        if kind == NORMAL and len(piece) > 1:
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"a piece that spans segments: {piece!r}")
    longer = [p for p, k in zip(pieces, kinds) if k == NORMAL and len(p) > 1]
    spanned = {c for p in longer for c in p}
    loners = {chr(c) for c in range(128)} - spanned - {" "}
    signs = {c for c in spanned if not c.isalpha()} - {MARK}
    while mixed := {
        sign
        for piece in longer
        for sign in signs.intersection(piece)
        if not signs.issuperset(piece.replace(MARK, ""))
    }:
        signs -= mixed
    return Model(
        model.trainer_spec.model_type,
        pieces,
        tuple(p.score for p in model.pieces),
        kinds,
        bool(rules.add_dummy_prefix),
        "".join(sorted(loners)),
        "".join(sorted(signs)),
        {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == BYTE},
        {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == NORMAL and len(p) == 1},
    )


@lru_cache(maxsize=4)
def _kinds(loners: str, signs: str) -> np.ndarray:
    """The kind of every character up to the last special one, and that of all others."""
    table = np.zeros(max(map(ord, MARK + loners + signs)) + 2, np.uint8)
    table[ord(MARK)] = _MARK
    table[[ord(c) for c in signs]] = _SIGN
    table[[ord(c) for c in loners]] = _LONER
    return table


def _cut_some(model: Model, texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    whole = [model.normalise(text) if text else "" for text in texts]
    sizes = np.array([len(text) for text in whole], np.int64)
    joined = "".join(whole)
    characters = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    table = _kinds(model.loners, model.signs)
    kinds = table[np.minimum(characters, len(table) - 1)]
    begins = kinds == _LONER
    begins[1:] |= (kinds[1:] != kinds[:-1]) & (kinds[:-1] != _MARK)
    begun = np.concatenate([[0], np.cumsum(sizes)])
    begins[begun[:-1][sizes > 0]] = True
    upto = np.concatenate([[0], np.cumsum(begins)])
    raw = joined.encode("utf-8")
    wide = np.ones(len(characters), np.uint8)
    for least in (0x80, 0x800, 0x10000):
        wide += characters >= least
    at = (np.cumsum(wide, dtype=np.int64) - wide)[begins]
    offsets = np.append(at, len(raw))
    found = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(raw))
    return found, np.diff(upto[begun])


@dataclass
class Cut:
    """The distinct segments of some texts, and the places in it of those of text ``i``, one
    after the other: ``places[starts[i]:starts[i + 1]]``."""

    names: pa.Array
    places: np.ndarray
    starts: np.ndarray

    @property
    def short(self) -> np.ndarray:
        """Which names go through the lattice."""
        return pc.utf8_length(self.names).to_numpy() <= FOLDED


def cut_texts(model: Model, texts: pa.Array) -> Cut:
    """Normalised texts cut before words, around characters that no piece spans, and between
    signs and other characters if no piece holds both."""
    parts = [
        _cut_some(model, texts.slice(i, SLICE).to_pylist()) for i in range(0, len(texts), SLICE)
    ]
    if not parts:
        return Cut(pa.array([], pa.large_string()), np.zeros(0, int), np.zeros(1, int))
    coded = pa.concat_arrays([found for found, _ in parts]).dictionary_encode()
    starts = np.concatenate([[0], *[sizes for _, sizes in parts]]).cumsum()
    return Cut(coded.dictionary, coded.indices.to_numpy(), starts)


# -- the lattice ---------------------------------------------------------------------


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """The pieces, their ids, scores and ranks by score, and an empty piece without an id."""
    ranks = {s: r for r, s in enumerate(sorted({s for _, _, s in model.normal()}, reverse=True))}
    rows = [*((p, i, s, ranks[s]) for p, i, s in model.normal()), ("", None, None, None)]
    kinds = {"piece": pa.string(), "id": pa.int64(), "score": pa.float64(), "rank": pa.int64()}
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)]
    return spark.createDataFrame(pa.table(columns, names=[*kinds]))


def lattice(words: DataFrame, model: Model) -> DataFrame:
    """``segment, edges`` from distinct ``segment``; a segment without an edge has none.

    Grouped where ``words`` are dealt by segment already.

    Edges are ``(start, stop, id, score)``. Of a merge model they are numbers made of rank,
    start, stop and id, so that they sort by rank, leftmost first; its merges begin at
    characters, which need no edge.
    """
    pieces = piece_table(words.sparkSession, model)  # bounded by the model file
    size = F.char_length("segment")
    starts = words.select("segment", F.explode(F.sequence(F.lit(0), size - 1)).alias("start"))
    spans = starts.select(
        "segment",
        "start",
        F.explode(
            F.sequence(
                F.lit(0), F.least(F.lit(model.longest), F.char_length("segment") - F.col("start"))
            )
        ).alias("n"),
    ).filter(f"n >= {2 if model.kind == BPE else 1} OR (n = 0 AND start = 0)")
    parts = spans.select(
        "segment",
        "start",
        (F.col("start") + F.col("n")).alias("stop"),
        F.substring(F.col("segment"), F.col("start") + 1, F.col("n")).alias("piece"),
    )
    if model.kind == BPE:
        place = (F.col("rank") * 64 + F.col("start")) * 64 + F.col("stop")
        edge = place * ID_SPAN + F.col("id")
    else:
        edge = F.when(F.col("id").isNotNull(), F.struct("start", "stop", "id", "score"))
    return (
        parts.join(F.broadcast(pieces), "piece")
        .groupBy("segment")
        .agg(F.collect_list(edge).alias("edges"))  # the empty piece's null is passed over
    )


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def merge_fold(edges: Column, size: Column) -> Column:
    """Cuts left when pieces are merged in order of rank, leftmost first.

    Cuts are the bits of a number. An edge is alive while both its ends are cuts and some
    cut lies between; if only one does, it can go.
    """

    def spread(edge: Column) -> Column:
        place = F.shiftright(edge, ID_BITS)
        start, stop = F.shiftright(place, 6).bitwiseAND(63), place.bitwiseAND(63)
        return F.struct(
            _bit(start).bitwiseOR(_bit(stop)).alias("ends"),
            (_bit(stop) - 2 * _bit(start)).alias("between"),
        )

    def alive(cuts: Column, held: Column) -> Column:
        return F.filter(
            held,
            lambda e: (cuts.bitwiseAND(e["ends"]) == e["ends"])
            & (cuts.bitwiseAND(e["between"]) != 0),
        )

    def step(state: Column) -> Column:
        cuts = state["cuts"]
        ready = F.filter(
            state["held"], lambda e: F.bit_count(cuts.bitwiseAND(e["between"])) == 1
        )
        return _let(
            _let(
                F.get(ready, F.lit(0)),
                lambda best: F.when(best.isNull(), F.lit(0).cast("bigint")).otherwise(
                    best["between"]
                ),
            ),
            lambda gone: _let(
                cuts - cuts.bitwiseAND(gone),
                lambda left: F.struct(
                    left.alias("cuts"),
                    # none to go: none will be
                    F.when(gone == 0, F.slice(state["held"], 1, 0))
                    .otherwise(alive(left, state["held"]))
                    .alias("held"),
                ),
            ),
        )

    first = F.struct(
        (_bit(size + 1) - 1).alias("cuts"),
        F.transform(F.sort_array(edges), spread).alias("held"),
    )
    cuts = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(size - 1, F.size(edges)))),
        first,
        lambda state, _: step(state),
        lambda state: state["cuts"],
    )
    return _let(
        cuts, lambda c: F.filter(F.sequence(F.lit(0), size), lambda i: F.getbit(c, i) == 1)
    )


def viterbi_fold(edges: Column, size: Column, unknown_score: float) -> Column:
    """Cuts of the path of the highest score; a character without an edge costs
    ``unknown_score``."""
    kind = "struct<score:double,cuts:array<int>>"
    first = F.array(
        F.struct(F.lit(0.0).alias("score"), F.array(F.lit(0)).alias("cuts")).cast(kind)
    )

    def step(paths: Column, stop: Column, edges: Column) -> Column:
        own = F.filter(edges, lambda e: e["stop"] == stop)
        alone = F.filter(own, lambda e: e["start"] == stop - 1)
        reached = F.transform(
            own,
            lambda e: F.struct(
                (F.get(paths, e["start"])["score"] + e["score"]).alias("score"),
                (-e["start"]).alias("left"),
            ),
        )
        forced = F.struct(
            (F.get(paths, stop - 1)["score"] + unknown_score).alias("score"),
            (-(stop - 1)).alias("left"),
        )
        all_ = F.when(F.size(alone) > 0, reached).otherwise(F.array_append(reached, forced))
        return _let(
            F.array_max(all_),
            lambda best: F.array_append(
                paths,
                F.struct(
                    best["score"].alias("score"),
                    F.array_append(F.get(paths, -best["left"])["cuts"], stop).alias("cuts"),
                ).cast(kind),
            ),
        )

    paths = F.aggregate(
        F.sequence(F.lit(1), size), first, lambda p, stop: step(p, stop, edges)
    )
    return F.element_at(paths, -1)["cuts"]


def encode_segments(words: DataFrame, model: Model) -> DataFrame:
    """``segment, ids`` for distinct ``segment`` of ``FOLDED`` characters at most."""
    found = lattice(words, model)
    size = F.char_length("segment")
    if model.kind == BPE:
        cuts = merge_fold(F.col("edges"), size)
    else:
        lowest = min((s for _, _, s in model.normal()), default=0.0)
        cuts = viterbi_fold(F.col("edges"), size, lowest - 10.0)
    cut = found.withColumn("cuts", cuts)

    def piece_ids(at: Column, next_: Column) -> Column:
        if model.kind == BPE:
            place = (at * 64 + next_).cast("bigint")
            own = F.filter(
                F.col("edges"),
                lambda e: F.shiftright(e, ID_BITS).bitwiseAND(4095) == place,
            )
            id_ = F.get(own, F.lit(0)).bitwiseAND(ID_SPAN - 1)
        else:
            own = F.filter(
                F.col("edges"), lambda e: (e["start"] == at) & (e["stop"] == next_)
            )
            id_ = F.get(own, F.lit(0))["id"]
        # without an edge: below zero, minus one less the character's number
        bare = F.ascii(F.substring(F.col("segment"), at + 1, F.lit(1)))
        return F.coalesce(id_, -1 - bare)

    ids = F.transform(
        F.slice("cuts", 1, F.size("cuts") - 1),
        lambda at, i: piece_ids(at, F.get("cuts", i + 1)).cast("int"),
    )
    return cut.select("segment", ids.alias("ids"))


def heap_encoder(model: Model):
    """The same pieces for one segment of any length, in n log n steps."""
    table = {p: (s, i) for p, i, s in model.normal()}

    def merged(segment: str) -> list[int]:
        parts: list[str | None] = list(segment)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple] = []

        def offer(left: int) -> None:
            right = after[left] if left >= 0 else len(parts)
            if left >= 0 and right < len(parts):
                both = parts[left] + parts[right]
                if both in table:
                    heapq.heappush(queue, (-table[both][0], left, parts[left], parts[right]))

        for i in range(len(parts)):
            offer(i)
        while queue:
            _, left, a, b = heapq.heappop(queue)
            right = after[left]
            if parts[left] != a or right >= len(parts) or parts[right] != b:
                continue
            parts[left], parts[right] = a + b, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return parts

    def best(segment: str) -> list[str]:
        lowest = min((s for s, _ in table.values()), default=0.0) - 10.0
        paths: list[tuple] = [(0.0, 0)]
        for stop in range(1, len(segment) + 1):
            found = [
                (paths[start][0] + table[segment[start:stop]][0], -start)
                for start in range(max(0, stop - model.longest), stop)
                if segment[start:stop] in table
            ]
            if segment[stop - 1] not in table:
                found.append((paths[stop - 1][0] + lowest, 1 - stop))
            paths.append(max(found))
        out, stop = [], len(segment)
        while stop:
            start = -paths[stop][1]
            out.append(segment[start:stop])
            stop = start
        return out[::-1]

    def encode(segment: str) -> list[int]:
        ids: list[int] = []
        for part in merged(segment) if model.kind == BPE else best(segment):
            if part is not None:
                ids.extend([table[part][1]] if part in table else model.fallback(part))
        return ids

    return encode


def _joined(values: pa.Array, starts: np.ndarray) -> pa.Array:
    """Runs of binary values put together: run ``i`` is ``starts[i]`` up to ``starts[i + 1]``."""
    edges = np.concatenate([[0], np.cumsum(pc.binary_length(values))]).astype(np.int64)
    data = values.buffers()[2] or pa.py_buffer(b"")
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(edges[starts]), data]
    )


def _starts(lists: pa.Array) -> np.ndarray:
    """Where lists begin in their values laid end to end, and the end; null ones are empty."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _uncoded(model: Model, codes: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Segments and ids from lists of ids, in which a character without an edge has its code:
    that becomes its piece, or its byte pieces."""
    starts, values = _starts(codes), codes.flatten().to_numpy().astype(np.int64)
    alone = np.unique(values[values < 0])
    characters = [chr(-1 - i) for i in alone.tolist()]
    spelling = pa.array([*model.pieces, *characters], pa.large_string())
    place = np.where(values < 0, len(model.pieces) + np.searchsorted(alone, values), values)
    names = _joined(spelling.cast(pa.large_binary()).take(pa.array(place)), starts)
    if len(alone):
        each = [[i] for i in range(len(model.pieces))] + [model.fallback(c) for c in characters]
        lists = pa.array(each, pa.large_list(pa.int64())).take(pa.array(place))
        values, starts = lists.flatten().to_numpy(), _starts(lists)[starts]
    ids = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(values.astype(np.int32)))
    return names.cast(pa.large_string()), ids


# -- texts ---------------------------------------------------------------------------


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few texts at a time, since their ids take space."""
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            yield batch.slice(i, SLICE)


def _count(path_model: Model):
    """Counts of the short segments that a task meets more than once; those it meets once are
    most of what it meets, and no common ones."""

    def summed(tables: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(tables).group_by("segment").aggregate([("n", "sum")])
        return sums.rename_columns(["segment", "n"]).combine_chunks()

    def repeated(table: pa.Table) -> Iterator[pa.RecordBatch]:
        found = table.filter(pc.greater(table["n"], 1))
        found = found.cast(pa.schema([("segment", pa.string()), ("n", pa.int64())]))
        yield from found.to_batches(max_chunksize=10_000)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            cut = cut_texts(path_model, batch.column("text"))
            times = np.bincount(cut.places, minlength=len(cut.names))
            table = pa.table({"segment": cut.names, "n": pa.array(times, pa.int64())})
            held.append(table.filter(pa.array(cut.short)))
            rows += held[-1].num_rows
            if rows > _FLUSH:
                held = [summed(held)]
                rows = held[0].num_rows
                if rows > _FLUSH:
                    yield from repeated(held[0])
                    held, rows = [], 0
        if held:
            yield from repeated(summed(held))

    return run


def _missing(model: Model, common):
    """``k, segment`` for the short segments of each text that are not common."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _ = common.value
        for batch in batches:
            cut = cut_texts(model, batch.column("text"))
            far = pc.index_in(cut.names, value_set=known).is_null().to_numpy(zero_copy_only=False)
            some = (far & cut.short)[cut.places]
            texts = np.repeat(np.arange(batch.num_rows), np.diff(cut.starts))[some]
            pairs = np.unique(texts * len(cut.names) + cut.places[some])
            text, place = np.divmod(pairs, max(1, len(cut.names)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k").take(pa.array(text)),
                    cut.names.take(pa.array(place)).cast(pa.string()),
                ],
                ["k", "segment"],
            )

    return run


@lean
def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, to be moved."""
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        packed = [None if t is None else codec.compress(t, asbytes=True) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("k"),
                pa.array([None if t is None else len(t) for t in texts], pa.int64()),
                pa.array(packed, pa.binary()),
            ],
            ["doc_id", "k", "size", "packed"],
        )


def _assemble(model: Model, common):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, known_ids), by_heap, codec = common.value, heap_encoder(model), pa.Codec("zstd")
        for batch in batches:
            sizes = batch.column("size").to_pylist()
            packed = batch.column("packed").to_pylist()
            texts = [
                None if t is None else codec.decompress(t, size, asbytes=True)
                for t, size in zip(packed, sizes, strict=True)
            ]
            texts = pa.array(texts, pa.binary()).cast(pa.string())
            cut = cut_texts(model, texts)
            own, own_ids = _uncoded(model, batch.column("found").flatten())
            long = pa.array(np.flatnonzero(~cut.short))
            long_ids = [by_heap(segment) for segment in cut.names.take(long).to_pylist()]
            # a segment has the same ids in every text
            held = pa.concat_arrays([known, own, cut.names.take(long)])
            ids = pa.concat_arrays(
                [known_ids, own_ids, pa.array(long_ids, pa.large_list(pa.int32()))]
            )
            place = pc.index_in(cut.names, value_set=held)
            if place.null_count:
                raise KeyError("a segment that was not looked up")
            taken = ids.take(place).take(pa.array(cut.places))
            offsets = _starts(taken)[cut.starts].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    texts,
                    pa.ListArray.from_arrays(pa.array(offsets), taken.flatten()),
                ],
                ["doc_id", "text", "ids"],
            )

    return run


def common_segments(counts: DataFrame, most: int | None = None) -> int | None:
    """Least count at which at most ``most`` (``COMMON``) short segments are left; None: not one
    fits."""
    most = COMMON if most is None else most
    short = counts.filter(F.char_length("segment") <= FOLDED)
    sizes = short.groupBy("n").agg(F.count("*").alias("many")).collect()
    least, held = None, 0
    for n, many in sorted(((r.n, r.many) for r in sizes), reverse=True):
        if held + many > most:
            break
        least, held = n, held + many
    return least


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, text, ids`` for every document, with the ids of the model's own library.

    No begin or end id is added. Null and empty texts give an empty list. One row per row
    that went in; ids may repeat or be null, other columns are ignored. Whole texts are
    encoded, however long a word is.
    """
    spark = docs.sparkSession
    ship(spark)
    model = load(model_path)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text")
    )
    counts = stored(
        rows.select("text")
        .mapInArrow(_count(model), "segment string, n bigint")
        .groupBy("segment")
        .agg(F.sum("n").alias("n"))
    )
    least = common_segments(counts)
    shares = -(-(counts.agg(F.sum("n")).first()[0] or 1) // SHARE)
    known = pa.array([], pa.large_string()), pa.array([], pa.large_list(pa.int32()))
    if least is not None:
        top = counts.filter((F.col("n") >= least) & (F.char_length("segment") <= FOLDED))
        # dealt by segment before they grow, so that the edges need not be moved to be grouped
        dealt = top.select("segment").repartition(DEALT, "segment")
        table = encode_segments(dealt, model).select("ids").toArrow()  # COMMON rows at most
        known = _uncoded(model, table["ids"].combine_chunks())
    common = spark.sparkContext.broadcast(known)
    # texts that share a key share what was looked up for both, so a short one will do
    keyed = rows.withColumn("k", F.hash("text", "doc_id"))
    rare = keyed.mapInArrow(_missing(model, common), "k int, segment string")
    dealt = rare.repartition(shares, "segment").distinct()
    dictionary = encode_segments(dealt.select("segment").distinct(), model)
    # ids spell their segment
    own = (
        dealt.join(dictionary, "segment").groupBy("k").agg(F.collect_list("ids").alias("found"))
    )
    texts = keyed.mapInArrow(_packed, "doc_id bigint, k int, size bigint, packed binary")
    return (
        texts.join(own, "k", "left")
        .select("doc_id", "size", "packed", "found")
        .mapInArrow(_assemble(model, common), "doc_id bigint, text string, ids array<int>")
    )


def decode(rows: DataFrame, model_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text of an id list appended; null ids give null.

    The inverse of ``encode`` but for texts that hold the word mark itself, which comes back
    as a space, as in the model's own library. Control and unknown pieces give nothing.
    """
    ship(rows.sparkSession)
    model = load(model_path)
    raw = [
        bytes([int(p[3:5], 16)])
        if k == BYTE
        else p.replace(MARK, " ").encode()
        if k == NORMAL
        else b""
        for p, k in zip(model.pieces, model.kinds)
    ]
    base = rows.drop(into)
    schema = T.StructType([*base.schema.fields, T.StructField(into, T.StringType())])

    pieces_raw = pa.array(raw, pa.large_binary())

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            lists = batch.column(ids)
            whole = _joined(pieces_raw.take(lists.flatten()), _starts(lists)).to_pylist()
            out = []
            for null, raw_text in zip(lists.is_null().to_pylist(), whole, strict=True):
                text = None if null else raw_text.decode("utf-8", "replace")
                cut = not null and model.dummy_prefix and text.startswith(" ")
                out.append(text[1:] if cut else text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out, pa.string())], [*batch.schema.names, into]
            )

    return base.mapInArrow(run, schema)
