"""Language-model scores from a log-bilinear model trained with noise-contrastive estimation.

The model's size is a parameter; its words are not. A word's hash gives it three codes: a
head, a tail and a third one; the ``NAMED`` commonest have heads of their own. A word's vector
as context is the sum of three code rows, so two words share it only if all their codes agree.
The context vector is the sum of the vectors of the two tokens before, each scaled per
position. A word's probability is that of its head, a softmax over heads, times that of its
tail within the head, a softmax over tails that starts from the corpus' shares of the cell
(head and tail), times the word's smoothed share of its cell's counts. All three are normalised
exactly for every context, so the log-probability of a text is normalised over all words, and
with all vectors at zero it is that of the unigram counts. No word is left out or merged
with others: each keeps its own count, however rare.

Training reads every training document. Texts become hashes once. A starting point is fitted on
at most ``WARM`` of their tokens, drawn over all of them; from it each task fits its own part,
about ``PART`` tokens, and the results, of a fixed size each, are averaged in two steps. Word counts are exact and grow with the corpus as a table. Words beyond a
bounded table of common ones meet their counts in a join.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ship, stored, word_bytes

END = b""  # the end token; no word is empty; its hash is 0
NAMED = 256  # heads of one word each
HEADS = TAILS = 256  # heads and tails that the other words are hashed to
THIRDS = 1 << 13
DIMENSIONS = 16
ROUNDS = 1  # passes over all training texts
WARM = 1 << 20  # tokens of the starting point
PART = 1 << 23  # tokens of a task that fits
SEED = 4
COMMON_WORDS = 200_000  # rows sent to every task at most, each of
COMMON_BYTES = 64  # bytes at most; other words are joined
SMOOTHING = 0.1
NOISE = 10  # noise samples that a data sample is told from
SHARED = 64  # noise heads drawn for a batch, each counted NOISE / SHARED times
OWN = 2  # noise tails drawn for a token within its word's head
BATCH = 1024  # tokens of a step
RATE = 0.1
STEADY = 1e-8  # squared gradients that Adagrad starts from
CHUNK = 1 << 20  # tokens that are fitted together
SCORED = 1 << 17  # tokens that are scored together
ROWS = 1 << 8  # contexts of a matrix product: what it makes stays in a core's cache
MERGED = 16  # models that reach the driver in a round, at most
_FLUSH = 500_000  # distinct words held in a task before they are sent on


def hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, found), np.uint32, len(found))


@dataclass
class Cells:
    """Which cell a hash belongs to, and the smoothed counts of the cells: those of a cell's
    words and of one that stands for all its unseen ones."""

    named: np.ndarray  # hashes with a head of their own, ascending
    alone: np.ndarray  # their counts
    mass: np.ndarray  # counts of the others by head and tail

    @property
    def heads(self) -> np.ndarray:
        """Counts of the heads, the named ones first."""
        return np.concatenate([self.alone, self.mass.sum(axis=1)])

    def codes(self, tokens: np.ndarray) -> np.ndarray:
        """Head, tail and third code of hashes."""
        at = np.searchsorted(self.named, tokens)
        own = np.append(self.named, 0)[at] == tokens
        own &= at < len(self.named)
        head = np.where(own, at, len(self.named) + tokens % HEADS)
        rest = tokens // HEADS
        return np.stack([head, rest % TAILS, rest // TAILS % THIRDS]).astype(np.uint16)

    def share(self, codes: np.ndarray) -> np.ndarray:
        """Counts of the cells of codes."""
        hashed = codes[0].astype(int) - len(self.named)
        own = np.append(self.alone, 0.0)[np.minimum(codes[0], len(self.named))]
        return np.where(hashed < 0, own, self.mass[np.maximum(hashed, 0), codes[1]])


@dataclass
class LogBilinear:
    """``score(head | a, b) = hidden . heads[head] + lean[head]`` and ``score(tail | head, a, b) =
    (hidden * gate[head]) . tails[tail] + log mass[head, tail]``, where ``hidden`` is
    ``near * vector(b) + far * vector(a)`` and a vector is ``by_head + by_tail + by_third``.
    Named heads have no tails. Tokens are given as codes, one column each."""

    by_head: np.ndarray
    by_tail: np.ndarray
    by_third: np.ndarray
    near: np.ndarray
    far: np.ndarray
    heads: np.ndarray
    lean: np.ndarray
    gate: np.ndarray
    tails: np.ndarray

    @classmethod
    def start(cls, cells: Cells, dimensions: int = DIMENSIONS, seed: int = SEED):
        """The model of the unigram counts."""
        draw = np.random.default_rng(seed)
        heads = len(cells.heads)

        def drawn(rows: int) -> np.ndarray:
            return draw.normal(0, 0.2, (rows, dimensions)).astype(np.float32)

        return cls(
            drawn(heads),
            drawn(TAILS),
            drawn(THIRDS),
            np.ones(dimensions, np.float32),
            np.full(dimensions, 0.5, np.float32),
            np.zeros((heads, dimensions), np.float32),
            np.log(cells.heads / cells.heads.sum()).astype(np.float32),
            np.ones((HEADS, dimensions), np.float32),
            np.zeros((TAILS, dimensions), np.float32),
        )

    def arrays(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    def unflat(self, flat: np.ndarray) -> LogBilinear:
        parts, at = [], 0
        for a in self.arrays():
            parts.append(np.asarray(flat[at : at + a.size], np.float32).reshape(a.shape))
            at += a.size
        return LogBilinear(*parts)

    def vector(self, codes: np.ndarray) -> np.ndarray:
        return self.by_head[codes[0]] + self.by_tail[codes[1]] + self.by_third[codes[2]]

    def log10(self, cells: Cells, far, near, token) -> np.ndarray:
        """log10 P(cell of token | far, near)."""
        prior = np.log(cells.mass).astype(np.float32)
        out = np.empty(token.shape[1])
        for i in range(0, len(out), ROWS):
            part = (slice(None), slice(i, i + ROWS))
            head, tail, _ = token[part]
            hidden = self.vector(near[part]) * self.near + self.vector(far[part]) * self.far
            scores = hidden @ self.heads.T
            scores += self.lean
            found = scores[np.arange(len(head)), head] - _log_sum(scores)
            inner = np.flatnonzero(head >= len(cells.named))
            row, tail = head[inner] - len(cells.named), tail[inner]
            scores = (hidden[inner] * self.gate[row]) @ self.tails.T
            scores += prior[row]
            found[inner] += scores[np.arange(len(row)), tail] - _log_sum(scores)
            out[i : i + ROWS] = found
        return out / math.log(10)


def _log_sum(scores: np.ndarray) -> np.ndarray:
    """Of the exponentials by row; ``scores`` are written over."""
    top = scores.max(axis=1)
    scores -= top[:, None]
    np.exp(scores, out=scores)
    return np.log(scores @ np.ones(scores.shape[1], scores.dtype)) + top


def _summed(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places and the sums of their values."""
    order = np.argsort(index, kind="stable")
    held = index[order]
    starts = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
    return held[starts], np.add.reduceat(values[order], starts, axis=0)


def _dense(index: np.ndarray, values: np.ndarray, shape: tuple) -> np.ndarray:
    """The sums at every place."""
    wide = math.prod(shape[1:])
    flat = (index.astype(np.int64)[:, None] * wide + np.arange(wide)).ravel()
    total = np.bincount(flat, values.ravel(), math.prod(shape))
    return total.astype(np.float32).reshape(shape)


def fit(
    model: LogBilinear,
    cells: Cells,
    tokens: np.ndarray,
    ends: np.ndarray,
    seed: int,
    rate: float = RATE,
    squares: list[np.ndarray] | None = None,
) -> LogBilinear:
    """One pass of noise-contrastive estimation over texts, hashes laid end to end, with Adagrad
    steps.

    Heads are told from noise heads that a batch shares. A word's tail is told from noise tails
    drawn by the corpus' shares within its head: these stand in the model's odds and in the
    noise's, so they cancel. ``squares`` carries the step sizes on.
    """
    words = cells.codes(tokens)
    fars, nears = _before(cells, words, ends)
    draw = np.random.default_rng(seed)
    model = LogBilinear(*(a.copy() for a in model.arrays()))
    if squares is None:
        squares = [np.full_like(a, STEADY) for a in model.arrays()]
    slot = {f.name: i for i, f in enumerate(fields(model))}
    upto = np.concatenate([[0.0], np.cumsum(cells.mass.ravel())])
    edges = upto[np.arange(HEADS + 1) * TAILS]
    share = cells.heads / cells.heads.sum()
    shift = np.log(NOISE * share).astype(np.float32)
    order = draw.permutation(len(tokens))

    def step(name: str, index: np.ndarray, gradient: np.ndarray) -> None:
        values, square = getattr(model, name), squares[slot[name]]
        if len(values) > len(index):
            index, total = _summed(index, gradient)
            square[index] += total * total
            values[index] -= rate * total / np.sqrt(square[index])
        else:  # a small table: all rows at once, untouched ones by nothing
            total = _dense(index, gradient, values.shape)
            square += total * total
            values -= rate * total / np.sqrt(square)

    def step_all(name: str, gradient: np.ndarray) -> None:
        squares[slot[name]] += gradient * gradient
        getattr(model, name)[:] -= rate * gradient / np.sqrt(squares[slot[name]])

    for i in range(0, len(order), BATCH):
        mine = order[i : i + BATCH]
        weight = np.float32(1 / len(mine))
        head, tail, _ = words[:, mine]
        at_b, at_a = model.vector(nears[:, mine]), model.vector(fars[:, mine])
        hidden = at_b * model.near + at_a * model.far

        noise = draw.choice(len(share), SHARED, p=share).astype(np.uint16)
        own, others = model.heads[head], model.heads[noise]
        pull = -weight * _chance(shift[head] - (hidden * own).sum(axis=1) - model.lean[head])
        push = weight * NOISE / SHARED * _chance(hidden @ others.T + (model.lean - shift)[noise])
        by_hidden = pull[:, None] * own + push @ others
        places = np.concatenate([head, noise])
        by_heads = np.concatenate([pull[:, None] * hidden, push.T @ hidden])
        by_lean = np.concatenate([pull, push.sum(axis=0)])

        inside = np.flatnonzero(head >= len(cells.named))
        head, tail = head[inside].astype(int) - len(cells.named), tail[inside]
        low, high = edges[head], edges[head + 1]
        cell = np.searchsorted(upto, low + draw.random((OWN, len(head))) * (high - low), "right")
        noise = np.clip(cell - 1 - head * TAILS, 0, TAILS - 1).astype(np.uint16)
        gate = model.gate[head]
        gated = hidden[inside] * gate
        own = model.tails[tail]
        pull = -weight * _chance(math.log(OWN) - (gated * own).sum(axis=1))
        by_gated = pull[:, None] * own
        inner, by_tails = [tail], [pull[:, None] * gated]
        for drawn in noise:
            other = model.tails[drawn]
            push = weight * _chance((gated * other).sum(axis=1) - math.log(OWN))
            by_gated += push[:, None] * other
            inner.append(drawn)
            by_tails.append(push[:, None] * gated)
        by_hidden[inside] += by_gated * gate

        step("heads", places, by_heads)
        step("lean", places, by_lean)
        if len(inside):
            step("tails", np.concatenate(inner), np.concatenate(by_tails))
            step("gate", head.astype(np.uint16), by_gated * hidden[inside])
        by_vector = np.concatenate([by_hidden * model.near, by_hidden * model.far])
        context = np.concatenate([nears[:, mine], fars[:, mine]], axis=1)
        for name, index in zip(("by_head", "by_tail", "by_third"), context, strict=True):
            step(name, index, by_vector)
        step_all("near", (by_hidden * at_b).sum(axis=0))
        step_all("far", (by_hidden * at_a).sum(axis=0))
    return model


def _chance(odds: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * odds)


def _before(cells: Cells, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes two and one before, in texts laid end to end; ``ends`` are the places of the ends."""
    n, end = words.shape[1], cells.codes(hashes([END]))
    back = np.concatenate([end, end, words], axis=1)
    near, far = back[:, 1 : n + 1].copy(), back[:, :n].copy()
    starts = np.concatenate([[0], ends[:-1] + 1])
    near[:, starts] = end
    far[:, starts] = end
    second = starts + 1
    far[:, second[second < n]] = end
    return far, near


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def sent() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
            ["word", "n"],
        )
        seen.clear()
        return out

    for batch in batches:
        for text in batch.column("text").to_pylist():
            seen.update(word_bytes(text))
            seen[END] += 1
            if len(seen) > _FLUSH:
                yield sent()
    if seen:
        yield sent()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word binary, n`` over all ``docs``, the end token included; summed in tasks first."""
    ship(docs.sparkSession)
    parts = docs.select("text").mapInArrow(_count_words, "word binary, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def common_words(counts: DataFrame, most: int | None = None) -> list[tuple[bytes, int]]:
    """The commonest words, at most ``most`` (``COMMON_WORDS``) of at most ``COMMON_BYTES`` bytes each.

    Cut where whole frequencies fit, so that ties are all in or all out.
    """
    most = COMMON_WORDS if most is None else most
    short = counts.filter(F.octet_length("word") <= COMMON_BYTES)
    sizes = sorted(
        (row.n, row.words) for row in short.groupBy("n").agg(F.count("*").alias("words")).collect()
    )
    least, held = None, 0
    for n, many in reversed(sizes):
        if held + many > most:
            break
        least, held = n, held + many
    if least is None:
        return []
    rows = short.filter(F.col("n") >= least).collect()
    return sorted(((bytes(r.word), r.n) for r in rows), key=lambda x: (-x[1], x[0]))


def held_out(id: str = "doc_id"):
    """crc32(id as text) mod 10 is 0; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 10 == 0, F.lit(False))


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            hashes([*word_bytes(text), END]).tobytes() for text in batch.column("text").to_pylist()
        ]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["tokens"])


def _local_fit(shared, round_: int, most: float = math.inf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, own = shared.value
        squares = [np.full_like(a, STEADY) for a in own.arrays()]
        held, ends, size, total = [], [], 0, 0

        def learnt() -> LogBilinear:
            tokens = np.frombuffer(b"".join(held), np.uint32)
            rate = RATE / (1 + round_)
            return fit(own, cells, tokens, np.array(ends), SEED + round_, rate, squares)

        for batch in batches:
            for text in batch.column("tokens").to_pylist():
                held.append(text)
                size += len(text) // 4
                ends.append(size - 1)
                if size >= CHUNK or total + size >= most:
                    own = learnt()
                    held, ends, size, total = [], [], 0, total + size
                if total >= most:
                    yield _model_batch(own.flat(), total)
                    return
        if size:
            own = learnt()
        if total + size:
            yield _model_batch(own.flat(), total + size)

    return run


def _model_batch(flat: np.ndarray, tokens: int) -> pa.RecordBatch:
    row = np.asarray(flat, np.float32).tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array([row], pa.binary()), pa.array([tokens], pa.int64())], ["model", "tokens"]
    )


def _mean_model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean of models by their tokens; holds one at a time beside the sum."""
    total, tokens = None, 0
    for batch in batches:
        for row, n in zip(batch.column("model"), batch.column("tokens").to_pylist()):
            one = np.frombuffer(row.as_py(), np.float32).astype(np.float64) * n
            total, tokens = one if total is None else total + one, tokens + n
    if tokens:
        yield _model_batch(total / tokens, tokens)


@dataclass
class Scorer:
    """All that scoring needs but the counts of words outside ``common``; of bounded size."""

    model: LogBilinear
    cells: Cells
    common: list[tuple[bytes, int]]
    total: int
    distinct: int


def cells_of(counts: DataFrame) -> Cells:
    """The cells of ``word, n``; at most a row a cell reaches the driver."""
    commonest = counts.orderBy(F.desc("n"), "word").limit(NAMED).select(F.crc32("word").alias("h"))
    named = sorted({r.h for r in commonest.collect()})
    hash_, size = F.crc32("word"), HEADS * TAILS
    cell = F.when(hash_.isin(named), size + hash_).otherwise(hash_ % size)
    sums = counts.groupBy(cell.alias("cell")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    table = sums.orderBy("cell").toArrow()
    place = table["cell"].to_numpy()
    own = table["n"].to_numpy() + SMOOTHING * (table["words"].to_numpy() + 1)
    mass = np.full(size, SMOOTHING)
    mass[place[place < size]] = own[place < size]
    # the head is the lower part of a hash
    by_head = np.ascontiguousarray(mass.reshape(TAILS, HEADS).T)
    return Cells(np.array(named, np.uint32), own[place >= size], by_head)


def train(training: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Scorer:
    """``Scorer`` learnt from all of ``training`` (column ``text``); ``counts`` are its words."""
    spark = training.sparkSession
    ship(spark)
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    cells = cells_of(counts)
    model = LogBilinear.start(cells)
    if total:
        hashed = training.select("text").mapInArrow(_hash_texts, "tokens binary")
        hashed = stored(hashed.repartition(-(-total // PART)))
        row = F.xxhash64("tokens", F.monotonically_increasing_id())
        passes = [(hashed.filter(row % -(-total // WARM) == 0).repartition(1), WARM)]
        passes += [(hashed, math.inf)] * rounds
    for round_, (rows, most) in enumerate(passes if total else []):
        shared = spark.sparkContext.broadcast((cells, model))
        schema = "model binary, tokens bigint"
        fitted = rows.mapInArrow(_local_fit(shared, round_, most), schema)
        means = fitted.repartition(MERGED).mapInArrow(_mean_model, schema).toArrow()
        for mean in _mean_model(iter(means.to_batches())):
            model = model.unflat(np.frombuffer(mean.column("model")[0].as_py(), np.float32))
        shared.unpersist()
    return Scorer(model, cells, common_words(counts), int(total), int(distinct))


def _scored(shared, extra: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cells, common = shared.value
        place = {w: i for i, (w, _) in enumerate(common)}
        joined = len(common)  # the place of words whose counts come with the join
        count = np.array([n for _, n in common] + [0])
        weight = np.log10(count + SMOOTHING)
        weight[joined] = 0.0

        def scored(held: pa.StructArray, texts: list[list[bytes]]) -> pa.RecordBatch:
            found = list(chain.from_iterable(texts))
            tokens = hashes(found)
            at = np.fromiter(map(place.get, found, repeat(joined)), np.int64, len(found))
            sizes = np.array([len(text) for text in texts])
            ends = np.cumsum(sizes) - 1
            own = cells.codes(tokens)
            far, near = _before(cells, own, ends)
            fancy = model.log10(cells, far, near, own) - np.log10(cells.share(own)) + weight[at]
            starts = ends + 1 - sizes
            rare = np.flatnonzero(at == joined)
            upto = [0, *np.searchsorted(rare, ends, "right").tolist()]
            missing = [found[i] for i in rare.tolist()]
            own_rare = [Counter(missing[i:j]) for i, j in zip(upto, upto[1:])]
            pairs = pa.StructArray.from_arrays(
                [
                    pa.array(list(chain.from_iterable(own_rare)), pa.binary()),
                    pa.array(list(chain.from_iterable(c.values() for c in own_rare)), pa.int64()),
                ],
                ["word", "times"],
            )
            offsets = np.cumsum([0, *map(len, own_rare)])
            return pa.RecordBatch.from_arrays(
                [
                    *(held.field(i) for i in range(len(extra))),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.add.reduceat((count[at] > 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(weight[at], starts), pa.float64()),
                    pa.array(np.add.reduceat(fancy, starts), pa.float64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
                ],
                [*extra, "n_tokens", "n_known", "plain", "fancy", "tail"],
            )

        for batch in batches:
            held = pa.StructArray.from_arrays([batch.column(c) for c in extra], extra)
            begun, size, texts = 0, 0, []
            for row, text in enumerate(batch.column("text").to_pylist()):
                texts.append([*word_bytes(text), END])
                size += len(texts[-1])
                if size >= SCORED or row + 1 == batch.num_rows:
                    yield scored(held.slice(begun, row + 1 - begun), texts)
                    begun, size, texts = row + 1, 0, []

    return run


def score(docs: DataFrame, scorer: Scorer, counts: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    ``docs`` has ``doc_id, held_out, text``; other columns, whatever their names, are left out.
    Scores are sums of log10 probabilities over the words and the end token of the whole text,
    however long. A null or empty text is the end token alone. One row per row that went in;
    ids may repeat or be null. Without any training text both scores rest on the smoothing
    alone.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((scorer.model, scorer.cells, scorer.common))
    extra = ["doc_id", "held_out"]
    parts = docs.select(*extra, "text").mapInArrow(
        _scored(shared, extra),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, plain double, "
        "fancy double, tail array<struct<word:binary,times:bigint>>",
    )
    parts = stored(parts.withColumn("row", F.monotonically_increasing_id()))
    tails = parts.select("row", F.inline("tail")).join(counts, "word", "left")
    smooth = F.log10(F.coalesce(F.col("n"), F.lit(0)) + SMOOTHING)
    sums = tails.groupBy("row").agg(
        F.sum(F.col("times") * smooth).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
    )
    base_norm = math.log10(scorer.total + SMOOTHING * (scorer.distinct + 1))
    more = F.coalesce(F.col("more"), F.lit(0.0))
    return parts.drop("tail").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(scorer.total).cast("bigint").alias("train_tokens"),
        (F.col("plain") + more - F.col("n_tokens") * base_norm).alias("base_score"),
        (F.col("fancy") + more).alias("score"),
    )


def train_and_score(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, then score all of them."""
    ship(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("text")
    ).withColumn("held_out", held_out())
    training = rows.filter("NOT held_out")
    counts = stored(word_counts(training))
    return score(rows, train(training, counts), counts)
