"""Repair of the structure of conversations by a run-length dynamic program.

A repaired conversation has the roles ``(system? (user assistant)+)?``. Rows are kept, given
another role, deleted, or joined by inserted empty turns; the cheapest edits are sought, of
equally cheap ones those whose initials come first.

A row is one symbol: its role's initial and its fault. One symbol takes the costs of the four
grammar states to those after it by a min-plus matrix, so equal consecutive symbols are one run,
and a run of n is the n-th power of its matrix, put together from powers of two that are cached
for all conversations. Long conversations are cut into pieces. Each piece gives one matrix; costs
stream backwards over the pieces of a conversation; every piece unrolls its choices for each
state it may be entered in, and states stream forwards to pick one. So a conversation that
holds a third of all rows is spread over tasks; what streams is a few numbers a piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import BLANKS, ship, stored
from shelfcast.operators.order import in_order

# The costs of edits.
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1

PIECE_BITS = 12  # a piece has 2 ** 12 = 4,096 rows of a conversation at most
START, SYSTEM, USER, ASSISTANT = STATES = range(4)  # the grammar: what was said last
NEXT = (USER, USER, ASSISTANT, USER)  # what an edit can say next
LAST = (START, ASSISTANT)  # where a conversation may end
ROLES = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 60

# symbols of rows: initial of the role, of other roles "o"; upper case if cut short; the same
# four as digits where the row must go
INITIALS, SHORT, GONE = "suao", "SUAO", "1234"
_KEPT = {
    **dict.fromkeys("sS", SYSTEM),
    **dict.fromkeys("uU", USER),
    **dict.fromkeys("aA", ASSISTANT),
}
_PAIRS = {"su", "ua", "au"}

Vector = tuple[int, ...]


def _may_follow(state: int, said: int) -> bool:
    return NEXT[state] == said or (state == START and said == SYSTEM)


def actions(symbol: str, state: int) -> Iterator[tuple[str, int, int]]:
    """``(edit, cost, state after)`` for a row of this symbol, in the order of the edits."""
    yield "D", DELETE, state
    if symbol in GONE:
        return
    short = CUT_SHORT if symbol in SHORT else 0
    said = _KEPT.get(symbol)
    if said is not None and _may_follow(state, said):
        yield "K", short, said
    yield "R", REROLE + short, NEXT[state]


def times(a: tuple[Vector, ...], b: tuple[Vector, ...]) -> tuple[Vector, ...]:
    """Min-plus product."""
    return tuple(
        tuple(min(NEVER, *(a[i][k] + b[k][j] for k in STATES)) for j in STATES) for i in STATES
    )


def before(matrix: tuple[Vector, ...], costs: Vector) -> Vector:
    """Costs to finish before what ``matrix`` stands for, from those after it."""
    return tuple(min(NEVER, *(matrix[i][k] + costs[k] for k in STATES)) for i in STATES)


NOTHING = tuple(tuple(0 if i == j else NEVER for j in STATES) for i in STATES)
_ONE_INSERT = tuple(
    tuple(0 if i == j else INSERT if NEXT[i] == j else NEVER for j in STATES) for i in STATES
)
# user, assistant, user reach every state that inserts can reach
INSERTS = times(_ONE_INSERT, times(_ONE_INSERT, _ONE_INSERT))
END = before(INSERTS, tuple(0 if s in LAST else NEVER for s in STATES))


def _like(symbol: str) -> str:
    """Rows that must go are alike, whatever their role."""
    return GONE[0] if symbol in GONE else symbol


@cache
def _power(symbol: str, bit: int) -> tuple[Vector, ...]:
    """The matrix of ``2 ** bit`` rows of a symbol."""
    if bit:
        return times(_power(symbol, bit - 1), _power(symbol, bit - 1))
    row = [[NEVER] * len(STATES) for _ in STATES]
    for state in STATES:
        for _, cost, after in actions(symbol, state):
            row[state][after] = min(row[state][after], cost)
    return times(INSERTS, tuple(map(tuple, row)))


def run_before(symbol: str, length: int, costs: Vector) -> Vector:
    """Costs to finish before ``length`` rows of a symbol."""
    bit = 0
    while length >> bit:
        if length >> bit & 1:
            costs = before(_power(symbol, bit), costs)
        bit += 1
    return costs


def runs(symbols: str) -> list[tuple[str, int]]:
    """Runs of equal symbols and their lengths."""
    return [(symbol, len(list(rows))) for symbol, rows in groupby(map(_like, symbols))]


def run_costs(symbols: str, costs: Vector) -> Vector:
    """Costs to finish before a piece, from those after it."""
    for symbol, length in reversed(runs(symbols)):
        costs = run_before(symbol, length, costs)
    return costs


def matrix_of(symbols: str) -> tuple[Vector, ...]:
    """The transition of a whole piece: column by column from the back."""
    units = (tuple(0 if i == j else NEVER for i in STATES) for j in STATES)
    return tuple(zip(*(run_costs(symbols, unit) for unit in units), strict=True))


def _choice(symbol: str, state: int, now: int, after: Vector) -> tuple[str, int]:
    """The first edit in ASCII order that costs no more than ``now`` to the end.

    Deletes come before inserts before keeps before reroles. ``after`` are the costs behind the
    row; an insert leaves the row to do, with ``now`` less its cost.
    """
    offers = {edit: (cost, to) for edit, cost, to in actions(symbol, state)}
    cost, to = offers["D"]
    if cost + after[to] == now:
        return "D", to
    ahead = before(_power(_like(symbol), 0), after)
    if INSERT + ahead[NEXT[state]] == now:
        return "I", NEXT[state]
    for edit in ("K", "R"):
        if edit in offers and offers[edit][0] + after[offers[edit][1]] == now:
            return edit, offers[edit][1]
    raise ArithmeticError("no edit has the cost of the best")


def _unroll_run(symbol: str, length: int, after: Vector, state: int, out: list) -> int:
    """Edits of a run, halved until single rows are left; appends ``(edit, state)``."""
    if length > 1:
        half = length // 2
        middle = run_before(symbol, length - half, after)
        state = _unroll_run(symbol, half, middle, state, out)
        return _unroll_run(symbol, length - half, after, state, out)
    now = before(_power(symbol, 0), after)
    edit = "I"
    while edit == "I":
        edit, to = _choice(symbol, state, now[state], after)
        out.append((edit, to))
        state = to
    return state


def unroll(symbols: str, state: int, after: Vector) -> tuple[list[tuple[str, int]], int]:
    """The edits of a piece entered in ``state``, and the state it is left in."""
    parts, costs = runs(symbols), after
    behind = []
    for symbol, length in reversed(parts):
        behind.append(costs)
        costs = run_before(symbol, length, costs)
    out: list[tuple[str, int]] = []
    for (symbol, length), costs in zip(parts, reversed(behind), strict=True):
        state = _unroll_run(symbol, length, costs, state, out)
    return out, state


def finish(state: int) -> list[tuple[str, int]]:
    """The inserts that end a conversation left in ``state``."""
    out = []
    while state not in LAST:
        state = NEXT[state]
        out.append(("I", state))
    return out


def illegal_pairs(symbols: str) -> int:
    roles = initials(symbols)
    return sum(a + b not in _PAIRS for a, b in zip(roles, roles[1:]))


def initials(symbols: str) -> str:
    return symbols.lower().translate(str.maketrans(GONE, INITIALS))


# -- Spark --------------------------------------------------------------------------


def row_symbol(role: Column, gone: Column, short: Column) -> Column:
    place = F.lit(len(INITIALS))
    for at, letter in enumerate(INITIALS[:3], 1):
        place = F.when(F.substring(role, 1, 1) == letter, at).otherwise(place)
    letters = F.when(gone, GONE).when(short, SHORT).otherwise(INITIALS)
    return F.substring(letters, place, F.lit(1))


def diagnose(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, row, piece, blank, duplicate, truncated, symbol`` of every row.

    Rows of a conversation are in the order of turn (null first), role and text; ``row``
    ascends in it. A row has its first fault only: blank (no character but blanks), duplicate
    (a row before it in the conversation has its role and text), truncated (the last character
    that is no blank is none of ``.!?``). Null roles and texts are empty. A null conv_id is a
    conversation. Other columns are ignored.
    """
    columns = ["conv_id", "turn", "role", "text"]
    none = F.lit("")
    known = turns.select(
        "conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), none).alias(c) for c in columns[2:]]
    )
    placed = in_order(known, [F.col(c).asc_nulls_first() for c in columns])
    bare = F.btrim("text", F.lit(BLANKS))
    said = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    rows = placed.select(
        *columns,
        F.col("_id").alias("row"),
        F.shiftright("_id", PIECE_BITS).alias("piece"),
        (bare == "").alias("blank"),
        F.substring(bare, -1, 1).isin(*".!?").alias("_ended"),
        F.sha2(said, 256).alias("_said"),
    )
    seen = (
        rows.filter("NOT blank")
        .groupBy("conv_id", "_said")
        .agg(F.min("row").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select(F.col("conv_id").alias("_conv"), F.col("_said").alias("_as"), "_first")
    )
    same = rows["conv_id"].eqNullSafe(seen["_conv"]) & (rows["_said"] == seen["_as"])
    blank, again = F.col("blank"), F.coalesce(F.col("row") > F.col("_first"), F.lit(False))
    marked = rows.join(seen, same, "left").select(
        *columns, "row", "piece", "blank", (~blank & again).alias("duplicate"), "_ended"
    )
    gone = blank | F.col("duplicate")
    marked = marked.withColumn("truncated", ~gone & ~F.col("_ended")).drop("_ended")
    symbol = row_symbol(F.col("role"), gone, F.col("truncated"))
    return stored(marked.withColumn("symbol", symbol))


def _batched(rows: Iterator[dict], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            yield from batch.slice(start, 1000).to_pylist()


def _mapped(df: DataFrame, step, columns: str) -> DataFrame:
    """``step`` over the rows of each partition; it takes and gives dicts."""
    schema = df.sparkSession.createDataFrame([], columns).toArrow().schema

    def run(batches):
        yield from _batched(step(_rows(batches)), schema)

    return df.mapInArrow(run, columns)


def _shapes(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        yield row | {"matrix": [x for line in matrix_of(row["symbols"]) for x in line]}


def _backwards(rows: Iterator[dict]) -> Iterator[dict]:
    """Costs behind each piece, of pieces that come last first."""
    held, costs = None, END
    for row in rows:
        matrix = row.pop("matrix")
        other = held is None or row["conv_id"] != held["conv_id"]
        if held is not None:
            yield held | {"leads": other}
        costs = END if other else costs
        held = row | {"after": list(costs)}
        n = len(STATES)
        costs = before(tuple(tuple(matrix[i * n : i * n + n]) for i in STATES), costs)
    if held is not None:
        yield held | {"leads": True}


def _choices(rows: Iterator[dict]) -> Iterator[dict]:
    """The edits of a piece for each state it may be entered in: ``edit`` and state in turn."""
    for row in rows:
        row["edits"], row["left"] = [], []
        after = tuple(row.pop("after"))
        possible = run_costs(row["symbols"], after)
        for state in STATES:
            entered = state == START or not row["leads"]
            if not entered or possible[state] >= NEVER:
                row["edits"].append("")
                row["left"].append(START)
                continue
            edits, left = unroll(row["symbols"], state, after)
            row["edits"].append("".join(f"{edit}{to}" for edit, to in edits))
            row["left"].append(left)
        yield row


def _forwards(rows: Iterator[dict]) -> Iterator[dict]:
    """The chosen edits of each piece, of pieces that come first first."""
    held, state = None, START
    for row in rows:
        follows = held is not None and row["conv_id"] == held["conv_id"]
        if held is not None:
            yield held | {"ends": not follows}
        state = state if follows else START
        joint = initials(held["symbols"][-1] + row["symbols"][0]) if follows else "ua"
        held = {
            "conv_id": row["conv_id"],
            "first": row["first"],
            "symbols": row["symbols"],
            "edits": row["edits"][state],
            "illegal": illegal_pairs(row["symbols"]) + (joint not in _PAIRS),
        }
        state = held["left"] = row["left"][state]
    if held is not None:
        yield held | {"ends": True}


def _edits(rows: Iterator[dict]) -> Iterator[dict]:
    """One row for each edit, inserts before the row they precede."""
    for piece in rows:
        letters = piece["edits"]
        edits = [(letters[i], int(letters[i + 1])) for i in range(0, len(letters), 2)]
        more = finish(piece["left"]) if piece["ends"] else []
        row, step, last = piece["first"], 0, piece["first"] + len(piece["symbols"]) - 1
        for edit, state in [*edits, *more]:
            said = ROLES[state] if edit in "IR" else None
            at = {"row": min(row, last), "step": step + (row > last)}
            yield {"conv_id": piece["conv_id"], "edit": edit, "said": said} | at
            row, step = (row, step + 1) if edit == "I" else (row + 1, 0)


@dataclass(frozen=True)
class Repair:
    """``rows``: what ``diagnose`` gives; ``edits``: ``conv_id, row, step, edit, turn, role, text,
    cost`` in the order of ``row, step``, deleted rows with what they held; ``pieces``: the
    illegal neighbours of each piece."""

    rows: DataFrame
    edits: DataFrame
    pieces: DataFrame

    @property
    def turns(self) -> DataFrame:
        """The repaired conversations, in the order of ``row, step``."""
        return self.edits.filter("edit <> 'D'").drop("edit", "cost")


def repair(turns: DataFrame) -> Repair:
    """The cheapest edits that give every conversation the roles ``(system? (user assistant)+)?``.

    ``conv_id, turn, role, text``; order and faults as in ``diagnose``. Keep costs 0 (1 for a
    truncated row), rerole to user or assistant 2 (3), delete 3, which blank and duplicate rows
    need, insert of an empty turn 2. Of equally cheap edits those whose initials come first in
    ASCII. An empty table has no edits. Repeated rows are duplicates.
    """
    ship(turns.sparkSession)
    rows = diagnose(turns)
    kind = dict(rows.dtypes)["conv_id"]
    in_piece = F.array_sort(F.collect_list(F.struct("row", "symbol")))["symbol"]
    pieces = rows.groupBy("conv_id", "piece").agg(
        F.min("row").alias("first"), F.array_join(in_piece, "").alias("symbols")
    )
    base = f"conv_id {kind}, piece bigint, first bigint, symbols string"
    shapes = _mapped(pieces, _shapes, f"{base}, matrix array<bigint>")
    conv = F.col("conv_id").asc_nulls_first()
    last_first = shapes.repartition("conv_id").sortWithinPartitions(conv, F.col("piece").desc())
    costs = _mapped(last_first, _backwards, f"{base}, after array<bigint>, leads boolean")
    chosen = _mapped(
        costs.repartition("conv_id", "piece"),
        _choices,
        f"{base}, leads boolean, edits array<string>, left array<int>",
    )
    in_turn = chosen.repartition("conv_id").sortWithinPartitions(conv, F.col("piece").asc())
    picked = stored(
        _mapped(
            in_turn,
            _forwards,
            f"conv_id {kind}, first bigint, symbols string, edits string, illegal bigint, "
            "left int, ends boolean",
        )
    )
    single = _mapped(
        picked.repartition("first"),
        _edits,
        f"conv_id {kind}, row bigint, step int, edit string, said string",
    )
    held = rows.select("row", "turn", "role", "text", "truncated")
    own = F.col("edit") != "I"
    short = F.when(F.col("truncated") & F.col("edit").isin("K", "R"), CUT_SHORT).otherwise(0)
    price = (
        F.when(F.col("edit") == "D", DELETE)
        .when(F.col("edit") == "I", INSERT)
        .when(F.col("edit") == "R", REROLE)
        .otherwise(0)
    )
    edits = single.join(held, "row").select(
        "conv_id",
        "row",
        "step",
        "edit",
        F.when(own, F.col("turn")).alias("turn"),
        F.coalesce("said", "role").alias("role"),
        F.when(own, F.col("text")).otherwise("").alias("text"),
        (price + short).cast("bigint").alias("cost"),
    )
    return Repair(rows, stored(edits), picked.select("conv_id", "illegal"))


def _digest(rows: Iterator[dict]) -> Iterator[dict]:
    """Audit and digest of conversations that come sorted; holds one turn at a time."""
    held = sha = None

    def closed():
        return held | {"audit": "".join(held["audit"]), "repaired_sha256": sha.hexdigest()}

    for row in rows:
        if held is None or row["conv_id"] != held["conv_id"]:
            if held is not None:
                yield closed()
            held, sha, first = {"conv_id": row["conv_id"], "cost": 0, "audit": []}, hashlib.sha256(), True
        held["cost"] += row["cost"]
        held["audit"].append(row["edit"])
        if row["edit"] != "D":
            sha.update(f"{'' if first else chr(10)}{row['role']}:{row['text']}".encode())
            first = False
    if held is not None:
        yield closed()


def report(repair: Repair) -> DataFrame:
    """Per conversation: ``gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`` (of ``role:text`` of its turns, joined by newlines).

    A digest runs over a conversation from end to end, so each streams through one task.
    """
    kind = dict(repair.rows.dtypes)["conv_id"]
    ordered = repair.edits.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "row", "step"
    )
    digests = _mapped(
        ordered.select("conv_id", "edit", "role", "text", "cost"),
        _digest,
        f"conv_id {kind}, cost bigint, audit string, repaired_sha256 string",
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    faults = [F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    counts = repair.rows.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("bigint").alias("gaps"), *faults
    )
    pairs = repair.pieces.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"))
    counts, pairs = counts.withColumnRenamed("conv_id", "_c"), pairs.withColumnRenamed("conv_id", "_p")
    joined = digests.join(counts, F.col("conv_id").eqNullSafe(F.col("_c")))
    return joined.join(pairs, F.col("conv_id").eqNullSafe(F.col("_p"))).drop("_c", "_p")
