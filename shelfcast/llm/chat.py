"""Chat formatting by incremental black-box rendering.

A template is any function from a list of ``(role, text)`` turns to a string. Successive
prefixes of a conversation are rendered; what one output adds to the one before is the span
of its last turn. The text's place inside a span is found by rendering the turn with two
probe texts. A template whose longer output does not begin with its shorter one rewrites
history: such turns are marked, and have no spans.

Every turn is rendered after all turns before it, so a conversation stays in one task and
costs time by the square of its turns. A template whose turns do not depend on each other says
so (``turnwise``): its prefixes begin ``LOOK_BACK`` turns before a window of ``WINDOW`` turns,
its conversations are sorted over range partitions, and a very long one is spread over tasks
and costs time in proportion to its turns. That claim is checked: the whole prefix is rendered
whenever its turns have doubled, at the end of a conversation, and after ``RUN`` turns, where
checking begins anew, and must be the pieces laid end to end.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import ship, stored

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

WINDOW = 8  # turns of a turnwise template whose prefixes begin at one place
LOOK_BACK = 2  # turns before the window that its prefixes begin with
RUN = 4096  # turns of a conversation in a task, and a window more at most, held to check a claim
PROBES = ("", "")  # two texts without a common first or last character

# fixed values: control strings of the template
CONTROLS = (
    "<s>",
    "</s>",
    "[INST]",
    "[/INST]",
    "[SYS]",
    "[/SYS]",
    "[ROLE]",
    "[/ROLE]",
    "[/TURN]",
)
_NAMES = "|".join(re.escape(c[1:]) for c in CONTROLS)
_PLAIN = re.compile(rf"([<\[])(\\*)({_NAMES})")
_MASKED = re.compile(rf"([<\[])\\(\\*)({_NAMES})")
_TURN = re.compile(
    r"\[SYS\] (?P<system>.*?) \[/SYS\]"
    r"|\[INST\] (?P<user>.*?) \[/INST\]"
    r"|<s>(?P<assistant>.*?)</s>"
    r"|\[ROLE\](?P<role>.*?)\[/ROLE\](?P<other>.*?)\[/TURN\]",
    re.DOTALL,
)


def escape(text: str) -> str:
    """Put a backslash inside every control string, and one more where some stand already."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _MASKED.sub(r"\1\2\3", text)


# the turns of successive prefixes are escaped once
_escaped = lru_cache(maxsize=4 * (WINDOW + LOOK_BACK))(escape)


def turnwise(template: Template) -> Template:
    """Declare that the output is that of each turn by itself, laid end to end."""
    template.turnwise = True
    return template


@turnwise
def instruct_template(turns: list[Turn]) -> str:
    """``[SYS] .. [/SYS]``, ``[INST] .. [/INST]``, ``<s>..</s>``; other roles are named."""
    out = []
    for role, text in turns:
        safe = _escaped(text)
        if role == "system":
            out.append(f"[SYS] {safe} [/SYS]")
        elif role == "user":
            out.append(f"[INST] {safe} [/INST]")
        elif role == "assistant":
            out.append(f"<s>{safe}</s>")
        else:
            out.append(f"[ROLE]{escape(role)}[/ROLE]{safe}[/TURN]")
    return "".join(out)


def parse(formatted: str) -> list[Turn]:
    """The turns of an output of ``instruct_template``."""
    found = []
    for m in _TURN.finditer(formatted):
        kind = m.lastgroup
        if kind == "other":
            found.append((unescape(m["role"]), unescape(m["other"])))
        else:
            found.append((kind, unescape(m[kind])))
    return found


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def spans(turns: list[Turn], template: Template, before: int = 0) -> list[tuple]:
    """``(piece, text_start, text_end, rewrites)`` for the turns after the first ``before``.

    ``piece`` is what the turn adds to the output, the places are inside ``piece``. Where
    the turn rewrites the output before it, ``piece`` is null and the places are -1. The first
    turn's piece holds all that stands before it.
    """
    done = template(turns[:before]) if before else ""
    out = []
    for k in range(before, len(turns)):
        now = template(turns[: k + 1])
        if not now.startswith(done):
            out.append((None, -1, -1, True))
            done = now
            continue
        role = turns[k][0]
        first, second = (template([*turns[:k], (role, p)]) for p in PROBES)
        head = _common(first, second)
        tail = _common(first[::-1], second[::-1])
        own = now[len(done) :]
        start, end = head - len(done), len(own) - tail
        fits = 0 <= start <= end and now.startswith(first[:head])
        out.append((own, start, end, False) if fits else (own, -1, -1, False))
        done = now
    return out


NOT_TURNWISE = "the template is declared turnwise, but its turns depend on each other"


def _turn_spans(turns: list[Turn], template: Template, back: list[Turn] = ()) -> list[tuple]:
    """``spans`` of ``turns`` from prefixes that begin with the turns ``back``."""
    found = spans([*back, *turns], template, len(back))
    if any(rewrites for *_, rewrites in found):
        raise ValueError(NOT_TURNWISE)
    return found


class _Turnwise:
    """Spans of a conversation's windows, one after the other; its claim is checked on the way."""

    def __init__(self, template: Template):
        self.template = template
        self.turns, self.pieces = [], []
        self.checked, self.next_check = 0, 2 * WINDOW

    def spans(self, turns: list[Turn]) -> list[tuple]:
        found = _turn_spans(turns, self.template, self.turns[-LOOK_BACK:])
        if not self.turns:  # these were whole prefixes
            self.checked = len(turns)
        self.turns += turns
        self.pieces += [piece for piece, *_ in found]
        if len(self.turns) >= min(self.next_check, RUN):
            self.check()
            self.next_check = 2 * len(self.turns)
            if len(self.turns) >= RUN:
                self.turns, self.pieces = self.turns[-LOOK_BACK:], self.pieces[-LOOK_BACK:]
                self.checked, self.next_check = 0, 2 * WINDOW
        return found

    def check(self) -> None:
        """The whole prefix, against the pieces."""
        if self.checked < len(self.turns) and self.template(self.turns) != "".join(self.pieces):
            raise ValueError(NOT_TURNWISE)
        self.checked = len(self.turns)


def _formatted(rows: list[dict], turns: list[Turn], found: list[tuple]) -> pa.RecordBatch:
    loss = [t[0] == "assistant" and s[1] >= 0 for t, s in zip(turns, found, strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r["conv_id"] for r in rows], pa.int64()),
            pa.array([r["turn"] for r in rows], pa.int64()),
            pa.array([r["ordinal"] for r in rows], pa.int64()),
            pa.array([r["role"] for r in rows], pa.string()),
            pa.array([s[0] for s in found], pa.string()),
            pa.array([s[1] if k else -1 for s, k in zip(found, loss)], pa.int64()),
            pa.array([s[2] if k else -1 for s, k in zip(found, loss)], pa.int64()),
            pa.array([s[3] for s in found], pa.bool_()),
        ],
        ["conv_id", "turn", "ordinal", "role", "formatted", "loss_start", "loss_end", "rewrites"],
    )


def _render(template: Template):
    alone = getattr(template, "turnwise", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, waiting, held = object(), [], _Turnwise(template)

        def sent():
            turns = [(r["role"] or "", r["text"] or "") for r in waiting]
            return _formatted(waiting, turns, held.spans(turns) if alone else spans(turns, template))

        for batch in batches:
            for row in batch.to_pylist():
                new = row["conv_id"] != conv
                if waiting and (new or (alone and len(waiting) >= WINDOW)):
                    yield sent()
                    waiting = []
                if new:
                    held.check()
                    conv, held = row["conv_id"], _Turnwise(template)
                waiting.append(row)
        if waiting:
            yield sent()
        held.check()

    return run


def format_turns(conversations: DataFrame, template: Template = instruct_template) -> DataFrame:
    """One row per turn: ``conv_id, turn, ordinal, role, formatted, loss_start, loss_end,
    rewrites``.

    The pieces of a conversation, in ``ordinal`` order, make its formatted text. The loss
    mask covers ``[loss_start, loss_end)`` of a piece: an assistant's text; -1 elsewhere.

    A template that is not declared ``turnwise`` sees all turns before each one: a conversation
    is then held by one task. One that is declared so sees the turns before a window that stand
    in the same task; a claim that the checks above find false ends the job with an error.

    Null text or role: empty. Rows that repeat a turn are kept, in the order of role and
    text; turns with a null number come first; a null conv_id is a conversation of its own.
    Extra columns are ignored.
    """
    ship(conversations.sparkSession)
    keys = ["conv_id", "turn", "role", "text"]
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    order = [F.col(k).asc_nulls_first() for k in keys]
    alone = getattr(template, "turnwise", False)
    spread = rows.repartitionByRange(*order) if alone else rows.repartition("conv_id")
    spread = spread.sortWithinPartitions(*order)
    numbered = spread.withColumn("ordinal", F.monotonically_increasing_id())
    return numbered.mapInArrow(
        _render(template),
        "conv_id bigint, turn bigint, ordinal bigint, role string, formatted string, "
        "loss_start bigint, loss_end bigint, rewrites boolean",
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations that arrive sorted; holds one piece at a time."""
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]
    none = object()
    conv, state, done = none, None, []

    def closed(key, s):
        return (key, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4], s[5])

    def sent(rows):
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[i] for r in rows], t)
                for i, t in enumerate([*types, pa.bool_()])
            ],
            ["conv_id", *names],
        )

    for batch in batches:
        columns = [
            batch.column(c).to_pylist()
            for c in ("conv_id", "formatted", "loss_start", "loss_end", "rewrites")
        ]
        for key, piece, start, end, rewrites in zip(*columns, strict=True):
            if key != conv:
                if conv is not none:
                    done.append(closed(conv, state))
                conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
            state[5] = state[5] or rewrites
            for role, text in parse(piece or ""):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            if start >= 0:
                text = unescape(piece[start:end])
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += len(piece or "")
        if len(done) >= 1000:
            yield sent(done)
            done = []
    if conv is not none:
        done.append(closed(conv, state))
    if done:
        yield sent(done)


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation: what ``format_turns`` wrote, read back.

    A digest runs over a conversation's text from end to end, so each conversation streams
    through one task, one piece at a time.
    """
    ship(formatted.sparkSession)
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "ordinal")
    return ordered.select("conv_id", "formatted", "loss_start", "loss_end", "rewrites").mapInArrow(
        _digest,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint, rewrites boolean",
    )


def format_and_digest(conversations: DataFrame) -> DataFrame:
    """Format all conversations to a table in the shared folder, and digest it."""
    return digests(stored(format_turns(conversations)))
