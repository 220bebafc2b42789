"""Repair of conversations against a search over all edits."""

import hashlib
import re
import zlib
from collections import defaultdict
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import queries, turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string, row int, piece string"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def talk(conv, *said):
    return [(conv, turn, role, text) for turn, (role, text) in enumerate(said)]


ROWS = [
    *(row for c in range(60) for row in talk(c, ("system", "S."), ("user", f"Q {c}?"), ("assistant", "A."), ("user", "Q?"), ("assistant", "A"))),
    *talk(100, ("assistant", "A."), ("assistant", "B."), ("user", "C.")),
    *talk(101, *[("user", f"Again {i}.") for i in range(9)]),
    *talk(102, *[("user", "same.")] * 40),
    *talk(103, ("user", " \t\n"), ("user", ""), ("assistant", None), (None, "text.")),
    *talk(104, ("tool", "T."), ("system", "S."), ("user", "U"), ("assistant", "A! \x0b")),
    *talk(105, ("user", "LONG. " * 30_000), ("assistant", "long " * 30_000)),
    (106, None, "user", "no turn."), (106, None, None, None), (106, 5, "assistant", "A."),
    (106, 9, "user", "U."), (106, 9, "assistant", "B."), (106, 9, "assistant", "B."),
    (None, 1, "user", "null conversation?"), (None, None, "assistant", "Yes."),
    (107, None, "user", "only null turns."), (108, 3, "", ""),
]


def crc(text):
    return zlib.crc32(text.encode())


def damage(rows):
    for conv, turn, role, text in rows:
        said = [" " if x is None else str(x) for x in (conv, turn)]
        role, text = (" " if x is None else x for x in (role, text))
        kind = crc(":".join(said)) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)


def faults(rows):
    seen = set()
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        if not bare:
            yield "blank"
        elif (role, text) in seen:
            yield "duplicate"
        else:
            yield "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))


def cheapest(rows, found):
    """Cost, audit and turns of the best edits, by trying all of them."""

    @cache
    def best(i, last, inserted):
        options = [(0, "", ())] if i == len(rows) and last in "-a" else []
        insert = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[insert]

        def then(cost, edit, at, state, inserted=0, turn=None):
            more = best(at, state, inserted)
            if more:
                said = (turn,) if turn else ()
                options.append((cost + more[0], edit + more[1], said + more[2]))

        if inserted < 3:
            then(2, "I", i, insert, inserted + 1, f"{name}:")
        if i < len(rows):
            then(3, "D", i + 1, last)
        if i < len(rows) and found[i] not in ("blank", "duplicate"):
            _, _, role, text = rows[i]
            extra = found[i] == "truncated"
            if role[:1] == insert or (role[:1] == "s" and last == "-"):
                then(extra, "K", i + 1, role[:1], turn=f"{role}:{text}")
            then(2 + extra, "R", i + 1, insert, turn=f"{name}:{text}")
        return min(options, default=None)

    return best(0, "-", 0)


def brute(rows):
    talks = defaultdict(list)
    for row in damage(rows):
        talks[row[0]].append(row)
    for conv in {r[0] for r in rows}:
        own = sorted(talks[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        found = list(faults(own))
        numbers = [r[1] for r in own if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        pairs = zip(own, own[1:])
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairs)
        cost, audit, said = cheapest(own, found)
        counts = [found.count(k) for k in ("blank", "duplicate", "truncated")]
        sha = hashlib.sha256("\n".join(said).encode()).hexdigest()
        yield conv, gaps, *counts, illegal, cost, audit, sha


COLUMNS = [
    "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
]


def asked(spark, rows, monkeypatch):
    table = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(4)
    monkeypatch.setattr(queries, "read", lambda *_: table)
    found = queries.turn_repair(spark, "").select(*COLUMNS).collect()
    return sorted(map(tuple, found), key=repr)


@pytest.mark.parametrize("rows", [ROWS, []], ids=["odd", "none"])
def test_query_equals_a_search_over_all_edits(spark, monkeypatch, rows):
    assert asked(spark, rows, monkeypatch) == sorted(brute(rows), key=repr)


def test_conversations_cut_into_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(turns, "PIECE_BITS", 1)
    assert asked(spark, ROWS, monkeypatch) == sorted(brute(ROWS), key=repr)


def test_repaired_turns_follow_the_grammar(spark):
    table = spark.createDataFrame([(*r, 1, "clash") for r in ROWS], SCHEMA)
    repaired = turns.repair(table).turns.orderBy("conv_id", "row", "step").collect()
    talks = defaultdict(str)
    for row in repaired:
        talks[row.conv_id] += row.role[:1]
    assert all(GRAMMAR.fullmatch(t) for t in talks.values())


@given(st.text("suaoSUAO1234", min_size=1, max_size=12), st.integers(0, 11))
@settings(max_examples=300, deadline=None)
def test_edits_are_the_first_of_the_cheapest(symbols, cut):
    cut = min(cut, len(symbols))
    left, right = symbols[:cut], symbols[cut:]
    middle = turns.run_costs(right, turns.END)
    assert turns.before(turns.matrix_of(right), turns.END) == middle
    edits, state = turns.unroll(left, turns.START, middle) if left else ([], turns.START)
    more, state = turns.unroll(right, state, turns.END) if right else ([], state)
    audit = "".join(e for e, _ in [*edits, *more, *turns.finish(state)])
    kinds = {**dict.fromkeys("1234", "blank"), **dict.fromkeys("SUAO", "truncated")}
    roles = {"s": "system", "u": "user", "a": "assistant", "o": "other"}
    rows = [(0, 0, roles[turns.initials(c)], "") for c in symbols]
    cost, expected, _ = cheapest(rows, [kinds.get(c, "") for c in symbols])
    assert audit == expected
    assert turns.run_costs(symbols, turns.END)[turns.START] == cost


def test_long_runs_cost_what_their_powers_say():
    length = 1_000_003
    costs = turns.run_before("u", length, turns.END)
    # a user and an inserted answer each, as cheap as every second one made an answer
    assert costs[turns.START] == length - 1 + 2
    assert turns.run_before("1", length, turns.END)[turns.START] == 3 * length
