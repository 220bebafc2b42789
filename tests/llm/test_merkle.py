"""Merkle manifest and proofs against a plain recomputation."""

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.llm import merkle, queries

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf int, tree string"
ROWS = [
    (i, f"Text {i} ÀÉ" if i % 7 else "", "en" if i % 3 else "de", f"s{i % 4}", i)
    for i in range(1, 90)
] + [
    (None, None, None, None, None),
    (None, "no id", "en", None, 3),
    (5, "ANOTHER text five", "en", "s", 1),
    (7, "same", "fr", "s", 1),
    (7, "same", "fr", "s", 1),
    (200, "LONG " * 50_000, "en", "s", None),
    (201, "A lone leaf", "zz", "s", 4),
]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars):
    return digest(*map(field, (doc_id, source, lang, n_chars, text)))


def tree_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        nodes = levels[-1]
        levels.append([digest(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)])
    return levels


def climb(levels, place, own):
    """The proof's digests, and the top that ``own`` leads to."""
    proof = []
    for nodes in levels[:-1]:
        first = place - place % 8
        run = nodes[first : first + 8]
        left, right = run[: place - first], run[place - first + 1 :]
        proof += left + right
        own = digest(*left, own, *right)
        place //= 8
    return proof, own


def low(text):
    return text and text.encode().lower().decode()


def brute(rows):
    languages = sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for lang in languages:
        own = [r for r in rows if r[2] == lang]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        trees.append((own, tree_of([leaf_of(*r) for r in own])))
    top = tree_of([levels[-1][0] for _, levels in trees])
    out = []
    for t, (own, levels) in enumerate(trees):
        for place, row in enumerate(own):
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            claimed = leaf_of(row[0], low(row[1]) if changed else row[1], *row[2:])
            inside, led = climb(levels, place, claimed)
            above, led = climb(top, t, led)
            root = top[-1][0]
            out.append((row[0], leaf_of(*row), levels[-1][0], root, digest(*inside, *above), led, led == root))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA).repartition(4)


def asked(spark, rows, monkeypatch):
    monkeypatch.setattr(queries, "read", lambda *_: table(spark, rows))
    return sorted(map(tuple, queries.merkle_manifest(spark, "").collect()), key=repr)


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], ROWS[:2], []], ids=["odd", "one", "two", "none"])
def test_query_equals_plain_recomputation(spark, monkeypatch, rows):
    assert asked(spark, rows, monkeypatch) == (brute(rows) if rows else [])


def test_small_chunks_make_the_same_proofs(spark, monkeypatch):
    whole = asked(spark, ROWS, monkeypatch)
    monkeypatch.setattr(merkle, "CHUNK", 5)
    assert asked(spark, ROWS, monkeypatch) == whole


def test_proofs_of_some_leaves_only(spark):
    manifest = merkle.build(table(spark, ROWS))
    some = manifest.leaves.filter("doc_id % 10 = 3")
    proofs = merkle.prove(manifest, some)
    led = merkle.folded(F.col("leaf"), F.col("places"), F.col("siblings"))
    found = proofs.select("doc_id", led.alias("led"), "root").collect()
    (root,) = manifest.root.first()
    assert sorted(r.doc_id for r in found) == list(range(3, 90, 10))
    assert {r.led for r in found} == {r.root for r in found} == {root}
    expected = {(r[0], r[4]) for r in brute(ROWS)}
    proved = proofs.select("doc_id", merkle.proof_digest(F.col("siblings"))).collect()
    assert {tuple(r) for r in proved} <= expected


def test_empty_table_has_no_root(spark):
    manifest = merkle.build(table(spark, []))
    assert manifest.root.count() == manifest.nodes.count() == merkle.prove(manifest).count() == 0


@given(st.integers(1, 700), st.data())
@settings(max_examples=60, deadline=None)
def test_missing_is_the_least_set_that_derives_the_top(n, data):
    chosen = data.draw(st.sets(st.integers(0, n - 1), min_size=1, max_size=20))
    levels = tree_of([digest(str(i)) for i in range(n)])
    wanted = merkle.missing(chosen, n)
    assert len(set(wanted)) == len(wanted)
    for level, place in wanted:  # nothing that the chosen leaves give themselves
        assert all(leaf // 8**level != place for leaf in chosen)
    known = {(0, p): levels[0][p] for p in chosen}
    known |= {c: levels[c[0]][c[1]] for c in wanted}
    assert merkle.derive(dict(known), set(chosen), n) == levels[-1][0]
    for dropped in wanted[:5]:
        with pytest.raises(KeyError):
            merkle.derive({c: d for c, d in known.items() if c != dropped}, set(chosen), n)
