"""Training-data operators against brute force, on small tables with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import (
    chat,
    graph,
    lm,
    minhash,
    mixing,
    pieces,
    quality,
    tokenfile,
    toxicity,
    urlrules,
    vafile,
)
from shelfcast.llm.queries import PIECE_MODEL, WORD_TOKENIZER

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, key int"
COPY = " ".join(f"w{i}" for i in range(60))
NEAR = COPY.replace("w30", "other")
TEXTS = [
    (1, COPY, "en", "b"), (2, COPY.upper(), "en", "a"), (3, NEAR, "en", "b"),
    (4, None, "en", "a"), (5, "", None, None), (6, " \n\t ", "en", "b"), (7, "one", "de", "c"),
    (8, "one", "de", "c"), (9, "One two", None, None), (10, "x " * 3000, "en", "a"),
    (11, "Émile a b İ, <|endoftext|> '́s it's.", "fr", "\U00010000"),
    (12, "line one here\nline one here\n\n", "en", "ｚ"), (None, COPY, "en", "a"),
    (13, "a#b $c\r;\r tab\t▁ two  spaces   日本語 " + "q" * 90, "xx", "b"),
    (14, "the same words again and again the same words again and again " * 4, "en", "a"),
    (14, "another text of document fourteen", "en", "a"),
    (15, NEAR, "en", "b"), (15, NEAR, "en", "b"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, g, s, len(t or ""), "clash", 1) for i, t, g, s in TEXTS]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# -- near duplicates -----------------------------------------------------------------


def brute_components(rows, width, percent=80):
    sets = []
    for _, text in rows:
        w = words(text)
        k = min(width, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    least = {i: i for i, _ in rows if i is not None}

    def root(x):
        return x if least[x] == x else root(least[x])

    for (i, a), (j, b) in combinations(zip([r[0] for r in rows], sets), 2):
        if i is None or j is None or not a or not b:
            continue
        if i == j or 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((root(i), root(j)))
            least[y] = x
    return sorted(
        (
            (i, len(s), root(i) if i is not None else None, i is None or root(i) == i)
            for (i, _), s in zip(rows, sets)
        ),
        key=str,
    )


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates_match_brute_force(docs, width):
    found = minhash.near_duplicates(docs, width=width).collect()
    assert sorted(map(tuple, found), key=str) == brute_components([(r[0], r[1]) for r in TEXTS], width)


def test_near_duplicates_in_a_large_loose_group(spark, monkeypatch):
    """Copies that link with some of the group only, over several blocks."""
    monkeypatch.setattr(minhash, "LEFT", 8)
    monkeypatch.setattr(minhash, "RIGHT", 16)
    draw = np.random.default_rng(3)
    base = [f"t{i}" for i in range(80)]
    rows = []
    for i in range(90):
        own = list(base)
        for place in draw.choice(80, draw.integers(0, 9), replace=False):
            own[place] = f"n{draw.integers(4)}"
        rows.append((i, " ".join(own)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(map(tuple, minhash.near_duplicates(table, width=2).collect()), key=str)
    assert found == brute_components(rows, 2)


def test_signatures_estimate_similarity_with_shifts_of_one_permutation():
    signer, codes = minhash.Signer(), np.random.default_rng(0).integers(0, 2**63, 900).astype(np.uint64)
    a, b = signer.signature(np.sort(codes[:800])), signer.signature(np.sort(codes[100:]))
    assert len(a) == minhash.COORDINATES and abs((a == b).mean() - 700 / 900) < 0.15
    assert (signer.shifts[5, 1:] == signer.shifts[6, :-1]).all()
    assert (minhash.Signer().keys(codes) == signer.keys(codes)).all()


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (200, 200)]
    found = graph.components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert dict(map(tuple, found.collect())) == {i: 0 for i in range(61)} | {100: 100, 101: 100}


# -- toxicity ------------------------------------------------------------------------


def test_ordinal_regression_orders_grades_and_shares_weights():
    draw, texts, grades = np.random.default_rng(1), [], []
    for i in range(400):
        bad = i % 4
        texts.append({f"w{x}" for x in draw.integers(0, 300, 40)} | {f"rude{k}" for k in range(2 * bad)})
        grades.append(bad)
    model = toxicity.fit(texts, np.array(grades), steps=150)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == 3
    margin = [sum(model.weights.get(f, 0) for w in t for f in toxicity.features(w)) for t in texts]
    severity = model.severity(np.array(margin))
    means = [severity[np.array(grades) == g].mean() for g in range(4)]
    assert means == sorted(means) and means[0] < 0.4 < 1.0 < means[2]


def test_toxic_documents_are_found_and_others_left(spark):
    rows = [(i, f"plain text number {i} of the set" + (" you utter fool" if i % 5 == 0 else ""))
            for i in range(200)] + [(500, None), (501, ""), (502, "YOU utter FOOL!"), (503, "nice text")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("severity", F.lit(9))
    labels = spark.createDataFrame(
        [(i, 1, int(i % 5 == 0)) for i in range(0, 200)] + [(1, 1, None), (None, 1, 1)],
        "doc_id bigint, quality int, toxic int",
    )
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    found = {r.doc_id: r.toxic_rejected for r in scored.collect()}
    assert len(found) == 204 and all(found[i] == (i % 5 == 0) for i in range(200))
    assert not found[500] and not found[501] and found[502] and not found[503]
    none = toxicity.train(docs, labels.limit(0))
    assert {r.severity for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), none).count() == 0


# -- URL filters ---------------------------------------------------------------------

URLS = [
    "http://A.Example.NET/en/1?x=1", "https://example.net/en", "http://sub.example.com/de/2#t",
    "http://notexample.com/de/1", "http://x.org/fr/1", "http://org/fr/", "ftp://b.org/es/9", None,
    "no scheme/de/", "http://", "://net/", "http://spam.org/de/1", "http://spam.org/en/1", "http://net/a",
]


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.encode().lower().decode()
    fits = [r for r in urlrules.STATED
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best


def test_stated_rules_and_mined_verdicts(spark):
    rows = [(i, u, "h", 0.5) for i, u in enumerate(URLS * 3)] + [(0, URLS[0], None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, confidence double")
    known = [(f"http://spam{i % 3}.org/de/{i}", True) for i in range(30)]
    known += [(f"http://good{i % 3}.org/en/{i}", False) for i in range(30)] + [(None, True), ("http://q/", None)]
    labels = spark.createDataFrame(known, "url string, blocked boolean")
    found = urlrules.filter_urls(pages, labels, min_support=0.1, min_confidence=0.9).collect()
    assert len(found) == len(rows)
    for r in found:
        host, path, rule = brute_url(dict((i, u) for i, u, *_ in rows)[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None)
        wanted = rule.verdict if rule else ("block" if "/de/" in path else "allow")
        assert r.verdict == wanted, r
    assert urlrules.filter_urls(pages.limit(0)).count() == 0
    assert {r.verdict for r in urlrules.filter_urls(pages.filter("url IS NULL")).collect()} == {"allow"}


def test_pages_no_rule_covers_count_against_mined_rules(spark):
    urls = [f"https://example.com/de/{i}" for i in range(40)] + [f"https://example.com/en/{i}" for i in range(60)]
    urls += [f"https://shop.net/sale/{i}" for i in range(40)] + [f"https://shop.org/sale/{i}" for i in range(4)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    found = {urls[r.page_id]: r for r in urlrules.filter_urls(pages).collect()}
    assert all(r.verdict == "allow" and r.mined is None for u, r in found.items() if "/en/" in u)
    assert all(r.verdict == "block" for u, r in found.items() if "/de/" in u or ".net/" in u)
    carried = [r for u, r in found.items() if ".org/" in u]  # 40 of 44 with path:sale are blocked
    assert all(r.verdict == "block" and r.confidence == pytest.approx(40 / 44) for r in carried)


def test_mined_rules_match_brute_force(spark):
    draw = np.random.default_rng(5)
    rows = [([f"t{k}" for k in sorted(set(draw.integers(0, 6, 3).tolist()))],) for _ in range(200)]
    rows = [(t, "t1" in t and "t2" in t or draw.random() < 0.1) for (t,) in rows]
    table = spark.createDataFrame([(t, bool(b)) for t, b in rows], "tokens array<string>, blocked boolean")
    found = {tuple(r.antecedent): round(r.confidence, 9) for r in urlrules.mine(table, 0.02, 0.7).collect()}
    every = {}
    for size in (1, 2, 3):
        for combo in combinations([f"t{k}" for k in range(6)], size):
            hit = [b for t, b in rows if set(combo) <= set(t)]
            if hit and sum(hit) >= 0.02 * 200 and sum(hit) / len(hit) >= 0.7:
                every[combo] = sum(hit) / len(hit)
    kept = {
        c: round(v, 9)
        for c, v in every.items()
        if not any(every.get(tuple(x for x in c if x != y), -1) >= v for y in c if len(c) > 1)
    }
    assert found == kept and kept


# -- language model ------------------------------------------------------------------


def test_language_model_counts_and_base_score(docs, monkeypatch):
    monkeypatch.setattr(lm, "COMMON_WORDS", 6)  # most words then meet their counts in the join
    got = sorted(map(tuple, lm.train_and_score(docs).collect()), key=str)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter(w for i, t, *_ in TEXTS if not held(i) for w in [*words(t), ""])
    n, v = sum(counts.values()), len(counts)
    norm = math.log10(n + 0.1 * (v + 1))
    want = []
    for i, t, *_ in TEXTS:
        tokens = [*words(t), ""]
        base = sum(math.log10(counts[w] + 0.1) - norm for w in tokens)
        want.append((i, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), n, base))
    for g, w in zip(got, sorted(want, key=str), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], abs=1e-6) and g[6] < 0


def model_of(counts):
    """Cells by plain counting, and a model with drawn vectors."""
    named = sorted({zlib.crc32(w) for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: lm.NAMED]})
    alone, mass = [0.1] * len(named), np.full((lm.HEADS, lm.TAILS), 0.1)
    for w, n in counts.items():
        h = zlib.crc32(w)
        if h in named:
            alone[named.index(h)] += n + 0.1
        else:
            mass[h % lm.HEADS, h // lm.HEADS % lm.TAILS] += n + 0.1
    return lm.Cells(np.array(named, np.uint32), np.array(alone), mass)


def dense_log10(model, cells, counts, far, near, word):
    """log10 P(word | far, near) from every score, one at a time."""
    def code(w):
        h, named = zlib.crc32(w), cells.named.tolist()
        head = named.index(h) if h in named else len(named) + h % lm.HEADS
        return head, h // lm.HEADS % lm.TAILS, h // lm.HEADS // lm.TAILS % lm.THIRDS

    def vector(w):
        a, b, c = code(w)
        return (model.by_head[a] + model.by_tail[b] + model.by_third[c]).astype(float)

    def part(scores, at):
        return math.log10(math.exp(scores[at]) / sum(math.exp(x) for x in scores))

    hidden = vector(near) * model.near + vector(far) * model.far
    head, tail, _ = code(word)
    out = part([float(hidden @ u + b) for u, b in zip(model.heads, model.lean)], head)
    k = head - len(cells.named)
    if k >= 0:
        gated = hidden * model.gate[k]
        out += part([float(gated @ d) + math.log(m) for d, m in zip(model.tails, cells.mass[k])], tail)
    whole = cells.mass[k, tail] if k >= 0 else cells.alone[head]
    return out + math.log10((counts.get(word, 0) + 0.1) / whole)


def test_language_model_is_normalised_and_learns():
    draw = np.random.default_rng(0)
    every = [b"", *(b"w%d" % k for k in range(600))]
    texts = []
    for _ in range(400):  # words of even and odd number take turns
        start = draw.integers(0, 2)
        texts.append([*(b"w%d" % (2 * draw.integers(0, 300) + (start + i) % 2) for i in range(100)), b""])
    counts = Counter(w for t in texts for w in t)
    cells = model_of(counts)
    tokens = lm.hashes([w for t in texts for w in t])
    ends = np.cumsum([len(t) for t in texts]) - 1
    assert (cells.codes(tokens)[0] >= len(cells.named)).any() and len(cells.named) == lm.NAMED
    start = model = lm.LogBilinear.start(cells)
    for k in range(6):
        model = lm.fit(model, cells, tokens, ends, k)
    own = cells.codes(tokens)
    there = [*lm._before(cells, own, ends), own]
    first = np.concatenate([[0], ends[:-1] + 1])
    assert (there[1][:, first] == cells.codes(lm.hashes([b""]))).all()
    assert (there[1][:, first + 1] == own[:, first]).all() and (there[0][:, first + 2] == own[:, first]).all()
    plain = np.log10(cells.share(there[2]) / cells.heads.sum())
    assert start.log10(cells, *there).mean() == pytest.approx(plain.mean(), abs=1e-4)
    assert model.log10(cells, *there).mean() > plain.mean() + 0.15
    assert (model.unflat(model.flat()).by_third == model.by_third).all()
    # all cells at once
    hashed = np.arange(lm.HEADS * lm.TAILS, dtype=np.uint32)
    hashed = hashed[~np.isin(hashed, cells.named)]
    cell = np.concatenate([cells.codes(cells.named), cells.codes(hashed)], axis=1)
    missing = np.setdiff1d(np.arange(lm.HEADS * lm.TAILS), hashed)  # cells whose least hash is a named one
    more = (missing + lm.HEADS * lm.TAILS).astype(np.uint32)
    cell = np.concatenate([cell, cells.codes(more)], axis=1)
    for a, b in ((b"", b""), (b"w1", b"w2"), (b"unseen", b"w599")):
        context = [np.repeat(cells.codes(lm.hashes([w])), cell.shape[1], axis=1) for w in (a, b)]
        assert (10.0 ** model.log10(cells, *context, cell)).sum() == pytest.approx(1, abs=1e-3)
    for a, b, w in ((b"", b"", b"w7"), (b"w1", b"w2", b"w599"), (b"w3", b"never", b"unseen"), (b"w5", b"w8", b"")):
        one = [cells.codes(lm.hashes([x])) for x in (a, b, w)]
        share = math.log10((counts.get(w, 0) + 0.1) / cells.share(one[2])[0])
        want = dense_log10(model, cells, counts, a, b, w)
        assert model.log10(cells, *one)[0] + share == pytest.approx(want, abs=1e-4)
    assert set(every) >= set(counts)


def test_language_model_scores_every_word_against_a_dense_sum(spark, monkeypatch):
    """Whole scores, of common, joined, unseen and very long words, word by word."""
    monkeypatch.setattr(lm, "COMMON_WORDS", 300)
    draw = np.random.default_rng(1)
    texts = []
    for i in range(900):  # an odd word is followed by its own partner only
        texts.append(" ".join(f"p{k} q{k}" for k in draw.integers(0, 400, 40)) + f" once{i} bar")
    odd = {-7: "p3 q3", -8: "p3 q4", -9: "never " + "x" * 5000 + " once5", -10: None, -11: "P3\tQ3 "}
    rows = [*enumerate(texts), *odd.items(), (-7, "p3 q3"), (None, "bar")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    counts = lm.word_counts(table.filter("doc_id >= 0"))
    scorer = lm.train(table.filter("doc_id >= 0"), counts)
    held = Counter(w.encode() for t in texts for w in [*words(t), ""])
    want = model_of(held)
    assert (scorer.cells.named == want.named).all() and len(scorer.common) <= 300
    assert np.allclose(scorer.cells.alone, want.alone) and np.allclose(scorer.cells.mass, want.mass)
    found = lm.score(table.withColumns({"held_out": F.lit(False), "plain": F.lit(1)}), scorer, counts).collect()
    assert len(found) == len(rows)
    got = {r.doc_id: (r.base_score, r.score) for r in found}
    for i in (*odd, None, 0, 1):
        text = dict(rows)[i]
        tokens = [b"", b"", *(w.encode() for w in words(text)), b""]
        each = [dense_log10(scorer.model, want, held, *tokens[j : j + 3]) for j in range(len(tokens) - 2)]
        assert got[i][1] == pytest.approx(sum(each), abs=2e-3), i
    assert got[-7] == got[-11] and got[-7][1] > got[-8][1]
    assert sum(got[i][1] for i in range(900)) > sum(got[i][0] for i in range(900))


def test_language_model_has_one_size(spark):
    """Whatever the texts, a model, its cells and what a task sends are of the same size."""
    sizes = set()
    for n in (40, 400):
        texts = [(i, " ".join(f"w{i * 20 + k}" for k in range(20))) for i in range(n)]
        table = spark.createDataFrame(texts, "doc_id bigint, text string")
        scorer = lm.train(table, lm.word_counts(table))
        sizes.add((scorer.model.flat().size, scorer.cells.mass.size, len(scorer.cells.named)))
    assert len(sizes) == 1


def test_language_model_of_nothing(empty):
    assert lm.train_and_score(empty).count() == 0


# -- chat ----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text", ["", "plain", "</s>[INST] ok [/INST]", "[\\INST]", "<\\\\s>", "\\<s>\\", "[", "[/SYS", "a<"]
)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text and not any(c in safe for c in chat.CONTROLS)
    turns = [("user", text), ("assistant", text), ("system", text), ("tool", text), ("", text)]
    assert chat.parse(chat.instruct_template(turns)) == turns


def test_conversations_round_trip_over_windows(spark):
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", f"t{i} </s>") for i in range(75)]
    rows += [(8, 1, None, None), (8, None, "tool", "x"), (8, 1, None, None), (None, 0, "assistant", "y")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    table = table.withColumn("ordinal", F.lit("clash"))
    found = {r.conv_id: r for r in chat.format_and_digest(table).collect()}
    for key in (7, 8, None):
        own = sorted(
            ((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == key)
        )
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in own).encode()).hexdigest()
        loss = "".join(t for *_, r, t in own if r == "assistant")
        r = found[key]
        assert (r.n_turns, r.turns_sha256, r.loss_chars) == (len(own), digest, len(loss))
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest() and not r.rewrites
        assert r.formatted_chars == len(chat.instruct_template([(x[2], x[3]) for x in own]))
    assert chat.format_and_digest(table.limit(0)).count() == 0


def test_a_template_that_rewrites_history_is_found():
    def last_only(turns):
        return "".join(f"<{r}>{t if k == len(turns) - 1 else '..'}" for k, (r, t) in enumerate(turns))

    found = chat.spans([("user", "aaa"), ("assistant", "b"), ("user", "c")], last_only)
    assert [s[3] for s in found] == [False, True, True]
    upper = chat.spans([("user", "a"), ("assistant", "xyz")], lambda ts: "".join(f"{r}:{t}\n" for r, t in ts))
    assert upper[1][0][upper[1][1] : upper[1][2]] == "xyz"


@pytest.mark.parametrize("kind", ["rewrites an old turn", "prologue", "system in the last user turn"])
def test_templates_see_the_whole_prefix_over_partitions(spark, kind):
    def old(turns):  # the first turn is written anew from turn 30 on
        return "".join("*" if k == 0 and len(turns) > 30 else f"<{r}>{t}" for k, (r, t) in enumerate(turns))

    def prologue(turns):  # each turn names the first
        return "BOS|" + "".join(f"{turns[0][1]}/{r}:{t}\n" for r, t in turns)

    def moved(turns):
        last = max((k for k, (r, _) in enumerate(turns) if r == "user"), default=-1)
        first = turns[0][1] if turns else ""
        return "".join(f"<{r}>{first if k == last else ''}{t}" for k, (r, t) in enumerate(turns[1:], 1))

    template = {"rewrites an old turn": old, "prologue": prologue}.get(kind, moved)
    roles = lambda i: "system" if i == 0 else "user" if i % 2 else "assistant"
    rows = [(c, i, roles(i), f"c{c}t{i}") for c in range(3) for i in range(40)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    found = chat.format_turns(table, template).collect()
    assert len(found) == 120
    for c in range(3):
        own = sorted((r for r in found if r.conv_id == c), key=lambda r: r.ordinal)
        turns, done = [(r, t) for x, _, r, t in rows if x == c], ""
        assert [r.turn for r in own] == list(range(40))
        for k, r in enumerate(own):
            now = template(turns[: k + 1])
            assert r.rewrites == (not now.startswith(done))
            assert r.formatted == (None if r.rewrites else now[len(done) :])
            if r.loss_start >= 0:
                assert r.formatted[r.loss_start : r.loss_end] == turns[k][1]
            done = now
        assert any(r.rewrites for r in own) == (kind != "prologue")


def test_a_wrong_turnwise_claim_is_found():
    claimed = chat.turnwise(lambda turns: f"{len(turns)}" + "".join(t for _, t in turns))
    with pytest.raises(ValueError, match="turnwise"):
        chat._turn_spans([("user", "a"), ("user", "b")], claimed)


@pytest.mark.parametrize("since", [2, 17, 30, 60])
def test_a_turnwise_claim_that_turns_false_late_is_found(spark, since):
    def late(turns):  # the first turn is written anew from some turn on
        return "".join(f"<{r}>{'*' if k == 0 and len(turns) >= since else t}" for k, (r, t) in enumerate(turns))

    rows = [(c, i, "user", f"t{i}") for c in (1, 2) for i in range(12 if c == 1 else 64)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(1)
    with pytest.raises(Exception, match="turnwise"):
        chat.format_turns(table, chat.turnwise(late)).collect()


def test_turnwise_pieces_are_those_of_whole_prefixes(monkeypatch):
    asked = []

    def template(turns):
        asked.append(len(turns))
        return chat.instruct_template(turns)

    roles = ["system", "user", "assistant", "tool"]
    turns = [(roles[i % 4], f"turn {i} [/INST]") for i in range(100)]
    whole = chat.spans(turns, template)
    asked.clear()
    monkeypatch.setattr(chat, "RUN", 40)
    held, found = chat._Turnwise(template), []
    for i in range(0, 100, chat.WINDOW):
        found += held.spans(turns[i : i + chat.WINDOW])
    held.check()
    assert found == whole
    assert max(asked) < 40 + chat.WINDOW and sum(n > chat.WINDOW + chat.LOOK_BACK for n in asked) >= 5


# -- token files ---------------------------------------------------------------------


def test_token_files_hold_the_library_ids(spark, docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_TOKENIZER)
    found = [tuple(r) for r in tokenfile.encode_and_index(docs, WORD_TOKENIZER).orderBy("start").collect()]
    at, want = 0, []
    for i, t, *_ in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert found == want
    assert tokenfile.encode_and_index(empty, WORD_TOKENIZER).count() == 0


# -- quality -------------------------------------------------------------------------


def brute_quality(text):
    w = plain_words(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if plain_words(x)]
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(hit), failed)


def test_quality_counts_match_brute_force(docs, empty):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = quality.judge(docs)
    got = sorted(((r.doc_id, *(r[n] for n in names)) for r in judged.collect()), key=str)
    assert got == sorted(((i, *brute_quality(t)) for i, t, *_ in TEXTS), key=str)
    assert all(not r.kept for r in judged.filter("base_failed").collect())
    assert quality.judge(empty).count() == 0 and quality.keep_good(empty).columns == empty.columns


def test_divergence_matches_brute_force_and_drops_odd_texts(spark):
    good = [(i, "The cat and the dog saw a bird in the old tree, and then it flew. " * 8 + f"v{i} " * 3) for i in range(60)]
    good = [(i, " ".join(np.random.default_rng(i).permutation(t.split()))) for i, t in good]
    odd = [(100, " ".join(f"%{k}%!!" for k in range(200)))]
    table = spark.createDataFrame([(i, t, "en") for i, t in good + odd], "doc_id bigint, text string, lang string")
    refs = quality.references(table)
    ref = {r.lang: r for r in refs.collect()}["en"]
    for r in quality.judge(table, refs).collect():
        text = dict(good + odd)[r.doc_id]
        w = plain_words(text)
        c = Counter(w)
        counts = [c[x] for x in ref.common]
        p = np.array([*counts, len(w) - sum(counts)]) / len(w)
        q = np.array(ref.word_share)
        m = (p + q) / 2
        half = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
        assert r.word_js == pytest.approx(math.sqrt(max(0, (half(p) + half(q)) / 2)), abs=1e-6)
        assert r.base_failed or r.kept == (r.doc_id < 100)
    assert {r.doc_id for r in quality.keep_good(table).collect()} <= set(range(60))


def test_every_language_has_its_own_reference(spark, monkeypatch):
    """A corpus led by one language: the 70 small ones are not held to the pooled words."""
    draw, rows = np.random.default_rng(4), []
    for g in range(71):
        for _ in range(150 if g == 0 else 2):
            often = [f"g{g}w{k}" for k in draw.integers(0, 20, 60)]
            rest = [f"v{k}" for k in draw.integers(0, 10**6, 90)]
            rows.append((len(rows), " ".join(draw.permutation(often + rest)), f"l{g}"))
    table = spark.createDataFrame([*rows, (999, rows[0][1], None)], "doc_id bigint, text string, lang string")
    refs = {r.lang: r for r in quality.references(table).collect()}
    assert set(refs) == {f"l{g}" for g in range(71)} | {"*"}
    for g in (0, 70):
        c = Counter(w for _, t, name in rows if name == f"l{g}" for w in t.split())
        top = sorted(c.items(), key=lambda x: (-x[1], x[0]))[: quality.COMMON]
        assert refs[f"l{g}"].common == [w for w, _ in top]
        assert refs[f"l{g}"].word_share[:-1] == pytest.approx([n / c.total() for _, n in top])
    judged = {r.doc_id: r for r in quality.judge(table).collect()}
    assert len(judged) == len(rows) + 1 and all(r.kept for r in judged.values())
    monkeypatch.setattr(quality, "BROADCAST_BYTES", 0)  # a join of shuffled sides, no sifting: same result
    monkeypatch.setattr(quality, "SIFTED", 10)
    assert {r.doc_id: r for r in quality.judge(table).collect()} == judged


# -- exact top-k ---------------------------------------------------------------------


def test_top_k_matches_brute_force(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 420)]  # copies of a query
    rows += [(500, None), (501, [1.0, None] * 3), (502, [float("nan")] * 6), (503, [float("inf")] * 6)]
    rows += [(550, [1.0, 2.0]), (551, [0.5, 0.25]), (600, []), (None, [0.1] * 6)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("v", F.lit(1))
    found = sorted(map(tuple, vafile.top_k(table, k=5, every=50).collect()))
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fine[i] = np.floor(np.array(v, np.float32).astype(np.float64) * 256).astype(np.int64)
    want = []
    for q in sorted(i for i in fine if i % 50 == 0):
        scored = [(-int(fine[q] @ v), i) for i, v in fine.items() if i != q and len(v) == len(fine[q])]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:5])]
    assert found == sorted(want)
    assert vafile.top_k(table.limit(0)).count() == 0


@pytest.mark.parametrize("wave", [16, 1])
def test_top_k_of_any_finite_vector(spark, monkeypatch, wave):
    monkeypatch.setattr(vafile, "BLOCK", 5)
    monkeypatch.setattr(vafile, "WAVE", wave)
    draw = np.random.default_rng(5)
    for scale in (1.0, 1e12, 1e30, 7e305, 1.7e308):
        rows = []
        for i in range(120):
            wide = scale if i % 3 else 1.0
            rows.append((i, [float(x) for x in draw.uniform(-1, 1, 4) * wide]))
        rows += [(120, [1e30, 1.0]), (121, [2.0**60, 3.0]), (122, [-0.0, 0.0]), (125, [0.0, 0.0])]
        table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
        whole = {i: [math.floor(256 * x) for x in v] for i, v in rows if all(abs(256 * x) < math.inf for x in v)}
        want = []
        for q, a in whole.items():
            if q % 5:
                continue
            scores = []
            for c, b in whole.items():
                if c != q and len(a) == len(b):
                    score = sum(x * y for x, y in zip(a, b))
                    scores.append((-min(max(score, -(1 << 63)), (1 << 63) - 1), c))
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(scores)[:3])]
        found = vafile.top_k(table, k=3, every=5).collect()
        assert sorted(map(tuple, found)) == sorted(want)


def test_queries_are_cut_into_blocks_without_one_task_for_all(spark, monkeypatch):
    draw = np.random.default_rng(6)
    table = spark.createDataFrame(
        [(i, draw.normal(size=4).tolist()) for i in range(120)], "vec_id bigint, embedding array<float>"
    )
    whole = sorted(map(tuple, vafile.top_k(table, k=3, every=5).collect()))
    monkeypatch.setattr(vafile, "BLOCK", 7)
    asked = spark.range(500).withColumnRenamed("id", "entry")
    cut = vafile.in_blocks(asked, 500)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert {r.block for r in cut.collect()} <= set(range(72))
    assert sorted(map(tuple, vafile.top_k(table, k=3, every=5).collect())) == whole and len(whole) == 72


# -- mixing --------------------------------------------------------------------------


def reshared(sizes, weights, percent=150):
    """Targets by the plain loop: share, stop at the limit, share what is left."""
    target, total = {}, sum(sizes.values()) * percent / 100
    open_ = dict(weights)
    while open_:
        left = total - sum(target.values())
        level = left / sum(open_.values())
        full = [s for s in open_ if level * open_[s] > 2 * sizes[s]]
        if not full:
            return target | {s: level * w for s, w in open_.items()}
        for s in full:
            target[s] = 2.0 * sizes[s]
            del open_[s]
    return target


def test_mix_meets_its_targets(docs, empty):
    rows = mixing.mix_sizes(docs).collect()
    assert len(rows) == len(TEXTS)
    sizes, taken = Counter(), Counter()
    source = [(r[3], len(plain_words(r[1]))) for r in TEXTS]
    for s, n in source:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    want = reshared(sizes, {s: [3, 1, 2][i % 3] for i, s in enumerate(order)})
    source_of = {r[0]: r[3] for r in TEXTS}
    for r in rows:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix_sizes(docs.repartition(5)).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, rows), key=str)
    assert mixing.mix_sizes(empty).count() == 0
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns and mixing.mix_documents(empty).count() == 0
    assert max(Counter(r.doc_id for r in mixed.filter("doc_id < 14").collect()).values()) <= 2


@pytest.mark.parametrize("part_rows", [200_000, 3])
def test_taken_words_are_those_of_the_emitted_mix(spark, docs, monkeypatch, part_rows):
    monkeypatch.setattr(mixing, "PART_ROWS", part_rows)
    odd = [(100 + i, f"{i} " * (i % 7 + 1), "en", "abc"[i % 3], 0, "n", i) for i in range(60)]
    table = docs.unionByName(spark.createDataFrame(odd, DOCS)).withColumn("row", F.lit("clash"))
    counted = Counter()
    for r in mixing.mix_sizes(table).collect():
        counted[r.doc_id] += r.taken
    mixed = mixing.mix_documents(table).collect()
    emitted = Counter()
    whole = {}
    for r in table.collect():
        whole.setdefault(r.doc_id, []).append(r)
    cut = Counter()
    for r in mixed:
        emitted[r.doc_id] += len(plain_words(r.text))
        assert r.row == "clash" and any((r.text or "") == (w.text or "")[: len(r.text or "")] for w in whole[r.doc_id])
        cut[r.source] += not any(r.text == w.text for w in whole[r.doc_id])
    assert +emitted == +counted and max(cut.values()) <= 1 and sum(cut.values()) > 0
    # at every point of the mix the sources' words are near their shares, by a document at most
    sized = [(r.source, len(plain_words(r.text))) for r in mixed]
    total, so_far = Counter(), Counter()
    for s, n in sized:
        total[s] += n
    for s, n in (x for x in sized if x[1]):
        so_far[s] += n
        time = so_far[s] / total[s]
        assert all(so_far[o] <= time * total[o] + 1 for o in total if o != s)


def test_running_sums_over_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART_ROWS", 50)
    rows = [(i, "same" if i % 3 else str(i), i % 4) for i in range(1000)]
    table = spark.createDataFrame(rows, "row bigint, key string, n bigint").repartition(4)
    found = mixing.running(table, ["key", "row"], "n", []).orderBy("key", "row").collect()
    total = 0
    for r in found:
        assert r.before == total
        total += r.n
    assert len(found) == 1000


# -- pieces --------------------------------------------------------------------------


def test_pieces_equal_the_library_and_decode(docs, empty):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rows = pieces.decode(pieces.encode(docs, PIECE_MODEL), PIECE_MODEL).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r.ids == library.encode(r.text or "")
        assert r.decoded == (r.text or "").replace("▁", " ")
    assert pieces.encode(empty, PIECE_MODEL).count() == 0


def test_rare_segments_come_by_the_join(docs, monkeypatch):
    monkeypatch.setattr(pieces, "COMMON", 3)
    few = docs.sparkSession.createDataFrame([("a", 9), ("b", 5), ("c", 5), ("d", 1)], "segment string, n bigint")
    assert pieces.common_segments(few) == 5
    whole = sorted((str(r) for r in pieces.encode(docs, PIECE_MODEL).collect()))
    monkeypatch.setattr(pieces, "common_segments", lambda counts, most=0: None)
    assert sorted((str(r) for r in pieces.encode(docs, PIECE_MODEL).collect())) == whole


def test_rare_segments_of_equal_rows_are_looked_up_once(spark):
    text = " ".join(f"rare{i}word" for i in range(60))
    rows = spark.createDataFrame([(7, text)] * 300 + [(8, text + " more")], "doc_id bigint, text string")
    found = pieces.encode(rows, PIECE_MODEL).groupBy("doc_id").agg(
        F.count("*").alias("n"), F.count_distinct("ids").alias("lists")
    )
    assert sorted(map(tuple, found.collect())) == [(7, 300, 1), (8, 1, 1)]


def test_texts_are_cut_as_the_rule_says():
    model, mark = pieces.load(PIECE_MODEL), pieces.MARK
    one, beside = re.escape(model.loners), re.escape(model.signs)
    kinds = [rf"{mark}*[^{mark}{one}{beside}]+", rf"{mark}*[{beside}]+", rf"{mark}+", rf"[{one}]"]
    draw = random.Random(5)
    signs = [" ", " ", mark, "a", "bc", "\n", "1", ",", ".", "é", "日", "\t", "\0", " the", "😀"]
    texts = [None, "", " ", *("".join(draw.choices(signs, k=draw.randint(0, 12))) for _ in range(1500))]
    for some in (texts, [], [None], ["a b"]):
        cut = pieces.cut_texts(model, pa.array(some, pa.string()))
        names = cut.names.to_pylist()
        assert len(set(names)) == len(names)
        for text, a, b in zip(some, cut.starts, cut.starts[1:], strict=False):
            whole = re.findall("|".join(kinds), model.normalise(text)) if text else []
            assert [names[i] for i in cut.places[a:b]] == whole


def test_segments_met_once_are_not_moved_to_be_counted():
    texts = pa.array(["one two two", "two " + 2 * f" {'x' * 50}", None])
    found = pieces._count(pieces.load(PIECE_MODEL))(iter([pa.RecordBatch.from_arrays([texts], ["text"])]))
    assert [tuple(r.values()) for b in found for r in b.to_pylist()] == [("▁two", 3)]


def test_viterbi_equals_the_library_on_a_unigram_model(spark, docs, tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(PIECE_MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = pieces.UNIGRAM
    for i, piece in enumerate(model.pieces):
        if piece.type == pieces.NORMAL:
            piece.score = -8.0 - (i * 7919 % 10_007) / 3001 + 0.4 * len(piece.piece)
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as file:
        file.write(model.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in pieces.encode(docs, path).collect():
        assert r.ids == library.encode(r.text or "")


def test_public_files_are_where_they_should_be():
    assert public_tokenizers.path("piece_bpe_32k.model") == PIECE_MODEL
