"""Stages of the corpus pipeline on odd rows, and all of them against plain Python."""

from collections import Counter
from itertools import islice, product

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from shelfcast.llm import quality, toxicity
from shelfcast.llm.queries import PIECE_MODEL

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, severity string, "
    "kept int, _words string, _row string, row string, part string, copy string, ids string, n_words string"
)
CLASHES = ("s", 7, "w", "r", "row", "part", "copy", "ids", "n")
FIRST = ("river", "stone", "green", "early", "market", "window", "paper", "summer", "garden", "letter")
LAST = ("walks", "opens", "falls", "waits", "turns", "grows", "rests", "sings", "moves", "ends")


def prose(n, words=40):
    """A text of its own: no five words in a row as in another."""
    draw = [(n * 7919 + i * 104729 + i * i * (n + 3)) % 9973 for i in range(words)]
    return " ".join(f"{FIRST[d % 10]}{n} {LAST[d // 10 % 10]}" for d in draw)


def long_prose(words):
    """Words of which no two are alike."""
    return " ".join("".join(w) for w in islice(product("aeioulnrst", repeat=6), words))


def rows_of():
    clean = [(i, prose(i), "en", "abc"[i % 3]) for i in range(40)]
    copies = [(100 + i, prose(3), "en", "b") for i in range(4)] + [(3, prose(3), "en", "a")] * 3
    odd = [
        (200, None, "en", "a"), (201, "", "en", None), (202, " \n\t", None, "b"), (203, "short", "en", "c"),
        (204, long_prose(20_000), "en", "a"), (None, prose(300), "en", "b"), (None, prose(300), "en", "b"),
        (205, prose(205), None, None), (206, "again and again we go " * 30, "en", "a"),
    ]
    return [(*r, len(r[1] or ""), *CLASHES) for r in clean + copies + odd]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    """Documents, and labels of toxic and clean ones among them."""
    at = tmp_path_factory.mktemp("corpus")
    bad = [
        (400 + i, f"you utter filthgrub, vilescum {prose(400 + i)} filthgrub vilescum hatespit", "en", "b")
        for i in range(30)
    ]
    toxic = spark.createDataFrame([(*r, len(r[1]), *CLASHES) for r in bad], SCHEMA)
    docs.unionByName(toxic).write.parquet(str(at / "documents.parquet"))
    labels = [(i, 0) for i in range(40)] + [(400 + i, 1) for i in range(25)] + [(None, 1), (9999, 0)]
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(str(at / "labels.parquet"))
    return str(at)


def counted(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, docs, folder, name):
    found = dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), folder)
    assert found.count() == 0
    assert found.columns == (["doc_id", "n_pieces", "ids"] if name == "piece_encoding" else docs.columns)


def test_toxic_documents_go_and_all_others_stay(spark, docs, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    kept = corpus_pipeline.reject_toxic(spark, table, folder)
    assert kept.schema == table.schema
    left = counted(kept)
    assert left == counted(docs)  # toxic ones without a label are gone as well
    model = toxicity.train(table, spark.read.parquet(f"{folder}/labels.parquet"))
    rejected = toxicity.score(table.select("doc_id", "text"), model).filter("toxic_rejected")
    assert rejected.count() == 30 == rejected.filter("doc_id >= 400").count()


def test_rules_keep_rows_whole(spark, docs, folder):
    kept = counted(corpus_pipeline.apply_rules(spark, docs, folder))
    every = counted(docs)
    gone = every - kept
    assert not kept - every
    assert {r[0] for r in gone} == {200, 201, 202, 203, 206}
    judged = quality.judge(docs)
    assert "_words" in judged.columns and "_row" in judged.columns
    assert {r._words for r in judged.select("_words").collect()} == {"w"}
    assert not judged.filter("n_words IS NULL OR kept IS NULL").count()


def test_one_of_each_group_of_copies_stays(spark, docs, folder):
    kept = corpus_pipeline.drop_copies(spark, docs, folder)
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter({i: 1 for i in (*range(40), *range(200, 207))}) + Counter({None: 2})
    assert kept.schema == docs.schema


def test_mixing_keeps_columns_and_limits(spark, docs, folder):
    mixed = corpus_pipeline.mix_sources(spark, docs, folder)
    assert mixed.schema == docs.schema
    whole = {}
    for r in docs.collect():
        whole.setdefault((r.doc_id, r.source), []).append(r)
    for key, n in Counter((r.doc_id, r.source) for r in mixed.collect()).items():
        assert n <= 2 * len(whole[key])
    again = corpus_pipeline.mix_sources(spark, docs, folder)
    assert list(map(tuple, again.collect())) == list(map(tuple, mixed.collect()))


def test_encoding_equals_the_library(spark, docs, folder):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = Counter((r.doc_id, tuple(library.encode(r.text or ""))) for r in docs.collect())
    found = corpus_pipeline.encode_pieces(spark, docs, folder).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == texts
    assert all(r.n_pieces == len(r.ids) for r in found)


def test_whole_run(spark, docs, folder):
    found = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in found}
    assert ids <= {*range(40), 204, 205, None}
    per_doc = Counter(r.doc_id for r in found)
    assert max(n for i, n in per_doc.items() if i is not None) <= 2 and per_doc[None] <= 4
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    text_of = {r.doc_id: r.text for r in docs.filter("doc_id < 40 OR doc_id IN (204, 205)").collect()}
    same = 0
    for r in found:
        if r.doc_id is not None:
            decoded, text = library.decode(list(r.ids)), text_of[r.doc_id]
            assert text.startswith(decoded.strip())
            same += decoded.strip() == text
    assert len([r for r in found if r.doc_id is not None]) - same <= 4  # one cut a source at most
